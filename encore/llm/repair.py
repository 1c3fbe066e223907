"""Conversation structure repair by dynamic programming with square-root checkpoints.

Turns are kept, given another role, deleted, or inserted, so that the roles of a conversation read: a system turn
or none, then pairs of a user and an assistant turn, or nothing at all. Costs from a place on depend only on the place and
on one of four states, so a backward vector of four costs is all that a place needs.

Distinct turns are sorted over the cluster and cut into blocks of about the square root of their number. A block gives a matrix of
costs from state to state; a backward walk over a conversation's matrices gives the vectors at its checkpoints, the ends of blocks.
Each block is then recomputed on its own between its checkpoints, walking forward from each state; a forward walk over the blocks says
which state each one starts from. So a conversation of any length is worked on by many tasks, one of which holds a block at most;
the walks over blocks stream.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Fixed costs of edits, and of a truncated turn that stays.
COSTS, TRUNCATED_COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}, 1
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The role a state asks for next, and the state after it.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (USER, USER, ASSISTANT, USER)
#: State after a kept turn, by state and initial of its role.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = ("su", "ua", "au")
ENDLESS = 1 << 60
#: Turns of a block, at least; it grows with the square root of the number of turns.
LEAST_BLOCK = 1024

#: Kinds of turns, in the order in which faults count.
GOOD, BLANK, DUPLICATE, TRUNCATED = range(4)
SPACE = r"\x20\x09-\x0D"


def with_inserts(costs: Sequence[int]) -> list[int]:
    """Costs at a place where turns may be inserted before going on as ``costs`` say."""
    user, assistant = costs[USER], costs[ASSISTANT]
    user, assistant = min(user, assistant + COSTS[INSERT]), min(assistant, user + COSTS[INSERT])
    return [min(costs[START], user + COSTS[INSERT]), min(costs[SYSTEM], user + COSTS[INSERT]), user, assistant]


#: Costs after the last turn: nothing, or a pair's end.
AT_END = with_inserts([0, ENDLESS, ENDLESS, 0])


def before(costs: Sequence[int], letter: str, kind: int, times: int) -> list[int]:
    """Costs before a turn (repeated ``times`` times, if it has to go) from those after it."""
    if kind in (BLANK, DUPLICATE):
        return [c + COSTS[DELETE] * times for c in costs]
    stays = TRUNCATED_COST if kind == TRUNCATED else 0
    out = []
    for state in range(STATES):
        best = min(costs[state] + COSTS[DELETE], costs[NEXT_STATE[state]] + COSTS[REROLE] + stays)
        kept = KEPT.get((state, letter))
        out.append(best if kept is None else min(best, costs[kept] + COSTS[KEEP] + stays))
    return with_inserts(out)


def matrix(turns: Sequence[tuple[str, int, int]]) -> list[int]:
    """Cheapest costs from each state before the turns to each state after them, row by row."""
    columns = []
    for state in range(STATES):
        costs = [0 if s == state else ENDLESS for s in range(STATES)]
        for turn in reversed(turns):
            costs = before(costs, *turn)
        columns.append(costs)
    return [columns[to][start] for start in range(STATES) for to in range(STATES)]


def joined(costs: Sequence[int], through: Sequence[int]) -> list[int]:
    """Costs before a block from its matrix and the costs after it."""
    return [min(through[STATES * s + to] + costs[to] for to in range(STATES)) for s in range(STATES)]


def walk(turns: Sequence[tuple[str, int, int]], after: Sequence[int], last: bool) -> tuple[list[int], list[str]]:
    """(state after the block, ASCII-least tight edits) from each state before it; ``after`` are the costs after the block."""
    vectors = [list(after)]
    for turn in reversed(turns):
        vectors.append(before(vectors[-1], *turn))
    vectors.reverse()
    ends, edits = [], []
    for state in range(STATES):
        out: list[str] = []
        at = 0
        while at < len(turns) or (last and vectors[at][state] > 0):
            here = vectors[at][state]
            insert = NEXT_STATE[state] if COSTS[INSERT] + vectors[at][NEXT_STATE[state]] == here else None
            if at == len(turns):
                out.append(INSERT)
                state = NEXT_STATE[state]
                continue
            letter, kind, times = turns[at]
            following = vectors[at + 1]
            if kind in (BLANK, DUPLICATE):
                out.append(DELETE * times)  # tight in every state, and the least edit
                at += 1
                continue
            kept = KEPT.get((state, letter))
            stays = TRUNCATED_COST if kind == TRUNCATED else 0
            if COSTS[DELETE] + following[state] == here:
                out.append(DELETE)
            elif insert is not None:
                out.append(INSERT)
                state = insert
                continue
            elif kept is not None and COSTS[KEEP] + stays + following[kept] == here:
                out.append(KEEP)
                state = kept
            else:
                out.append(REROLE)
                state = NEXT_STATE[state]
            at += 1
        ends.append(state)
        edits.append("".join(out))
    return ends, edits


def has_text(text: Column) -> Column:
    return F.rlike(text, F.lit(f"[^{SPACE}]"))


def is_finished(text: Column) -> Column:
    return F.rlike(text, F.lit(rf"[.!?][{SPACE}]*\z"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(records: Iterator[dict], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    waiting: list[dict] = []
    for record in records:
        waiting.append(record)
        if len(waiting) == size:
            yield pa.RecordBatch.from_pylist(waiting, schema)
            waiting = []
    yield pa.RecordBatch.from_pylist(waiting, schema)


def _each(df: DataFrame, run, schema: str) -> DataFrame:
    """``run`` from an iterator of rows (dicts) to one, for each partition."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(run(_records(batches)), arrow)

    return df.mapInArrow(mapped, schema)


KEY = ["conv_id", "turn", "role", "digest"]


def keyed(turns: DataFrame, times: str | None = None) -> DataFrame:
    """Turns with a digest of their text and how often each is repeated; nulls of role and text are one space."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    number = F.lit(1) if times is None else F.col(f"`{times}`")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"), number.cast("long").alias("times"))


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, kind, times): distinct keyed turns with their first fault; without their texts.

    Of ``times`` equal turns that are no blanks the first is of the kind, the others are duplicates.
    """
    text = F.col("text")
    kind = F.when(~has_text(text), BLANK).when(~is_finished(text), TRUNCATED).otherwise(GOOD)
    distinct = turns.select(*KEY, kind.alias("kind"), "times").groupBy(*KEY, "kind").agg(F.sum("times").alias("times"))
    first = distinct.where(F.col("kind") != BLANK).groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct("turn")).alias("first"))
    seen = (F.col("conv_id").eqNullSafe(F.col("c"))) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again = (F.col("kind") != BLANK) & (F.struct("turn") > F.col("first"))
    return distinct.join(first, seen, "left").select(
        *KEY, F.when(again, DUPLICATE).otherwise(F.col("kind")).alias("kind"), "times")


TURN = "struct<turn:bigint,role:string,digest:binary,kind:int,times:bigint>"


def _entries(turns: Sequence[dict]) -> list[tuple[str, int, int]]:
    """(initial, kind, times) of a block's turns; the repeats of one that stays are duplicates of their own."""
    out = []
    for t in turns:
        letter, kind, times = t["role"][:1], t["kind"], t["times"]
        if kind in (BLANK, DUPLICATE):
            out.append((letter, kind, times))
        else:
            out.append((letter, kind, 1))
            if times > 1:
                out.append((letter, DUPLICATE, times - 1))
    return out


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, part, turns, through): blocks of consecutive turns of a conversation with their matrices; parts ascend."""
    turns = checkpointed(turns)  # counted, and sampled for the ranges
    size = max(LEAST_BLOCK, math.isqrt(turns.count()))
    ordered = turns.repartitionByRange(*KEY).sortWithinPartitions(*KEY)

    def cut(rows: Iterator[dict]) -> Iterator[dict]:
        part = TaskContext.get().partitionId() << 40
        held: list[dict] = []

        def done() -> dict:
            return {"conv_id": held[0]["conv_id"], "part": part, "turns": held, "through": matrix(_entries(held))}

        for row in rows:
            if held and (len(held) == size or held[0]["conv_id"] != row["conv_id"]):
                yield done()
                part, held = part + 1, []
            held.append(row)
        if held:
            yield done()

    # places depend on the partitions of this run, so the blocks are written once
    return checkpointed(_each(ordered, cut, f"conv_id bigint, part bigint, turns array<{TURN}>, through array<bigint>"))


def _runs(rows: Iterator[dict]) -> Iterator[tuple[dict, bool]]:
    """(row, whether it is the first of its conversation) of sorted rows."""
    conversation, started = None, False
    for row in rows:
        yield row, not started or row["conv_id"] != conversation
        conversation, started = row["conv_id"], True


def checkpoints(pieces: DataFrame) -> DataFrame:
    """(part, after, last): the backward costs at the end of each block, by a walk from the last one."""
    def back(rows: Iterator[dict]) -> Iterator[dict]:
        costs = AT_END
        for row, last in _runs(rows):
            costs = AT_END if last else costs
            yield {"part": row["part"], "after": costs, "last": last}
            costs = joined(costs, row["through"])

    ordered = pieces.select("conv_id", "part", "through").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"))
    return _each(ordered, back, "part bigint, after array<bigint>, last boolean")


COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns", "cost"]
_COUNTED = ", ".join(f"{c} bigint" for c in COUNTS)


def _counts(turns: Sequence[dict]) -> dict:
    """Faults, steps between illegal neighbours and distinct turns within a block."""
    entries = _entries(turns)
    kinds = [sum(times for _, k, times in entries if k == kind) for kind in (BLANK, DUPLICATE, TRUNCATED)]
    run = [(t["role"][:1], t["times"]) for t in turns]
    illegal = sum(n - 1 for letter, n in run if letter * 2 not in LEGAL) + sum(
        a + b not in LEGAL for (a, _), (b, _) in zip(run, run[1:]))
    known = [t["turn"] for t in turns if t["turn"] is not None]
    return {**dict(zip(COUNTS, kinds)), "illegal": illegal, "turns": len(set(known)),
            "least": min(known, default=None), "most": max(known, default=None), "first": run[0][0], "final": run[-1][0]}


def edited(pieces: DataFrame) -> DataFrame:
    """(conv_id, part, state, edits, counts) of every block: its state at the start and its edits, one letter each."""
    shape = (f"conv_id bigint, part bigint, ends array<int>, edits array<string>, {_COUNTED}, least bigint, most bigint, "
             "first string, final string")

    def recompute(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            ends, edits = walk(_entries(row["turns"]), row["after"], row["last"])
            yield {"conv_id": row["conv_id"], "part": row["part"], "ends": ends, "edits": edits, "cost": 0, **_counts(row["turns"])}

    tried = _each(pieces.select("conv_id", "part", "turns").join(checkpoints(pieces), "part"), recompute, shape)

    def forward(rows: Iterator[dict]) -> Iterator[dict]:
        state, before_it = START, {}
        for row, first in _runs(rows):
            state = START if first else state
            if not first:
                row["illegal"] += before_it["final"] + row["first"] not in LEGAL
                row["turns"] -= row["least"] is not None and row["least"] == before_it["most"]
            edits = row["edits"][state]
            cost = sum(edits.count(e) * c for e, c in COSTS.items())
            yield {**{c: row[c] for c in ("conv_id", "part", *COUNTS, "least", "most")}, "state": state, "edits": edits, "cost": cost}
            state = row["ends"][state]
            before_it = {**row, "most": before_it.get("most") if row["most"] is None and not first else row["most"]}

    ordered = tried.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return _each(ordered, forward, f"conv_id bigint, part bigint, state int, edits string, {_COUNTED}, least bigint, most bigint")


EDIT = "conv_id bigint, part bigint, place bigint, edit string, new_role string, truncated boolean, turn bigint, role string, digest binary"


def edits_of(pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row for each edit of each block, in order of (part, place): the turn it is about and the role it gives."""
    def spread(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            state, at, left = row["state"], 0, 0
            turns = row["turns"]
            for place, edit in enumerate(row["edits"]):
                out = {"conv_id": row["conv_id"], "part": row["part"], "place": place, "edit": edit, "new_role": None,
                       "truncated": False, "turn": None, "role": None, "digest": None}
                if edit == INSERT:
                    out["new_role"], state = NEXT_ROLE[state], NEXT_STATE[state]
                    yield out
                    continue
                turn = turns[at]
                left = (left or turn["times"]) - 1
                at += left == 0
                out |= {"turn": turn["turn"], "role": turn["role"], "digest": turn["digest"],
                        "truncated": turn["kind"] == TRUNCATED and edit != DELETE}
                if edit == KEEP:
                    out["new_role"], state = turn["role"], KEPT[state, turn["role"][:1]]
                elif edit == REROLE:
                    out["new_role"], state = NEXT_ROLE[state], NEXT_STATE[state]
                yield out

    both = pieces.select("conv_id", "part", "turns").join(chosen.select("part", "state", "edits"), "part")
    return _each(both, spread, EDIT)


class Repair:
    """What a repair found: written tables, each read lazily.

    ``edits``: one row (conv_id, part, place, edit, new_role, truncated, turn, role, digest) for each edit.
    ``blocks``: faults, costs and the edits' letters by block of a conversation, in order of ``part``.
    """

    def __init__(self, turns: DataFrame, times: str | None = None):
        self.turns = keyed(turns, times)
        pieces = blocks(faults(self.turns))
        self.blocks = checkpointed(edited(pieces))
        self.edits = checkpointed(edits_of(pieces, self.blocks))

    def messages(self) -> DataFrame:
        """(conv_id, part, place, edit, role, text) of the repaired conversations, in order of (part, place)."""
        stays = self.edits.where(F.col("edit").isin(KEEP, REROLE))
        texts = self.turns.groupBy(*KEY).agg(F.first("text").alias("text"))
        texts = texts.select(*[F.col(c).alias(f"_{c}") for c in KEY], "text")
        same = (F.col("conv_id").eqNullSafe(F.col("_conv_id"))) & (F.col("turn").eqNullSafe(F.col("_turn"))) & (
            F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
        out = ["conv_id", "part", "place", "edit", F.col("new_role").alias("role")]
        return stays.join(texts, same).select(*out, "text").union(
            self.edits.where(F.col("edit") == INSERT).select(*out, F.lit("").alias("text")))

    def report(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of the conversations that have turns.

        ``gaps`` counts numbers missing between the least and the greatest turn, ``illegal`` neighbours whose roles may not follow
        each other, ``audit`` has the letters of the edits. They are summed over blocks; only the letters of a conversation meet in one place.
        """
        extra = self.edits.where("truncated").groupBy("conv_id").agg(F.count("*").alias("kept_truncated"))
        letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "edits"))), lambda p: p["edits"]), "")
        sums = [F.sum(c).alias(c) for c in COUNTS]
        whole = self.blocks.groupBy("conv_id").agg(*sums, F.min("least").alias("least"), F.max("most").alias("most"), letters.alias("audit"))
        gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
        cost = F.col("cost") + F.coalesce("kept_truncated", F.lit(0)) * TRUNCATED_COST
        named = extra.withColumnRenamed("conv_id", "c")
        return whole.join(named, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
            "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", cost.alias("cost"), "audit")


def repair(turns: DataFrame, times: str | None = None) -> Repair:
    """Repair the conversations of turns (conv_id, turn, role, text); ``times`` names a column of a turn's repetitions, others are left aside.

    Turns are taken in order of ``turn``, nulls first, equal ones in order of role and text digest. A turn's first fault counts: blank (no text
    but white space), duplicate (role and text seen earlier), truncated (its last character but white space ends no sentence). Keeping a turn costs 0,
    giving it the role user or assistant 2, deleting it 3, inserting an empty one 2; blanks and duplicates have to go, a truncated
    turn that stays costs 1 more. Of the cheapest edits the ASCII-least row of letters is taken. Null roles and texts are one space, null
    conversations are one conversation. Texts and conversations of any length; no turns give no rows.
    """
    return Repair(turns, times)


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with one of five faults made in a quarter of them, chosen by a checksum of conversation and turn (nulls: one space)."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(name) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where(
        "fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("times"))


def digests(messages: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of ``role:text`` of a conversation's messages, joined by line breaks; read as a stream, never held."""
    def hashed(rows: Iterator[dict]) -> Iterator[dict]:
        sha, now = None, None
        for row, first in _runs(rows):
            if first:
                if sha is not None:
                    yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}
                sha, now = hashlib.sha256(), row["conv_id"]
            else:
                sha.update(b"\n")
            sha.update(f"{row['role']}:{row['text']}".encode())
        if sha is not None:
            yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}

    ordered = messages.select("conv_id", "part", "place", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "place")
    return _each(ordered, hashed, "conv_id bigint, repaired_sha256 string")
