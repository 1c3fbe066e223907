from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from encore.llm import repair as r
from encore.llm.common import table
from encore.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, letters) of the least edits of (initial, kind) rows, by recursion over all of them."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in (0, 3):
            found.append((0, ""))
        nxt = 3 if state == 2 else 2
        if inserted < 3:
            cost, letters = best(i, nxt, inserted + 1)
            found.append((cost + 2, "I" + letters))
        if i < len(rows):
            letter, kind = rows[i]
            cost, letters = best(i + 1, state, 0)
            found.append((cost + 3, "D" + letters))
            if kind not in ("blank", "duplicate"):
                more = kind == "truncated"
                cost, letters = best(i + 1, nxt, 0)
                found.append((cost + 2 + more, "R" + letters))
                if (state, letter) in step:
                    cost, letters = best(i + 1, step[state, letter], 0)
                    found.append((cost + more, "K" + letters))
        return min(found, default=(10 ** 6, ""))

    return best(0, 0, 0)


def expected(rows):
    """What the audit of one conversation's rows (turn, role, text), in order, must say, and its repaired messages."""
    seen, kinds = set(), []
    for _, role, text in rows:
        left = text.strip(SPACES)
        kinds.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = cheapest(tuple((role[:1], k) for (_, role, _), k in zip(rows, kinds)))
    at, state, messages = 0, 0, []
    for e in audit:
        if e == "I":
            messages.append("assistant:" if state == 2 else "user:")
            state = 3 if state == 2 else 2
            continue
        _, role, text = rows[at]
        at += 1
        if e == "D":
            continue
        if e == "R":
            role = "assistant" if state == 2 else "user"
        state = {"s": 1, "u": 2, "a": 3}[role[0]]
        messages.append(f"{role}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(messages).encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            role = "user" if fault == 4 else role
            text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
            out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def by_conversation(rows):
    found = {}
    order = sorted(rows, key=lambda t: (t[1] is not None, t[1] or 0, t[2], hashlib.sha256(t[3].encode()).digest()))
    for conv, *rest in order:
        found.setdefault(conv, []).append(tuple(rest))
    return found


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_given_conversations(spark):
    folder = "/root/testdata/sf0.01"
    given = [tuple(t) for t in table(spark, folder, "conversations").collect()]
    left = by_conversation(damage(given))
    wanted = {c: expected(left.get(c, [])) for c in {t[0] for t in given}}
    found = {row.conv_id: tuple(row[f] for f in FIELDS) for row in QUERIES["op12_conversation_repair"](spark, folder).collect()}
    assert found == wanted


def audited(spark, rows, schema=TURNS, times=None):
    found = r.repair(spark.createDataFrame(rows, schema).repartition(3), times)
    report, hashed = found.report().collect(), {h.conv_id: h.repaired_sha256 for h in r.digests(found.messages()).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {row.conv_id: (*[row[f] for f in FIELDS[:-1]], hashed.get(row.conv_id, nothing)) for row in report}


def random_rows(rng, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "u2", "", "tool", None]
    texts = ["a.", "b", "c!", " ", "", "Why?\n", "end. \t", " ", None, "d"]
    return [(conv, rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) if rng.random() < .5 else f"{rng.random()}.")
            for _ in range(n)]


@pytest.mark.parametrize("least", [1, 3, 1024])
def test_blocks_and_checkpoints(spark, monkeypatch, least):
    """Blocks of a few turns, so that conversations span many blocks and partitions."""
    monkeypatch.setattr(r, "LEAST_BLOCK", least)
    rng = random.Random(least)
    rows = [t for c in range(30) for t in random_rows(rng, c, rng.randrange(1, 9))] + random_rows(rng, None, 60) + random_rows(rng, 99, 120)
    filled = [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]
    assert audited(spark, rows) == {c: expected(t) for c, t in by_conversation(filled).items()}


def test_hot_repeated_turn_and_long_texts(spark):
    rows = [(1, 0, "user", "Hi.", 1), (1, 1, "assistant", "x" * 300_000 + ".", 1), (1, 1, "user", "same", 5000), (1, 2, "user", " ", 3)]
    found = audited(spark, rows, TURNS + ", n int", "n")
    assert found[1][:4] == (0, 3, 4999, 1) and found[1][6].count("D") == 5003 and len(found[1][6]) == 5005
    wanted = "user:Hi.\nassistant:" + "x" * 300_000 + "."
    assert found[1][7] == hashlib.sha256(wanted.encode()).hexdigest()


def test_clashing_columns_and_no_rows(spark):
    rows = [(1, 0, "user", "Hi.", "x", "y", "z"), (1, 1, "assistant", "Ho.", "x", "y", "z")]
    found = audited(spark, rows, TURNS + ", times string, digest string, kind string")
    assert found[1][:7] == (0, 0, 0, 0, 0, 0, "KK")
    empty = r.repair(spark.createDataFrame([], TURNS))
    assert empty.report().count() == 0 and empty.messages().count() == 0 and r.digests(empty.messages()).count() == 0
