"""Toxicity by a weighted finite-state pattern grammar.

Words become class symbols (insult, threat, target, negation, reported speech, other);
small transducers rewrite the symbols of a clause one after another and are composed
into a single machine: negation, reported speech, then targets. What leaves the machine are matched patterns with
weights, so an insult counts less where it is negated or reported and more where it is aimed at
someone. A text is scored by the weights of its matched clauses.

Insults are learnt: words and word beginnings that labelled texts show to be toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed, named, small_batches

#: Labelled rows of each class that the lexicon and the weights are fitted on, about, at most.
ROWS_PER_CLASS = 10_000
HELD_OUT_OF, HELD_OUT = 4, 2
#: Lengths of word beginnings that are features beside whole words.
STEMS = (4, 5, 6, 7)
#: A feature of the lexicon is in this share of toxic texts at least, and so many times likelier in them (log odds).
SUPPORT, LEAST_TEXTS, LEAST_ODDS = 0.01, 5, 4.0
LEXICON = 5_000
FEATURES_AT_ONCE = 100_000
THRESHOLD = 0.3
#: Evidence that more of it adds nothing to.
FULL = 8.0
#: Weights without labelled texts of both classes: all texts score alike, below the threshold.
UNLEARNT = (-3.0, 0.0, 0.0)

#: Fixed word lists of the classes that are not learnt.
NEGATIONS = "not no never nobody none isn aren wasn weren don doesn nicht kein keine nie niemals pas jamais ne nunca jamás ni".split()
REPORTS = "said says wrote claimed claims called quoted quote asked told sagte schrieb behauptet dit écrit affirmé dijo escribió afirma".split()
TARGETS = "you your yours they them he she him her we us people du dich dir ihr euch sie er tu toi vous ils elles il elle tú usted ustedes ellos ellas".split()
THREATS = "kill murder shoot stab destroy burn hang beat hurt töten erschießen umbringen schlagen tuer frapper brûler matar golpear quemar".split()

WORD = re.compile(r"\w+")
TOKEN = re.compile(r"\w+|[.!?;:\n]+")

#: Share of an insult's weight that a pattern counts for.
PATTERNS = {"insult": 1.0, "targeted": 1.3, "negated": 0.6, "reported": 0.8, "threat": 0.2, "targeted threat": 0.6}


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1, start 0; ``moves[state][symbol] = (next state, symbol written, factor)``.

    A symbol without a move is written unchanged and the state falls back by one towards 0.
    """

    states: int
    moves: dict[int, dict[str, tuple[int, str, float]]]

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.moves.get(state, {}).get(symbol) or (max(0, state - 1), symbol, 1.0)


def compose(first: Transducer, second: Transducer, alphabet: Sequence[str]) -> Transducer:
    """The transducer that runs the second on what the first writes; factors multiply."""
    moves: dict[int, dict[str, tuple[int, str, float]]] = {}
    for a in range(first.states):
        for b in range(second.states):
            row = moves.setdefault(a * second.states + b, {})
            for symbol in alphabet:
                to, middle, x = first.step(a, symbol)
                then, written, y = second.step(b, middle)
                row[symbol] = (to * second.states + then, written, x * y)
    return Transducer(first.states * second.states, moves)


ALPHABET = ("other", "insult", "threat", "target", "negation", "report")


def grammar(patterns: dict[str, float] = PATTERNS) -> Transducer:
    """Negation reaches three words, reported speech to the end of the clause, a target four words."""
    negated = {"insult": (2, "negated", 1.0), "threat": (2, "other", 1.0)}
    negation = Transducer(4, {0: {"negation": (3, "other", 1.0)}} | {
        s: {"negation": (3, "other", 1.0), **negated} for s in (1, 2, 3)})
    inside = {s: (1, s, 1.0) for s in ("other", "target", "negated", "report")}
    reported = Transducer(2, {0: {"report": (1, "other", 1.0)},
                              1: inside | {"insult": (1, "reported", 1.0), "threat": (1, "other", 1.0)}})
    aimed = {"insult": (4, "targeted", 1.0), "threat": (4, "targeted threat", 1.0), "target": (4, "other", 1.0)}
    target = Transducer(5, {0: {"target": (4, "other", 1.0)}} | {s: aimed for s in (1, 2, 3, 4)})
    written = Transducer(1, {0: {p: (0, p, f) for p, f in patterns.items()}})
    machine = compose(compose(negation, reported, ALPHABET), target, ALPHABET)
    return compose(machine, written, ALPHABET)


@dataclass
class Model:
    """The learnt lexicon (feature to weight) and the weights of a text's evidence."""

    lexicon: dict[str, float]
    weights: tuple[float, float, float]

    def __post_init__(self):
        self.machine = grammar()
        self.classes = {w: (c, 1.0) for c, words in (
            ("negation", NEGATIONS), ("report", REPORTS), ("target", TARGETS), ("threat", THREATS)) for w in words}
        self.seen: dict[str, bool] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        """Class and weight of a lower-cased word; of its features the longest that the lexicon has."""
        if (found := self.lexicon.get(word)) is not None:
            return "insult", found
        for n in reversed(STEMS):
            if len(word) >= n and (found := self.lexicon.get(word[:n] + "*")) is not None:
                return "insult", found
        return self.classes.get(word, ("other", 0.0))

    def counts(self, word: str) -> bool:
        """Whether a word alone can make a pattern."""
        known = self.seen.get(word)
        if known is None:
            if len(self.seen) > FEATURES_AT_ONCE:
                self.seen.clear()
            known = self.seen[word] = self.symbol(word)[0] in ("insult", "threat")
        return known

    def evidence(self, text: str) -> float:
        """Sum over the clauses of the weights of matched patterns; a clause counts no more than its three strongest."""
        lowered = text.lower()
        if not any(map(self.counts, set(WORD.findall(lowered)))):
            return 0.0
        total, state, clause = 0.0, 0, []
        for token in TOKEN.findall(lowered):
            if token[0] in ".!?;:\n":
                total += sum(sorted(clause, reverse=True)[:3])
                state, clause = 0, []
                continue
            symbol, weight = self.symbol(token)
            state, written, factor = self.machine.step(state, symbol)
            if written in PATTERNS:
                clause.append(weight * factor)
        return total + sum(sorted(clause, reverse=True)[:3])

    def score(self, text: str) -> float:
        """Between 0 and 1."""
        x = features(np.array([self.evidence(text)]))[0]
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, float(x @ np.array(self.weights))))))


def features(evidence: np.ndarray) -> np.ndarray:
    """Constant, whether any pattern matched, and the size of the evidence, full from about one plain insult on."""
    return np.stack([np.ones(len(evidence)), evidence > 0, np.minimum(evidence, FULL) / FULL], axis=1)


def text_features(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def fitted(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton's method; classes weigh as they are in the labels."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def held_out(id: Column) -> Column:
    """Rows never learnt from: those whose crc32 of the id as text leaves the remainder ``HELD_OUT``."""
    return F.coalesce(F.crc32(id.cast("string")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def learn(
    documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
) -> Model:
    """Lexicon and weights from labelled rows that are not held out.

    About ``rows_per_class`` rows of each class at most, picked by a hash of the id; texts
    that repeat count once in the lexicon. Rows with a null id, null label or null text teach nothing; of several
    labels of one id the highest counts. Without toxic or without other rows the model has an empty
    lexicon and scores all texts alike, below the threshold.
    """
    spark = documents.sparkSession
    small_batches(spark)
    ids = named(labels, [id, label]).toDF("id", "y").where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    ids = ids.where(~held_out(F.col("id")))
    sizes = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, min(1.0, rows_per_class / n)).otherwise(share)
    picked = ids.where(F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1_000_000)) < share * 1_000_000)
    # about two times rows_per_class rows, by the share above
    sample = documents.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").join(
        F.broadcast(picked), "id")
    sample = checkpointed(sample)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            keys = list(found[0].keys() | found[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([found[1][k] for k in keys], pa.int64()),
                 pa.array([found[0][k] for k in keys], pa.int64())], names=["feature", "toxic", "other"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[y > 0].update(text_features(text))
                if len(found[0]) + len(found[1]) > FEATURES_AT_ONCE:
                    yield rows()
                    found[0].clear(), found[1].clear()
        yield rows()

    texts = sample.groupBy(F.sha2("text", 256).alias("h")).agg(F.first("text").alias("text"), F.max("y").alias("y"))
    texts = texts.select("text", F.col("y").cast("long").alias("y"))
    n = {r["y"] > 0: r["count"] for r in sample.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(
        F.count_distinct(F.sha2("text", 256)).alias("count")).collect()}
    n1, n0 = n.get(True, 0), n.get(False, 0)
    if not n1 or not n0:
        return Model({}, UNLEARNT)
    totals = texts.mapInArrow(counted, "feature string, toxic long, other long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("other") + 0.5) / (n0 + 1.0))
    known = totals.withColumn("odds", odds).where(
        (F.col("toxic") >= max(LEAST_TEXTS, SUPPORT * n1)) & (F.col("odds") >= LEAST_ODDS)
    ).orderBy(F.desc("toxic"), "feature").limit(LEXICON)
    lexicon = {r["feature"]: float(r["odds"]) for r in known.select("feature", "odds").collect()}
    model = Model(lexicon, (0.0, 0.0, 0.0))
    shared = spark.sparkContext.broadcast((lexicon, model.weights))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            x = [own.evidence(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], names=["x", "y"])

    seen = sample.select("text", (F.col("y") > 0).cast("int").alias("y")).mapInArrow(weighed, "x double, y int")
    data = seen.groupBy("x", "y").count().toPandas()  # of the bounded sample
    x, y = np.repeat(data["x"].to_numpy(), data["count"]), np.repeat(data["y"].to_numpy(), data["count"])
    return Model(lexicon, fitted(features(x), y))


def score(
    rows: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",), threshold: float = THRESHOLD
) -> DataFrame:
    """Columns ``keep`` of every row with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Whole texts are read; a null text is empty and has no evidence. Repeated rows stay repeated, no
    rows give none; columns outside ``keep`` are left aside, a kept one named like a result gives way.
    """
    keep = [c for c in keep if c not in ("score", "predicted")]
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast((model.lexicon, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            s = [own.score(t.as_py() or "") for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(s, pa.float64())], names=[*keep, "score"])

    types = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    scored = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text")).mapInArrow(
        run, ", ".join([*types, "score double"]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
