from __future__ import annotations

import random
import zlib

import pytest

from encore.llm import toxicity as t

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def made_up(n=600):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice("ab cd ef gh of the and on it".split()) + rng.choice(["", "", "ly", str(i % 97)]) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randint(0, 40), rng.choice(["grubnix", "Grubnixen", "grubnixity", "vladdo"]))
        docs.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = made_up()
    documents, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = t.learn(documents, marks)
    assert "grub*" in model.lexicon and "vladdo" in model.lexicon
    truth = {i: y for i, _, y in labels}
    held = [r for r in t.score(documents, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100 and all(r.predicted == truth[r.doc_id] for r in held)
    assert all((r.score >= t.THRESHOLD) == (r.predicted == 1) and 0 <= r.score <= 1 for r in held)


def test_held_out_labels_are_never_learnt_from(spark):
    docs, labels = made_up()
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    flipped = [(i, q, 1 - y if out(i) else y) for i, q, y in labels]
    documents = spark.createDataFrame(docs, DOCS)
    a, b = (t.learn(documents, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a.lexicon == b.lexicon and a.weights == b.weights
    ids = spark.createDataFrame([(i,) for i, _ in docs] + [(None,)], "id long")
    for r in ids.select("id", t.held_out(ids["id"]).alias("h")).collect():
        assert r.h == (r.id is not None and out(r.id))


@pytest.fixture(scope="module")
def model():
    return t.Model({"idiot": 8.0, "mor*": 1.0, "moro*": 6.0}, (-5.0, 2.0, 6.0))


def test_patterns_weigh_clauses(model):
    plain = model.evidence("he was an old and tired idiot today")
    weight = lambda p: 8.0 * t.PATTERNS[p]
    assert model.evidence("Some IDIOT came") == weight("insult")
    assert plain == weight("insult")  # the target is too far away
    assert model.evidence("you idiot") == weight("targeted")
    assert model.evidence("not an idiot") == weight("negated")
    assert model.evidence("not today. an idiot") == weight("insult")
    assert model.evidence("a paper wrote idiot") == weight("reported")
    assert model.evidence("a paper wrote much; idiot") == weight("insult")
    assert model.evidence("kind words") == 0.0 and model.evidence("") == 0.0
    assert model.evidence("moronic") == 6.0 and model.evidence("morals") == 0.0
    assert model.score("you idiot") > model.score("an idiot") - 1e-12 > model.score("nothing")


def test_composition_is_one_after_the_other():
    first = t.Transducer(2, {0: {"a": (1, "b", 2.0)}, 1: {"a": (0, "c", 1.0)}})
    second = t.Transducer(2, {0: {"b": (1, "x", 3.0)}, 1: {"c": (1, "y", 5.0)}})
    both, state, out = t.compose(first, second, ["a", "z"]), 0, []
    for symbol in "aaza":
        state, written, factor = both.step(state, symbol)
        out.append((written, factor))
    assert out == [("x", 6.0), ("y", 5.0), ("z", 1.0), ("x", 6.0)]


def test_nulls_ties_and_empty_tables(spark, rows, model):
    frame = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (None, "idiot", 0.1), (2, "", None)], "doc_id long, text string, score double")
    found = t.score(frame, model, keep=["doc_id", "score"]).collect()
    assert sorted([(r.doc_id, r.predicted) for r in found], key=repr) == [(1, 0), (1, 0), (2, 0), (None, 1)]
    assert t.score(frame.limit(0), model).count() == 0
    nothing = t.learn(frame, spark.createDataFrame([(1, 1, 1), (None, 1, 0), (2, None, None)], LABELS))
    assert nothing.lexicon == {} and len({r.score for r in t.score(frame, nothing).collect()}) == 1
    assert {r.predicted for r in t.score(frame, nothing).collect()} == {0}
    assert t.learn(frame.limit(0), spark.createDataFrame([], LABELS)).lexicon == {}
