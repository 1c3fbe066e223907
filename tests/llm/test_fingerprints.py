from __future__ import annotations

import hashlib
import random
import re

import pytest

from encore.llm import fingerprints as f
from encore.llm.common import table
from encore.llm.queries import QUERIES

DOCS = "doc_id long, text string"
def runs(words):
    return re.compile(r"(?:[^ \t\n\x0b\f\r]{1,24}+[ \t\x0b\f\r]+){0,%d}[^ \t\n\x0b\f\r]{1,24}" % (words - 1))


def paragraphs(text):
    text = text or ""
    return {*runs(4).findall(text[:160]), *runs(64).findall(text)}


def near(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def edits(texts):
    """Texts in order of id, with their edited versions and the texts after them."""
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        yield text, text[:len(text) - half] + following[:half], following


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = sorted((d.doc_id, d.text or "") for d in table(spark, folder, "documents").collect())
    found = {r.doc_id: r for r in QUERIES["op11_fingerprints"](spark, folder).collect()}
    assert len(found) == len(docs)
    for (i, _), (text, edited, following) in zip(docs, edits([t for _, t in docs])):
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == pytest.approx((near(text, edited), near(text, following)))
        assert (r.fingerprint == r.edited_fingerprint) == (paragraphs(text) == paragraphs(edited))
    same = {}
    for i, text in docs:
        assert same.setdefault(text, found[i].fingerprint) == found[i].fingerprint


def test_differing_digests_are_recovered(spark):
    rng = random.Random(1)
    common = [rng.getrandbits(63) for _ in range(300)]
    wanted = {}
    for n in (0, 1, 3, 8, 40, 700):
        wanted[n] = (common + [rng.getrandbits(63) for _ in range(n)], common + [-rng.getrandbits(63) for _ in range(n // 2)])
    wanted |= {1000: ([], common), 1001: ([], [])}
    frame = spark.createDataFrame([(i, *ab) for i, ab in wanted.items()], "id long, a array<long>, b array<long>")
    found = {r.id: r.b for r in f.differences(frame, ["id"], "a", ["b"]).collect()}
    assert 0 not in found and 1001 not in found
    for i, r in found.items():
        a, b = map(set, wanted[i])
        assert set(r.removed) <= a - b and set(r.added) <= b - a
        assert r.failed or (len(r.removed), len(r.added)) == (len(a - b), len(b - a)) == (r.n_removed, r.n_added)
    assert sum(r.failed for r in found.values()) <= 1
    again = {r.id: r.b for r in f.differences(frame, ["id"], "a", ["b"], 3, lists=False).collect()}
    assert all((not r.failed, r.n_removed) == (True, len(set(wanted[i][0]) - set(wanted[i][1]))) for i, r in again.items())


def test_failed_comparisons_are_tried_again_wider(spark, monkeypatch):
    """A first sketch far too small for most documents."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    key = lambda r: (r.doc_id, r.near_edited, r.near_next, sorted(r.removed_next), sorted(r.added_edited))
    wanted = sorted(map(key, f.compare_with_edits(docs).collect()))
    tried = []
    solved = f.solved
    monkeypatch.setattr(f, "solved", lambda *a: (tried.append(a[-1]), solved(*a))[1])
    monkeypatch.setattr(f, "ROUNDS", 3)
    assert sorted(map(key, f.compare_with_edits(docs).collect())) == wanted and len(tried) > 1


def test_order_nulls_repeats_and_clashing_columns(spark):
    rows = [(3, "c one. c two."), (None, "first of all."), (1, "a one.\na two."), (1, "a one.\na two."), (2, None), (7, "z" * 100_000 + " end. " * 9)]
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], DOCS + ", id string, n_chars int").repartition(3)
    found = sorted(f.compare_with_edits(frame).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in found] == [None, 1, 1, 2, 3, 7] and found[1] == found[2]
    texts = ["first of all.", "a one.\na two.", "", "c one. c two.", "z" * 100_000 + " end. " * 9]
    for r, (text, edited, following) in zip([found[0], *found[2:]], edits(texts)):
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == pytest.approx((near(text, edited), near(text, following)))


def test_one_and_no_documents(spark):
    one = f.compare_with_edits(spark.createDataFrame([(1, "abcd")], DOCS)).first()
    assert (one.edited_sha256, one.near_next) == (hashlib.sha256(b"abab").hexdigest(), 1.0)
    assert f.compare_with_edits(spark.createDataFrame([], DOCS)).count() == 0


def test_no_python_and_no_shuffle_of_cells(spark):
    frame = spark.createDataFrame([(1, [1, 2], [2, 3])], "id long, a array<long>, b array<long>").repartition(3, "id")
    plan = f.differences(frame, ["id"], "a", ["b"], lists=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "Python" not in plan and "InArrow" not in plan
