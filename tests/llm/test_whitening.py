from __future__ import annotations

import math

import numpy as np
import pytest

from encore.llm import whitening as w
from encore.llm.common import table
from encore.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def check(rows, vectors, components=16):
    """Rows of ``whiten`` against numpy on the same vectors (id, vector)."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(x) for x in {tuple(x) for _, x in good}]
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, d)
    assert len(rows) == len(good) * k and {r.n for r in rows} == {n}
    found = {}
    for r in rows:
        found.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    signs = {}
    for i, x in good:
        wanted = np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ u[:, :k] / np.sqrt(e[:k])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for j in range(k):
            r = found[i][j + 1][0]
            sign = signs.setdefault(j, 1 if r.whitened * wanted[j] >= 0 else -1) if abs(wanted[j]) > 1e-6 else 1
            assert r.deviation == deviation
            assert r.explained == pytest.approx(e[j] / e.sum(), rel=1e-9)
            assert abs(abs(r.whitened) - abs(wanted[j])) < 1e-6
            if abs(wanted[j]) > 1e-6:
                assert r.whitened == pytest.approx(sign * wanted[j], abs=1e-6)
    assert max(r.identity_error for r in rows) < 1e-9


def test_given_vectors(spark):
    folder = "/root/testdata/sf0.001"
    vectors = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    check(QUERIES["op13_whitening"](spark, folder).collect(), vectors)


def test_several_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(w, "BLOCK_VALUES", 40)
    monkeypatch.setattr(w, "BLOCK_COLUMNS", 4)
    monkeypatch.setattr(w, "BLOCKS_PER_TASK", 2)
    rng = np.random.default_rng(3)
    vectors = [(i, [float(np.float32(c)) for c in rng.normal(size=6) * [5, 4, 3, 2, 1, .5]]) for i in range(90)]
    vectors += [(100, vectors[0][1]), (100, vectors[1][1])]  # repeated vectors, and a repeated id
    rows = w.whiten(spark.createDataFrame(vectors, SCHEMA).repartition(5), components=3).collect()
    assert len(rows) == 92 * 3
    check([r for r in rows if r.vec_id != 100], vectors[:90], 3)


def test_unusable_vectors_and_other_columns(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=3)]) for i in range(20)]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 2.0]), (53, [float("inf"), 0.0, 1.0]),
           (54, [1e30, 0.0, 0.0]), (55, [1.0, 2.0]), (56, [])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in good + bad], SCHEMA + ", y string, n int")
    check(w.whiten(frame).collect(), good)


def test_hot_vector_large_entries_and_no_variance(spark):
    same = w.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)] + [(None, [1.0, 2.0])], SCHEMA)).collect()
    assert len(same) == 12 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, 0.0, 0.0)}
    line = w.whiten(spark.createDataFrame([(0, [0.0, 1.0])] * 40 + [(1, [3.0, 1.0]), (2, [1.0, 1.0])], SCHEMA)).collect()
    assert len(line) == 84 and all((r.whitened is None) == (r.component == 2) for r in line)
    huge = spark.createDataFrame([(0, [2.0 ** 40, 0.0]), (1, [-2.0 ** 40, 1.0]), (2, [0.0, 2.0])], SCHEMA)
    rows = w.whiten(huge).collect()
    assert {r.vec_id: int(r.deviation) for r in rows}[0] == (3 * 64 * 2 ** 40) ** 2 + (64 * 3) ** 2


def test_no_rows(spark):
    frame = spark.createDataFrame([(1, None), (2, [])], SCHEMA)
    assert w.whiten(frame).collect() == [] and w.whiten(frame.limit(0)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
