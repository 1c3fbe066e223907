from __future__ import annotations

import numpy as np

from encore.llm import ann
from encore.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def exact(vectors, queries, k=10):
    ids = np.array([i for i, _ in vectors])
    m = np.array([v for _, v in vectors], dtype=np.float32).astype(np.float64)
    out = {}
    for q, v in queries:
        d = np.sqrt(((m - np.asarray(v, dtype=np.float32).astype(np.float64)) ** 2).sum(1))
        d, i = d[ids != q], ids[ids != q]
        best = np.lexsort((i, d))[:k]
        out[q] = list(zip(i[best].tolist(), d[best].tolist()))
    return out


def as_dict(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_against_brute_force(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = as_dict(ann.search(vectors, vectors.where("vec_id % 20 = 0")))
    wanted = exact(rows, [r for r in rows if r[0] % 20 == 0])
    assert set(found) == set(wanted)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    scores = {(q, i): d for q in wanted for i, d in wanted[q]}
    assert all(scores[q, i] == d for q in found for i, d in found[q] if (q, i) in scores)


def test_recall_of_a_part_of_the_rows(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.6 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(4000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = as_dict(ann.search(frame, frame.where("vec_id % 100 = 0"), share=0.1, least_rows=0))
    wanted = exact(rows, rows[::100])
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 10 * len(wanted)


def test_large_cells_are_split_and_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 20)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(200)] + [(1000 + i, [float(i), -1.0, 0.5]) for i in range(50)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = as_dict(ann.search(frame, frame.where("vec_id IN (0, 150)")))
    assert found[0] == [(i, 0.0) for i in range(1, 11)] and found[150] == [(i, 0.0) for i in range(10)]


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (9, [0.0, 3.0]), (9, [0.0, 4.0]), (0, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", cell int")
    found = as_dict(ann.search(frame, frame))
    assert set(found) == {0, 1, 9}
    assert [i for i, _ in found[1]] == [0, 0, 9, 9] and found[0][0] == (1, 1.0)
    assert [d for _, d in found[9]] == [np.sqrt(10.0)] * 2 + [np.sqrt(13.0)]


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert ann.search(frame, frame).count() == 0


def test_cells_are_walked_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    books = (rng.normal(size=(6, 2)), rng.normal(size=(5, 2)))
    q, counts = rng.normal(size=4), rng.integers(0, 3, 30)
    sums = [((books[0][c // 5] - q[:2]) ** 2).sum() + ((books[1][c % 5] - q[2:]) ** 2).sum() for c in range(30)]
    order = [c for c in np.argsort(sums) if counts[c]]
    assert ann.walk(q, books, counts, 10 ** 9) == order
    assert ann.walk(q, books, counts, 1) == order[:1]
