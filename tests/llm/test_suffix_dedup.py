from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from encore.llm import suffix_dedup as s


def by_hand(rows, length):
    """(id, bytes, spans, digest) of each row, comparing every window with those of smaller ids."""
    least = {}
    big = 1 << 63
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            k = b[p:p + length]
            least[k] = min(least.get(k, big), big - 1 if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p:p + length]] < (big - 1 if i is None else i):
                gone[p:p + length] = b"\1" * length
        spans = [(p, next((q for q in range(p, len(b)) if not gone[q]), len(b))) for p in range(len(b)) if gone[p] and not (p and gone[p - 1])]
        out.append((i, len(b), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted([(r.doc_id, r.n_bytes, [tuple(x) for x in r.spans], r.kept_sha256) for r in frame.collect()], key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "and", "tion", "élan", "naïve", "über", "a", "x"]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choices(words + [str(rng.random())], k=rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        rows.append((rng.choice([i, i, i, 5, None]), " ".join(parts)))
    return rows + [(70, rows[0][1]), (71, rows[0][1]), (72, None), (73, ""), (74, "ab" * 200), (75, "ab" * 150), (76, "x" * 49)]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_window_of_smaller_ids_goes(spark, seed):
    rows = corpus(seed)
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, chunk int").repartition(3)
    done = s.without_repeats(frame, keep=["chunk"], chunk_bytes=400)
    assert found(done) == by_hand(rows, 50)
    assert done.columns == ["doc_id", "chunk", "n_bytes", "spans", "kept", "kept_sha256"]
    for r in done.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_large_numbers_beside_nulls(spark):
    big = (1 << 62) + 1
    rows = [(big + i, "x" * 60, None if i % 2 else big + i) for i in range(40)] + [(None, "x" * 60, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long")
    found = {(r.doc_id, r.n): [tuple(x) for x in r.spans] for r in s.without_repeats(frame, keep=["n"]).collect()}
    assert found == {(i, n): [] if i == big else [(0, 60)] for i, _, n in rows}


def test_whole_characters_stay_text(spark):
    rows = [(1, "é" * 40 + "a"), (2, "xx" + "é" * 40 + "ü" * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in s.without_repeats(frame, whole_characters=True).collect():
        r.kept.decode()
    assert s.inner_characters("aéü".encode(), 2, 4) == (3, 3)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert s.without_repeats(empty).count() == 0


def test_levels_are_few_and_know_the_least_id():
    rng = np.random.default_rng(1)
    family, seen = s.Levels(), {}
    for i in range(40):
        keys = rng.integers(0, 3000, 200).astype(np.uint64)
        ids = np.full(200, i)
        assert family.add(keys, ids).tolist() == [k in seen for k in keys.tolist()]
        for k in keys.tolist():
            seen.setdefault(k, i)
        assert len(family.arrays) <= 8
    merged = {k: d for keys, ids in family.arrays[::-1] for k, d in zip(keys.tolist(), ids.tolist())}
    assert merged == seen


def test_long_texts_have_the_same_anchors_block_by_block(monkeypatch):
    data = np.frombuffer(random.Random(3).randbytes(5000), dtype=np.uint8)
    whole = s.anchors(data)
    monkeypatch.setattr(s, "BLOCK_BYTES", 700)
    parts = s.anchors(data)
    of = lambda a: {p: h for h, x, y in zip(*a) for p in range(x, y)}
    assert of(whole) == of(parts) and len(of(whole)) == 4951
