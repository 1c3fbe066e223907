from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from encore.llm import components, simhash as s


def fingerprint_by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def near_fingerprints(seed, n=300):
    rng = random.Random(seed)
    fps = [0, 1, (1 << 64) - 1]
    while len(fps) < n:
        base = rng.choice(fps) if rng.random() < 0.7 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(0, 7)):
            base ^= 1 << b
        fps.append(base)
    return sorted(set(fps))


def signed(fps):
    return np.array(fps, dtype=np.uint64).view(np.int64).tolist()


def test_more_fingerprints_get_wider_keys():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    widest = []
    for rows in (10 ** 5, 10 ** 7, 10 ** 9, 10 ** 11):
        groups, limits = s.partitions(sample, rows)
        assert sum(limits) == s.DISTANCE - len(groups) + 1
        work = s.thresholds(sample, groups, s.DISTANCE, rows)[0]
        widest.append(len(groups[0]))
        assert all(work <= s.thresholds(sample, s.correlated_partitions(sample, p), s.DISTANCE, rows)[0] for p in range(2, 6))
        assert rows < 10 ** 9 or work < rows / 10 ** 4
    assert widest == sorted(widest) and widest[0] < widest[-1]


@pytest.mark.parametrize("block,parts", [(s.BLOCK, None), (8, None), (8, 2), (8, 3), (s.BLOCK, 4)])
def test_links_connect_what_is_near_and_nothing_else(spark, monkeypatch, block, parts):
    monkeypatch.setattr(s, "BLOCK", block)  # small blocks: large buckets are cut
    if parts:  # as many fingerprints would have
        groups = lambda sample: s.correlated_partitions(sample, parts)
        monkeypatch.setattr(s, "partitions", lambda sample, rows, distance: (groups(sample), s.thresholds(sample, groups(sample), distance)[1]))
    fps = near_fingerprints(block)
    frame = spark.createDataFrame([(f,) for f in signed(fps)], "fp long")
    pairs = s.links(frame).collect()
    by_signed = dict(zip(signed(fps), fps))
    found = {tuple(sorted((by_signed[r.a], by_signed[r.b]))) for r in pairs}
    at = {f: i for i, f in enumerate(fps)}
    root = components_by_hand(fps, s.DISTANCE)
    assert all(root[at[a]] == root[at[b]] for a, b in found)
    joined = {f: f for f in fps}

    def find(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for a, b in found:
        joined[find(a)] = find(b)
    assert len({find(f) for f in fps}) == len(set(root))


def test_thresholds_add_up_and_cover_all_near_pairs():
    sample = np.array(near_fingerprints(3), dtype=np.uint64)
    for parts, distance in ((4, 4), (3, 4), (5, 4), (4, 7)):
        groups = s.correlated_partitions(sample, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        _, limits = s.thresholds(sample, groups, distance)
        assert sum(limits) == distance - parts + 1 and min(limits) >= -1


def test_every_row(spark, rows):
    rng = random.Random(2)
    base = [rng.choice(["alpha", "beta", "Gamma", "delta", "naïve", "x"]) + str(rng.randint(0, 30)) for _ in range(150)]
    texts = [None, "", " \t\r\n ", "ONE two", "one TWO", "a b c d", "É b c d", "a b c d e", " ".join(base), " ".join(base).upper(),
             " ".join(base + ["extra"]), " ".join(base[1:]), "z" * 5000, " ".join(base[::-1])]
    ids = [11, 3, 8, 5, None, 9, 4, 2, 1, 7, 6, 10, 0, 12]
    frame = spark.createDataFrame([(i, t, "f") for i, t in zip(ids, texts)] + [(11, None, "f")], "doc_id long, text string, fingerprint string")
    texts, ids = texts + [None], ids + [11]
    fps = [fingerprint_by_hand(t) for t in texts]
    root = components_by_hand(fps, 4)
    least = {r: min([i for i, x in zip(ids, root) if x == r and i is not None], default=None) for r in set(root)}
    assert rows(s.components(frame)) == sorted([(i, f"{f:016x}", least[r]) for i, f, r in zip(ids, fps, root)], key=repr)


def test_no_rows(spark):
    assert s.components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    cycle = [(200, 203), (203, 201), (201, 200), (200, 200)]
    links = spark.createDataFrame(path + star + cycle + [(500, 500)], "a long, b long")
    found = {r.node: r.root for r in components.roots(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, **{i: 200 for i in (200, 201, 203)}}
