"""Removal of long repeated passages by a logarithmic family of suffix indexes.

Every byte covered by a string of ``length`` bytes that also starts in a document with
a smaller id goes. Suffixes matter only by their first ``length`` bytes, and of those only the
ones near anchors: in each window of ``length`` bytes the anchor is the place of the
least hash of ``GRAM`` bytes, so equal windows have equal anchors at equal places.

1. Documents of equal text are represented by the one with the least id.
2. Documents are packed into chunks. Each chunk sends the hashes of its anchors to shards; a shard
   answers which of them other chunks have too. Most anchors end here.
3. Around the anchors that are shared, each chunk sends its distinct segments, with the least id that has
   them, to shards by the anchor's hash. A shard reads its segments in batches in
   order of their ids: a new batch gets its suffix array (sorted fingerprints of its suffixes),
   is merge-scanned against the arrays of the levels before it, and joins the family;
   arrays of similar size are merged, so there are about log2 of them.
4. A shard answers with one bit for each suffix: whether a smaller id has it. The
   chunk marks bytes and writes what is left.

Only hashes, segments of shared anchors and bits are shuffled besides the texts, once
per chunk however often it holds them, so a passage that a third of all documents share costs a task no more
than one segment per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import small_batches

LENGTH, GRAM = 50, 24
#: Bytes of text in a chunk, about, and anchors in a shard, about.
CHUNK_BYTES, SHARD_ANCHORS = 4_000_000, 1_000_000
#: Bytes of text that are hashed at once.
BLOCK_BYTES = 1 << 20
#: Suffixes in a new batch of a shard, about.
BATCH = 1 << 16

_random = np.random.default_rng(20)
#: Hash of each byte, and odd bases of two independent polynomials modulo 2 ** 64.
BYTE_HASH = _random.integers(0, 1 << 63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2 ** 64."""
    if which not in _powers or len(_powers[which][0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        both = []
        for base in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[which] = (both[0], both[1])
    up, down = _powers[which]
    return up[:n], down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a polynomial hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0xC4CEB9FE1A85EC53) ^ (h >> np.uint64(32))


def window_hashes(data: np.ndarray, width: int, which: int) -> np.ndarray:
    """Hash of every window of ``width`` bytes."""
    n = len(data)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(which, n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_HASH[which][data] * up[:n], out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * down[:n - width + 1])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, past the last window) of each anchor of a text, in order.

    The windows from the first on have this anchor; texts shorter than a window have none.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(data) > BLOCK_BYTES + length:
        # long texts block by block; an anchor whose windows two blocks share is given in both
        parts = []
        for at in range(0, n, BLOCK_BYTES):
            h, a, b = anchors(data[at:min(len(data), at + BLOCK_BYTES + length - 1)], length, gram)
            parts.append((h, a + at, b + at))
        return tuple(np.concatenate(p) for p in zip(*parts))
    hashes = window_hashes(data, gram, 0)
    span = length - gram + 1
    # the upper bits of the hash and the place in one number: its least is the leftmost least hash
    least = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return hashes[place[first]], first, np.r_[first[1:], n]


class Texts:
    """Distinct texts of a chunk with their anchors."""

    def __init__(self, ids: Sequence[int], texts: Sequence[bytes], length: int):
        self.ids, self.length = np.asarray(ids, dtype=np.int64), length
        self.data = [np.frombuffer(t, dtype=np.uint8) for t in texts]
        found = [anchors(d, length) for d in self.data]
        n = [len(f[0]) for f in found]
        self.doc = np.repeat(np.arange(len(self.data)), n)
        self.hash, self.first, self.past = (
            np.concatenate([np.zeros(0, kind), *[f[i] for f in found]]) for i, kind in enumerate((np.uint64, np.int64, np.int64)))

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes of the anchors, and whether two texts of the chunk have each."""
        order = np.lexsort((self.doc, self.hash))
        h, d = self.hash[order], self.doc[order]
        if not len(h):
            return h, np.zeros(0, dtype=bool)
        start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        last = np.r_[start[1:], len(h)] - 1
        return h[start], d[start] != d[last]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def pack(hashes: np.ndarray) -> bytes:
    """Five bytes of each hash; the shard is made of the other bits, so they tell most hashes of a shard apart."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 5, 8), dtype=np.uint8)
    wide[:, :5] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 5)
    return wide.view(np.uint64).ravel()


class Segments:
    """Distinct segments of shared anchors of a chunk, in the order in which they are sent and answered."""

    def __init__(self, texts: Texts, shared: np.ndarray):
        at = np.flatnonzero(np.isin(texts.hash, shared))
        span = texts.length - 1
        self.at = at
        raw = [texts.data[d][a:b + span].tobytes() for d, a, b in zip(
            texts.doc[at].tolist(), texts.first[at].tolist(), texts.past[at].tolist())]
        number: dict[bytes, int] = {}
        self.which = np.array([number.setdefault(s, len(number)) for s in raw], dtype=np.int64)
        self.segments = list(number)
        self.least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.which, texts.ids[texts.doc[at]])
        self.hash = np.zeros(len(number), dtype=np.uint64)
        self.hash[self.which] = texts.hash[at]
        self.windows = np.array([len(s) - span for s in self.segments], dtype=np.int64)


class Levels:
    """Logarithmic family of suffix arrays: sorted fingerprints with the least id that has each."""

    def __init__(self):
        self.arrays: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether each suffix of a batch is one of a smaller id, in the family or the batch; then takes the batch in.

        Batches come in order of ids, none below those of the family.
        """
        order = np.lexsort((ids, keys))
        k, d = keys[order], ids[order]
        new = np.r_[True, k[1:] != k[:-1]]
        start = np.flatnonzero(new)
        own, least = k[start], d[start].copy()
        group = np.cumsum(new) - 1
        for known, known_ids in self.arrays:
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            same = known[at] == own
            least[same] = np.minimum(least[same], known_ids[at[same]])
        found = np.zeros(len(keys), dtype=bool)
        found[order] = least[group] < d
        self.arrays.append((own, least))
        while len(self.arrays) > 1 and len(self.arrays[-2][0]) < 2 * len(self.arrays[-1][0]):
            (a, x), (b, y) = self.arrays.pop(), self.arrays.pop()
            keys, ids = np.concatenate([a, b]), np.concatenate([x, y])
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
            first = np.r_[True, keys[1:] != keys[:-1]]
            self.arrays.append((keys[first], ids[first]))
        return found


def suffixes(segments: Sequence[bytes], windows: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the suffixes that start at the windows of segments, segment by segment."""
    out, at = [], 0
    while at < len(segments):
        end, size = at, 0
        while end < len(segments) and (size == 0 or size + len(segments[end]) <= BLOCK_BYTES):
            size += len(segments[end])
            end += 1
        hashes = window_hashes(np.frombuffer(b"".join(segments[at:end]), dtype=np.uint8), length, 1)
        n = windows[at:end]
        starts = np.cumsum(n + length - 1) - (n + length - 1)
        out.append(hashes[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def compared(parts: pd.DataFrame, length: int) -> Iterator[tuple[int, bytes]]:
    """Answers of a shard to each of its chunks: bits of the suffixes of its segments, in order."""
    ids, segments, windows = [], [], []
    for lengths, least, body in zip(parts["lengths"], parts["ids"], parts["body"]):
        sizes = np.frombuffer(lengths, dtype=np.int32)
        ends = np.cumsum(sizes)
        segments += [body[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]
        windows.append(sizes.astype(np.int64) - (length - 1))
        ids.append(np.frombuffer(least, dtype=np.int64))
    of_chunk = np.cumsum([w.sum() for w in windows])[:-1]
    windows, ids = np.concatenate(windows), np.concatenate(ids)
    keys = suffixes(segments, windows, length)
    owner = np.repeat(ids, windows)
    found = np.zeros(len(keys), dtype=bool)
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    family, at = Levels(), 0
    while at < len(order):
        end = min(len(order), at + BATCH)
        # suffixes of one id stay in one batch
        end = int(np.searchsorted(owner, owner[end - 1], side="right"))
        batch = order[at:end]
        found[batch] = family.add(keys[batch], owner[at:end])
        at = end
    for c, bits in zip(parts["chunk"], np.split(found, of_chunk)):
        yield c, np.packbits(bits).tobytes()


def runs(covered: np.ndarray) -> np.ndarray:
    """(start, end) of the maximal runs of true."""
    edges = np.flatnonzero(np.diff(np.r_[0, covered.view(np.int8), 0]))
    return edges.reshape(-1, 2)


def inner_characters(text: bytes, start: int, end: int) -> tuple[int, int]:
    """The span without characters that it covers in part."""
    while start < end and text[start] & 0xC0 == 0x80:
        start += 1
    while start < end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def covered_bytes(text: Texts, doc: int, starts: np.ndarray) -> np.ndarray:
    marks = np.zeros(len(text.data[doc]) + 1, dtype=np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + text.length, -1)
    return np.cumsum(marks)[:-1] > 0


def without_repeats(
    rows: DataFrame, id: str = "doc_id", text: str = "text", keep: Sequence[str] = (), length: int = LENGTH,
    texts: bool = True, whole_characters: bool = False, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(id, *keep, n_bytes, spans, kept, kept_sha256) for every row.

    ``spans`` are the removed byte runs (start, end), ``kept`` the remaining bytes in order as binary, or null
    if ``texts`` is false, ``kept_sha256`` their digest in hex. A string also counts if it starts several times only in
    the smaller document. With ``whole_characters`` a character of which a span covers
    only some bytes is kept, so what is left of a text is text. Null texts are empty. Rows with one id count as one document: they remove
    nothing from each other. Rows with a null id come after all others and remove nothing from each other. No rows
    give none; other columns are ignored; a kept column named like a result gives way.
    """
    keep = [c for c in keep if c not in (id, "n_bytes", "spans", "kept", "kept_sha256")]
    small_batches(rows.sparkSession)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (id, *keep)}
    # whole numbers that may be missing would come to pandas as floats: they travel as text
    carried = {c: "string" if k in ("tinyint", "smallint", "int", "bigint") else k for c, k in kinds.items()}
    big = F.lit((1 << 63) - 1)
    source = rows.select(
        F.coalesce(F.col(f"`{id}`").cast("long"), big).alias("_id"),
        F.coalesce(F.encode(F.col(f"`{text}`"), "UTF-8"), F.lit(b"")).alias("_text"),
        F.struct(F.col(f"`{id}`").cast(carried[id]).alias("id"), *[
            F.col(f"`{c}`").cast(carried[c]).alias(f"k{i}") for i, c in enumerate(keep)]).alias("_row"))
    total = rows.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    chunks = max(16, -(-total // chunk_bytes))
    shards = max(16, -(-total // (14 * SHARD_ANCHORS)))
    # texts of one id, or of none, never remove from each other and need not meet: the digest spreads them
    chunk = F.pmod(F.xxhash64("_id", "digest"), F.lit(chunks)).cast("long").alias("chunk")
    # equal texts: only the least id takes part, the others go where they have it in them
    first = source.groupBy(F.sha2("_text", 256).alias("digest")).agg(F.min("_id").alias("_id"))
    # one text column names a represented row: a number that may be missing would come to pandas as a float
    name = F.concat_ws(":", F.col("_id").cast("string"), F.col("digest"))
    firsts = first.select(chunk, name.alias("first"))
    flat = source.withColumn("digest", F.sha2("_text", 256)).select(chunk, "_id", "_text", name.alias("name"), *[
        F.col("_row.id").alias("id"), *[F.col(f"_row.k{i}").alias(f"k{i}") for i in range(len(keep))]])

    def represented(documents: pd.DataFrame, own: pd.DataFrame) -> Texts:
        firsts = set(own["first"])
        taken = {n: (i, t) for n, i, t in zip(documents["name"], documents["_id"], documents["_text"]) if n in firsts}
        ordered = [taken[n] for n in sorted(taken)]
        return Texts([i for i, _ in ordered], [t for _, t in ordered], length)

    def announce(documents: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = {"shard": [], "chunk": [], "packed": [], "several": []}
        if len(documents):
            hashes, several = represented(documents, own).distinct()
            shard = shard_of(hashes, shards)
            for s in np.unique(shard):
                here = shard == s
                out["shard"].append(s)
                out["chunk"].append(documents["chunk"].iloc[0])
                out["packed"].append(pack(hashes[here]))
                out["several"].append(np.packbits(several[here]).tobytes())
        return pd.DataFrame(out)

    announced = flat.groupBy("chunk").cogroup(firsts.groupBy("chunk")).applyInPandas(
        announce, "shard long, chunk long, packed binary, several binary")

    def agreed(parts: pd.DataFrame) -> pd.DataFrame:
        packed = [unpack(p) for p in parts["packed"]]
        several = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(p)) for s, p in zip(parts["several"], packed)]
        _, where, n = np.unique(np.concatenate(packed), return_inverse=True, return_counts=True)
        local = np.bincount(where, np.concatenate(several), len(n))
        shared = ((n > 1) | (local > 0))[where]
        cuts = np.cumsum([len(p) for p in packed])[:-1]
        return pd.DataFrame({"chunk": parts["chunk"], "shard": parts["shard"],
                             "bits": [np.packbits(b).tobytes() for b in np.split(shared, cuts)]})

    replies = announced.groupBy("shard").applyInPandas(agreed, "chunk long, shard long, bits binary")

    def shared_of(texts: Texts, answers: pd.DataFrame) -> np.ndarray:
        hashes, _ = texts.distinct()
        shard = shard_of(hashes, shards)
        found = [np.zeros(0, dtype=np.uint64)]
        for s, bits in zip(answers["shard"], answers["bits"]):
            here = hashes[shard == s]
            found.append(here[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(here)).astype(bool)])
        return np.concatenate(found)

    def send(documents: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = {"key": [], "chunk": [], "lengths": [], "ids": [], "body": []}
        if len(documents):
            own = answers[answers["shard"] < 0]
            texts = represented(documents, own)
            segments = Segments(texts, shared_of(texts, answers[answers["shard"] >= 0]))
            c = int(documents["chunk"].iloc[0])
            shard = shard_of(segments.hash, shards)
            lengths = segments.windows + length - 1
            for s in np.unique(shard):
                here = np.flatnonzero(shard == s)
                out["key"].append(int(s))
                out["chunk"].append(c)
                out["lengths"].append(lengths[here].astype(np.int32).tobytes())
                out["ids"].append(segments.least[here].tobytes())
                out["body"].append(b"".join([segments.segments[i] for i in here]))
        return pd.DataFrame(out)

    # the first ids travel with the answers, so that a chunk is joined with one other side
    told = replies.select("chunk", "shard", "bits", F.lit(None).cast("string").alias("first")).union(
        firsts.select("chunk", F.lit(-1).cast("long").alias("shard"), F.lit(None).cast("binary").alias("bits"), "first"))
    sent = flat.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(
        send, "key long, chunk long, lengths binary, ids binary, body binary")

    def answer(parts: pd.DataFrame) -> pd.DataFrame:
        found = list(compared(parts, length))
        return pd.DataFrame({"chunk": [c for c, _ in found], "shard": parts["key"].iloc[0], "found": [b for _, b in found]})

    answered = sent.groupBy("key").applyInPandas(answer, "chunk long, shard long, found binary")
    all_told = told.withColumn("found", F.lit(None).cast("binary")).unionByName(answered.select(
        "chunk", "shard", F.lit(None).cast("binary").alias("bits"), F.lit(None).cast("string").alias("first"), "found"))

    def finish(documents: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = answers[answers["shard"] < 0]
        results = answers[answers["found"].notna()]
        texts = represented(documents, own)
        segments = Segments(texts, shared_of(texts, answers[answers["bits"].notna()]))
        shard = shard_of(segments.hash, shards)
        offset = np.cumsum(segments.windows) - segments.windows
        earlier = np.zeros(int(segments.windows.sum()), dtype=bool)
        for s, bits in zip(results["shard"], results["found"]):
            here = np.flatnonzero(shard == s)
            n = segments.windows[here]
            into = np.repeat(offset[here] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            earlier[into] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(into)).astype(bool)
        # an occurrence goes if a smaller id has it elsewhere, or its segment has a smaller id in this chunk
        doc = texts.doc[segments.at]
        later = texts.ids[doc] > segments.least[segments.which]
        n = segments.windows[segments.which]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        goes = np.repeat(later, n) | earlier[np.repeat(offset[segments.which], n) + inside]
        place = np.repeat(texts.first[segments.at], n) + inside
        of = np.repeat(doc, n)
        number = {n: k for k, n in enumerate(sorted(set(own["first"])))}
        bounds = np.searchsorted(of, np.arange(len(texts.data) + 1))
        order = np.argsort(of, kind="stable")
        out = []
        for n, t in zip(documents["name"], documents["_text"]):
            if (k := number.get(n)) is None:
                # a copy of a text with a smaller id
                spans = [(0, len(t))] if len(t) >= length else []
            else:
                mine = order[bounds[k]:bounds[k + 1]]
                spans = runs(covered_bytes(texts, k, place[mine][goes[mine]])).tolist()
            if whole_characters:
                spans = [x for x in (inner_characters(t, a, b) for a, b in spans) if x[0] < x[1]]
            left, at = [], 0
            for a, b in spans:
                left.append(t[at:a])
                at = b
            kept = b"".join([*left, t[at:]])
            out.append((len(t), [{"start": a, "end": b} for a, b in spans], kept if texts_wanted else None,
                        hashlib.sha256(kept).hexdigest()))
        done = pd.DataFrame(out, columns=["n_bytes", "spans", "kept", "kept_sha256"], index=documents.index)
        return pd.concat([documents[["id", *[f"k{i}" for i in range(len(keep))]]], done], axis=1)

    texts_wanted = texts
    types = [f"id {carried[id]}"] + [f"k{i} {carried[c]}" for i, c in enumerate(keep)]
    result = flat.groupBy("chunk").cogroup(all_told.groupBy("chunk")).applyInPandas(finish, ", ".join(
        [*types, "n_bytes long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string"]))
    return result.select(F.col("id").cast(kinds[id]).alias(id), *[F.col(f"k{i}").cast(kinds[c]).alias(c) for i, c in enumerate(keep)],
                         "n_bytes", "spans", "kept", "kept_sha256")
