"""BPE encoding and decoding with segment trees over the ranks of adjacent pairs.

Each word has a segment tree whose leaves are the ranks of its adjacent pairs; the
root holds the lowest rank and, of equal ones, the leftmost place, so it names the
next merge. A merge changes three leaves, each updated along its path to the root;
a word is done when its root holds no rank. Words of similar length are processed
side by side: a step of numpy merges once in every unfinished word.

Words repeat, so each Python worker keeps those it has encoded, up to a bound.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame, functions as F

from .common import named, small_batches

#: Words of a generation that a worker keeps (it keeps two), and their longest length.
KEPT_WORDS, KEPT_LENGTH = 150_000, 64
#: Characters of a text that are split into words at once, up to the next blank.
SLICE = 1 << 19
#: Words of slices that are learnt together, about.
WORDS_AT_ONCE = 150_000
#: Fixed values of byte-level vocabularies: the bytes that stand for themselves.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from 256 on."""
    shifted = iter(range(256, 512))
    return [chr(b) if b in set(PRINTABLE) else chr(next(shifted)) for b in range(256)]


#: All characters before this one have a category.
FIRST_UNASSIGNED = "\u0378"
_BEYOND = re.compile(f"[{FIRST_UNASSIGNED}-\U0010ffff]")


def may_be_unassigned(text: str) -> bool:
    """Cheap tests first: most texts have no character beyond Latin."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
        return False
    except UnicodeEncodeError:
        return _BEYOND.search(text) is not None and unassigned().search(text) is not None


@lru_cache(maxsize=1)
def unassigned() -> re.Pattern[str]:
    """A character without a category in Python's Unicode tables."""
    ranges, start = [], None
    for c in range(0x110001):
        here = c < 0x110000 and unicodedata.category(chr(c)) == "Cn"
        if here and start is None:
            start = c
        elif not here and start is not None:
            ranges.append(f"{re.escape(chr(start))}-{re.escape(chr(c - 1))}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


class Vocabulary:
    """Tables of a tokenizer file with byte-level words, an end-of-word suffix and lower-cased NFC texts."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        ids = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*ids.items(), *special.items()]:
            self.tokens[i] = token
        self.numbers = [str(i) for i in range(size)]
        characters = byte_characters()
        self.inner = np.array([ids[c] for c in characters], dtype=np.int64)
        self.last = np.array([ids[c + suffix] for c in characters], dtype=np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = size
        keys = np.array([ids[a] * size + ids[b] for a, b in merges], dtype=np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[self.order], np.iinfo(np.int64).max)
        self.order = np.append(self.order, 0)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        self.none = len(merges)  # the rank of a pair that does not merge
        self.special = special
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.splitter = tokenizers.Tokenizer.from_str(content)
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens.

        Characters that Python's tables do not know, but those of the installed libraries may, are
        rare; a text with one is split by the library that defines the vocabulary.
        """
        if may_be_unassigned(text):
            plain = self.splitter.normalizer.normalize_str(text)
            return [plain[a:b] for _, (a, b) in self.splitter.pre_tokenizer.pre_tokenize_str(plain)]
        # lower case by character, so no form of sigma depends on its place
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of token ids; negative ids are places outside the word."""
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.order[at], self.none)

    def encode_class(self, symbols: np.ndarray) -> np.ndarray:
        """Merge the rows of a matrix of token ids, padded with -1 to a power of two; freed places become -1."""
        n, width = symbols.shape
        nothing = self.none * width
        here = np.arange(width)
        after = np.tile(here + 1, (n, 1))
        before = np.tile(here - 1, (n, 1))
        right = np.concatenate([symbols[:, 1:], np.full((n, 1), -1)], axis=1)
        tree = np.full((n, 2 * width), nothing, dtype=np.int64)
        tree[:, width:] = self.ranks(symbols, right) * width + here
        for level in range(width.bit_length() - 2, -1, -1):
            lo = 1 << level
            children = tree[:, 2 * lo:4 * lo]
            tree[:, lo:2 * lo] = np.minimum(children[:, ::2], children[:, 1::2])

        def put(rows: np.ndarray, place: np.ndarray, rank: np.ndarray) -> None:
            node = place + width
            tree[rows, node] = rank * width + place
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < nothing)
        while len(rows):
            root = tree[rows, 1]
            place = root % width
            gone = after[rows, place]
            following = after[rows, gone]
            new = self.merged[root // width]
            symbols[rows, place], symbols[rows, gone] = new, -1
            after[rows, place] = following
            inside = following < width
            before[rows[inside], following[inside]] = place[inside]
            beyond = np.where(inside, symbols[rows, np.minimum(following, width - 1)], -1)
            put(rows, gone, np.full(len(rows), self.none))
            put(rows, place, self.ranks(new, beyond))
            previous = before[rows, place]
            has = previous >= 0
            if has.any():
                put(rows[has], previous[has], self.ranks(symbols[rows[has], previous[has]], new[has]))
            rows = rows[tree[rows, 1] < nothing]
        return symbols

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """Token ids of each word."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(b) for b in raw], dtype=np.int64)
        out: list[list[int]] = [[]] * len(raw)
        width = 1
        while len(raw) and width < 2 * lengths.max():
            # classes of one width, in blocks that bound the memory of their trees
            at = np.flatnonzero((lengths > width // 2) & (lengths <= width))
            for block in np.array_split(at, max(1, len(at) * width // (1 << 18))) if len(at) else ():
                size = lengths[block]
                column = np.arange(width)
                inside = column < size[:, None]
                symbols = np.full((len(block), width), -1, dtype=np.int64)
                symbols[inside] = self.inner[np.frombuffer(b"".join(raw[i] for i in block), dtype=np.uint8)]
                final = np.frombuffer(bytes(raw[i][-1] for i in block), dtype=np.uint8)
                symbols[np.arange(len(block)), size - 1] = self.last[final]
                if width > 1:
                    symbols = self.encode_class(symbols)
                stays = symbols >= 0
                flat, start = symbols[stays].tolist(), 0
                for i, n in zip(block.tolist(), stays.sum(1).tolist()):
                    out[i] = flat[start:start + n]
                    start += n
            width *= 2
        return out


class Encoder:
    """Texts to tokens, keeping the words seen: the ids and the tokens of each, joined by blanks, in UTF-8.

    Words are kept in two generations. When the younger is full it becomes the older, whose words move on when
    they are met again; those not met for a whole generation are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.start()

    def start(self) -> None:
        self.ids: dict[str, bytes] = {c: str(i).encode() for c, i in self.v.special.items()}
        self.tokens: dict[str, bytes] = {c: c.encode() for c in self.v.special}

    def slices(self, text: str) -> Iterator[list[str]]:
        """Words and special tokens of a text, slice by slice; slices end before a blank."""
        at = 0
        while at < len(text):
            end = min(len(text), at + SLICE)
            while end < len(text) and text[end] not in " \n":
                end += 1
            piece, at = text[at:end], end
            words: list[str] = []
            for k, part in enumerate(self.v.split_special.split(piece) if "<|" in piece else [piece]):
                if k % 2:
                    words.append(part)
                else:
                    words.extend(self.v.split(part))
            yield words

    def learn(self, words: set[str]) -> list[str]:
        """Encode the words not kept; returns those too long to keep, for this slice only."""
        fresh = words.difference(self.ids)
        ids, tokens = self.older
        for word in fresh.intersection(ids):
            self.ids[word], self.tokens[word] = ids[word], tokens[word]
        unknown = list(fresh.difference(ids))
        for word, found in zip(unknown, self.v.encode_words(unknown)):
            self.ids[word] = " ".join([self.v.numbers[i] for i in found]).encode()
            self.tokens[word] = " ".join([self.v.tokens[i] for i in found]).encode()
        return [w for w in unknown if len(w) > KEPT_LENGTH]

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[int, str, str, int]]:
        """``pieces`` as strings."""
        for number, ids, tokens, n in self.pieces(texts):
            yield number, ids.decode(), tokens.decode(), n

    def pieces(self, texts: Sequence[str]) -> Iterator[tuple[int, bytes, bytes, int]]:
        """(text's number, ids and tokens, each joined by blanks, and their count) of each slice that has words, in order.

        Words of some slices are learnt together, so that their trees are worked on side by side.
        """
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for number, text in enumerate(texts):
            for words in self.slices(text):
                if words:
                    waiting.append((number, words))
                    size += len(words)
                if size > WORDS_AT_ONCE:
                    yield from self.finish(waiting)
                    waiting, size = [], 0
        yield from self.finish(waiting)

    def finish(self, slices: Sequence[tuple[int, list[str]]]) -> Iterator[tuple[int, bytes, bytes, int]]:
        if len(self.ids) > KEPT_WORDS:
            self.older = self.ids, self.tokens
            self.start()
        long = self.learn(set().union(*[words for _, words in slices]))
        for number, words in slices:
            ids = b" ".join(map(self.ids.__getitem__, words))
            yield number, ids, b" ".join(map(self.tokens.__getitem__, words)), ids.count(b" ") + 1
        for word in long:
            del self.ids[word], self.tokens[word]


@lru_cache(maxsize=2)
def encoder_of(content: str) -> Encoder:
    """One encoder a Python worker and vocabulary, kept over its tasks."""
    return Encoder(Vocabulary(content))


OUTPUTS = {
    "n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string",
}


def encode(
    rows: DataFrame, tokenizer: str, text: str = "text", keep: Sequence[str] = ("doc_id",),
    outputs: Sequence[str] = ("n_tokens", "ids"),
) -> DataFrame:
    """Columns ``keep`` of every row with ``outputs`` of its encoded text.

    ``tokenizer`` is the content of a tokenizer file: a fixed vocabulary, sent to all tasks.
    ``outputs``: ``n_tokens``; ``ids``; ``decoded``, the tokens of the ids joined by blanks, special
    ones included; ``ids_sha256`` of the decimal ids joined by blanks and
    ``decoded_sha256``, in hex, which need no texts to leave the tasks. Special tokens
    in a text are taken as such. A null text is empty and has no tokens; texts of any
    length are read slice by slice; repeated rows stay repeated, no rows give none.
    Columns outside ``keep`` are left aside; a kept one named like an output gives way to it.
    """
    keep = [c for c in keep if c not in outputs]
    small_batches(rows.sparkSession)
    content = rows.sparkSession.sparkContext.broadcast(tokenizer)
    source = rows.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    whole = {"ids", "decoded"} & set(outputs)

    class Result:
        def __init__(self):
            self.n_tokens, self.ids, self.pieces = 0, [], []
            self.numbers, self.text = hashlib.sha256(), hashlib.sha256()

        def add(self, numbers: bytes, tokens: bytes, n: int) -> None:
            if self.n_tokens:
                self.numbers.update(b" ")
                self.text.update(b" ")
            self.numbers.update(numbers)
            self.text.update(tokens)
            self.n_tokens += n
            if whole:
                self.ids.append(np.array(numbers.split(), dtype=np.int32))
                self.pieces.append(tokens.decode())

        def row(self) -> dict:
            ids = np.concatenate([np.zeros(0, dtype=np.int32), *self.ids])
            return {"n_tokens": self.n_tokens, "ids": ids, "decoded": " ".join(self.pieces),
                    "ids_sha256": self.numbers.hexdigest(), "decoded_sha256": self.text.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(content.value)
        kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
        for batch in batches:
            done = [Result() for _ in range(batch.num_rows)]
            for number, *piece in encoder.pieces(batch.column(len(keep)).to_pylist()):
                done[number].add(*piece)
            found = [d.row() for d in done]
            columns = [pa.array([d[o] for d in found], type=kinds.get(o, pa.string())) for o in outputs]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *columns], names=[*keep, *outputs])

    types = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep] + [f"`{o}` {OUTPUTS[o]}" for o in outputs]
    return source.mapInArrow(run, ", ".join(types))


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with ``decoded``: the tokens of an array of ids joined by blanks; null or empty arrays give an
    empty text, null ids in an array are passed over."""
    keep = [c for c in keep if c != "decoded"]
    content = rows.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder_of(content.value).v.tokens
        for batch in batches:
            texts = [" ".join([tokens[i] for i in a or () if i is not None]) for a in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    types = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return named(rows, [*keep, ids]).mapInArrow(run, ", ".join([*types, "decoded string"]))
