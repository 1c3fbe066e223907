from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from encore.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
CONTENT = open(PATH, encoding="utf-8").read()
TRICKY = [
    None, "", "   \n\t ", "Hello, World!", "I'LL don't we've 'S", "<|endoftext|>x<|startoftext|><|endof", "ΑΣ ΣΑΣ",
    "é ́x", "a" * 3000, "x" * 70 + " y " + "x" * 70, "１２3 ½ ⅷ", "\x1c\x1d a\u00a0b\u2003c\u200bd", "日本語 テキスト",
    "👩‍👩‍👧 🙂", "a\u0558b \u1c89", "tab\tnew\nline", "Hello, World!",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(CONTENT))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def joined(encoder, text):
    parts = list(encoder.encode([text]))
    return [int(i) for p in parts for i in p[1].split(" ")], " ".join(p[2] for p in parts)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text_is_encoded_as_the_library_does(library, encoder, text):
    assert joined(encoder, text) == expected(library, text)


@settings(max_examples=100, deadline=None)
@given(words=st.lists(st.text("abcdeinrst", min_size=1, max_size=40), min_size=1, max_size=20))
def test_words_of_all_lengths_side_by_side(library, encoder, words):
    fresh = bpe.Encoder(encoder.v)
    assert joined(fresh, " ".join(words)) == expected(library, " ".join(words))


def test_long_texts_are_read_slice_by_slice(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 50)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    text = "The quick brown fox's den, 12 times.\n" * 40
    assert joined(bpe.Encoder(encoder.v), text) == expected(library, text)


def test_rows(spark, library):
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TRICKY)], "doc_id long, text string, n_tokens int")
    done = bpe.encode(rows, CONTENT, keep=["doc_id", "n_tokens"], outputs=list(bpe.OUTPUTS)).collect()
    assert len(done) == len(TRICKY)
    for r in done:
        ids, text = expected(library, TRICKY[r.doc_id])
        assert (r.ids, r.decoded, r.n_tokens) == (ids, text, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_decode_takes_ids_back(spark, library):
    rows = spark.createDataFrame([(1, [320, 49407, None]), (2, []), (3, None)], "doc_id long, ids array<int>")
    found = dict(tuple(r) for r in bpe.decode(rows, CONTENT).collect())
    assert found == {1: library.decode([320, 49407], skip_special_tokens=False), 2: "", 3: ""}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, CONTENT).count() == 0
