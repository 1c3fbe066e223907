from __future__ import annotations

import hashlib
import os
import re
import subprocess
import sys

import duckdb
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from encore.llm import toxicity
from encore.llm.common import checkpointed, table
from encore.llm.queries import ORACLES, QUERIES
from test_simhash import components_by_hand, fingerprint_by_hand
from test_suffix_dedup import by_hand

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, FOLDER, "documents"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = checkpointed(stage(spark, docs, FOLDER))
        out[name] = docs.collect()
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stages_are_the_five_in_order():
    assert [n.split()[0] for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "suffix-array", "benchmark", "bpe"]


def test_toxic_documents_go(spark, stages):
    model = toxicity.learn(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    assert ids(stages["toxicity"]) == sorted(r.doc_id for r in stages["documents"] if model.score(r.text or "") < 0.3)


def test_one_document_of_each_group_stays(stages):
    before = stages["toxicity"]
    root = components_by_hand([fingerprint_by_hand(r.text) for r in before], 4)
    least = {}
    for r, c in zip(before, root):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert ids(stages["simhash near-dedup"]) == sorted(least.values())


def test_repeated_passages_go(stages):
    before, after = stages["simhash near-dedup"], {r.doc_id: r for r in stages["suffix-array dedup"]}
    spans = {i: s for i, _, s, _ in by_hand([(r.doc_id, r.text) for r in before], 50)}
    assert any(spans.values()) and len(after) == len(before)
    for r in before:
        raw, left, at = r.text.encode(), [], 0
        for a, b in spans[r.doc_id]:
            while a < b and raw[a] & 0xC0 == 0x80:
                a += 1
            while a < b < len(raw) and raw[b] & 0xC0 == 0x80:
                b -= 1
            left.append(raw[at:a])
            at = b
        text = b"".join([*left, raw[at:]]).decode()
        assert (after[r.doc_id].text, after[r.doc_id].n_chars, after[r.doc_id].lang) == (text, len(text), r.lang)


def test_contaminated_documents_go(spark, stages):
    words = lambda t: "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
    grams = lambda t: {tuple(w[i:i + 5]) for w in [words(t)] for i in range(len(w) - 4)}
    items = [grams(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    clean = [r for r in stages["suffix-array dedup"] if all(len(g & grams(r.text)) < 0.8 * len(g) for g in items if g)]
    assert ids(stages["benchmark decontamination"]) == ids(clean)


def test_what_is_left_is_encoded(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    texts = {r.doc_id: r.text for r in stages["benchmark decontamination"]}
    done = stages["bpe encoding and decoding"]
    assert ids(done) == sorted(texts)
    assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in done)


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (None, "some words of a text", "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame, last in ((docs, 2), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = checkpointed(stage(spark, frame, FOLDER))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert frame.columns == corpus_pipeline.COLUMNS
        assert frame.count() == last


def test_ids_that_repeat_or_are_missing_decide_nothing(spark):
    words = [f"word{i}" for i in range(400)]
    first, second, third = (" ".join(words[a:a + 100]) for a in (0, 100, 200))
    item = table(spark, FOLDER, "benchmark").first().text
    rows = [(1, first), (1, second), (None, third), (None, first), (None, f"{third} {item}"), (1, f"{second} {item}"), (-5, third)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    distinct = corpus_pipeline.without_near_duplicates(spark, docs, FOLDER).collect()
    fps = [fingerprint_by_hand(t) for _, t in rows]
    root = components_by_hand(fps, 4)
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest())
    kept = [min((r for r, c in zip(rows, root) if c == one), key=order) for one in dict.fromkeys(root)]
    assert {(1, first), (1, second), (-5, third)} <= set(kept) and (None, first) not in kept
    assert sorted([(r.doc_id, r.text) for r in distinct], key=repr) == sorted(kept, key=repr)
    clean = corpus_pipeline.without_benchmark(spark, docs, FOLDER).collect()
    assert sorted([(r.doc_id, r.text) for r in clean], key=repr) == sorted([r for r in rows if item not in r[1]], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        db.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    wanted = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in QUERIES[name](spark, FOLDER).collect()) == wanted


def test_all_thirteen_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_the_library_does_not_need_this_subpackage():
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name in ('corpus_pipeline', 'encore.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 100 and not any(q.startswith('op') for q in e.queries())\n")
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
