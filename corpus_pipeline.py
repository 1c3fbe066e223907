"""The training-data pipeline: stages over documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from encore.llm import bpe, decontamination, simhash, suffix_dedup, toxicity
from encore.llm.common import checkpointed, table
from encore.llm.queries import ORACLES, QUERIES, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def row_order() -> Column:
    """Sorts rows by id, those without one last, then by a digest of the text: 16 hex digits of the id with its sign turned, and 64."""
    id = F.lpad(F.hex(F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.coalesce(id, F.lit("none")), F.sha2(F.coalesce("text", F.lit("")), 256))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not reject."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=COLUMNS).where("predicted = 0").select(COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, that of the smallest id.

    Groups decide on texts of rows, not on ids: rows that share an id or have none are told apart by
    their text, those without an id come last, and rows of one id and one text are one document.
    """
    keyed = docs.withColumn("_key", row_order())
    first = simhash.components(keyed, id="_key").where("_key = component_id").select("_key").distinct()
    return keyed.join(first, "_key", "left_semi").dropDuplicates(["_key"]).select(COLUMNS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without long passages that a document of a smaller id has."""
    others = [c for c in COLUMNS if c not in ("doc_id", "text", "n_chars")]
    left = suffix_dedup.without_repeats(docs, keep=others, whole_characters=True)
    text = F.col("kept").cast("string")
    return left.select("doc_id", text.alias("text"), *others, F.char_length(text).cast("long").alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; ids decide nothing."""
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = decontamination.contaminated(keyed, table(spark, sf_dir, "benchmark"), id="_row")
    return keyed.join(found.select("_row").distinct(), "_row", "left_anti").select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and digests of them and of the decoded text."""
    return bpe.encode(docs, tokenizer(spark), keep=["doc_id", "lang", "source"],
                      outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("suffix-array dedup", without_repeated_passages),
    ("benchmark decontamination", without_benchmark),
    ("bpe encoding and decoding", encoded),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


ALL = {**QUERIES, "pipeline": run}

__all__ = ["ALL", "ORACLES", "ORACLE_SQL", "STAGES", "run"]
