"""The operators applied to the given tables, and oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    ann, bpe, chat, decontamination, fingerprints, html_extraction, repair, sharding, simhash, suffix_dedup, toxicity, url_filters, whitening,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def tokenizer(spark: SparkSession) -> str:
    """Content of the vocabulary file, read where the driver runs."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded."""
    documents = table(spark, folder, "documents")
    return bpe.encode(documents, tokenizer(spark), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts look like control strings, formatted and read back."""
    tricky = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                 "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").unionByName(more)
    return chat.digest(chat.render(chat.fold(chat.message_events(turns))))


ORACLES["op2_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(4 + length(role) + 1 + length(text) + 8
        + length(role || text) - length(replace(replace(replace(role || text, '\', ''), '#', ''), '<', ''))
        + length(role) - length(replace(role, chr(10), '')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

@query
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that a document of a smaller id has."""
    done = suffix_dedup.without_repeats(table(spark, folder, "documents"), texts=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by nested host and path rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, folder, "pages"), rules)


ORACLES["op4_url_filters"] = r"""
WITH rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (
    SELECT row_number() OVER () AS n, page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages),
fit AS (
    SELECT n, rh || rp AS rule, v,
        row_number() OVER (PARTITION BY n ORDER BY length(rh) + length(rp) DESC, length(rh) DESC) AS k
    FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (n)
"""


@query
def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract(table(spark, folder, "pages"))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a grammar learnt from the labels that are not held out."""
    documents = table(spark, folder, "documents")
    model = toxicity.learn(documents, table(spark, folder, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.components(table(spark, folder, "documents"))


@query
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors found for each hundredth one."""
    vectors = table(spark, folder, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"))


SHARDS = 8


@query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents dealt to shards of equal numbers of rows."""
    documents = table(spark, folder, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    dealt = sharding.assign(documents, "doc_id", SHARDS, ["doc_id", "size", "text_crc32"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, re-parameterised ones included."""
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint against those of its edited text and of the next document."""
    found = fingerprints.compare_with_edits(table(spark, folder, "documents"), lists=False)
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations damaged, audited and repaired at least cost."""
    conversations = table(spark, folder, "conversations")
    found = repair.repair(repair.damaged(conversations), times="times")
    report = found.report().withColumnRenamed("conv_id", "r")
    hashed = repair.digests(found.messages()).withColumnRenamed("conv_id", "h")
    whole = conversations.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("r")), "left").join(
        hashed, F.col("conv_id").eqNullSafe(F.col("h")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector whitened on up to 16 components."""
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
