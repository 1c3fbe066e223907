"""Landed JSON documents and scraped pages -> typed raw rows.

Row-wise projections only: a missing object, an empty list or an absent field
gives NULL and keeps the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from encore.functions.nested import first_of, first_where, joined_names
from encore.functions.parse import monthly_listeners
from encore.functions.text import date_part, empty_to_null, last_segment, time_part

def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON-lines files read with a declared schema."""
    return spark.read.schema(schema).json(path)


#: Column of the text of a landed document that cannot be read as declared.
UNREAD = "_corrupt_record"


def read_with_unread(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed documents with their text in ``UNREAD`` where they, or some of their fields, cannot be read."""
    return read_landed(spark, path, f"{schema}, {UNREAD} STRING")


def _nothing_read(docs: DataFrame) -> Column:
    """Whether no field of a document was read: the text is broken, or is no document."""
    fields = [F.col(c).isNull() for c in docs.columns if c not in (UNREAD, "feed_rank", *POSITION)]
    return F.col(UNREAD).isNotNull() & reduce(Column.__and__, fields)


def read_documents(docs: DataFrame) -> DataFrame:
    """The documents of ``read_with_unread`` that are some: one with an unreadable field stays, the field being NULL."""
    return docs.where(~_nothing_read(docs)).drop(UNREAD)


def unread_documents(docs: DataFrame, source: str, loaded_at: Column | None = None) -> DataFrame:
    """(source, landed_file, landed_block, document, reason, loaded_at) of what could not be read, whole or in part.

    Lines of a feed are the documents read and those whose reason is ``no document``; a document with the reason
    ``unreadable field`` is among the documents read as well. Empty lines are none. Needs ``in_landed_order``.
    """
    reason = F.when(_nothing_read(docs), "no document").otherwise("unreadable field")
    return docs.where(F.col(UNREAD).isNotNull()).select(
        F.lit(source).alias("source"), "landed_file", "landed_block", F.col(UNREAD).alias("document"), reason.alias("reason"), _stamp(loaded_at))


#: Where a document stands in its feed, in order.
POSITION = ["landed_file", "landed_block", "landed_row"]


def in_landed_order(docs: DataFrame) -> DataFrame:
    """Landed documents with their position: file, block of the file, row of the block.

    A block is read from top to bottom by one task, so the growing number orders its rows.
    """
    return docs.withColumns({
        "landed_file": F.col("_metadata.file_path"),
        "landed_block": F.col("_metadata.file_block_start"),
        "landed_row": F.monotonically_increasing_id(),
    })


def parse_landed(df: DataFrame, text: str, schema: str) -> DataFrame:
    """Documents held as text in a column; other columns are kept.

    ``from_json`` is interpreted, and so is all that Spark merges into it. The text is named twice, which Spark merges only
    where it is cheap: a text that is computed stays in generated code.
    """
    others = [c for c in df.columns if c != text]
    doc = F.when(F.col(text).isNotNull(), F.from_json(text, schema))
    return df.select(*others, doc.alias("__doc")).select(*others, "__doc.*")


def union_feeds(*feeds: DataFrame, rank: str = "feed_rank") -> DataFrame:
    """Bag union of feeds; ``rank`` tells the feed, 1 being the first."""
    ranked = [f.withColumn(rank, F.lit(i)) for i, f in enumerate(feeds, start=1)]
    whole = ranked[0]
    for f in ranked[1:]:
        whole = whole.unionByName(f)
    return whole


def _stamp(loaded_at: Column | None) -> Column:
    return (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at")


def flatten_events(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Event documents -> rows of raw_ticketmaster_events."""
    venue = first_of("_embedded.venues")
    artist = first_of("_embedded.attractions")
    price = first_of("priceRanges")
    return docs.select(
        F.col("id").alias("event_id"),
        F.col("name").alias("event_name"),
        F.col("url").alias("event_url"),
        F.col("dates.start.localDate").alias("event_date"),
        F.col("dates.start.localTime").alias("event_time"),
        F.col("dates.status.code").alias("sale_status"),
        artist["name"].alias("artist_name"),
        artist["id"].alias("artist_id"),
        venue["name"].alias("venue_name"),
        venue["id"].alias("venue_id"),
        venue["city"]["name"].alias("city"),
        venue["state"]["stateCode"].alias("state"),
        price["min"].alias("price_min"),
        price["max"].alias("price_max"),
        price["currency"].alias("currency"),
        first_of("classifications")["genre"]["name"].alias("genre"),
        _stamp(loaded_at),
    )


def flatten_performers(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Performer documents -> rows of raw_seatgeek_performers."""
    return docs.select(
        F.col("id").cast("string").alias("performer_id"),
        F.col("name").alias("performer_name"),
        "short_name",
        F.col("url").alias("seatgeek_url"),
        F.col("score").alias("sg_score"),
        F.col("popularity").alias("sg_popularity"),
        F.col("num_upcoming_events").alias("upcoming_events"),
        joined_names("genres").alias("genres"),
        F.col("type").alias("performer_type"),
        _stamp(loaded_at),
    )


def flatten_listings(docs: DataFrame, loaded_at: Column | None = None, beside: Sequence[str] = ()) -> DataFrame:
    """Listing documents -> rows of raw_seatgeek_events (one per document; see ``keep_first``).

    Columns named ``beside`` are kept. Flat rows take less memory than documents, so choose among them once they are flat.
    """
    performer = first_where("performers", lambda p: p["primary"])
    return docs.select(
        *beside,
        F.col("id").cast("string").alias("event_id"),
        F.col("title").alias("event_title"),
        F.col("url").alias("event_url"),
        date_part("datetime_local").alias("event_date"),
        time_part("datetime_local").alias("event_time"),
        F.col("type").alias("event_type"),
        performer["name"].alias("performer_name"),
        performer["id"].cast("string").alias("performer_id"),
        F.col("venue.name").alias("venue_name"),
        F.col("venue.id").cast("string").alias("venue_id"),
        F.col("venue.city").alias("city"),
        F.col("venue.state").alias("state"),
        F.col("stats.lowest_price").alias("lowest_price"),
        F.col("stats.average_price").alias("average_price"),
        F.col("stats.highest_price").alias("highest_price"),
        F.col("stats.listing_count").alias("listing_count"),
        F.col("popularity").alias("event_popularity"),
        F.col("score").alias("event_score"),
        _stamp(loaded_at),
    )


def parse_pages(pages: DataFrame, loaded_at: Column | None = None, keep_chars: int | None = None) -> DataFrame:
    """Scraped pages -> rows of raw_spotify_artists. The phrase is searched in the whole text.

    The whole text is kept, or its first ``keep_chars`` characters where a table is to hold no more.
    """
    kept = F.col("markdown") if keep_chars is None else F.substring("markdown", 1, keep_chars)

    def meta(key):
        return F.try_element_at("metadata", F.lit(key))

    return pages.select(
        last_segment("url").alias("artist_id"),
        "artist_name",
        F.col("url").alias("spotify_url"),
        monthly_listeners("markdown").alias("monthly_listeners"),
        F.coalesce(empty_to_null("title"), meta("title"), F.lit("")).alias("page_title"),
        F.coalesce(meta("description"), F.lit("")).alias("page_description"),
        empty_to_null(kept).alias("raw_markdown"),
        F.when(F.size("metadata") > 0, F.to_json("metadata")).alias("raw_metadata"),
        _stamp(loaded_at),
    )
