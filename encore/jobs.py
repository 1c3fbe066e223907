"""The daily jobs end to end: land, build, check, report.

    python -m encore.jobs ingest --raw RAW --kind events --landed BROAD [TARGETED ...] [--batch ID]
    python -m encore.jobs build  --raw RAW --out MARTS [--strict]
    python -m encore.jobs check  --raw RAW --out MARTS
    python -m encore.jobs report --raw RAW --out MARTS --reports REPORTS [--strict]
    python -m encore.jobs find   --raw RAW --out PAGES

Folders are anything Spark can write and every executor can see.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from encore import schemas
from encore.operators.aggregates import distinct_values
from encore.operators.checks import failed_run
from encore.operators.joins import union_with_precedence
from encore.operators.latest import keep_first
from encore.plans import reports
from encore.plans.build import Models, build
from encore.session import session
from encore.sources import landed, ledger, reference, tables

# What lands: document schema, flattener, raw table.
KINDS = {
    "events": (schemas.EVENT_DOC, landed.flatten_events, "raw_ticketmaster_events"),
    "performers": (schemas.PERFORMER_DOC, landed.flatten_performers, "raw_seatgeek_performers"),
    "listings": (schemas.LISTING_DOC, landed.flatten_listings, "raw_seatgeek_events"),
    "pages": (schemas.PAGE_DOC, landed.parse_pages, "raw_spotify_artists"),
}


def columns_of(table: str) -> list[str]:
    """Column names of a raw table, in declared order."""
    return [field.split()[0] for field in schemas.RAW_TABLES[table].replace("(38,0)", "").split(",")]


REJECTED = "rejected_documents"
REJECTED_COLUMNS = ["source", "landed_file", "landed_block", "document", "reason", "loaded_at"]


def append(rows: DataFrame, path: str, columns: Sequence[str], batch: str | None) -> None:
    """Append a load; one with a batch id only if that is not there yet."""
    if batch is None:
        tables.append_rows(rows, path, columns)
    else:
        ledger.append_once(rows, path, columns, batch)


def ingest(spark: SparkSession, kind: str, feeds: Sequence[str], raw: str, batch: str | None = None) -> None:
    """Append one load. Events and listings are kept once per id: the first feed wins, within
    a feed the first file, within a file the first document.

    Documents that cannot be read go to the table ``REJECTED`` with their file, text and reason. A load with a ``batch`` id may be
    repeated, also after it broke half-way: its rows are there once.
    """
    schema, flatten, table = KINDS[kind]
    docs = landed.union_feeds(*[
        landed.in_landed_order(landed.read_with_unread(spark, path, schema)) for path in feeds
    ])
    unread = landed.unread_documents(docs, table)
    append(unread, f"{raw}/{REJECTED}", REJECTED_COLUMNS, None if batch is None else f"{table} {batch}")
    docs = landed.read_documents(docs)
    if kind in ("events", "listings"):
        docs = docs.withColumn("id", F.col("id").cast("string"))
        docs = keep_first(docs, "id", ["feed_rank", *landed.POSITION], drop_missing=kind == "events")
    rows = flatten(docs)
    rows = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schemas.RAW_TABLES[table]) if f.name in rows.columns])
    append(rows, f"{raw}/{table}", columns_of(table), batch)


def refresh_tours(spark: SparkSession, raw: str, tours: DataFrame | None = None) -> None:
    """Replace the tour table, by default with the verified tours held in code."""
    df = reference.tours(spark) if tours is None else tours
    tables.replace_rows(df, f"{raw}/raw_tour_revenue", columns_of("raw_tour_revenue"))


def pages_to_read(spark: SparkSession, raw: dict[str, DataFrame], n: int | None = None) -> DataFrame:
    """Artist pages to read: the curated list, then the artists of the events that it lacks (without a page yet)."""
    curated = reference.curated_artists(spark)
    found = reports.artists_to_find(raw["raw_ticketmaster_events"], curated, n).select("artist_name")
    blank = found.select("artist_name", *[F.lit(None).cast(curated.schema[c].dataType).alias(c) for c in curated.columns if c != "artist_name"])
    return union_with_precedence(curated, blank.select(*curated.columns), "artist_name")


def raw_tables(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    return {name: ledger.scan_loads(spark, f"{raw}/{name}", schema) for name, schema in schemas.RAW_TABLES.items()}


def declare(spark: SparkSession, raw: str) -> None:
    """Declare the raw tables in the catalog where they are absent."""
    for name, schema in schemas.RAW_TABLES.items():
        tables.create_if_absent(spark, name, schema, f"{raw}/{name}")


def check(models: Models) -> DataFrame:
    """The quality report; raises when a check of severity error fails."""
    found = models.quality_report()
    # one row for each declared check: kept as rows, so that no check runs twice
    report = found.sparkSession.createDataFrame(found.collect(), found.schema)
    failed = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed_run(report).collect()]
    if failed:
        raise ValueError("checks failed: " + "; ".join(failed))
    return report


def analyses(spark: SparkSession, models: Models, unique_events: bool = False) -> dict[str, DataFrame]:
    """Every report, lazily."""
    star = models.star(reference.city_coordinates(spark), unique_events)
    listeners = reports.listeners_view(models.stg_spotify_artists)
    market = reports.market_view(models.stg_seatgeek_performers)
    tours = reports.tours_view(models.stg_tour_revenue)
    compared = reports.revenue_comparison(tours, listeners)
    return {
        "star_frame": star.frame(),
        "overview": reports.overview(star),
        "top_genres": reports.top_by(star, "genre"),
        "top_artists": reports.top_by(star, "artist_name"),
        "top_venue_names": reports.top_by(star, "venue_name"),
        "demand_leaderboard": reports.demand_leaderboard(star, listeners, market),
        "tour_ranking": reports.tour_ranking(tours),
        "revenue_comparison": reports.conversion_table(compared),
        "conversion_kpis": reports.conversion_kpis(compared),
        "price_by_genre": reports.price_by_genre(star),
        "price_distribution": reports.price_distribution(models.fact_events if unique_events else star.frame()),
        "artist_profiles": reports.artist_profiles(star, listeners, market, tours),
        "artist_events": reports.artist_events(star),
        "audience_and_events": reports.audience_and_events(star, listeners),
        "untapped_artists": reports.untapped_artists(star, listeners),
        "hotspots": reports.hotspots(star),
        "top_states": reports.top_by(star, "state", 15),
        "states": distinct_values(star.venues.frame, "state"),
        "genres": distinct_values(star.artists.frame, "genre"),
        "top_venues": reports.top_venues(star),
        "market_kpis": reports.market_kpis(star),
        "market_genres": reports.market_genres(star),
        "market_artists": reports.market_artists(star, listeners),
        "by_weekday": reports.by_weekday(star),
        "by_month": reports.by_month(star),
        "genre_weekdays": reports.genre_weekdays(star),
        "known_artists": reports.known_artists(star, listeners),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["ingest", "tours", "declare", "build", "check", "report", "find"])
    parser.add_argument("--raw", required=True, help="folder of the raw tables")
    parser.add_argument("--out", help="folder of the built tables")
    parser.add_argument("--reports", help="folder of the written reports")
    parser.add_argument("--kind", choices=list(KINDS))
    parser.add_argument("--landed", nargs="+", default=[], help="landed feeds, first one first")
    parser.add_argument("--batch", help="id of the load: the same load repeated adds nothing")
    parser.add_argument("--strict", action="store_true", help="one row per dimension key")
    parser.add_argument("--keep-days", type=float, help="remove versions of the built tables older than this, but the last two")
    parser.add_argument("--lenient", action="store_true", help="values that cannot be read become NULL")
    args = parser.parse_args()
    spark = session("encore")
    if args.job == "ingest":
        ingest(spark, args.kind, args.landed, args.raw, args.batch)
    elif args.job == "tours":
        refresh_tours(spark, args.raw)
    elif args.job == "declare":
        declare(spark, args.raw)
    elif args.job == "build":
        keep_for = None if args.keep_days is None else timedelta(days=args.keep_days)
        build(raw_tables(spark, args.raw), args.out, strict=args.strict, lenient=args.lenient, keep_for=keep_for)
    elif args.job == "find":
        pages_to_read(spark, raw_tables(spark, args.raw)).write.mode("overwrite").parquet(args.out)
    else:
        models = Models.read(spark, args.out)
        if args.job == "check":
            check(models).show(100, truncate=False)
        else:
            for name, df in analyses(spark, models, unique_events=args.strict).items():
                df.write.mode("overwrite").parquet(f"{args.reports}/{name}")


if __name__ == "__main__":
    main()
