"""Sources, sinks, feeds and staging models over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore import schemas
from encore.operators.aggregates import count_by, union_distinct
from encore.operators.joins import union_with_precedence
from encore.operators.latest import keep_first
from encore.session import small_reads, small_sorts
from encore.sources import landed, ledger, tables, versions

from . import roles
from .oracle import LOW, text_of
from .registry import query

LINE = "case when l_linenumber < 7 then"


def doubles(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def stamps_as_text(df, name="loaded_at"):
    return df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))


# Scans and landed documents ---------------------------------------------------------------


@query("src1_declared_scan", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_returnflag = 'A'")
def declared_scan(t):
    return t.lineitem.where(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", "l_quantity")


def event_documents(t):
    """Lines as landed JSON text: no venues for line 7, no prices where a line is flagged N."""
    venue = F.struct(
        F.col("l_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.struct(F.col("n_name").alias("name")).alias("city"),
        F.struct(F.col("r_name").alias("stateCode")).alias("state"),
    )
    other = F.struct(
        F.lit("other").alias("id"),
        F.lit("Other").alias("name"),
        F.struct(F.lit("Elsewhere").alias("name")).alias("city"),
        F.struct(F.lit("ZZ").alias("stateCode")).alias("state"),
    )
    artist = F.struct(F.col("l_partkey").cast("string").alias("id"), F.concat(F.lit("act "), "l_partkey").alias("name"))
    price = F.struct(
        roles.low_price().cast("double").alias("min"), F.col("l_extendedprice").alias("max"), F.lit("USD").alias("currency")
    )
    genre = F.struct(F.struct(F.col("l_linestatus").alias("name")).alias("genre"))
    document = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.concat(F.lit("show "), "l_partkey").alias("name"),
        F.concat(F.lit("https://events.example.com/"), "l_orderkey").alias("url"),
        F.struct(
            F.struct(
                F.date_format("l_shipdate", "yyyy-MM-dd").alias("localDate"), F.lit("20:00:00").alias("localTime")
            ).alias("start"),
            F.struct(F.lower("l_returnflag").alias("code")).alias("status"),
        ).alias("dates"),
        F.struct(
            F.when(F.col("l_linenumber") < 7, F.array(venue, other)).otherwise(F.slice(F.array(venue), 1, 0)).alias("venues"),
            F.array(artist).alias("attractions"),
        ).alias("_embedded"),
        F.when(F.col("l_returnflag") != "N", F.array(price)).alias("priceRanges"),
        F.when(F.col("l_linestatus") == "F", F.array(genre)).alias("classifications"),
    )
    return roles.places_of_lines(t).select(F.to_json(document).alias("document"))


@query("src2_flatten_events", f"""
  select l_orderkey || '-' || l_linenumber as event_id, 'show ' || l_partkey as event_name,
    'https://events.example.com/' || l_orderkey as event_url, strftime(l_shipdate, '%Y-%m-%d') as event_date, '20:00:00' as event_time,
    lower(l_returnflag) as sale_status, 'act ' || l_partkey as artist_name, cast(l_partkey as varchar) as artist_id,
    {LINE} s_name end as venue_name, {LINE} cast(l_suppkey as varchar) end as venue_id, {LINE} n_name end as city,
    {LINE} r_name end as state, cast({LOW} as double) as price_min,
    case when l_returnflag <> 'N' then l_extendedprice end as price_max, case when l_returnflag <> 'N' then 'USD' end as currency,
    case when l_linestatus = 'F' then l_linestatus end as genre from lines""")
def flatten_events(t):
    small_reads(t.spark)
    return landed.flatten_events(landed.parse_landed(event_documents(t), "document", schemas.EVENT_DOC)).drop("loaded_at")


def performer_documents(t):
    named = F.array(F.struct(F.lower("c_mktsegment").alias("name")), F.struct(F.lit("live").alias("name")))
    document = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("no. "), "c_custkey").alias("short_name"),
        F.concat(F.lit("https://tickets.example.com/"), "c_custkey").alias("url"),
        (F.col("c_acctbal") / 10000).alias("score"),
        F.col("c_acctbal").alias("popularity"),
        F.col("c_nationkey").cast("bigint").alias("num_upcoming_events"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", named).otherwise(F.slice(named, 1, 0)).alias("genres"),
        F.lit("band").alias("type"),
    )
    return t.customer.select(F.to_json(document).alias("document"))


@query("src3_flatten_performers", """
  select cast(c_custkey as varchar) as performer_id, c_name as performer_name, 'no. ' || c_custkey as short_name,
    'https://tickets.example.com/' || c_custkey as seatgeek_url, c_acctbal / 10000 as sg_score, c_acctbal as sg_popularity,
    cast(c_nationkey as bigint) as upcoming_events, case when c_mktsegment <> 'HOUSEHOLD' then lower(c_mktsegment) || ', live' end as genres,
    'band' as performer_type from customer""")
def flatten_performers(t):
    docs = landed.parse_landed(performer_documents(t), "document", schemas.PERFORMER_DOC)
    return landed.flatten_performers(docs).drop("loaded_at")


def listing_documents(t):
    """Lines of an order are deliveries of one listing, in order of their line."""
    performers = F.array(
        F.struct(F.col("l_suppkey").alias("id"), F.lit("support").alias("name"), F.lit(False).alias("primary")),
        F.struct(F.col("l_partkey").alias("id"), F.lit("headliner").alias("name"), (F.col("l_returnflag") == "R").alias("primary")),
    )
    document = F.struct(
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit("listing "), "l_orderkey").alias("title"),
        F.lit("https://tickets.example.com/").alias("url"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("datetime_local"),
        F.lit("concert").alias("type"),
        F.when(F.col("l_returnflag") != "N", performers).otherwise(F.slice(performers, 1, 0)).alias("performers"),
        F.struct(F.col("l_suppkey").alias("id"), F.lit("hall").alias("name"), F.lit("city").alias("city"), F.lit("ST").alias("state")).alias("venue"),
        F.struct(
            F.col("l_discount").alias("lowest_price"), F.col("l_quantity").alias("average_price"),
            F.col("l_extendedprice").alias("highest_price"), F.col("l_partkey").alias("listing_count"),
        ).alias("stats"),
        F.col("l_tax").alias("popularity"),
        F.col("l_discount").alias("score"),
    )
    return t.lineitem.select("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", F.to_json(document).alias("document"))


FIRST_LISTING = """
  select * from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_shipdate, l_partkey, l_suppkey) as rn
    from lineitem) where rn = 1"""


@query("src4_flatten_listings", f"""
  select cast(l_orderkey as varchar) as event_id, 'listing ' || l_orderkey as event_title, 'https://tickets.example.com/' as event_url,
    strftime(l_shipdate, '%Y-%m-%d') as event_date, case when l_linestatus = 'F' then strftime(l_shipdate, '%H:%M:%S') end as event_time,
    'concert' as event_type,
    case l_returnflag when 'R' then 'headliner' when 'A' then 'support' end as performer_name,
    case l_returnflag when 'R' then cast(l_partkey as varchar) when 'A' then cast(l_suppkey as varchar) end as performer_id,
    'hall' as venue_name, cast(l_suppkey as varchar) as venue_id, 'city' as city, 'ST' as state, l_discount as lowest_price,
    l_quantity as average_price, l_extendedprice as highest_price, l_partkey as listing_count, l_tax as event_popularity,
    l_discount as event_score from ({FIRST_LISTING})""")
def flatten_listings(t):
    small_sorts(t.spark)
    order = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]
    docs = landed.parse_landed(listing_documents(t), "document", schemas.LISTING_DOC)
    flat = landed.flatten_listings(docs, beside=order).drop("loaded_at")
    return keep_first(flat, "event_id", order, drop_missing=False).drop(*order)


def page_documents(t):
    """Pages with a listener phrase and an artist link put in front of most of them."""
    phrase = F.concat(F.format_number(F.col("page_id") * 1037, 0), F.lit(" Monthly\n Listeners "))
    return t.pages.select(
        F.concat(F.lit("Act "), "page_id").alias("artist_name"),
        "url",
        F.when(F.col("page_id") > 20, F.regexp_extract("html", "<title>(.*?)</title>", 1)).alias("title"),
        F.concat(F.when(F.col("page_id") > 9, phrase).otherwise(F.lit("")), F.col("html")).alias("markdown"),
        F.when(
            F.col("page_id") > 4,
            F.create_map(F.lit("title"), F.concat(F.lit("Page "), "page_id"), F.lit("description"), F.lit("about an act")),
        ).alias("metadata"),
    )


@query("src5_parse_pages", """
  select list_extract(string_split(url, '/'), -1) as artist_id, 'Act ' || page_id as artist_name, url as spotify_url,
    case when page_id > 9 then page_id * 1037 end as monthly_listeners,
    coalesce(nullif(case when page_id > 20 then regexp_extract(html, '<title>(.*?)</title>', 1) end, ''),
      case when page_id > 4 then 'Page ' || page_id end, '') as page_title,
    case when page_id > 4 then 'about an act' else '' end as page_description,
    case when page_id > 9 then format('{:,}', page_id * 1037) || ' Monthly' || chr(10) || ' Listeners ' else '' end || html as raw_markdown,
    case when page_id > 4 then '{"title":"Page ' || page_id || '","description":"about an act"}' end as raw_metadata
  from pages""")
def parse_pages(t):
    pages = landed.parse_pages(page_documents(t)).drop("loaded_at")
    return pages.withColumn("monthly_listeners", F.col("monthly_listeners").cast("bigint"))


# Sinks ------------------------------------------------------------------------------------

LOADED = ["o_orderkey", "o_custkey", "o_orderstatus"]
LOADED_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING"


@query("src6_append_load", "select o_orderkey, o_custkey, o_orderstatus from orders union all select o_orderkey, o_custkey, 'again' from orders")
def append_load(t):
    path = tables.new_location(t.spark, "appended")
    tables.append_rows(t.orders, path, LOADED)
    tables.append_rows(t.orders.withColumn("o_orderstatus", F.lit("again")), path, LOADED)
    return tables.scan(t.spark, path, LOADED_DDL)


@query("src6_repeated_append", "select o_orderkey, o_custkey, o_orderstatus from orders union all select o_orderkey, o_custkey, 'later' from orders")
def repeated_append(t):
    """Two loads, the first sent twice."""
    path = tables.new_location(t.spark, "loads")
    for batch, load in (("1", t.orders), ("2", t.orders.withColumn("o_orderstatus", F.lit("later"))), ("1", t.orders)):
        ledger.append_once(load, path, LOADED, batch)
    return ledger.scan_loads(t.spark, path, LOADED_DDL)


@query("src7_full_refresh", "select o_orderkey, o_custkey, o_orderstatus from orders")
def full_refresh(t):
    path = tables.new_location(t.spark, "refreshed")
    tables.replace_rows(t.orders.withColumn("o_orderstatus", F.lit("old")), path, LOADED)
    tables.replace_rows(t.orders, path, LOADED)
    return tables.scan(t.spark, path, LOADED_DDL)


@query("src8_inline_rows", """
  select p.city, p.state, count(*) as halls from places p join halls h on p.city = h.city and p.state = h.state group by p.city, p.state""")
def inline_rows(t):
    return count_by(roles.venues(t).join(roles.places(t), ["city", "state"]), "city", "state", name="halls")


@query("src9_create_if_absent", "select p_partkey, p_name from part")
def create_if_absent(t):
    path = tables.new_location(t.spark, "declared")
    name = "declared_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        tables.create_if_absent(t.spark, name, "p_partkey BIGINT, p_name STRING", path)
    t.part.select("p_partkey", "p_name").write.insertInto(name)
    return t.spark.table(name)


@query("src10_load_stamp", "select o_orderkey, true as stamped, cast(1 as bigint) as stamps from orders")
def load_stamp(t):
    loads = tables.stamped(t.orders.select("o_orderkey"))
    distinct = loads.agg(F.count_distinct("loaded_at").alias("n")).scalar()
    return loads.select("o_orderkey", F.col("loaded_at").isNotNull().alias("stamped"), distinct.alias("stamps"))


@query("src11_view_and_table", "select o_orderstatus, year(o_orderdate) as y, count(*) as n from orders group by 1, 2")
def view_and_table(t):
    path = tables.new_location(t.spark, "model")
    dated = t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("bigint").alias("y"))
    table = tables.materialise(dated, path, ["y"])
    view = tables.publish_view(table, "model_" + path.rsplit("-", 1)[1])
    return view.groupBy("o_orderstatus", "y").agg(F.count("o_orderkey").alias("n"))


@query("src11_published_version", "select o_orderkey, 'new' as of_version from orders")
def published_version(t):
    """Readers see the version published last, whole, while the next one is being written."""
    root = tables.new_location(t.spark, "set")
    for name, publish in (("old", True), ("new", True), ("unfinished", False)):
        folder = versions.new_version(root)
        t.orders.select("o_orderkey", F.lit(name).alias("of_version")).write.parquet(f"{folder}/orders")
        if publish:
            versions.publish(t.spark, root, folder)
    return tables.scan(t.spark, f"{versions.current(t.spark, root)}/orders", "o_orderkey BIGINT, of_version STRING")


@query("src12_reused_result", """
  select 'status' as part, o_orderstatus as value, count(*) as n from orders group by 2
  union all select 'priority', o_orderpriority, count(*) from orders group by 2""")
def reused_result(t):
    counts = tables.reused(t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")))

    def part(label, column):
        return counts.groupBy(F.lit(label).alias("part"), F.col(column).alias("value")).agg(F.sum("n").alias("n"))

    return part("status", "o_orderstatus").unionByName(part("priority", "o_orderpriority"))


# Feeds ------------------------------------------------------------------------------------


def feeds(t):
    """Two overlapping feeds of orders: one sorted by key, one of urgent orders from another place."""
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    broad = t.orders.where(F.col("o_orderstatus") != "P").select(*columns)
    targeted = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", (F.col("o_custkey") + 1000000).alias("o_custkey"), "o_orderpriority"
    )
    return broad, targeted


FEEDS = """
  select o_orderkey, o_custkey, o_orderpriority, 1 as feed_rank from orders where o_orderstatus <> 'P'
  union all select o_orderkey, o_custkey + 1000000, o_orderpriority, 2 from orders where o_orderpriority = '1-URGENT'"""


@query("set1_union_feeds", FEEDS)
def union_feeds(t):
    return landed.union_feeds(*feeds(t))


@query("set2_keep_first", f"""
  select o_orderkey, o_custkey, feed_rank from (select *, row_number() over (partition by o_orderkey order by feed_rank, o_custkey) as rn
    from ({FEEDS})) where rn = 1""")
def keep_first_of_feeds(t):
    united = landed.union_feeds(*feeds(t)).withColumn("id", F.col("o_orderkey").cast("string"))
    return keep_first(united, "id", ["feed_rank", "o_custkey"]).select("o_orderkey", "o_custkey", "feed_rank")


@query("set3_union_distinct", "select c_name as name from customer union select s_name from supplier order by name")
def names_of_both(t):
    return union_distinct(t.customer.select(F.col("c_name").alias("name")), t.supplier.select(F.col("s_name").alias("name")), "name")


@query("set4_union_with_precedence", """
  select p_name, p_brand from part where p_size > 25 union all
  select upper(p_name), 'found' from part where lower(p_name) not in (select lower(p_name) from part where p_size > 25)""")
def precedence(t):
    curated = t.part.where(F.col("p_size") > 25).select("p_name", "p_brand")
    found = t.part.select(F.upper("p_name").alias("p_name"), F.lit("found").alias("p_brand"))
    return union_with_precedence(curated, found, "p_name")


# Staging models ---------------------------------------------------------------------------


@query("prj3_staging_events", f"""
  select * replace (cast(event_date as varchar) as event_date, cast(price_min as double) as price_min,
    cast(price_max as double) as price_max, {text_of('loaded_at')} as loaded_at) from stg_events""")
def staging_events(t):
    small_sorts(t.spark)
    staged = roles.stg_events(t).withColumn("event_date", F.col("event_date").cast("string"))
    return stamps_as_text(doubles(staged, "price_min", "price_max"))


@query("prj4_staging_listeners", f"select * replace ({text_of('loaded_at')} as loaded_at) from stg_listeners")
def staging_listeners(t):
    return stamps_as_text(roles.stg_listeners(t))


@query("prj5_staging_performers", f"select * replace ({text_of('loaded_at')} as loaded_at) from stg_performers")
def staging_performers(t):
    return stamps_as_text(roles.stg_performers(t))


@query("prj6_staging_listings", f"""
  select * replace (cast(event_date as varchar) as event_date, cast(lowest_price as double) as lowest_price,
    cast(highest_price as double) as highest_price, {text_of('loaded_at')} as loaded_at),
    cast(lowest_price + highest_price as double) / 2 as average_price from stg_listings""")
def staging_listings(t):
    return stamps_as_text(roles.stg_listings(t).withColumn("event_date", F.col("event_date").cast("string")))


@query("prj7_staging_tours", f"""
  select * replace (cast(gross_revenue as double) as gross_revenue, cast(tickets_sold as double) as tickets_sold,
    cast(avg_ticket_price as double) as avg_ticket_price, {text_of('loaded_at')} as loaded_at) from stg_tours""")
def staging_tours(t):
    staged = doubles(roles.stg_tours(t), "gross_revenue", "tickets_sold", "avg_ticket_price")
    return stamps_as_text(staged.withColumn("shows", F.col("shows").cast("bigint")))
