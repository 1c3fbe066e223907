"""Projections and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions import calendar as cal, keys, money, nested, parse, report_text as text, text as words
from encore.operators.lookup import geocode
from encore.plans import staging

from . import roles
from .ingest import page_documents
from .oracle import key, title
from .registry import query

LATE = "case when o_orderstatus <> 'P' then o_totalprice end"


def late_price():
    """A price that is missing for pending orders."""
    return F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))


# Projections ------------------------------------------------------------------------------


@query("prj1_project_rename", "select c_custkey as artist_id, c_name as artist_name from customer")
def project_rename(t):
    return t.customer.select(F.col("c_custkey").alias("artist_id"), F.col("c_name").alias("artist_name"))


@query("prj2_all_plus_computed", f"select *, {key('c_custkey')} as customer_key from customer")
def all_plus_computed(t):
    return t.customer.withColumn("customer_key", keys.surrogate_key("c_custkey"))


@query("prj8_case_without_else", f"select o_orderkey, ({LATE} + o_custkey) / 2 as mid from orders")
def case_without_else(t):
    return t.orders.select("o_orderkey", money.midpoint(late_price(), "o_custkey").alias("mid"))


@query("prj9_weekday_names", "select o_orderkey, dayname(o_orderdate) as day_name from orders")
def weekday_names(t):
    return t.orders.select("o_orderkey", cal.day_name("o_orderdate").alias("day_name"))


@query("prj10_weekend_flag", """
  select o_orderkey, dayofweek(o_orderdate) in (0, 6) as is_weekend,
    case when dayofweek(o_orderdate) in (0, 6) then 'Weekend' else 'Weekday' end as label from orders""")
def weekend_flag(t):
    flag = cal.is_weekend("o_orderdate")
    return t.orders.select("o_orderkey", flag.alias("is_weekend"), cal.weekend_label(flag).alias("label"))


@query("prj11_long_weekend", """
  select o_orderkey, case when dayofweek(o_orderdate) in (0, 5, 6) then 'Weekend' else 'Weekday' end as label from orders""")
def long_weekend(t):
    return t.orders.select("o_orderkey", cal.long_weekend_label(cal.day_name("o_orderdate")).alias("label"))


@query("prj12_report_columns", "select c_name as artist, c_mktsegment as genre, c_acctbal as balance from customer")
def report_columns(t):
    return t.customer.select("c_name", "c_mktsegment", "c_acctbal").toDF("artist", "genre", "balance")


@query("prj13_drop_helper", "select s_suppkey, s_name from supplier")
def drop_helper(t):
    keyed = t.supplier.select("s_suppkey", "s_name").withColumn("helper", words.name_key("s_name"))
    return keyed.drop("helper")


# Text -------------------------------------------------------------------------------------


@query("scl1_trim", "select doc_id, trim(' ' || source || '  ') as source from documents")
def trim(t):
    padded = t.documents.select("doc_id", F.concat(F.lit(" "), "source", F.lit("  ")).alias("source"))
    return padded.select("doc_id", *staging._trim("source"))


@query("scl2_title_case", f"""
  select c_custkey, {title("name")} as by_breaks, {title("plain")} as by_space
  from (select c_custkey, 'the o''brien-' || lower(c_mktsegment) || '/dc j.' || c_name || ' & co' as name,
    lower(c_mktsegment) || ' band' as plain from customer)""")
def title_case(t):
    name = F.concat(F.lit("the o'brien-"), F.lower("c_mktsegment"), F.lit("/dc j."), "c_name", F.lit(" & co"))
    plain = F.concat(F.lower("c_mktsegment"), F.lit(" band"))
    return t.customer.select("c_custkey", words.title_case(name).alias("by_breaks"), words.title_case(plain, " ").alias("by_space"))


@query("scl3_upper_lower", "select p_partkey, upper(p_name) as u, lower(p_brand) as l from part")
def upper_lower(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("u"), F.lower("p_brand").alias("l"))


@query("scl4_name_key", "select p_partkey, lower(p_name) as k from part")
def name_key(t):
    return t.part.select("p_partkey", words.name_key(F.concat(F.lit("\t "), F.upper("p_name"), F.lit("\r\n "))).alias("k"))


@query("scl5_label", """
  select c_custkey, c_name || ' (' || nullif(c_mktsegment, 'HOUSEHOLD') || ')' as label from customer""")
def label(t):
    return t.customer.select("c_custkey", words.venue_label("c_name", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD"))).alias("label"))


MOMENT = """
  select event_id, case event_type when 'error' then '' when 'click' then strftime(ts, '%Y-%m-%d') else strftime(ts, '%Y-%m-%dT%H:%M:%S') end as m
  from events"""


@query("scl6_date_and_time_parts", f"""
  select event_id, nullif(substr(m, 1, 10), '') as d, nullif(substr(m, 12), '') as h from ({MOMENT})""")
def date_and_time_parts(t):
    moment = (
        F.when(F.col("event_type") == "error", "")
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return t.events.select("event_id", words.date_part(moment).alias("d"), words.time_part(moment).alias("h"))


@query("scl7_last_segment", "select page_id, list_extract(string_split(url, '/'), -1) as segment from pages")
def last_segment(t):
    return t.pages.select("page_id", words.last_segment("url").alias("segment"))


@query("scl8_prefix", "select doc_id, substr(text, 1, 5000) as kept, length(text) as n from documents")
def prefix(t):
    return t.documents.select("doc_id", F.substring("text", 1, 5000).alias("kept"), F.length("text").cast("bigint").alias("n"))


@query("scl9_listener_count", """
  select page_id, case when page_id > 9 then page_id * 1037 end as listeners from pages""")
def listener_count(t):
    return page_documents(t).select(
        F.substring_index("artist_name", " ", -1).cast("bigint").alias("page_id"), parse.monthly_listeners("markdown").cast("bigint").alias("listeners")
    )


@query("scl10_artist_link", """
  select page_id, case when page_id <> 3 then 'Id' || page_id || 'x' end as link from pages""")
def artist_link(t):
    linked = F.concat(F.col("html"), F.when(F.col("page_id") != 3, F.concat(
        F.lit(" see https://open.spotify.com/artist/Id"), "page_id", F.lit("x?si=1 and https://open.spotify.com/artist/other")
    )).otherwise(F.lit("")))
    return t.pages.select("page_id", parse.artist_link_id(linked).alias("link"))


@query("scl11_joined_names", """
  select p_partkey, case when p_size > 10 then p_type || ', ' || p_brand end as names from part""")
def joined_names(t):
    both = F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.col("p_brand").alias("name")))
    names = F.when(F.col("p_size") > 10, both).otherwise(F.slice(both, 1, 0))
    return t.part.select("p_partkey", nested.joined_names(names).alias("names"))


@query("scl12_surrogate_key", f"""
  select c_custkey, {key('c_custkey')} as k1, md5(coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), '_dbt_utils_surrogate_key_null_')
    || '-' || c_nationkey) as k2 from customer""")
def surrogate_key(t):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD"))
    return t.customer.select(
        "c_custkey", keys.surrogate_key("c_custkey").alias("k1"), keys.surrogate_key(segment, "c_nationkey").alias("k2")
    )


# Casts, dates, numbers --------------------------------------------------------------------


@query("scl13_casts", """
  select l_orderkey, l_linenumber, l_partkey, cast(cast(l_quantity as decimal(10,2)) as double) as dec, cast(l_quantity as bigint) as int,
    cast(cast(l_shipdate as date) as varchar) as day, try_cast(l_returnflag as bigint) as lenient from lineitem""")
def casts(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        staging._cast("l_quantity", "decimal(10,2)", False).cast("double").alias("dec"),
        staging._cast("l_quantity", "bigint", False).alias("int"),
        staging._cast("l_shipdate", "date", False).cast("string").alias("day"),
        staging._cast("l_returnflag", "bigint", True).alias("lenient"),
    )


def _dates(name: str, oracle: str, build):
    @query(name, f"select o_orderkey, {oracle} from orders")
    def dated(t):
        return t.orders.select("o_orderkey", *build())

    return dated


_dates("scl14_day_number", "cast(dayofweek(o_orderdate) as integer) as n", lambda: [cal.day_number("o_orderdate").alias("n")])
_dates("scl15_day_name", "dayname(o_orderdate) as n", lambda: [cal.day_name("o_orderdate").alias("n")])
_dates(
    "scl16_month_year_quarter",
    "cast(month(o_orderdate) as integer) as m, cast(year(o_orderdate) as integer) as y, cast(quarter(o_orderdate) as integer) as q",
    lambda: [F.month("o_orderdate").alias("m"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")],
)
_dates("scl17_month_name", "strftime(o_orderdate, '%b') as n", lambda: [cal.month_name("o_orderdate").alias("n")])
_dates("scl18_is_weekend", "dayofweek(o_orderdate) in (0, 6) as w", lambda: [cal.is_weekend("o_orderdate").alias("w")])


@query("scl19_midpoint", "select event_id, price_avg from frame")
def midpoint(t):
    fact = roles.star(t, with_artists=False).fact
    return fact.select("event_id", F.col("price_avg").cast("double").alias("price_avg"))


@query("scl20_streaming_estimate", "select o_orderkey, o_custkey * 50 * 12 * 0.004::double as est from orders")
def streaming_estimate(t):
    return t.orders.select("o_orderkey", money.streaming_estimate("o_custkey").alias("est"))


@query("scl21_revenue_multiplier", """
  select o_orderkey, cast(round_even(o_totalprice / greatest(e, 1), 0) as bigint) as multiplier
  from (select *, case when o_orderstatus <> 'P' then cast(o_custkey as double) * 50 * 12 * 0.004::double end as est from orders),
  lateral (select est as e) where e is not null
  union all select o_orderkey, null from orders where o_orderstatus = 'P'""")
def revenue_multiplier(t):
    listeners = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return t.orders.select("o_orderkey", money.revenue_multiplier("o_totalprice", money.streaming_estimate(listeners)).alias("multiplier"))


@query("scl22_conversion_rate", """
  select o_orderkey, case when o_custkey <> 0 then round_even(o_orderkey / cast(o_custkey as double) * 100, 1) end as rate from orders""")
def conversion_rate(t):
    return t.orders.select("o_orderkey", money.conversion_rate("o_orderkey", "o_custkey").alias("rate"))


@query("scl23_fill_zero", f"select o_orderkey, cast(coalesce({LATE}, 0) as bigint) as v from (select * replace (floor(o_totalprice) as o_totalprice) from orders)")
def fill_zero(t):
    return t.orders.select("o_orderkey", F.floor(late_price()).alias("v")).fillna(0, ["v"]).withColumn("v", F.col("v").cast("bigint"))


@query("scl24_empty_to_null", """
  select doc_id, nullif(case when lang = 'en' then '' else lang end, '') as lang, coalesce(nullif(case when lang = 'en' then '' else lang end, ''), 'none') as filled
  from documents""")
def empty_to_null(t):
    lang = words.empty_to_null(F.when(F.col("lang") == "en", "").otherwise(F.col("lang")))
    return t.documents.select("doc_id", lang.alias("lang"), F.coalesce(lang, F.lit("none")).alias("filled"))


@query("scl25_safe_nested_access", """
  select event_id, event_type, case when event_type <> 'view' then cast(regexp_extract(props, '[0-9]+') as integer) end as k from events""")
def safe_nested_access(t):
    parsed = F.from_json("props", "k INT")
    items = F.when(F.col("event_type") != "view", F.array(parsed)).otherwise(F.slice(F.array(parsed), 1, 0))
    return t.events.select("event_id", "event_type", nested.first_of(items)["k"].alias("k"))


@query("scl26_to_json", """
  select p_partkey, '{"size":' || p_size || ',"brand":"' || p_brand || '"}' as j from part""")
def to_json(t):
    return t.part.select("p_partkey", F.to_json(F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))).alias("j"))


@query("scl27_report_text", f"""
  select o_orderkey, coalesce(format('{{:,}}', cast(round_even({LATE}, 0) as bigint)), '—') as thousands,
    coalesce('$' || format('{{:,}}', cast(round_even({LATE}, 0) as bigint)), 'N/A') as dollars,
    coalesce('$' || format('{{:,}}', cast(round_even({LATE} * 1000 / 1e6, 0) as bigint)) || 'M', '—') as millions,
    coalesce(format('{{:.1f}}', {LATE} / 1000) || '%', '—') as percent, o_custkey || 'x' as times from orders""")
def report_text(t):
    price = late_price()
    return t.orders.select(
        "o_orderkey",
        text.thousands(price).alias("thousands"),
        text.dollars(price).alias("dollars"),
        text.millions(price * 1000).alias("millions"),
        text.percent(price / 1000).alias("percent"),
        text.times("o_custkey").alias("times"),
    )


@query("scl28_membership", "select p_partkey, p_type in ('ECONOMY', 'SMALL') as member from part")
def membership(t):
    return t.part.select("p_partkey", F.col("p_type").isin("ECONOMY", "SMALL").alias("member"))


@query("scl29_containment", "select p_partkey, contains(lower(p_name), lower('RED')) as red from part")
def containment(t):
    return t.part.select("p_partkey", words.contains_ignoring_case("p_name", F.lit("RED")).alias("red"))


# Functions that are expressions or joins, never Python per row ------------------------------


@query("udf1_geocode", "select venue_key, lat, lon from located")
def geocoded(t):
    return geocode(roles.venues(t), roles.places(t)).select("venue_key", "lat", "lon")


@query("udf2_cell_format", """
  select event_id, case when value > 0 then format('{:,}', cast(round_even(value, 0) as bigint)) else '—' end as shown,
    format('{:.2f}', value) as score from events""")
def cell_format(t):
    return t.events.select("event_id", text.positive_thousands("value").alias("shown"), text.two_decimals("value").alias("score"))


@query("udf3_key_function", f"select p_partkey, {key('p_name')} as k from part")
def key_function(t):
    return t.part.select("p_partkey", keys.surrogate_key("p_name").alias("k"))
