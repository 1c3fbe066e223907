"""Single filters, joins, aggregates, windows, orders and checks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions.calendar import DAYS, MONTHS
from encore.operators import aggregates, filters, joins, ranking, skew
from encore.operators.checks import failed_run, not_null, repeated_keys, run_checks, unique
from encore.operators.current import LatestTable
from encore.operators.latest import first_per_key, latest_per_key
from encore.operators.lookup import exact_places, geocode
from encore.operators.scaffold import fill_days
from encore.plans import marts, reports
from encore.plans.layouts import lay_out
from encore.sources.tables import new_location

from . import roles
from .analyses import MEAN, built_models
from .registry import query
from .tables import SCHEMAS

SEGMENT = "nullif(c_mktsegment, 'HOUSEHOLD')"


def segments(t):
    """Customers with a segment that may be missing."""
    return t.customer.withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")))


# Filters ----------------------------------------------------------------------------------


@query("flt1_known_text", f"select c_custkey, {SEGMENT} as segment from customer where {SEGMENT} is not null and {SEGMENT} <> ''")
def known_text(t):
    return filters.known_text(segments(t), "segment").select("c_custkey", "segment")


@query("flt2_rank_filter", """
  select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn
    from orders) where rn = 1""")
def rank_filter(t):
    slim = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return latest_per_key(slim, ["o_custkey"], "o_totalprice", [F.col("o_orderkey").asc()]).select("o_custkey", "o_orderkey")


@query("flt3_threshold_after_latest", """
  select user_id, value from (select *, row_number() over (partition by user_id order by ts desc) as rn from events
    where event_type = 'purchase') where rn = 1 and value > 30""")
def threshold_after_latest(t):
    bought = t.events.where(F.col("event_type") == "purchase").select("user_id", "ts", "value")
    return filters.above(latest_per_key(bought, ["user_id"], "ts"), "value", 30).select("user_id", "value")


@query("flt4_priced_rows", "select event_id, price_avg from frame where price_avg is not null and price_avg > 0")
def priced_rows(t):
    fact = roles.star(t, with_artists=False).fact.select("event_id", F.col("price_avg").cast("double").alias("price_avg"))
    return filters.priced_rows(fact)


@query("flt5_selected_value", "select c_custkey, c_name from customer where c_mktsegment = 'BUILDING'")
def selected_value(t):
    return filters.selected(t.customer, "c_mktsegment", "BUILDING").select("c_custkey", "c_name")


@query("flt6_selected_ignoring_case", "select p_partkey, p_name from part where lower(p_name) = lower('Red WIDGET')")
def selected_ignoring_case(t):
    return filters.selected_name(t.part, "p_name", "Red WIDGET").select("p_partkey", "p_name")


@query("flt7_at_most", """
  select c_custkey, count(o_orderkey) as orders from customer left join orders on c_custkey = o_custkey group by c_custkey
  having count(o_orderkey) <= 6""")
def at_most(t):
    counts = aggregates.count_by(t.orders, "o_custkey", name="orders")
    both = t.customer.select("c_custkey").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0, ["orders"])
    return filters.at_most(both, "orders", 6).select("c_custkey", "orders")


@query("flt8_geocoded_only", "select venue_key, lat, lon from located where lat is not null")
def geocoded_only(t):
    return filters.known(geocode(roles.venues(t), roles.places(t)), "lat").select("venue_key", "lat", "lon")


# Joins ------------------------------------------------------------------------------------


@query("jn1_star_build", """
  select event_id, f.artist_key, f.venue_key, date_key from fact f""")
def star_build(t):
    return built_models(t).fact_events.select("event_id", "artist_key", "venue_key", "date_key")


@query("jn2_star_read", """
  select event_id, artist_name, genre, venue_name, city, state, day_name, month_name from frame""")
def star_read(t):
    star = roles.star(t)
    wide = joins.attach(star.fact, star.artists.frame, {"artist_key": "artist_key"}, ["artist_name", "genre"])
    wide = joins.attach(wide, star.venues.frame, {"venue_key": "venue_key"}, ["venue_name", "city", "state"])
    wide = joins.attach(wide, star.dates.frame, {"event_date": "event_date"}, ["day_name", "month_name"])
    return wide.select("event_id", "artist_name", "genre", "venue_name", "city", "state", "day_name", "month_name")


@query("jn2_star_bucketed", """
  select 'genre' as attribute, genre as value, count(event_id) as events from fact f join dim_artists a on f.artist_key = a.artist_key
    where genre is not null group by genre
  union all select 'state', state, count(event_id) from fact f join dim_venues v on f.venue_key = v.venue_key where state is not null group by state
  union all select 'day_name', day_name, count(event_id) from fact f join dim_dates d on f.date_key = d.date_key where day_name is not null group by day_name""")
def star_bucketed(t):
    """Events per attribute of each dimension, from layouts of the fact by its key."""
    star, result = built_models(t).star(), None
    for dim, attribute in ((star.artists, "genre"), (star.venues, "state"), (star.dates, "day_name")):
        layout = lay_out(star.fact, dim, ["event_id"], new_location(t.spark, "layout"), buckets=8, take=[attribute])
        part = layout.grouped(attribute, {"events": F.count("event_id")}).select(
            F.lit(attribute).alias("attribute"), F.col(attribute).alias("value"), "events")
        result = part if result is None else result.unionByName(part)
    return result


@query("jn3_enrichment_by_name", """
  select artist_key, tm_artist_id, artist_name, genre, spotify_artist_id, spotify_url, monthly_listeners, sg_performer_id, seatgeek_url,
    round(sg_score, 6) as sg_score, sg_popularity, sg_upcoming_events, sg_genres from dim_artists""")
def enrichment(t):
    dim = marts.dim_artists(roles.stg_events(t), roles.stg_listeners(t), roles.stg_performers(t))
    return dim.withColumn("sg_score", F.round("sg_score", 6))


@query("jn3_enrichment_strict", """
  select a.artist_name, monthly_listeners from (select distinct artist_name from dim_artists) a left join (
    select *, row_number() over (partition by lower(artist_name) order by loaded_at desc, artist_name desc, spotify_url desc,
      monthly_listeners desc nulls last) as rn from stg_listeners) s on lower(a.artist_name) = lower(s.artist_name) and rn = 1""")
def enrichment_strict(t):
    dim = marts.dim_artists(roles.stg_events(t), roles.stg_listeners(t), roles.stg_performers(t), strict=True)
    return dim.select("artist_name", "monthly_listeners")


@query("jn3_name_fan_out", """
  select p.p_partkey, q.sizes from part p left join (select upper(p_name) as n, p_brand, count(*) as sizes from part group by 1, 2) q
    on lower(p.p_name) = lower(q.n)""")
def name_fan_out(t):
    brands = t.part.groupBy(F.upper("p_name").alias("n"), "p_brand").agg(F.count(F.lit(1)).alias("sizes"))
    return joins.attach_by_name(t.part, brands, "p_name", "n", ["sizes"]).select("p_partkey", "sizes")


@query("jn4_full_outer_hot", """
  select coalesce(l.flag, r.flag) as flag, coalesce(l.linenumber, -1) as linenumber, coalesce(m, -1) as m, count(*) as lines
  from (select nullif(l_returnflag, 'A') as flag, l_linenumber as linenumber from lineitem) l
  full join (select nullif(o_orderstatus, 'P') as flag, count(*) as m from orders group by 1
    union all select 'N', count(*) from orders union all select nullif(l_returnflag, 'R'), count(*) from lineitem group by 1) r
    on l.flag is not distinct from r.flag group by 1, 2, 3""")
def full_outer_hot(t):
    """Three values hold all lines; one of them is missing."""
    left = t.lineitem.select(F.nullif(F.col("l_returnflag"), F.lit("A")).alias("flag"), F.col("l_linenumber").alias("linenumber"))
    per = t.orders.groupBy(F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("flag")).agg(F.count(F.lit(1)).alias("m"))
    every = t.orders.agg(F.count(F.lit(1)).alias("m")).select(F.lit("N").alias("flag"), "m")
    flags = t.lineitem.groupBy(F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag")).agg(F.count(F.lit(1)).alias("m"))
    joined = skew.outer_by_hot_name(left, per.unionByName(every).unionByName(flags), "flag").fillna(-1, ["linenumber", "m"])
    return joined.groupBy("flag", "linenumber", "m").agg(F.count(F.lit(1)).alias("lines"))


@query("jn4_full_outer_by_name", f"""
  select coalesce(a.segment, b.segment) as segment, n, coalesce(m, 0) as m
  from (select {SEGMENT} as segment, count(*) as n from customer group by 1) a
  full join (select nullif(c_mktsegment, 'BUILDING') as segment, count(*) as m from customer group by 1) b
    on a.segment is not distinct from b.segment""")
def full_outer(t):
    left = segments(t).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    right = t.customer.groupBy(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")).agg(F.count(F.lit(1)).alias("m"))
    return joins.outer_by_name(left, right, "segment").fillna(0, ["m"]).select("segment", "n", "m")


@query("jn5_inner_by_name", "select t.artist_name, tour_name, monthly_listeners from tours t join listeners l on t.artist_name = l.artist_name")
def inner_by_name(t):
    return reports.revenue_comparison(roles.tours(t), roles.listeners(t)).select("artist_name", "tour_name", "monthly_listeners")


@query("jn6_left_by_stripped_name", """
  select c_name, coalesce(n, 0) as n from customer left join (select lower(trim(artist_name)) as k, count(*) as n from stg_tours group by 1)
    on lower(trim(replace(c_name, '#', '-No.'))) = k""")
def left_by_stripped_name(t):
    counts = roles.stg_tours(t).groupBy(F.concat(F.lit("\t"), F.upper("artist_name"), F.lit(" \n")).alias("artist_name")).agg(
        F.count(F.lit(1)).alias("n")
    )
    names = t.customer.select("c_name", F.replace("c_name", F.lit("#"), F.lit("-No.")).alias("artist_name"))
    return joins.left_by_name_key(names, counts, "artist_name", ["n"]).fillna(0, ["n"]).select("c_name", "n")


@query("jn7_top_rows_with_audience", """
  select c.artist_name, events, monthly_listeners from (select artist_name, count(event_id) as events from frame
    where artist_name is not null group by 1 order by 2 desc, 1 limit 10) c left join listeners l on c.artist_name = l.artist_name""")
def top_rows_with_audience(t):
    top = reports.top_by(roles.star(t), "artist_name", 10)
    return top.join(roles.listeners(t), "artist_name", "left").select("artist_name", "events", "monthly_listeners")


@query("jn8_calendar_scaffold", """
  select genre, d.day_name, count(f.event_id) as events
  from (select g.genre, days.day_name from (select distinct genre from frame where genre is not null) g cross join days) d
  left join (select genre as g, day_name, event_id from frame where day_name <> 'Monday' and day_name <> 'Sunday') f
    on d.genre = f.g and d.day_name = f.day_name
  group by genre, d.day_name""")
def calendar_scaffold(t):
    counts = roles.star(t).rollup("genre", "day_name").where(~F.col("day_name").isin("Monday", "Sunday"))
    genres = roles.star(t).rollup("genre").select("genre", F.lit("none").alias("day_name"), F.lit(0).alias("events"))
    return fill_days(counts.select("genre", "day_name", "events").unionByName(genres), by=["genre"])


@query("jn9_exact_lookup", """
  select venue_key, p.lat, p.lon from halls h left join places p on h.city = p.city and h.state = p.state""")
def exact_lookup(t):
    places, venues = exact_places(roles.places(t)), roles.venues(t)
    found = venues.join(places, (venues.city == places["__city"]) & (venues.state == places["__state"]), "left")
    return found.select("venue_key", F.col("__lat").alias("lat"), F.col("__lon").alias("lon"))


@query("jn10_lookup_with_fallback", "select venue_key, city, state, lat, lon from located")
def lookup_with_fallback(t):
    return geocode(roles.venues(t), roles.places(t)).select("venue_key", "city", "state", "lat", "lon")


@query("jn11_anti_by_name", """
  select p_partkey, p_name from part where lower(p_name) not in (select lower(p_name) from part where p_brand = 'Brand#3')""")
def anti_by_name(t):
    excluded = t.part.where(F.col("p_brand") == "Brand#3").select(F.upper("p_name").alias("p_name"))
    return joins.without_names(t.part, excluded, "p_name").select("p_partkey", "p_name")


# Aggregates -------------------------------------------------------------------------------


@query("ag1_rows_per_key", f"select {SEGMENT} as segment, count(*) as events from customer where {SEGMENT} is not null group by 1")
def rows_per_key(t):
    return aggregates.count_by(segments(t), "segment")


@query("ag2_values_per_key", "select o_custkey, count(case when o_orderstatus <> 'P' then o_orderkey end) as n from orders group by 1")
def values_per_key(t):
    known = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("k"))
    return aggregates.count_by(known, "o_custkey", of="k", name="n")


@query("ag3_rows_per_composite_key", f"""
  select c_nationkey, {SEGMENT} as segment, count(*) as events from customer where {SEGMENT} is not null group by 1, 2""")
def rows_per_composite_key(t):
    return aggregates.count_by(segments(t), "c_nationkey", "segment")


@query("ag4_rows_per_text", f"select {SEGMENT} as segment, count(*) as n from customer where {SEGMENT} <> '' group by 1")
def rows_per_text(t):
    return aggregates.count_text_by(segments(t), "segment", "n")


@query("ag5_distinct_counts", "select count(distinct event_id) as events, count(distinct artist_name) as artists, count(distinct venue_name) as venues from frame")
def distinct_counts(t):
    names = {"events": "event_id", "artists": "artist_name", "venues": "venue_name"}
    return roles.events_frame(t).agg(*aggregates.distinct_counts(names))


@query("ag6_filtered_mean", """
  select round(avg(case when l_discount > 0 then l_discount end), 9) as mean, avg(case when l_discount > 5 then l_discount end) as none from lineitem""")
def filtered_mean(t):
    return t.lineitem.withColumn("negative", -F.col("l_discount")).agg(
        F.round(aggregates.mean_where_positive("l_discount", "mean"), 9).alias("mean"),
        aggregates.mean_where_positive("negative", "none"),
    )


@query("ag7_mean_per_key", f"select genre, {MEAN} as avg_price from frame where price_avg > 0 and genre is not null group by genre")
def mean_per_key(t):
    star = roles.star(t)
    priced = filters.priced_rows(star.fact).join(star.artists.frame, "artist_key", "left")
    return aggregates.mean_by(priced, "genre", "price_avg", "avg_price")


@query("ag8_sums_and_gap", """
  select sum(gross_revenue) as gross, round(sum(est_annual_streaming), 2) as est, round(sum(gross_revenue) - sum(est_annual_streaming), 2) as gap,
    round(avg(conversion_rate), 6) as rate from compared""")
def sums_and_gap(t):
    compared = reports.revenue_comparison(roles.tours(t), roles.listeners(t))
    gross, est = F.sum("gross_revenue"), F.sum("est_annual_streaming")
    return compared.agg(gross.alias("gross"), F.round(est, 2).alias("est"), F.round(gross - est, 2).alias("gap"),
                        F.round(F.avg("conversion_rate"), 6).alias("rate"))


@query("ag9_most_frequent", """
  select o_custkey, o_orderpriority from (select o_custkey, o_orderpriority,
      row_number() over (partition by o_custkey order by count(*) desc, o_orderpriority) as rn from orders group by 1, 2) where rn = 1""")
def most_frequent(t):
    counts = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.most_frequent(counts, ["o_custkey"], "o_orderpriority", "n")


@query("ag10_histogram", """
  select cast(i as integer) as bin, coalesce(n, 0) as events from unnest(generate_series(1, 20)) as g(i)
  left join (select least(floor(20 * (s_acctbal - lo) / (hi - lo)) + 1, 20) as k, count(*) as n
    from supplier cross join (select min(s_acctbal) as lo, max(s_acctbal) as hi from supplier) group by 1) on k = i""")
def histogram(t):
    return aggregates.histogram(t.supplier, "s_acctbal").select("bin", "events")


@query("ag11_distinct_rows", "select distinct s_nationkey, n_name, r_name from lines where s_nationkey is not null")
def distinct_rows(t):
    return aggregates.distinct_rows(roles.places_of_lines(t), "s_nationkey", "n_name", "r_name")


@query("ag11_dim_venues", "select * from dim_venues")
def dim_venues(t):
    return marts.dim_venues(roles.stg_events(t))


@query("ag11_dim_dates", "select * replace (cast(event_date as varchar) as event_date) from dim_dates")
def dim_dates(t):
    return marts.dim_dates(roles.stg_events(t)).withColumn("event_date", F.col("event_date").cast("string"))


@query("ag12_sorted_distinct", f"select distinct {SEGMENT} as segment from customer where {SEGMENT} is not null order by 1")
def sorted_distinct(t):
    return aggregates.distinct_values(segments(t), "segment")


@query("ag13_counts_by_weekday", "select dayname(o_orderdate) as day_name, count(*) as events from orders group by 1")
def counts_by_weekday(t):
    return ranking.by_ordinal(aggregates.count_by(t.orders.select(F.date_format("o_orderdate", "EEEE").alias("day_name")), "day_name"), "day_name", DAYS)


# Windows ----------------------------------------------------------------------------------


@query("win1_latest_per_key", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') as shipped from latest")
def latest(t):
    return roles.latest_lines(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    )


@query("win1_latest_kept_up_to_date", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') as shipped from latest")
def latest_by_merges(t):
    """Three loads, each with rows older than those merged before."""
    table = LatestTable(t.spark, new_location(t.spark, "latest"), SCHEMAS["lineitem"], roles.LINE_KEYS, buckets=16,
                        loaded_at="l_shipdate", tiebreak=roles.LINE_TIES)
    for i in range(3):
        table.merge(t.lineitem.where(F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_shipdate"), F.lit(3)) == i))
    return table.frame().select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


@query("win2_first_per_key", """
  select artist_id, artist_name, genre from (select *, row_number() over (partition by artist_id order by artist_name, genre nulls last) as rn
    from stg_events where artist_id is not null) where rn = 1""")
def first(t):
    named = filters.known(roles.stg_events(t), "artist_id").select("artist_id", "artist_name", "genre")
    return first_per_key(named, ["artist_id"], ["artist_name", "genre"])


# Orders and limits ------------------------------------------------------------------------


@query("srt1_top_ascending", "select o_custkey, count(*) as events from orders group by 1 order by 2 desc, 1 limit 15")
def top_ascending(t):
    return ranking.top_k(aggregates.count_by(t.orders, "o_custkey"), "events", 15, ["o_custkey"], ascending=True)


@query("srt2_top_descending", """
  select user_id, top from (select user_id, max(case when event_type = 'error' then value end) as top from events group by 1)
  order by top desc nulls last, user_id limit 20""")
def top_descending(t):
    tops = t.events.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "error", F.col("value"))).alias("top"))
    return ranking.top_k(tops, "top", 20, ["user_id"])


@query("srt3_ordinal_sort", "select strftime(o_orderdate, '%b') as month_name, count(*) as events from orders group by 1")
def ordinal_sort(t):
    months = t.orders.select(F.monthname("o_orderdate").alias("month_name"))
    return ranking.by_ordinal(aggregates.count_by(months, "month_name"), "month_name", MONTHS)


@query("srt4_order_limit", "select user_id, count(*) as n from events group by 1 order by 2 desc, 1 limit 50")
def order_limit(t):
    return ranking.top_k(aggregates.count_by(t.events, "user_id", name="n"), "n", 50, ["user_id"])


@query("srt5_best_row", """
  select c_nationkey, c_name from (select *, row_number() over (partition by c_nationkey order by c_acctbal desc, c_name) as rn from customer)
  where rn = 1""")
def best_row(t):
    return t.customer.groupBy("c_nationkey").agg(ranking.best("c_name", "c_acctbal", "c_name").alias("c_name"))


@query("srt6_full_sort", "select genre, " + MEAN + " as avg_price from frame where price_avg > 0 and genre is not null group by genre order by 2, 1")
def full_sort(t):
    return ranking.ordered(reports.price_by_genre(roles.star(t)), "avg_price", "genre")


# Checks -----------------------------------------------------------------------------------


@query("qc1_not_null", f"""
  select 'customer' as table_name, 'segment' as column_name, 'not_null' as check_name, 'error' as severity,
    (select count(*) from customer where {SEGMENT} is null) as failures, false as passed
  union all select 'customer', 'c_name', 'not_null', 'error', (select count(*) from customer where c_name is null), true""")
def check_not_null(t):
    return run_checks(segments(t), "customer", [not_null("segment"), not_null("c_name")])


@query("qc2_unique", """
  select l_orderkey || '-' || l_linenumber as line, count(*) as n from lineitem group by 1 having count(*) > 1""")
def check_unique(t):
    return repeated_keys(t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line")), "line")


@query("qc3_severity", f"""
  select 'customer' as table_name, 'c_nationkey' as column_name, 'unique' as check_name, 'error' as severity,
    (select count(*) from (select c_nationkey from customer group by 1 having count(*) > 1)) as failures, false as passed""")
def check_severity(t):
    checks = [not_null("segment", "warn"), unique("c_custkey"), unique("c_nationkey")]
    return failed_run(run_checks(segments(t), "customer", checks))
