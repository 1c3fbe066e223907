"""The named analyses over the star of the given tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from encore.operators import filters
from encore.plans import reports, sketches
from encore.plans.build import CHECKS, Models, build
from encore.plans.star import Star
from encore.sources.tables import materialise, new_location

from . import roles
from .registry import query


_builds: dict[tuple[str, str], Models] = {}


def built_models(t) -> Models:
    """The whole build, written once for each session and folder to a new place in the shared folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _builds:
        _builds[key] = build(roles.raw(t), new_location(t.spark, "marts"), tiebreaks=roles.RAW_TIES)
    return _builds[key]


def marts_star(t, with_places: bool = False) -> Star:
    """The star of the built marts, whose events and dimension keys may repeat."""
    return built_models(t).star(roles.places(t) if with_places else None)


def marts_listeners(t):
    return reports.listeners_view(built_models(t).stg_spotify_artists)


def on_marts(statement: str) -> str:
    """The oracle of a report over the rows of the built marts instead of those of the natural keys."""
    return re.sub(r"\bframe\b", "mart_frame", statement)


# Mean positive price from exact decimal sums, so that both engines divide the same numbers.
MEAN = (
    "cast(sum(case when price_avg > 0 then price_min + price_max end) as double) / 2 "
    "/ count(case when price_avg > 0 then 1 end)"
)


def cents(name: str, places: int = 4):
    return F.round(F.col(name).cast("double"), places).alias(name)


@query("q1_star_frame", """
  select event_id, event_name, cast(f.event_date as varchar) as event_date, event_time, sale_status,
    cast(price_min as double) as price_min, cast(price_max as double) as price_max, round(price_avg, 4) as price_avg, currency,
    artist_name, genre, cast(monthly_listeners as double) as monthly_listeners, round(sg_score, 6) as sg_score, sg_popularity,
    venue_name, v.city, v.state, x.lat, x.lon, day_name, month_name, month_num, year, quarter,
    case when is_weekend then 'Weekend' else 'Weekday' end as is_weekend
  from fact f left join dim_artists a on f.artist_key = a.artist_key
  left join dim_venues v on f.venue_key = v.venue_key
  left join (select city, state,
      coalesce((select arg_min(lat, ord) from places q where q.state = h.state and q.city = h.city),
        (select arg_min(lat, ord) from places q where q.state = h.state and contains(lower(q.city), lower(h.city)))) as lat,
      coalesce((select arg_min(lon, ord) from places q where q.state = h.state and q.city = h.city),
        (select arg_min(lon, ord) from places q where q.state = h.state and contains(lower(q.city), lower(h.city)))) as lon
    from (select distinct city, state from dim_venues) h) x on v.city = x.city and v.state = x.state
  left join dim_dates d on f.date_key = d.date_key""")
def star_frame(t):
    frame = built_models(t).star(roles.places(t)).frame()
    return frame.select(*[
        cents(c) if c == "price_avg"
        else cents(c, 6) if c == "sg_score"
        else F.col(c).cast("string") if c == "event_date"
        else F.col(c)
        for c in frame.columns
    ])


@query("q2_overview", f"""
  select count(distinct event_id) as events, count(distinct artist_name) as artists, count(distinct venue_name) as venues,
    {MEAN} as avg_price from frame""")
def overview(t):
    return reports.overview(roles.star(t))


def _top(attribute: str, k: int) -> str:
    return f"""
      select {attribute}, count(*) as events from frame where {attribute} is not null
      group by {attribute} order by events desc, {attribute} limit {k}"""


@query("q3_top_genres", _top("genre", 10))
def top_genres(t):
    return reports.top_by(roles.star(t), "genre")


@query("q3_top_artists", _top("artist_name", 10))
def top_artists(t):
    return reports.top_by(roles.star(t), "artist_name")


@query("q3_top_venues", _top("venue_name", 10))
def top_venue_names(t):
    return reports.top_by(roles.star(t, with_artists=False), "venue_name")


DEMAND = """
  select coalesce(l.artist_name, m.artist_name, c.artist_name) as artist_name, monthly_listeners, round(sg_score, 6) as sg_score,
    sg_popularity, coalesce(tm_events, 0) as tm_events
  from listeners l full join market m on l.artist_name = m.artist_name
  full join (select artist_name, count(event_id) as tm_events from frame where artist_name is not null group by 1) c
    on coalesce(l.artist_name, m.artist_name) = c.artist_name
  order by monthly_listeners desc nulls last, artist_name, sg_score nulls last, sg_popularity nulls last, tm_events limit 20"""


def _demand(t):
    return reports.demand_leaderboard(roles.star(t), roles.listeners(t), roles.market(t))


@query("q4_demand_leaderboard", DEMAND)
def demand(t):
    return _demand(t).withColumn("sg_score", F.round("sg_score", 6))


@query("q4_demand_leaderboard_text", f"""
  select artist_name,
    case when monthly_listeners is null then '—' else format('{{:,}}', cast(round_even(monthly_listeners, 0) as bigint)) end as spotify_listeners,
    case when sg_score is null then '—' else format('{{:.2f}}', sg_score) end as seatgeek_score,
    case when sg_popularity > 0 then format('{{:,}}', cast(round_even(sg_popularity, 0) as bigint)) else '—' end as seatgeek_popularity,
    tm_events
  from ({DEMAND})""")
def demand_text(t):
    return reports.demand_leaderboard_text(_demand(t))


@query("q5_tour_ranking", "select * from tours")
def tour_ranking(t):
    return reports.tour_ranking(roles.tours(t))


def _compared(t):
    return reports.revenue_comparison(roles.tours(t), roles.listeners(t))


@query("q6_revenue_comparison", "select * replace (round(est_annual_streaming, 4) as est_annual_streaming) from compared")
def revenue_comparison(t):
    return reports.conversion_table(_compared(t).withColumn("est_annual_streaming", F.round("est_annual_streaming", 4)))


@query("q6_revenue_comparison_text", """
  select artist_name, tour_name, tour_year, format('{:,}', cast(monthly_listeners as bigint)) as monthly_listeners,
    format('{:,}', cast(tickets_sold as bigint)) as tickets_sold, coalesce(format('{:.1f}', conversion_rate) || '%', '—') as conversion_rate,
    '$' || format('{:,}', cast(round_even(gross_revenue / 1e6, 0) as bigint)) || 'M' as tour_gross,
    '$' || format('{:,}', cast(round_even(est_annual_streaming / 1e6, 0) as bigint)) || 'M' as est_streaming_revenue,
    revenue_multiplier || 'x' as revenue_multiplier from compared""")
def revenue_comparison_text(t):
    return reports.conversion_text(_compared(t))


@query("q7_conversion_kpis", """
  select (select artist_name from compared order by revenue_multiplier desc nulls last, artist_name limit 1) as top_artist,
    max(revenue_multiplier) as top_multiplier, round(avg(conversion_rate), 4) as avg_conversion_rate,
    round(sum(gross_revenue) - sum(est_annual_streaming), 2) as total_gap from compared""")
def conversion_kpis(t):
    return reports.conversion_kpis(_compared(t)).select(
        "top_artist", "top_multiplier", cents("avg_conversion_rate"), cents("total_gap", 2)
    )


@query("q8_price_by_genre", f"""
  select genre, {MEAN} as avg_price from frame where price_avg > 0 and genre is not null group by genre""")
def price_by_genre(t):
    return reports.price_by_genre(roles.star(t))


def _histogram(value: str, source: str, columns: str = "bin, bin_low, bin_high, events") -> str:
    """All twenty bins of a column, empty ones included."""
    return f"""
      select {columns} from (select cast(i as integer) as bin, lo + (i - 1) * ((hi - lo) / 20) as bin_low,
          lo + i * ((hi - lo) / 20) as bin_high, coalesce(n, 0) as events
        from (select min({value}) as lo, max({value}) as hi from {source} where {value} > 0), unnest(generate_series(1, 20)) as g(i)
        left join (select least(floor(20 * ({value} - l) / (h - l)) + 1, 20) as k, count(*) as n
          from {source}, (select min({value}) as l, max({value}) as h from {source} where {value} > 0)
          where {value} > 0 group by 1) on k = i)"""


@query("q9_price_histogram", _histogram("price_avg", "frame"))
def price_histogram(t):
    fact = roles.star(t, with_artists=False).fact
    return reports.price_distribution(fact)


@query("q10_artist_profiles", f"""
  with names as (select distinct artist_name from frame where artist_name is not null union select artist_name from listeners),
  genres as (select artist_name, genre, row_number() over (partition by artist_name order by count(*) desc, genre) as rn
    from frame where artist_name is not null and genre is not null group by artist_name, genre),
  stats as (select artist_name, count(distinct event_id) as events, {MEAN} as avg_price
    from frame where artist_name is not null group by artist_name),
  heard as (select *, row_number() over (partition by lower(artist_name) order by artist_name, monthly_listeners) as rn from listeners),
  signals as (select *, row_number() over (partition by lower(artist_name) order by artist_name, sg_score, sg_genres) as rn from market),
  tour as (select *, row_number() over (partition by lower(artist_name) order by artist_name, tour_name, tour_year, gross_revenue) as rn from tours)
  select n.artist_name, coalesce(g.genre, s.sg_genres, '—') as genre, monthly_listeners, round(sg_score, 6) as sg_score,
    coalesce(events, 0) as events, avg_price, tour_name, tour_year, gross_revenue, tickets_sold, avg_ticket_price,
    shows, round(case when monthly_listeners <> 0 then gross_revenue / greatest(monthly_listeners * 50 * 12 * 0.004, 1) end, 4) as revenue_ratio,
    coalesce(events, 0) = 0 and coalesce(monthly_listeners <> 0, false) as booking_opportunity
  from names n left join genres g on n.artist_name = g.artist_name and g.rn = 1
  left join stats e on n.artist_name = e.artist_name
  left join heard h on lower(n.artist_name) = lower(h.artist_name) and h.rn = 1
  left join signals s on lower(n.artist_name) = lower(s.artist_name) and s.rn = 1
  left join tour r on lower(n.artist_name) = lower(r.artist_name) and r.rn = 1""")
def artist_profiles(t):
    profiles = reports.artist_profiles(roles.star(t), roles.listeners(t), roles.market(t), roles.tours(t))
    return profiles.withColumns({
        "sg_score": F.round("sg_score", 6), "revenue_ratio": F.round("revenue_ratio", 4)
    })


@query("q11_artist_events", """
  select artist_name, event_name, venue_name, city, state, cast(event_date as varchar) as event_date,
    case when price_avg > 0 then '$' || format('{:,}', cast(round_even(price_avg, 0) as bigint)) else 'Dynamic' end as avg_price
  from frame where artist_name is not null""")
def artist_events(t):
    return reports.artist_events(roles.star(t)).withColumn("event_date", F.col("event_date").cast("string"))


AUDIENCE = """
  select l.artist_name, monthly_listeners, coalesce(n, 0) as event_count
  from listeners l left join (select lower(trim(artist_name)) as k, count(event_id) as n from frame where artist_name is not null
    group by 1) c on lower(trim(l.artist_name)) = c.k"""


@query("q12_audience_and_events", AUDIENCE)
def audience_and_events(t):
    return reports.audience_and_events(roles.star(t), roles.listeners(t))


@query("q13_untapped_artists", f"select *, event_count = 0 as no_events from ({AUDIENCE}) where event_count <= 25")
def untapped_artists(t):
    return reports.untapped_artists(roles.star(t), roles.listeners(t), at_most_events=25)


@query("q14_hotspots", """
  select city, state, lat, lon, count(event_id) as events from frame where lat is not null and city is not null
  group by city, state, lat, lon""")
def hotspots(t):
    return reports.hotspots(roles.star(t, with_artists=False, with_places=True))


@query("q15_top_states", _top("state", 15))
def top_states(t):
    return reports.top_by(roles.star(t, with_artists=False), "state", 15)


@query("q16_top_venues", """
  select venue_name, city, state, count(event_id) as events, venue_name || ' (' || state || ')' as label from frame
  where venue_name is not null and city is not null and state is not null group by venue_name, city, state
  order by events desc, venue_name, city, state limit 15""")
def top_venues(t):
    return reports.top_venues(roles.star(t, with_artists=False))


@query("q17_market_kpis", f"""
  select state, count(distinct event_id) as events, count(distinct venue_name) as venues, count(distinct artist_name) as artists,
    {MEAN} as avg_price from frame where state is not null group by state""")
def market_kpis(t):
    return reports.market_kpis(roles.star(t))


@query("q17_market_genres", """
  select state, genre, events from (select state, genre, count(*) as events,
      row_number() over (partition by state order by count(*) desc, genre) as rn
    from frame where state is not null and genre is not null group by state, genre) where rn <= 8""")
def market_genres(t):
    return reports.market_genres(roles.star(t))


MARKET_ARTISTS = """
  select state, c.artist_name, events, monthly_listeners from (select state, artist_name, count(event_id) as events,
      row_number() over (partition by state order by count(event_id) desc, artist_name) as rn
    from frame where state is not null and artist_name is not null group by state, artist_name) c
  left join listeners l on c.artist_name = l.artist_name where rn <= 10"""


@query("q17_market_artists", MARKET_ARTISTS)
def market_artists(t):
    return reports.market_artists(roles.star(t), roles.listeners(t))


@query("q17_market_artists_text", f"""
  select state, artist_name, events, case when monthly_listeners > 0
    then format('{{:,}}', cast(monthly_listeners as bigint)) else '—' end as spotify_listeners from ({MARKET_ARTISTS})""")
def market_artists_text(t):
    return reports.market_artists_text(reports.market_artists(roles.star(t), roles.listeners(t)))


@query("q18_events_by_weekday", """
  select day_name, count(*) as events, case when day_name in ('Friday', 'Saturday', 'Sunday') then 'Weekend' else 'Weekday' end as label
  from frame where day_name is not null group by day_name""")
def events_by_weekday(t):
    return reports.by_weekday(roles.star(t, with_artists=False))


@query("q19_events_by_month", "select month_name, count(*) as events from frame where month_name is not null group by month_name")
def events_by_month(t):
    return reports.by_month(roles.star(t, with_artists=False))


@query("q20_genre_weekdays", """
  select genre, d.day_name, count(f.event_id) as events
  from (select g.genre, days.day_name from (select distinct genre from frame where genre is not null) g cross join days) d
  left join (select genre as g, day_name, event_id from frame) f on d.genre = f.g and d.day_name = f.day_name group by genre, d.day_name""")
def genre_weekdays(t):
    return reports.genre_weekdays(roles.star(t))


@query("q21_known_artists", """
  select artist_name from frame where artist_name is not null union select artist_name from listeners""")
def known_artists(t):
    return reports.known_artists(roles.star(t), roles.listeners(t))


FREQUENT = """
  select artist_name, count(*) as events from raw_events where artist_name is not null and artist_name <> ''
  group by artist_name order by events desc, artist_name limit 50"""


@query("q22_frequent_artists", FREQUENT)
def frequent_artists(t):
    return reports.frequent_artists(roles.raw_artist_names(t))


@query("q22_artists_to_find", """
  select artist_name, count(*) as events from raw_events where artist_name is not null and artist_name <> '' group by artist_name
  having lower(artist_name) not in (select lower(artist_name) from raw_listeners)""")
def artists_to_find(t):
    return reports.artists_to_find(roles.raw_artist_names(t), roles.raw_listeners(t))


def _checks(table: str, cte: str) -> str:
    rows = []
    for c in CHECKS[table]:
        failures = (
            f"(select count(*) from {cte} where {c.column} is null)"
            if c.kind == "not_null"
            else f"(select count(*) from (select {c.column} from {cte} where {c.column} is not null group by 1 having count(*) > 1))"
        )
        rows.append(
            f"select '{table}' as table_name, '{c.column}' as column_name, '{c.kind}' as check_name, "
            f"'{c.severity}' as severity, {failures} as failures"
        )
    return " union all ".join(rows)


CHECKED = {
    "stg_ticketmaster_events": "stg_events", "stg_spotify_artists": "stg_listeners", "stg_seatgeek_performers": "stg_performers",
    "stg_seatgeek_events": "stg_listings", "fact_events": "fact", "dim_artists": "dim_artists", "dim_venues": "dim_venues",
    "dim_dates": "dim_dates",
}


@query("q23_quality_report", "select *, failures = 0 as passed from ("
       + " union all ".join(_checks(table, cte) for table, cte in CHECKED.items()) + ")")
def quality_report(t):
    return built_models(t).quality_report()


# The reports on the built marts, where events and dimension keys repeat ---------------------


def _on_marts(name: str, of: str):
    """Register a report on the marts under the oracle of the report on the natural keys."""
    return query(name, on_marts(_STATEMENTS[of]))


_STATEMENTS = {
    "overview": f"""
      select count(distinct event_id) as events, count(distinct artist_name) as artists, count(distinct venue_name) as venues,
        {MEAN} as avg_price from frame""",
    "genres": _top("genre", 10),
    "artists": _top("artist_name", 10),
    "venue_names": _top("venue_name", 10),
    "states": _top("state", 15),
    "prices": f"select genre, {MEAN} as avg_price from frame where price_avg > 0 and genre is not null group by genre",
    "markets": f"""
      select state, count(distinct event_id) as events, count(distinct venue_name) as venues, count(distinct artist_name) as artists,
        {MEAN} as avg_price from frame where state is not null group by state""",
    "one_market": f"""
      select state, count(distinct event_id) as events, count(distinct venue_name) as venues, count(distinct artist_name) as artists,
        {MEAN} as avg_price from frame where state = (select min(state) from frame) group by state""",
    "market_genres": """
      select state, genre, events from (select state, genre, count(*) as events,
          row_number() over (partition by state order by count(*) desc, genre) as rn
        from frame where state is not null and genre is not null group by state, genre) where rn <= 8""",
    "venues": """
      select venue_name, city, state, count(event_id) as events, venue_name || ' (' || state || ')' as label from frame
      where venue_name is not null and city is not null and state is not null group by venue_name, city, state
      order by events desc, venue_name, city, state limit 15""",
    "weekdays": """
      select day_name, count(*) as events,
        case when day_name in ('Friday', 'Saturday', 'Sunday') then 'Weekend' else 'Weekday' end as label
      from frame where day_name is not null group by day_name""",
    "months": "select month_name, count(*) as events from frame where month_name is not null group by month_name",
    "genre_weekdays": """
      select genre, d.day_name, count(f.event_id) as events
      from (select g.genre, days.day_name from (select distinct genre from frame where genre is not null) g cross join days) d
      left join (select genre as g, day_name, event_id from frame) f on d.genre = f.g and d.day_name = f.day_name
      group by genre, d.day_name""",
    "audience": AUDIENCE,
    "known": "select artist_name from frame where artist_name is not null union select artist_name from listeners",
}


@_on_marts("q2_overview_marts", "overview")
def overview_marts(t):
    return reports.overview(marts_star(t))


@_on_marts("q3_top_genres_marts", "genres")
def top_genres_marts(t):
    return reports.top_by(marts_star(t), "genre")


@_on_marts("q3_top_artists_marts", "artists")
def top_artists_marts(t):
    return reports.top_by(marts_star(t), "artist_name")


@_on_marts("q3_top_venues_marts", "venue_names")
def top_venue_names_marts(t):
    return reports.top_by(marts_star(t), "venue_name")


@_on_marts("q8_price_by_genre_marts", "prices")
def price_by_genre_marts(t):
    return reports.price_by_genre(marts_star(t))


@_on_marts("q12_audience_and_events_marts", "audience")
def audience_marts(t):
    return reports.audience_and_events(marts_star(t), marts_listeners(t))


@_on_marts("q15_top_states_marts", "states")
def top_states_marts(t):
    return reports.top_by(marts_star(t), "state", 15)


@_on_marts("q16_top_venues_marts", "venues")
def top_venues_marts(t):
    return reports.top_venues(marts_star(t))


@_on_marts("q17_market_kpis_marts", "markets")
def market_kpis_marts(t):
    return reports.market_kpis(marts_star(t))


@_on_marts("q17_one_market_marts", "one_market")
def one_market_marts(t):
    star = marts_star(t)
    return reports.market_kpis(star, star.venues.frame.agg(F.min("state")).first()[0])


@_on_marts("q17_market_genres_marts", "market_genres")
def market_genres_marts(t):
    return reports.market_genres(marts_star(t))


@_on_marts("q18_events_by_weekday_marts", "weekdays")
def weekdays_marts(t):
    return reports.by_weekday(marts_star(t))


@_on_marts("q19_events_by_month_marts", "months")
def months_marts(t):
    return reports.by_month(marts_star(t))


@_on_marts("q20_genre_weekdays_marts", "genre_weekdays")
def genre_weekdays_marts(t):
    return reports.genre_weekdays(marts_star(t))


@_on_marts("q21_known_artists_marts", "known")
def known_artists_marts(t):
    return reports.known_artists(marts_star(t), marts_listeners(t))


# Reports from sketches --------------------------------------------------------------------

_cells: dict[tuple[str, str], object] = {}


def daily_cells(t):
    """The sketches of the built marts, written once for each session and folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _cells:
        _cells[key] = materialise(sketches.daily_cells(marts_star(t)), f"{new_location(t.spark, 'cells')}/daily_cells")
    return _cells[key]


def _beside(exact, estimated, names, *keys):
    """The exact counts, and whether each estimate is within four standard errors and a rounding of it."""
    for name in names:
        estimated = estimated.withColumnRenamed(name, f"{name}__")
    both = exact.join(estimated.drop("avg_price"), list(keys)) if keys else exact.withColumn("k", F.lit(1)).join(
        estimated.drop("avg_price").withColumn("k", F.lit(1)), "k").drop("k")
    bound = 4 * sketches.relative_error()
    near = [(F.abs(F.col(f"{n}__") - F.col(n)) <= 1 + bound * F.col(n)).alias(f"{n}_near") for n in names]
    return both.select(*exact.columns, *near)


_NEAR = "true as events_near, true as artists_near, true as venues_near"


@query("q2_overview_sketched", on_marts(f"select *, {_NEAR} from ({_STATEMENTS['overview']})"))
def overview_sketched(t):
    star, cells = marts_star(t), daily_cells(t)
    return _beside(reports.overview(star), reports.overview(star, cells), ["events", "artists", "venues"])


@query("q17_market_kpis_sketched", on_marts(f"select *, {_NEAR} from ({_STATEMENTS['markets']})"))
def market_kpis_sketched(t):
    star, cells = marts_star(t), daily_cells(t)
    return _beside(reports.market_kpis(star), reports.market_kpis(star, cells=cells), ["events", "artists", "venues"], "state")


@query("q17_market_prices_sketched", f"""
  select state, count(case when price_avg > 0 then 1 end) as price_n, {MEAN} as avg_price, 3 as shares, true as near
  from mart_frame where state is not null group by state having count(case when price_avg > 0 then 1 end) > 0""")
def market_prices_sketched(t):
    """Priced events per state with their quantiles from merged sketches, each within the error of its rank among the exact prices."""
    cells = filters.known(daily_cells(t), "state")
    at = sketches.price_quantiles(cells, [0.25, 0.5, 0.75], "state")
    counts = filters.priced_rows(filters.known(marts_star(t).frame(), "state")).groupBy("state", "price_avg").agg(F.count(F.lit(1)).alias("n"))
    ranks = counts.join(at, "state").groupBy("state", "share", "price").agg(
        F.sum(F.when(F.col("price_avg") < F.col("price"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("price_avg") <= F.col("price"), F.col("n")).otherwise(0)).alias("up_to"), F.sum("n").alias("n"))
    off = F.greatest(F.col("below") - F.col("share") * F.col("n"), F.col("share") * F.col("n") - F.col("up_to"))
    judged = ranks.groupBy("state").agg(F.count(F.lit(1)).cast("int").alias("shares"), F.every(off <= 1 + 0.0266 * F.col("n")).alias("near"))
    sums = sketches.merged(cells, "state").select("state", "price_n")
    means = reports.market_kpis(marts_star(t), cells=cells).select("state", "avg_price")
    return sums.join(means, "state").join(judged, "state").select("state", "price_n", "avg_price", "shares", "near")
