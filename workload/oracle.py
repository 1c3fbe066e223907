"""Independent SQL for the registered queries: named common table expressions.

``sql(select)`` puts the expressions a statement mentions, directly or through each
other, in front of it. They are written from the definitions of the tables, with
windows, joins and scalar functions of standard SQL, not from the Spark code.
"""

from __future__ import annotations

import re

BREAKS = '!?@"^#$&~_,.:;+-*%/|\\[](){}<> '


def title(x: str) -> str:
    """Capital after a break, small letters elsewhere, letter by letter."""
    breaks = BREAKS.replace("'", "''")
    return (
        f"case when {x} is not null then array_to_string(list_transform(range(1, length({x}) + 1), lambda i: "
        f"case when i = 1 or contains('{breaks}', substr({x}, i - 1, 1)) "
        f"then upper(substr({x}, i, 1)) else lower(substr({x}, i, 1)) end), '') end"
    )


def key(x: str) -> str:
    return f"md5(coalesce(cast({x} as varchar), '_dbt_utils_surrogate_key_null_'))"


MESSY = "' ' || replace(lower(c_name), '#', '-no.')"
HIGH = (
    "case when l_tax <> 0 and l_returnflag <> 'N' then case when l_discount = 0.1 then 0 "
    "else cast(l_extendedprice as decimal(10,2)) end end"
)
LOW = (
    "case when l_returnflag <> 'N' then case when l_discount = 0.1 then 0 else "
    "cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(10,2)) end end"
)
ARTIST_ID = "case when o_orderpriority <> '4-NOT SPECIFIED' then o_custkey end"
VENUE_ID = "case when l_quantity < 50 then l_suppkey end"
EVENT_DATE = "case when l_tax <> 0.08 then cast(l_shipdate as date) end"


def text_of(timestamp: str) -> str:
    return f"strftime({timestamp}, '%Y-%m-%d %H:%M:%S')"


CTES = {
    "places": """
      select ord, city, state, cast(lat as double) as lat, cast(lon as double) as lon from (values (0, 'Nation_0', 'AFRICA', 10.5, -1.25), (1, 'Nation_11 Harbour', 'AMERICA', 11.5, -2.25),
             (2, 'Nation_10', 'AFRICA', 12.5, -3.25), (3, 'Old Nation_12', 'ASIA', 13.5, -4.25),
             (4, 'Nation_12', 'ASIA', 14.5, -5.25), (5, 'nation_2 West', 'ASIA', 15.5, -6.25),
             (6, 'Nation_23', 'EUROPE', 16.5, -7.25), (7, 'Nation_3', 'ASIA', 17.5, -8.25),
             (8, 'Greater NATION_4', 'MIDDLE EAST', 18.5, -9.25), (9, 'Nation_24', 'MIDDLE EAST', 19.5, -10.25)) as p(ord, city, state, lat, lon)""",
    "days(ord, day_name)": """
      values (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'),
             (6, 'Saturday'), (7, 'Sunday')""",
    # Raw tables
    "lines": """
      select * from lineitem left join supplier on l_suppkey = s_suppkey
      left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "raw_events": f"""
      select l_orderkey || '-' || l_linenumber as event_id, ' show ' || lpad(cast(l_partkey as varchar), 12, '0') || ' ' as event_name,
        'https://events.example.com/' || l_orderkey || '/' || l_linenumber || ' ' as event_url,
        cast({EVENT_DATE} as varchar) as event_date,
        lpad(cast(l_linenumber + 12 as varchar), 2, '0') || ':30:00' as event_time,
        ' ' || lower(o_orderstatus) as sale_status,
        case when {ARTIST_ID} is not null then {MESSY} end as artist_name,
        cast({ARTIST_ID} as varchar) as artist_id, lower(s_name) as venue_name,
        cast({VENUE_ID} as varchar) as venue_id, lower(n_name) as city, lower(r_name) || ' ' as state,
        {LOW} as price_min, {HIGH} as price_max, 'usd ' as currency,
        case when {ARTIST_ID} is not null then nullif(c_mktsegment, 'HOUSEHOLD') || ' ' end as genre,
        l_shipdate as loaded_at
      from lines left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey""",
    "raw_listeners": f"""
      select cast(user_id as varchar) as artist_id,
        case when props = '{{"k": 0}}' then upper({MESSY}) else {MESSY} end as artist_name,
        'https://audience.example.com/artist/' || user_id || ' ' as spotify_url,
        case when value >= 1 then cast(floor(value * 1000) as bigint) end as monthly_listeners,
        ' page of ' || c_name as page_title, event_type || ' ' as page_description, ts as loaded_at
      from events left join customer on user_id = c_custkey where event_type = 'view'""",
    "raw_performers": f"""
      select cast(user_id as varchar) as performer_id, {MESSY} as performer_name, ' ' || c_name as short_name,
        'https://tickets.example.com/' || user_id as seatgeek_url, least(1.0, value / 60) as sg_score,
        floor(value * 10) as sg_popularity, cast(floor(value) as bigint) as upcoming_events,
        lower(c_mktsegment) || ', live ' as genres, 'band ' as performer_type, ts as loaded_at
      from events left join customer on user_id = c_custkey where event_type = 'purchase'""",
    "raw_listings": f"""
      select cast(l_orderkey as varchar) as event_id, ' listing ' || l_orderkey as event_title,
        'https://tickets.example.com/e/' || l_linenumber as event_url, cast({EVENT_DATE} as varchar) as event_date,
        lpad(cast(l_linenumber + 12 as varchar), 2, '0') || ':30:00' as event_time, ' concert' as event_type,
        'act/no-' || lpad(cast(l_partkey as varchar), 12, '0') as performer_name, cast(l_partkey as varchar) as performer_id,
        lower(s_name) as venue_name, cast(l_suppkey as varchar) as venue_id, lower(n_name) as city, lower(r_name) as state,
        {LOW} as lowest_price, {HIGH} as highest_price, cast(l_quantity as bigint) as listing_count,
        l_discount as event_popularity, l_tax as event_score, l_shipdate as loaded_at
      from lines""",
    "raw_tours": f"""
      select {MESSY} as artist_name, ' tour ' || y as tour_name, gross as gross_revenue, n * 1000 as tickets_sold,
        top as avg_ticket_price, n as shows, cast(y as varchar) as tour_year, ' Orders desk ' as source, last as loaded_at
      from (select o_custkey, year(o_orderdate) as y, sum(cast(o_totalprice as decimal(12,2))) as gross, count(*) as n,
              max(cast(o_totalprice as decimal(12,2))) as top, max(o_orderdate) as last
            from orders group by o_custkey, year(o_orderdate)) left join customer on o_custkey = c_custkey""",
    # Staging
    "stg_events": f"""
      select event_id, artist_id, venue_id, trim(event_name) as event_name, trim(event_url) as event_url,
        trim(upper(sale_status)) as sale_status, trim(genre) as genre, trim({title('artist_name')}) as artist_name,
        trim({title('venue_name')}) as venue_name, trim({title('city')}) as city, trim(upper(state)) as state,
        cast(event_date as date) as event_date, event_time, price_min, price_max, trim(upper(currency)) as currency, loaded_at
      from (select *, row_number() over (partition by event_id order by loaded_at desc nulls first,
              event_name desc nulls last, venue_name desc nulls last, price_max desc nulls last, venue_id desc nulls last,
              price_min desc nulls last, event_date desc nulls last) as rn from raw_events) where rn = 1""",
    "stg_listeners": f"""
      select artist_id, trim({title('artist_name')}) as artist_name, trim(spotify_url) as spotify_url, monthly_listeners,
        trim(page_title) as page_title, trim(page_description) as page_description, loaded_at
      from (select *, row_number() over (partition by artist_name order by loaded_at desc nulls first,
              artist_id desc nulls last, monthly_listeners desc nulls last) as rn from raw_listeners) where rn = 1""",
    "stg_performers": f"""
      select performer_id, trim({title('performer_name')}) as performer_name, trim(short_name) as short_name,
        trim(seatgeek_url) as seatgeek_url, sg_score, sg_popularity, upcoming_events, trim(genres) as genres,
        trim(performer_type) as performer_type, loaded_at
      from (select *, row_number() over (partition by performer_name order by loaded_at desc nulls first,
              performer_id desc nulls last, sg_score desc nulls last) as rn from raw_performers)
      where rn = 1 and sg_score > 0.5""",
    "stg_listings": f"""
      select event_id, trim(event_title) as event_title, trim(event_url) as event_url, cast(event_date as date) as event_date,
        event_time, trim(event_type) as event_type, trim({title('performer_name')}) as performer_name, performer_id,
        trim({title('venue_name')}) as venue_name, venue_id, trim({title('city')}) as city, trim(upper(state)) as state,
        lowest_price, highest_price, listing_count, event_popularity, event_score, loaded_at
      from (select *, row_number() over (partition by event_id order by loaded_at desc nulls first, event_url desc nulls last,
              performer_name desc nulls last, venue_name desc nulls last, highest_price desc nulls last,
              listing_count desc nulls last) as rn from raw_listings) where rn = 1""",
    "stg_tours": f"""
      select trim({title('artist_name')}) as artist_name, trim(tour_name) as tour_name,
        cast(gross_revenue as decimal(38,0)) as gross_revenue, cast(tickets_sold as decimal(38,0)) as tickets_sold,
        cast(avg_ticket_price as decimal(38,0)) as avg_ticket_price, cast(shows as bigint) as shows,
        trim(tour_year) as tour_year, trim(source) as source, loaded_at from raw_tours""",
    "listeners": """
      select artist_name, cast(monthly_listeners as double) as monthly_listeners from stg_listeners
      where monthly_listeners is not null""",
    "market": """
      select performer_name as artist_name, sg_score, sg_popularity, upcoming_events as sg_upcoming_events, genres as sg_genres
      from stg_performers""",
    "tours": """
      select artist_name, tour_name, cast(gross_revenue as double) as gross_revenue, cast(tickets_sold as double) as tickets_sold,
        cast(avg_ticket_price as double) as avg_ticket_price, shows, tour_year, source from stg_tours""",
    # Marts
    "dim_artists": f"""
      select {key('tm_artist_id')} as artist_key, tm_artist_id, a.artist_name, genre, s.artist_id as spotify_artist_id, spotify_url,
        monthly_listeners, performer_id as sg_performer_id, seatgeek_url, sg_score, sg_popularity,
        upcoming_events as sg_upcoming_events, genres as sg_genres
      from (select artist_id as tm_artist_id, artist_name, genre,
              row_number() over (partition by artist_id order by artist_name, genre nulls last) as rn
            from stg_events where artist_name is not null and artist_id is not null) a
      left join stg_listeners s on lower(a.artist_name) = lower(s.artist_name)
      left join stg_performers p on lower(a.artist_name) = lower(p.performer_name)
      where rn = 1""",
    "dim_venues": f"""
      select {key('venue_id')} as venue_key, * from
        (select distinct venue_id, venue_name, city, state from stg_events where venue_id is not null)""",
    "dim_dates": f"""
      select {key('event_date')} as date_key, event_date, cast(dayofweek(event_date) as integer) as day_of_week,
        dayname(event_date) as day_name, cast(month(event_date) as integer) as month_num, strftime(event_date, '%b') as month_name,
        cast(year(event_date) as integer) as year, cast(quarter(event_date) as integer) as quarter,
        dayofweek(event_date) in (0, 6) as is_weekend
      from (select distinct event_date from stg_events where event_date is not null)""",
    "fact": f"""
      select {key('event_id')} as event_key, event_id, event_name, event_url, artist_key, venue_key, date_key, e.event_date,
        event_time, sale_status, price_min, price_max,
        case when price_min is not null and price_max is not null then cast(price_min + price_max as double) / 2 end as price_avg,
        currency, loaded_at
      from stg_events e left join (select tm_artist_id, artist_key from dim_artists) a on e.artist_id = a.tm_artist_id
      left join (select venue_id, venue_key from dim_venues) v on e.venue_id = v.venue_id
      left join (select event_date, date_key from dim_dates) d on e.event_date = d.event_date""",
    "mart_frame": """
      select event_id, f.event_date, price_min, price_max, price_avg, artist_name, genre, venue_name, city, state, day_name, month_name
      from fact f left join dim_artists a on f.artist_key = a.artist_key left join dim_venues v on f.venue_key = v.venue_key
      left join dim_dates d on f.date_key = d.date_key""",
    # The star of the reports, by natural keys
    "latest": """
      select * from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc nulls first,
        l_partkey desc, l_suppkey desc) as rn from lineitem)
      where rn = 1""",
    "halls": f"""
      select s_suppkey as venue_key, s_name as venue_name, {title('n_name')} as city, r_name as state
      from supplier left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "located": """
      select h.*, coalesce(x.lat, (select arg_min(lat, ord) from places q where q.state = h.state and contains(lower(q.city), lower(h.city)))) as lat,
        coalesce(x.lon, (select arg_min(lon, ord) from places q where q.state = h.state and contains(lower(q.city), lower(h.city)))) as lon
      from halls h left join places x on x.city = h.city and x.state = h.state""",
    "frame": f"""
      select l_orderkey || '-' || l_linenumber as event_id, 'show ' || l_partkey as event_name, {ARTIST_ID} as artist_key,
        {VENUE_ID} as venue_key, {EVENT_DATE} as event_date, {LOW} as price_min, {HIGH} as price_max,
        cast({LOW} + {HIGH} as double) / 2 as price_avg, replace(c_name, '#', '-No.') as artist_name,
        nullif(c_mktsegment, 'HOUSEHOLD') as genre, venue_name, city, state, lat, lon,
        dayname({EVENT_DATE}) as day_name, strftime({EVENT_DATE}, '%b') as month_name
      from latest left join orders on l_orderkey = o_orderkey left join customer on c_custkey = {ARTIST_ID}
      left join located on venue_key = {VENUE_ID}""",
    "compared": """
      select t.artist_name, tour_name, tour_year, monthly_listeners, tickets_sold,
        case when monthly_listeners <> 0 then round_even(tickets_sold / monthly_listeners * 100, 1) end as conversion_rate,
        gross_revenue, monthly_listeners * 50 * 12 * 0.004 as est_annual_streaming,
        cast(round_even(gross_revenue / greatest(monthly_listeners * 50 * 12 * 0.004, 1), 0) as bigint) as revenue_multiplier
      from tours t join listeners l on t.artist_name = l.artist_name""",
}

_NAMES = {head.split("(")[0]: head for head in CTES}


def _mentioned(statement: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", statement))
    return [n for n in _NAMES if n in words and re.search(rf"(from|join)\s+{n}\b", statement)]


def sql(select: str) -> str:
    """The statement with every expression it needs in front."""
    needed: set[str] = set()
    todo = _mentioned(select)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _mentioned(CTES[_NAMES[name]])
    parts = [f"{head} as ({body})" for head, body in CTES.items() if head.split("(")[0] in needed]
    select = select.strip()
    if not parts:
        return select
    joint = ",\n" + select.removeprefix("with ") if select.startswith("with ") else "\n" + select
    return "with " + ",\n".join(parts) + joint
