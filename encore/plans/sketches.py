"""Approximate distinct counts and price distributions from sketches kept per day and state.

``daily_cells`` reads the fact once and leaves one row per event date and state with mergeable sketches: HyperLogLog of the
distinct events, artists and venues, KLL of the prices, and exact price sums. The rows are as many as days times states, however many
events there are, and merge in any order, so a report over any days or states reads only them. Exact reports stay the
default; ``reports.overview`` and ``reports.market_kpis`` take the cells where a caller asks for them.

Errors: a count of n distinct values has a relative standard error of 1.04 / sqrt(2 ** lg_k) before and after merges (0.8 % at
the default 14), and is exact but for rounding while few hash values are kept; a quantile's rank is off by about 1.33 % at most (k = 200) with 99 % confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from encore.functions.money import priced

from .star import MEASURES, Star

DAY, STATE = "event_date", "state"
#: Sketched columns: what is counted, under which name.
COUNTED = {"events": "event_id", "venues": "venue_name", "artists": "artist_name"}
LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """Standard error of a distinct count as a share of it."""
    return 1.04 / 2 ** (lg_k / 2)


def daily_cells(star: Star, lg_k: int = LG_K) -> DataFrame:
    """(event_date, state, events, venues, artists, prices, price_sum, price_n): sketches and sums of each day and state.

    Rows without a date or state have cells of their own. Dimension keys that repeat multiply the price sums as the
    row-wise joins do; distinct counts do not notice, and the price sketch sees repeats of artists and venues only. One pass over the fact; only the artist's name, the venue's name and
    its state are joined to it, and sketches are merged map-side, so a hot day or state costs one row a task.
    """
    star = star.packed(numbers=True)
    fact, weight = star.weighted(star.artists, star.venues)
    sums = dict(zip(MEASURES, star.measures(weight)))
    rows = star.with_attributes(fact, star.artists, ["artist_name"])
    rows = star.with_attributes(rows, star.venues, ["venue_name", STATE])
    counts = [F.hll_sketch_agg(column, lg_k).alias(name) for name, column in COUNTED.items()]
    price = F.kll_sketch_agg_double(priced("price_avg").cast("double")).alias("prices")
    return rows.groupBy(DAY, STATE).agg(*counts, price, sums["price_sum"], sums["price_n"])


def merged(cells: DataFrame, *keys: str) -> DataFrame:
    """The cells of all days, or of a coarser key, as one: still sketches, to be merged further."""
    counts = [F.hll_union_agg(name).alias(name) for name in COUNTED]
    return cells.groupBy(*keys).agg(
        *counts, F.kll_merge_agg_double("prices").alias("prices"), F.sum("price_sum").alias("price_sum"), F.sum("price_n").alias("price_n"))


def estimates(*names: str) -> list[Column]:
    """The estimated counts of merged cells; zero where there is no cell."""
    return [F.coalesce(F.hll_sketch_estimate(name), F.lit(0)).alias(name) for name in names]


def price_quantiles(cells: DataFrame, shares: Sequence[float], *keys: str) -> DataFrame:
    """Prices at shares of the priced events, a row per key and share: (keys, share, price). No prices give no rows."""
    whole = merged(cells, *keys).where(F.kll_sketch_get_n_double("prices") > 0)
    at = F.array(*[F.struct(F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("prices", F.lit(float(s))).alias("price")) for s in shares])
    return whole.select(*keys, F.inline(at))


def price_bins(cells: DataFrame, edges: Sequence[float], *keys: str) -> DataFrame:
    """Estimated events with a price above the lower and up to the upper edge of each bin: (keys, bin, bin_low, bin_high, events)."""
    if list(edges) != sorted(set(edges)) or len(edges) < 2:
        raise ValueError("edges must rise")
    n = F.kll_sketch_get_n_double("prices")
    below = [F.kll_sketch_get_rank_double("prices", F.lit(float(e))) for e in edges]
    bins = [F.struct(F.lit(i).alias("bin"), F.lit(float(a)).alias("bin_low"), F.lit(float(b)).alias("bin_high"),
                     F.round((high - low) * n).cast("bigint").alias("events"))
            for i, (a, b, low, high) in enumerate(zip(edges, edges[1:], below, below[1:]), 1)]
    return merged(cells, *keys).where(n > 0).select(*keys, F.inline(F.array(*bins)))
