"""The star schema as one object, and aggregation below its joins.

A report groups events by attributes of the dimensions. Joining every event to
its dimensions first would move all events once per dimension too large to
broadcast, and a popular artist would make a skewed join. Instead ``rollup``
first aggregates the fact on the dimension keys, which needs no more than the key
columns and is combined map-side, and joins one row per key. A dimension key that
repeats still multiplies the counts exactly as the row-wise join does: keys of asked
dimensions in the join, keys of the others as weights of the fact's rows.

Only the dimensions a report asks for are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from encore.functions.calendar import weekend_label
from encore.functions.keys import packed_key
from encore.functions.money import priced
from encore.operators.filters import known
from encore.operators.joins import attach


#: Repeating keys of a dimension that are broadcast, at most; more are joined by a shuffle.
BROADCAST_KEYS = 100_000
#: Rows of a dimension that is broadcast where all events would be shuffled to it, at most; they are counted before.
BROADCAST_ROWS = 400_000

MEASURES = ["events", "event_rows", "price_sum", "price_n"]


@dataclass(frozen=True)
class Dimension:
    """A dimension table and the column that the fact refers to it by.

    ``derived`` names attributes that are functions of the key, as those of a date are: they are computed on the
    groups and the table is not read for them.
    """

    frame: DataFrame
    key: str
    derived: dict[str, Column] = field(default_factory=dict)

    def repeats(self) -> tuple[DataFrame, int]:
        """(key, times) of the keys that repeat, and how many there are; looked up once."""
        if self.key not in self._repeats:
            found = self.frame.groupBy(self.key).agg(F.count(F.lit(1)).alias("times")).where(
                F.col("times") > 1).where(F.col(self.key).isNotNull())
            self._repeats[self.key] = (found, found.limit(BROADCAST_KEYS + 1).count())
        return self._repeats[self.key]

    _repeats: dict = field(default_factory=dict, compare=False, repr=False)

    def few(self) -> bool:
        """Whether the rows can be broadcast; counted once."""
        if "few" not in self._counted:
            self._counted["few"] = self.frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        return self._counted["few"]

    def numbered(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` with the ranks of their keys among those of this dimension, which has few; NULL for keys that it lacks."""
        rank = F.dense_rank().over(Window.orderBy("__key")).alias("__rank")
        ranks = known(self.frame, self.key).select(F.col(self.key).alias("__key")).distinct().select("__key", rank)
        joined = df.join(F.broadcast(ranks), df[self.key] == ranks["__key"], "left")
        return joined.withColumn(self.key, F.col("__rank")).drop("__key", "__rank")

    _counted: dict = field(default_factory=dict, compare=False, repr=False)


@dataclass(frozen=True)
class Star:
    """A fact with its dimensions.

    ``unique_events`` states that the fact holds every event once and that dimension
    keys do not repeat, as after a strict build (the uniqueness checks tell). It turns
    distinct event counts into plain counts and leaves unused dimensions out.
    """

    fact: DataFrame
    artists: Dimension
    venues: Dimension
    dates: Dimension
    unique_events: bool = False

    def events_counted(self):
        return F.count("event_id") if self.unique_events else F.count_distinct("event_id")

    def dimensions_of(self, *attributes: str) -> list[tuple[Dimension, list[str]]]:
        """Which dimension supplies which of the attributes."""
        supply = []
        for dim in (self.artists, self.venues, self.dates):
            own = [a for a in attributes if a in dim.derived or a in dim.frame.columns]
            if own:
                supply.append((dim, own))
        missing = set(attributes) - {a for _, own in supply for a in own}
        if missing:
            raise ValueError(f"no dimension has {sorted(missing)}")
        return supply

    def packed(self, numbers: bool = False) -> "Star":
        """The same star by shorter keys: hashed text keys are most of a narrow row and do not compress in a shuffle.

        Where events are to be shuffled, ``numbers`` replaces the keys of dimensions of few rows by their ranks; that costs two broadcasts.
        """
        fact, dims = self.fact, [self.artists, self.venues, self.dates]
        numbers = numbers and not all(d.few() for d in dims)
        for i, dim in enumerate(dims):
            if fact.schema[dim.key].dataType == dim.frame.schema[dim.key].dataType == StringType() and not dim.derived:
                short, frame = (dim.numbered(fact), dim.numbered(dim.frame)) if numbers and dim.few() else [
                    df.withColumn(dim.key, packed_key(dim.key)) for df in (fact, dim.frame)]
                fact, dims[i] = short, Dimension(frame, dim.key, _counted=dim._counted)
        return Star(fact, *dims, self.unique_events)

    def with_attributes(self, events: DataFrame, dim: Dimension, attributes: Sequence[str]) -> DataFrame:
        """Events, row by row, with attributes of a dimension; they are shuffled to it only if its rows are many."""
        return attach(events, dim.frame, {dim.key: dim.key}, attributes, dim.few())

    def frame(self) -> DataFrame:
        """Events with all attributes, as the analyses see them. Events are shuffled only to dimensions of many rows, by short keys."""
        artist_columns = ["artist_name", "genre", "monthly_listeners", "sg_score", "sg_popularity"]
        venue_columns = ["venue_name", "city", "state"] + [c for c in ("lat", "lon") if c in self.venues.frame.columns]
        date_columns = ["day_name", "month_name", "month_num", "year", "quarter", "is_weekend"]
        star = self.packed(numbers=True)
        wide = star.with_attributes(star.fact, star.artists, artist_columns)
        wide = star.with_attributes(wide, star.venues, venue_columns)
        wide = star.with_attributes(wide, star.dates, date_columns)
        numbers = ["price_min", "price_max", "price_avg", "monthly_listeners", "sg_score", "sg_popularity"]
        own = ["event_id", "event_name", "event_date", "event_time", "sale_status", "price_min", "price_max", "price_avg", "currency"]
        columns = [
            F.col(c).cast("double").alias(c) if c in numbers else F.col(c)
            for c in own + artist_columns + venue_columns + date_columns[:-1]
        ]
        return wide.select(*columns, weekend_label("is_weekend").alias("is_weekend"))

    def chosen(self, attribute: str, value=None) -> "Star":
        """The star of the events with a value of an attribute: the dimension is reduced first
        and the fact's rows are chosen by its keys, below all grouping. No value means the whole star."""
        if value is None:
            return self
        [(dim, _)] = self.dimensions_of(attribute)
        frame = dim.frame.where(F.col(attribute) == F.lit(value))
        fact = self.fact.join(frame.select(dim.key).distinct(), dim.key, "left_semi")
        name = next(n for n in ("artists", "venues", "dates") if getattr(self, n) is dim)
        return replace(self, fact=fact, **{name: Dimension(frame, dim.key)})

    def weighted(self, *asked: Dimension) -> tuple[DataFrame, Column | None]:
        """The fact and how often the dimensions that are not asked for repeat each row; None for once."""
        fact, weight = self.fact, None
        for i, dim in enumerate((self.artists, self.venues, self.dates)):
            if self.unique_events or any(dim is d for d in asked):
                continue
            repeats, n = dim.repeats()
            if n == 0:
                continue
            times = repeats.select(F.col(dim.key).alias("__key"), F.col("times").alias(f"__times{i}"))
            small = F.broadcast(times) if n <= BROADCAST_KEYS else times
            fact = fact.join(small, fact[dim.key] == small["__key"], "left").drop("__key")
            own = F.coalesce(f"__times{i}", F.lit(1))
            weight = own if weight is None else weight * own
        return fact, weight

    def measures(self, weight: Column | None) -> list[Column]:
        """Aggregates of the fact's rows, each counting ``weight`` times."""
        price = priced("price_avg")
        if weight is None:
            return [
                F.count("event_id").alias("events"), F.count(F.lit(1)).alias("event_rows"),
                F.sum(price).alias("price_sum"), F.count(price).alias("price_n"),
            ]
        return [
            F.coalesce(F.sum(F.when(F.col("event_id").isNotNull(), weight)), F.lit(0)).alias("events"),
            F.sum(weight).alias("event_rows"),
            F.sum(price * weight.cast("int")).alias("price_sum"),
            F.coalesce(F.sum(F.when(price.isNotNull(), weight)), F.lit(0)).alias("price_n"),
        ]

    def cells(self, *attributes: str) -> DataFrame:
        """Events per combination of the keys of the asked dimensions, with the attributes joined to it.

        Measures: ``events`` (known ids), ``event_rows``, ``price_sum`` and ``price_n``
        (positive prices); those not used are pruned. Combinations of attributes may
        repeat, so sums and distinct counts over cells equal those over events. A key that repeats in another
        dimension multiplies the rows of every analysis: it weighs the fact's rows.
        """
        supply = self.dimensions_of(*attributes)
        fact, weight = self.weighted(*[d for d, _ in supply])
        cells = fact.groupBy(*[d.key for d, _ in supply]).agg(*self.measures(weight))
        for dim, own in supply:
            if set(own) <= set(dim.derived):
                cells = cells.withColumns({a: dim.derived[a] for a in own})
            else:
                cells = attach(cells, dim.frame, {dim.key: dim.key}, own)
        return cells.select(*attributes, *MEASURES)

    def rollup(self, *attributes: str, keep_null: bool = False) -> DataFrame:
        """The measures of ``cells`` per combination of attributes.

        Combinations with a NULL attribute are dropped unless ``keep_null``.
        """
        cells = self.cells(*attributes)
        if not keep_null:
            cells = known(cells, *attributes)
        return cells.groupBy(*attributes).agg(*[F.sum(m).alias(m) for m in MEASURES])

    def distinct_events(self, attribute: str) -> DataFrame:
        """Distinct events per attribute value, exact also where dimension keys repeat."""
        [(dim, _)] = self.dimensions_of(attribute)
        pairs = dim.frame.select(dim.key, attribute).distinct()
        if self.unique_events:
            counts = self.fact.groupBy(dim.key).agg(F.count("event_id").alias("events"))
            counts = attach(counts, pairs, {dim.key: dim.key}, [attribute])
            return known(counts, attribute).groupBy(attribute).agg(F.sum("events").alias("events"))
        rows = attach(self.fact.select(dim.key, "event_id"), pairs, {dim.key: dim.key}, [attribute], dim.few())
        return known(rows, attribute).groupBy(attribute).agg(self.events_counted().alias("events"))

    def totals(self, attribute: str, name: str, counted: str) -> DataFrame:
        """Measures per known value of an attribute of a dimension of few rows, and how many names of it events refer to, as ``counted``.

        Names are bits at their ranks, so that a task sends some bitmaps and not each name that it saw.
        """
        [(dim, _)] = self.dimensions_of(attribute)
        fact, weight = self.weighted(dim)
        rank = F.when(F.col(name).isNotNull(), F.dense_rank().over(Window.orderBy(name))).cast("bigint")
        ranked = dim.frame.select(dim.key, attribute, rank.alias("__rank"))
        rows = known(attach(fact, ranked, {dim.key: dim.key}, [attribute, "__rank"], True), attribute)
        parts = rows.groupBy(attribute, F.bitmap_bucket_number("__rank").alias("__bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("__rank")).alias("__bits"), *self.measures(weight))
        return parts.groupBy(attribute).agg(F.sum(F.bitmap_count("__bits")).alias(counted), *[F.sum(m).alias(m) for m in MEASURES])

    def distinct_names(self, attribute: str, name: str, counted: str) -> DataFrame:
        """Distinct names of one dimension per known value of an attribute of another, of few rows, as ``counted``: (attribute, counted).

        Events get the value by a broadcast, then only pairs of value and name's key are shuffled.
        """
        (dim, _), (named, _) = *self.dimensions_of(attribute), *self.dimensions_of(name)
        values = dim.frame.select(dim.key, attribute).distinct()
        rows = attach(self.fact.select(dim.key, named.key), values, {dim.key: dim.key}, [attribute], True)
        pairs = known(rows, attribute).select(attribute, named.key).distinct()
        return attach(pairs, named.frame, {named.key: named.key}, [name]).groupBy(attribute).agg(F.count_distinct(name).alias(counted))

    def seen(self, dim: Dimension) -> DataFrame:
        """Rows of a dimension that at least one event refers to."""
        return dim.frame.join(self.fact.select(dim.key).distinct(), dim.key, "left_semi")
