"""Hot keys: found by counting, and joined apart from the others.

Adaptive execution splits a hot key of an inner or left join, but neither of a full outer join nor of a bucketed
table. Both get their hot keys treated here. A key is hot where it holds more than ``1 / parts`` of the rows, so
there are fewer than ``parts`` hot keys, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from encore.operators.filters import known

#: Rows of hot keys that are broadcast, at most.
BROADCAST_ROWS = 100_000
#: Salts per part: salts meet tasks by hash, so a task should get several of them.
SALTS = 8


def hot_keys(df: DataFrame, key: str, parts: int) -> list:
    """The known keys that hold more than a share of ``1 / parts`` of all rows; fewer than ``parts`` of them.

    Rows are counted per key map-side; the counts are read once more for the total.
    """
    counts = known(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return sorted(r[0] for r in counts.where(F.col("n") * parts > total).collect())


def among(key: str, values: list) -> Column:
    """Whether a key is one of the values; false, not NULL, where it is missing."""
    return F.coalesce(F.col(key).isin(values), F.lit(False)) if values else F.lit(False)


def salted_join(many: DataFrame, few: DataFrame, name: str, parts: int) -> DataFrame:
    """Inner join of hot names: the many rows get one of ``SALTS * parts`` salts by their contents, the few are repeated for each."""
    salts = SALTS * parts
    salt = F.pmod(F.xxhash64(*many.columns), F.lit(salts)).cast("int")
    many = many.withColumn("__salt", salt)
    few = few.withColumnRenamed(name, "__name").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = (many[name] == few["__name"]) & (many["__salt"] == few["__salt"])
    return many.join(few, on).drop(many["__salt"]).drop("__salt", "__name")


def outer_by_hot_name(left: DataFrame, right: DataFrame, name: str, parts: int = 200) -> DataFrame:
    """``joins.outer_by_name`` where a name may hold much of a side: the same rows, no task with a whole hot name.

    Names that are hot on either side leave the outer join. Those on both sides are joined inner: with the side that has fewer rows
    of them broadcast where it is counted to be small, so that the other does not move and its copies stay where they are; else salted by the
    rows' contents, with that side repeated (equal whole rows share a salt then). Those on one side only need no join at all. Missing names are hot too, as they match each other.
    Columns besides the name must differ; both sides are read several times, so give tables.
    """
    own_left, own_right = [c for c in left.columns if c != name], [c for c in right.columns if c != name]
    if set(own_left) & set(own_right):
        raise ValueError(f"both sides have {sorted(set(own_left) & set(own_right))}")
    hot = sorted({*hot_keys(left, name, parts), *hot_keys(right, name, parts)})

    def missing(side: DataFrame, columns: list[str]) -> DataFrame:
        return side.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns])

    types = {**dict(left.dtypes), **dict(right.dtypes)}
    spread = left.where(~among(name, hot) & F.col(name).isNotNull()).join(
        right.where(~among(name, hot) & F.col(name).isNotNull()), name, "full")
    columns = [name, *own_left, *own_right]
    result = spread.select(columns)
    for test, joined_on in ((among(name, hot), name), (F.col(name).isNull(), None)):
        sides = [side.where(test) for side in (left, right)]
        sizes = [{r[0]: r[1] for r in s.groupBy(name).agg(F.count(F.lit(1))).collect()} for s in sides]  # under 2 * parts names
        both = sorted(set(sizes[0]) & set(sizes[1]), key=repr)
        alone = [sorted(set(s) - set(both), key=repr) for s in sizes]
        for side, keys, other in ((sides[0], alone[0], own_right), (sides[1], alone[1], own_left)):
            if keys:
                rows = side if joined_on is None else side.where(among(name, keys))
                result = result.unionByName(missing(rows, [(c, types[c]) for c in other]).select(columns))
        if not both:
            continue
        if joined_on is None:  # one constant stands for the missing name
            sides = [s.withColumn(name, F.lit(0)) for s in sides]
        few = 0 if sum(sizes[0][k] for k in both) <= sum(sizes[1][k] for k in both) else 1
        rows = sum(sizes[few][k] for k in both)
        fewer, many = sides[few], sides[1 - few]
        inner = many.join(F.broadcast(fewer), name) if rows <= BROADCAST_ROWS else salted_join(many, fewer, name, parts)
        if joined_on is None:
            inner = inner.withColumn(name, F.lit(None).cast(types[name]))
        result = result.unionByName(inner.select(columns))
    return result
