"""One row per key, and the best rows per group.

All of them are ``row_number() <= k`` filters, which Spark plans with a group
limit before the shuffle: each map task sends at most k rows of a key, so a key
that holds a third of all rows costs one row per map task and not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from encore.functions.text import pack_texts, packed_parts, unpack_texts

_RANK, _PACKED = "__rank", "__packed"


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of every group. NULL keys form one group."""
    ranks = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(ranks))
    return ranked.where(F.col(_RANK) <= k).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    loaded_at: str = "loaded_at",
    tiebreak: Sequence[str | Column] | None = None,
    whole: bool = False,
) -> DataFrame:
    """The most recently loaded row of every key.

    A missing load time sorts first, as descending order does in the warehouse.
    Rows loaded at the same instant are told apart by ``tiebreak``, by default
    all other columns, so the result is the same on every run. ``whole`` tells that all columns are used after: texts
    that decide nothing are then sorted and shuffled as one.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c != loaded_at]
    order = [F.col(loaded_at).desc_nulls_first()]
    order += [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in tiebreak]
    decide = {*keys, loaded_at, *[c for c in tiebreak if isinstance(c, str)]}
    carried = [f.name for f in df.schema if f.name not in decide and f.dataType == StringType()]
    if not whole or len(carried) < 2 or not all(isinstance(c, str) for c in tiebreak):
        return top_per_group(df, keys, order, 1)
    packed = df.select(*[c for c in df.columns if c not in carried], pack_texts(carried).alias(_PACKED))
    best = top_per_group(packed, keys, order, 1).withColumn(_PACKED, packed_parts(_PACKED))
    texts = dict(zip(carried, unpack_texts(F.col(_PACKED), carried)))
    return best.select(*[texts.get(c, c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The smallest row of every key in ascending order, NULLs last."""
    return top_per_group(df, keys, [F.col(c).asc_nulls_last() for c in order], 1)


def keep_first(
    df: DataFrame, key: str, order: Sequence[str], drop_missing: bool = True
) -> DataFrame:
    """Keep-first distinct in feed order. ``dropDuplicates`` would keep an arbitrary row."""
    if drop_missing:
        df = df.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return first_per_key(df, [key], order)
