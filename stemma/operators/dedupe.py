"""First, best and distinct rows of a group. Every order is total and explicit: nothing depends on how rows arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE = "__place"


def best_by(df: DataFrame, keys: list, order: list, n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each group in this order (row_number, so that Spark drops the rest before the shuffle)."""
    out = df.withColumn(rank or PLACE, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank or PLACE) <= n)
    return out if rank else out.drop(PLACE)


def distinct_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key, the first in this order (dropDuplicates would take any)."""
    return best_by(df, keys, order)


def last_wins(df: DataFrame, key: str, order: list) -> DataFrame:
    """A map of rows where a later row replaces an earlier one of the same key; rows without a key are dropped."""
    return best_by(df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")), [key], [c.desc() for c in order])


def first_of(value: Column, *order: Column) -> Column:
    """Aggregate: the value where this order is smallest; combined before the shuffle."""
    return F.min_by(value, F.struct(*order))


def last_of(value: Column, *order: Column) -> Column:
    return F.max_by(value, F.struct(*order))


def sorted_set(c: Column) -> Column:
    return F.array_sort(F.collect_set(c))


def ordered_list(value: Column, *order: Column) -> Column:
    """Aggregate: the values in this order, nulls left out."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.alias("v")))))
    return F.transform(pairs, lambda x: x["v"])
