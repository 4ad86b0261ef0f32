"""Samples that are the same on every run: the order is a digest of seed and key, not a random generator's state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import best_by


def seeded(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def stratified(df: DataFrame, strata: list, key: str, size: int, seed: int = 1) -> DataFrame:
    """One row of each stratum (in the strata's order, no more than size), then others by their digest up to size."""
    d = df.withColumn("__h", seeded(seed, F.col(key)))
    one = best_by(d, strata, [F.asc("__h"), F.asc(key)]).withColumn("__first", F.lit(0))
    rest = d.join(one.select(key), key, "left_anti").withColumn("__first", F.lit(1))
    blank = [F.when(F.col("__first") == 0, F.col(s)).asc() for s in strata]
    # orderBy with limit keeps `size` rows of each partition and merges those.
    return one.unionByName(rest).orderBy("__first", *blank, "__h", key).limit(size).drop("__h", "__first")


def top(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
