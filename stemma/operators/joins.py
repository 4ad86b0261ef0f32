"""Lookups, overrides, overlays and set operations between tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined, safe
from .dedupe import last_wins

def rejection_hits(df: DataFrame, rejections: DataFrame, row_key: str, title: Column, slug: Column, source: Column) -> DataFrame:
    """(row_key, __all) for the rows of df that have some: reasons of the rejections under the same normalized_title whose candidate is the row's title
    or slug and whose source, if both have one, is part of the row's. rejections: normalized_title, rejected, source,
    reason, ordinal. row_key identifies df's rows."""
    r = rejections.select(F.col("normalized_title").alias("__n"), F.lower("rejected").alias("__r"), F.lower("source").alias("__s"), safe(F.col("reason")).alias("__why"), F.col("ordinal").alias("__o"))
    src = F.lower(safe(source))
    fits = (safe(F.col("__s")) == "") | (src == "") | src.contains(F.col("__s"))
    same = (F.col("__r") != "") & ((F.col("__r") == F.lower(safe(title))) | (F.col("__r") == F.lower(safe(slug))))
    why = F.when(F.col("__why") == "", "manual rejection").otherwise(F.col("__why"))
    return df.join(r, (F.col("normalized_title") == F.col("__n")) & fits & same).groupBy(row_key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", why.alias("w")))), lambda x: x["w"]).alias("__all"))


def rejection_reasons(df: DataFrame, rejections: DataFrame, row_key: str, title: Column, slug: Column, source: Column) -> DataFrame:
    """df with rejection_notes: the reasons that rejection_hits finds, joined."""
    hit = rejection_hits(df, rejections, row_key, title, slug, source)
    return df.join(hit, row_key, "left").withColumn("rejection_notes", F.coalesce(joined(F.col("__all")), F.lit(""))).drop("__all")


def trailing_zero(df: DataFrame, key: str) -> DataFrame:
    """key without a last 0 where the shorter key exists too; the keys are those before any merge."""
    ids = df.select(F.col(key).alias("__short")).distinct()
    zero = F.col(key).endswith("0")
    # Rows without a zero go by their own key: as nulls they would all meet in one task.
    cut = F.when(zero, F.substring(key, F.lit(1), F.length(key) - 1)).otherwise(F.col(key))
    out = df.withColumn("__cut", cut).join(ids, (F.col("__cut") == F.col("__short")) & zero, "left")
    return out.withColumn("merged", F.col("__short").isNotNull()).withColumn(key, F.coalesce("__short", key)).drop("__cut", "__short")


def overlay(base: DataFrame, delta: DataFrame, key, replaced: DataFrame | None = None) -> DataFrame:
    """base without the rows of replaced's keys (delta's, if not given), and delta's rows: an upsert by key."""
    return base.join((replaced if replaced is not None else delta).select(key).distinct(), key, "left_anti").unionByName(delta)


def orphans(df: DataFrame, parents: DataFrame, key) -> DataFrame:
    """Rows whose key no parent has."""
    return df.join(parents, key, "left_anti")


def insert_absent(base: DataFrame, rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """base and the rows whose key it lacks, one per key, the first in this order."""
    from .dedupe import distinct_first

    return base.unionByName(distinct_first(rows, keys, order).join(base.select(*keys).distinct(), keys, "left_anti"))


def pushed_down(rows: DataFrame, master: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows with these columns of their key's master row in place of their own; rows whose key has none are dropped."""
    mine = {c.lower() for c in columns}
    return rows.drop(*[c for c in rows.columns if c.lower() in mine]).join(master.select(key, *columns), key)


def overridden(rows: DataFrame, overrides: DataFrame, hidden_classes: list[str]) -> DataFrame:
    """rows with content_class replaced where overrides (game_id, content_class, publishable, reason; the last of a game in
    the order of all columns) say one, manual_content_reason, and hidden: said not to be published, or of a hidden class."""
    last = last_wins(overrides, "game_id", [F.col(c) for c in ("game_id", "representative_title", "content_class", "publishable", "reason")])
    o = last.select("game_id", F.col("content_class").alias("__class"), F.lower(F.trim(safe(F.col("publishable")))).alias("__publish"), F.col("reason").alias("manual_content_reason"))
    out = rows.join(o, "game_id", "left").withColumn("content_class", F.when(safe(F.col("__class")) != "", F.col("__class")).otherwise(F.col("content_class")))
    hidden = F.coalesce(F.col("__publish").isin("0", "false", "no"), F.lit(False)) | F.col("content_class").isin(hidden_classes)
    return out.withColumn("hidden", hidden).drop("__class", "__publish")


def changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change) for the different keys that only one of two tables has: added or removed."""
    x, y = (t.select(key).where(F.col(key).isNotNull() & (F.col(key) != "")).distinct() for t in (before, after))
    return orphans(y, x, key).withColumn("change", F.lit("added")).unionByName(orphans(x, y, key).withColumn("change", F.lit("removed")))


def delta(a: DataFrame, b: DataFrame, key: str, names=("n_before", "n_after")) -> DataFrame:
    """Per key the number of rows in either table and flags for new and gone keys."""
    x, y = (t.groupBy(key).agg(F.count("*").alias(n)) for t, n in zip((a, b), names, strict=True))
    out = x.join(y, key, "full_outer")
    return out.select(key, *[F.coalesce(n, F.lit(0)).alias(n) for n in names], F.col(names[0]).isNull().alias("added"), F.col(names[1]).isNull().alias("removed"))
