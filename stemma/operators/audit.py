"""Measures of strategies and releases: recall, sufficiency, digests, literal scans, near variants, the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import variant_fold
from .dedupe import sorted_set


def recall(found: DataFrame, merged: dict[str, list[str]] | None = None) -> DataFrame:
    """Per strategy (strategy, title): candidates, different titles, and their share of all titles; merged names unions of
    strategies that are measured as one."""
    for name, of in (merged or {}).items():
        found = found.unionByName(found.where(F.col("strategy").isin(of)).withColumn("strategy", F.lit(name)))
    per = found.groupBy("strategy").agg(F.count("*").alias("candidates"), F.count_distinct("title").alias("titles"))
    all_ = found.agg(F.count_distinct("title").alias("union_size"))  # one row
    share = F.coalesce(F.round(F.try_divide(F.col("titles").cast("double"), F.col("union_size").cast("double")), 6), F.lit(0.0))
    return per.crossJoin(F.broadcast(all_)).withColumn("recall", share)


def digest(df: DataFrame) -> DataFrame:
    """One row (n, digest) that doesn't depend on the order of rows or columns; repeated rows count, and so does where the
    nulls are: a hash skips nulls, so each column is hashed after the fact whether it is one, and nested values as JSON
    that names them."""
    parts: list[Column] = []
    for name in sorted(df.columns):
        c = F.col("`" + name.replace("`", "``") + "`")
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
        parts += [c.isNull(), F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}) if nested else c]
    h = F.xxhash64(*parts)
    return df.agg(F.count("*").alias("n"), F.concat_ws("|", F.bit_xor(h), F.sum((h % 1000003).cast("bigint")), F.sum(F.pmod(F.shiftright(h, 20), F.lit(1000003)))).alias("digest"))


def literal_hits(docs: DataFrame, key: str, text: Column, literals: list[str]) -> DataFrame:
    """(key, literal) for every literal a text holds: the texts are scanned in place, nothing is joined."""
    found = F.filter(F.array(*[F.when(text.contains(x), F.lit(x)) for x in literals]), lambda x: x.isNotNull())
    return docs.select(key, F.explode(found).alias("literal"))


def near_variants(titles: DataFrame, column: str) -> DataFrame:
    """Groups of different titles that are the same but for umlauts, case and punctuation."""
    g = titles.groupBy(variant_fold(F.col(column)).alias("key")).agg(sorted_set(F.col(column)).alias("members"))
    return g.where(F.size("members") > 1)


def verdict(blockers: DataFrame, caveats: DataFrame) -> DataFrame:
    b, c = blockers.agg(F.count("*").alias("blockers")), caveats.agg(F.count("*").alias("caveats"))
    v = F.when(F.col("blockers") > 0, "not ready").when(F.col("caveats") > 0, "ready with caveats").otherwise("ready")
    return b.crossJoin(F.broadcast(c)).withColumn("verdict", v)


def mojibake(texts: DataFrame, key: str, text: str) -> DataFrame:
    """How often each text shows signs of a wrong decoding."""
    return texts.select(key, sum((F.regexp_count(text, F.lit(x)) for x in ("�", "Ã", "Â")), F.lit(0)).cast("bigint").alias("n"))
