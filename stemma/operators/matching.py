"""Scoring of reference candidates and the choice among them."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import public_notes, reference_title, safe, slug, strip_version
from .dedupe import best_by


def ratio(a: Column, b: Column) -> Column:
    """Gestalt similarity, for which no built-in exists: Arrow batches, each different pair of a batch once."""

    @F.pandas_udf("double")
    def of(x: pd.Series, y: pd.Series) -> pd.Series:
        seen: dict = {}
        return pd.Series([seen[p] if p in seen else seen.setdefault(p, SequenceMatcher(None, *p).ratio()) for p in zip(x, y, strict=True)], dtype="float64")

    return of(a, b)


def length_bound(a: Column, b: Column) -> Column:
    """No similarity of two texts exceeds this."""
    return F.when(F.length(a) + F.length(b) == 0, F.lit(1.0)).otherwise(2.0 * F.least(F.length(a), F.length(b)) / (F.length(a) + F.length(b)))


def exact_tier(variant: Column, candidate: Column) -> Column:
    """100 equal, 96 equal without a version, 82 one holds the other, else 0; an empty variant is held by every text."""
    v, t, c = reference_title(variant), reference_title(strip_version(variant)), reference_title(candidate)
    return F.when(c == "", 0).when(v == c, 100).when((t != "") & (t == c), 96).when(c.contains(v) | v.contains(c), 82).otherwise(0)


def similar_tier(r: Column) -> Column:
    return F.when(r >= 0.97, 90).when(r >= 0.93, 80).when(r >= 0.89, 68).otherwise(0)


def candidate_scores(pairs: DataFrame, keys: list[str], variant: str, text: str) -> DataFrame:
    """Best score per key over pairs of a variant and a candidate's text. Only pairs that the native tiers leave below 90
    and whose lengths allow it reach the Python function."""
    p = pairs.withColumn("__tier", exact_tier(F.col(variant), F.col(text))).withColumn("__v", reference_title(F.col(variant))).withColumn("__c", reference_title(F.col(text)))
    open_ = (F.col("__tier") < 90) & (F.col("__c") != "") & (length_bound(F.col("__v"), F.col("__c")) >= 0.89)
    done = p.where(~open_).select(*keys, F.col("__tier").alias("__s"))
    more = p.where(open_).withColumn("__r", ratio(F.col("__v"), F.col("__c"))).select(*keys, F.greatest("__tier", similar_tier(F.col("__r"))).alias("__s"))
    return done.unionByName(more).groupBy(*keys).agg(F.max("__s").alias("score"))


def top_columns(df: DataFrame, keys: list[str], order: list, value: str, n: int = 3, prefix: str = "candidate_") -> DataFrame:
    """The first n values of each group as columns, empty where there are fewer."""
    top = best_by(df, keys, order, n, "__k")
    return top.groupBy(*keys).agg(*[F.max(F.when(F.col("__k") == i, F.col(value))).alias(f"{prefix}{i}") for i in range(1, n + 1)])


def gap_status(df: DataFrame, keys: list[str], score: str, order: list, least: float = 95, lead: float = 8, near: float = 5) -> DataFrame:
    """Per group: matched if the best score is high enough and leads clearly, ambiguous if another is near, else unmatched."""
    top = best_by(df, keys, order, 2, "__k")
    g = top.groupBy(*keys).agg(F.max(F.when(F.col("__k") == 1, F.col(score))).alias("top1"), F.max(F.when(F.col("__k") == 2, F.col(score))).alias("top2"))
    ahead = F.col("top1") - F.col("top2")
    status = F.when((F.col("top1") >= least) & (F.col("top2").isNull() | (ahead >= lead)), "matched").when(ahead <= near, "ambiguous").otherwise("unmatched")
    return g.withColumn("status", status)


def best_match(rows: DataFrame, key: str, fields: list[str], first_year: str) -> DataFrame:
    """The match of each group of alias rows (fields, source_title, alias_rejection_notes, first_year): one row per key
    with the fields, match_quality, quality_notes, match_action and had_match. Ties of all three sort keys go
    to the row that comes first by ordinal."""
    q = R.match_quality(F.col, F.col(first_year).cast("int"))
    r = rows.withColumn("__q", q).withColumns({"__points": F.col("__q")["points"], "__notes": F.array_join(F.col("__q")["notes"], "; ")})
    target = F.when(F.col("match_status") == "matched", F.coalesce(F.nullif(safe(F.col("canonical_slug")), F.lit("")), F.nullif(safe(F.col("wikidata_id")), F.lit(""))))
    # What the group says together is aggregated once per key and joined to its one best row.
    g = r.groupBy(key).agg(
        F.count_distinct(target).alias("__targets"),
        (F.max((F.col("match_status") == "ambiguous").cast("int")) == 1).alias("__ambiguous"),
        (F.max((F.col("match_status") == "matched").cast("int")) == 1).alias("had_match"),
    )
    r = best_by(r, [key], [F.desc("__points"), F.desc(safe(F.col("canonical_title"))), F.desc(safe(F.col("wikipedia_url"))), F.asc("ordinal")]).join(g, key)
    fill = R.is_qid(F.col("canonical_title")) & F.col("__notes").contains("raw_qid_title_backfill_candidate")
    r = r.withColumns(
        {
            "canonical_slug": F.when(fill, slug(F.col("source_title"))).otherwise(F.col("canonical_slug")),
            "notes": F.when(fill, public_notes(F.array(F.col("notes"), F.lit("canonical_title_backfilled_from_local_title")))).otherwise(F.col("notes")),
            "canonical_title": F.when(fill, F.col("source_title")).otherwise(F.col("canonical_title")),
        }
    )
    weak, torn = F.col("__points") < 50, F.col("__targets") > 1
    action = F.when(weak, "demoted_weak_alias_match").when(torn, "retained_with_cluster_conflict").otherwise("retained_best_alias_match")
    blank = {f: F.when(weak, F.lit("")).otherwise(safe(F.col(f))) for f in fields}
    blank |= {
        "match_status": F.when(weak, F.when(F.col("__ambiguous"), "ambiguous").otherwise("unmatched")).otherwise(F.col("match_status")),
        "match_confidence": F.when(weak, "low").otherwise(F.col("match_confidence")),
        "notes": F.when(weak, public_notes(F.array("__notes", "notes"))).when(torn, public_notes(F.array(F.col("notes"), F.lit("cluster_has_multiple_canonical_targets")))).otherwise(safe(F.col("notes"))),
    }
    return r.select(key, *[blank[f].alias(f) for f in fields], F.col("__points").alias("match_quality"), F.col("__notes").alias("quality_notes"), action.alias("match_action"), "had_match")
