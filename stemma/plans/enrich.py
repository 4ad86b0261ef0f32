"""From published tables to the enriched release: every alias of a game is looked up, the best match decides, and the rest
is routed to aliases, ambiguous, unmatched and demoted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules as R
from ..functions.text import joined, lenient_int, public_notes, public_reason, safe, slug
from ..operators import joins as J
from ..operators.dedupe import best_by, last_wins, ordered_list
from ..operators.extract import alias_pairs
from ..operators.matching import best_match
from ..session import materialised
from . import schemas as S
from .publish import with_matches



def selected(issues: DataFrame, master: DataFrame, status: str | None = None, limit: int | None = None) -> DataFrame:
    """game_id of the games to enrich: all, those of one match status, the first so many in order."""
    ids = issues.select(safe(F.col("game_id")).alias("game_id")).distinct()
    if status:
        ids = ids.join(master.where(F.col("match_status") == status).select("game_id"), "game_id", "left_semi")
    return ids.orderBy("game_id").limit(limit) if limit is not None else ids


def enrich(issues: DataFrame, master: DataFrame, baseline: DataFrame, rejections: DataFrame, status: str | None = None, limit: int | None = None) -> dict[str, DataFrame]:
    """The enriched tables by name."""
    ids = selected(issues, master, status, limit)
    rows = issues.join(ids, "game_id", "left_semi").withColumn("ordinal", F.concat_ws("\u0001", safe(F.col("issue_code")), safe(F.col("archive_name"))))
    m = last_wins(master, "game_id", [F.col("representative_title")])
    pairs = alias_pairs(rows, ["game_id"]).withColumn("key", F.concat_ws("\u0001", "game_id", "normalized", "title"))
    pairs = pairs.withColumn("ordinal", F.concat_ws("\u0001", "ordinal", F.lpad(F.col("n").cast("string"), 6, "0")))
    looked = materialised(with_matches(materialised(pairs), "normalized", baseline, rejections, "key"))
    first = ids.join(m.select("game_id", lenient_int(safe(F.col("first_seen_year"))).alias("first_year")), "game_id", "left")
    alias_rows = looked.select("game_id", "ordinal", F.col("title").alias("source_title"), "alias_rejection_notes", *[F.col(f"alias_{f}").alias(f) for f in V.MATCH_FIELDS]).join(first, "game_id")
    best = materialised(best_match(alias_rows, "game_id", V.MATCH_FIELDS, "first_year"))
    drop = [c for c in m.columns if c in {*V.MATCH_FIELDS, *S.UNFILLED, "match_action", "match_notes", "data_quality_score"}]
    e = ids.join(m.drop(*drop), "game_id", "left").join(best, "game_id")
    action = F.when(F.col("match_action") != "retained_best_alias_match", F.col("match_action"))
    e = e.withColumn("match_notes", public_notes(F.array("notes", "quality_notes", action)))
    e = e.withColumn("canonical_slug", F.when(F.col("canonical_slug") != "", F.col("canonical_slug")).when(F.col("canonical_title") != "", slug(F.col("canonical_title"))).otherwise(""))
    e = e.withColumns({c: F.lit("") for c in S.UNFILLED}).withColumn("data_quality_score", R.quality_points(F.col))
    e = materialised(e)
    down = [*S.ENRICHED, "match_action", "match_notes", "data_quality_score"]
    issue_rows = J.pushed_down(rows.drop("ordinal"), e, "game_id", down)
    ranked = rank_aliases(alias_rows)
    top = best_by(ranked, ["game_id"], [F.asc("place")], 3).groupBy("game_id").agg(*[F.max(F.when(F.col("place") == i, F.col(c))).alias(f"candidate_{i}_{k}") for i in (1, 2, 3) for k, c in (("title", "canonical_title"), ("url", "match_source_url"))])
    named = [c.alias(n) for n, c in (("cluster_title", F.col("representative_title")), ("match_status", F.col("match_status")), ("match_confidence", F.col("match_confidence")), ("canonical_title", F.col("canonical_title")), ("canonical_slug", F.col("canonical_slug")))]
    aliases = looked.select("game_id", F.col("normalized").alias("normalized_title"), F.col("title").alias("representative_title"), *[F.col(f"alias_{f}") for f in ("match_status", "match_confidence", "canonical_title", "canonical_slug")], "alias_rejection_notes").join(e.select("game_id", *named), "game_id")
    ambiguous = e.where("match_status = 'ambiguous'").withColumn("failure_reason", F.col("match_notes")).join(top, "game_id", "left")
    variants = looked.groupBy("game_id").agg(joined(ordered_list(F.col("title"), F.col("ordinal"))).alias("search_variants"))
    unmatched = e.where("match_status = 'unmatched'").withColumn("failure_reason", F.col("match_notes")).join(variants, "game_id", "left")
    said = F.concat_ws(":", "source_title", "match_status", "canonical_title")
    told = ranked.groupBy("game_id").agg(joined(ordered_list(F.col("source_title"), F.col("place"))).alias("source_alias_titles"), joined(F.slice(ordered_list(said, F.col("place")), 1, 5)).alias("candidate_match_statuses"))
    demoted = e.where("match_action = 'demoted_weak_alias_match' and had_match").withColumn("demotion_reason", public_reason(F.coalesce(F.nullif("quality_notes", F.lit("")), F.col("notes")))).join(told, "game_id")
    texts = lambda df, cols: df.select([safe(F.col(c)).alias(c) for c in cols])
    return {
        "enriched_master_games": e.drop("notes", "quality_notes", "match_quality", "had_match"),
        "enriched_issue_titles": issue_rows,
        "title_aliases": texts(aliases, S.ALIASES),
        "ambiguous_matches": texts(ambiguous, S.AMBIGUOUS),
        "unmatched_titles": texts(unmatched, S.UNMATCHED),
        "match_demotions": texts(demoted, S.DEMOTIONS),
    }


def rank_aliases(rows: DataFrame) -> DataFrame:
    """Alias rows with place, their rank by quality within the game."""
    from pyspark.sql import Window

    r = rows.withColumn("__p", R.match_quality(F.col, F.col("first_year"))["points"])
    w = Window.partitionBy("game_id").orderBy(F.desc("__p"), F.desc("canonical_title"), F.desc("wikipedia_url"), F.asc("ordinal"))
    return r.withColumn("place", F.row_number().over(w)).drop("__p")


def audit(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of counts over the enriched tables."""
    m = tables["enriched_master_games"].agg(
        F.count("*").alias("master_rows"),
        *[F.count_if(F.col("match_status") == s).alias(s) for s in ("matched", "ambiguous", "unmatched")],
        *[F.count_if(F.col("data_quality_score") >= n).alias(f"quality_{n}") for n in (80, 60)],
    )
    others = {"issue_rows": "enriched_issue_titles", "demotions": "match_demotions"}
    for name, t in others.items():
        m = m.crossJoin(tables[t].agg(F.count("*").alias(name)))
    return m
