"""Queries of joins, overlays, scoring and the choice of matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import safe
from ..operators import joins as J
from ..operators import matching as M
from .registry import query, table



@query("""
WITH p AS (SELECT p_partkey, p_name AS normalized_title, p_type AS title, p_brand AS source FROM part),
r AS (SELECT DISTINCT p_name AS n, lower(p_type) AS rejected, CASE WHEN p_size % 2 = 0 THEN 'brand#1' ELSE '' END AS s, 'size ' || (p_size % 4) AS reason, p_size % 4 AS o FROM part WHERE p_size < 8),
h AS (SELECT p_partkey, reason, min(o) AS o FROM p JOIN r ON n = normalized_title AND rejected = lower(title) AND (s = '' OR contains(lower(source), s)) GROUP BY 1, 2)
SELECT p.p_partkey, coalesce(string_agg(reason, '; ' ORDER BY o), '') AS rejection_notes FROM p LEFT JOIN h USING (p_partkey) GROUP BY 1""")
def rejection_theta(spark, d):
    part = table(spark, d, "part")
    p = part.select("p_partkey", F.col("p_name").alias("normalized_title"), "p_type", "p_brand")
    r = part.where("p_size < 8").select(F.col("p_name").alias("normalized_title"), F.col("p_type").alias("rejected"), F.when(F.col("p_size") % 2 == 0, "Brand#1").otherwise("").alias("source"), F.concat(F.lit("size "), (F.col("p_size") % 4).cast("string")).alias("reason"), (F.col("p_size") % 4).alias("ordinal")).distinct()
    return J.rejection_reasons(p, r, "p_partkey", F.col("p_type"), F.lit(""), F.col("p_brand")).select("p_partkey", "rejection_notes")


@query("""
WITH k AS (SELECT c_custkey::VARCHAR AS k FROM customer)
SELECT a.k AS source, CASE WHEN b.k IS NOT NULL THEN b.k ELSE a.k END AS key, b.k IS NOT NULL AS merged
FROM k a LEFT JOIN k b ON ends_with(a.k, '0') AND b.k = left(a.k, length(a.k) - 1) AND length(a.k) > 1""")
def trailing_zero_merge(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key")).withColumn("source", F.col("key"))
    return J.trailing_zero(c, "key").select("source", "key", "merged")


@query("""
WITH retry AS (SELECT o_orderkey, o_custkey, 'R' AS o_orderstatus, round(o_totalprice * 2, 2) AS o_totalprice FROM orders WHERE o_custkey % 7 = 0 AND o_orderstatus = 'F')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM retry) UNION ALL SELECT * FROM retry""")
def overlay_merge(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    retry = o.where("o_custkey % 7 = 0 and o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("R")).withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    return J.overlay(o, retry, "o_custkey")


@query("""
WITH v AS (SELECT DISTINCT p_name FROM part), c AS (SELECT DISTINCT p_name || CASE WHEN p_size % 3 = 0 THEN ' v 2' WHEN p_size % 3 = 1 THEN '' ELSE ' deluxe' END AS label FROM part),
s AS (SELECT p_name, label, CASE WHEN p_name = label THEN 100 WHEN contains(label, p_name) OR contains(p_name, label) THEN 82 ELSE 0 END AS tier FROM v JOIN c ON split_part(label, ' ', 1) = split_part(p_name, ' ', 1))
SELECT p_name, max(tier)::BIGINT AS score, count(*) FILTER (WHERE tier >= 82) AS candidates, min(levenshtein(p_name, label)) AS nearest FROM s GROUP BY 1""")
def variant_cross_score(spark, d):
    p = table(spark, d, "part")
    v = p.select("p_name").distinct().withColumn("k", F.split_part("p_name", F.lit(" "), F.lit(1)))
    tail = F.when(F.col("p_size") % 3 == 0, " v 2").when(F.col("p_size") % 3 == 1, "").otherwise(" deluxe")
    c = p.select(F.concat("p_name", tail).alias("label")).distinct().withColumn("k", F.split_part("label", F.lit(" "), F.lit(1)))
    s = v.join(c, "k").withColumn("tier", M.exact_tier(F.col("p_name"), F.col("label")))
    return s.groupBy("p_name").agg(F.max("tier").cast("bigint").alias("score"), F.count_if(F.col("tier") >= 82).alias("candidates"), F.min(F.levenshtein("p_name", "label")).cast("bigint").alias("nearest"))


@query(None)
def ratio_score(spark, d):
    """Best similarity of each part name to the names with the same first word, of every pair."""
    p = table(spark, d, "part").select("p_name", "p_type").distinct()
    v = p.select("p_name").distinct().withColumn("k", F.split_part("p_name", F.lit(" "), F.lit(1)))
    c = p.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("label"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("k")).distinct()
    return M.candidate_scores(v.join(c, "k"), ["p_name"], "p_name", "label")


@query("""
WITH k AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders)
SELECT o_custkey, max(o_orderkey) FILTER (WHERE k = 1) AS candidate_1, max(o_orderkey) FILTER (WHERE k = 2) AS candidate_2, max(o_orderkey) FILTER (WHERE k = 3) AS candidate_3
FROM k WHERE k <= 3 GROUP BY 1""")
def topk_pivot(spark, d):
    return M.top_columns(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], "o_orderkey")


@query("""
WITH s AS (SELECT o_custkey, o_orderkey, floor(o_totalprice / 5000)::BIGINT AS score FROM orders), k AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, o_orderkey) AS k FROM s),
g AS (SELECT o_custkey, max(score) FILTER (WHERE k = 1) AS top1, max(score) FILTER (WHERE k = 2) AS top2 FROM k WHERE k <= 2 GROUP BY 1)
SELECT *, CASE WHEN top1 >= 85 AND (top2 IS NULL OR top1 - top2 >= 8) THEN 'matched' WHEN top1 - top2 <= 5 THEN 'ambiguous' ELSE 'unmatched' END AS status FROM g""")
def gap_decision(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.floor(F.col("o_totalprice") / 5000).alias("score"))
    return M.gap_status(o, ["o_custkey"], "score", [F.desc("score"), F.asc("o_orderkey")], least=85)


#: Each order as a reference match of its customer's cluster.
MATCH_SQL = """
SELECT o_orderkey, o_custkey, (o_orderkey % 11) AS m, 1995 AS first_year,
  CASE WHEN o_orderkey % 5 < 3 THEN 'matched' WHEN o_orderkey % 5 = 3 THEN 'ambiguous' ELSE 'unmatched' END AS match_status,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Q' || o_orderkey ELSE 'Title ' || (o_orderkey % 13) END AS canonical_title,
  'title-' || (o_orderkey % 13) AS canonical_slug, CASE WHEN o_orderkey % 3 = 0 THEN 'game' ELSE '' END AS entity_type,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE year(o_orderdate)::VARCHAR END AS release_year,
  CASE WHEN o_orderkey % 6 = 1 THEN 'http://w/' || o_orderkey ELSE '' END AS wikipedia_url, CASE WHEN o_orderkey % 2 = 0 THEN 'Q' || o_orderkey ELSE '' END AS wikidata_id,
  CASE WHEN o_orderkey % 9 = 2 THEN 'x' ELSE '' END AS genres, CASE WHEN o_orderkey % 2 = 0 THEN 'https://www.wikidata.org/wiki/Q' || o_orderkey ELSE '' END AS match_source_url,
  CASE WHEN o_orderkey % 17 = 0 THEN 'no' ELSE '' END AS rejected FROM orders"""

POINTS_SQL = f"""
WITH m AS ({MATCH_SQL}), q AS (SELECT *, regexp_full_match(canonical_title, 'Q\\d+') AS qid, TRY_CAST(release_year AS INT) AS y FROM m),
f AS (SELECT *, entity_type = 'game' AND (y IS NULL OR y <= first_year + 3) AS fill, coalesce(y > first_year + 3, false) AS late FROM q),
p AS (SELECT *, CASE match_status WHEN 'matched' THEN 60 + CASE WHEN qid AND fill THEN -4 WHEN qid THEN -45 ELSE 10 END + CASE WHEN wikipedia_url <> '' THEN 10 ELSE 0 END
    + CASE WHEN wikidata_id <> '' THEN 5 ELSE 0 END + CASE WHEN genres <> '' THEN 5 ELSE 0 END + CASE WHEN release_year <> '' THEN 5 ELSE 0 END + CASE WHEN late THEN -50 ELSE 0 END
    + CASE WHEN match_source_url <> '' AND wikipedia_url = '' THEN -10 ELSE 0 END + CASE WHEN rejected <> '' THEN -60 ELSE 0 END WHEN 'ambiguous' THEN 25 ELSE 5 END AS points,
  CASE match_status WHEN 'matched' THEN array_to_string(list_filter([CASE WHEN qid AND fill THEN 'raw_qid_title_backfill_candidate' END, CASE WHEN qid AND NOT fill THEN 'demoted_raw_qid_title' END,
    CASE WHEN late THEN 'demoted_release_year_conflict' END, CASE WHEN y > first_year AND NOT late THEN 'release_after_first_issue_possible_preview' END,
    CASE WHEN match_source_url <> '' AND wikipedia_url = '' THEN 'wikidata_only_match' END, CASE WHEN rejected <> '' THEN 'manual_rejection' END], lambda x: x IS NOT NULL), '; ')
    WHEN 'ambiguous' THEN 'ambiguous_source_alias' ELSE 'unmatched_source_alias' END AS notes FROM f)"""


def matches(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    when = lambda c, a, b="": F.when(c, a).otherwise(F.lit(b))
    text = lambda prefix: F.concat(F.lit(prefix), k.cast("string"))
    return o.select(
        "o_orderkey", "o_custkey", F.lit(1995).alias("first_year"), k.alias("ordinal"), F.lit("some local title").alias("source_title"),
        F.when(k % 5 < 3, "matched").when(k % 5 == 3, "ambiguous").otherwise("unmatched").alias("match_status"),
        when(k % 7 == 0, text("Q"), None).alias("q"), F.coalesce(F.when(k % 7 == 0, text("Q")), F.concat(F.lit("Title "), (k % 13).cast("string"))).alias("canonical_title"),
        F.concat(F.lit("title-"), (k % 13).cast("string")).alias("canonical_slug"), when(k % 3 == 0, F.lit("game")).alias("entity_type"),
        F.when(k % 4 == 0, "").otherwise(F.year("o_orderdate").cast("string")).alias("release_year"), when(k % 6 == 1, text("http://w/")).alias("wikipedia_url"),
        when(k % 2 == 0, text("Q")).alias("wikidata_id"), when(k % 9 == 2, F.lit("x")).alias("genres"), when(k % 2 == 0, text("https://www.wikidata.org/wiki/Q")).alias("match_source_url"),
        when(k % 17 == 0, F.lit("no")).alias("alias_rejection_notes"), F.lit("").alias("categories"), F.lit("").alias("notes"), F.lit("high").alias("match_confidence"),
    )


@query(POINTS_SQL + " SELECT o_orderkey, points::BIGINT AS points, notes FROM p")
def match_quality(spark, d):
    m = matches(spark, d).withColumn("q", R.match_quality(F.col, F.col("first_year")))
    return m.select("o_orderkey", F.col("q.points").cast("bigint").alias("points"), F.array_join("q.notes", "; ").alias("notes"))


BEST_FIELDS = ["canonical_title", "match_status", "match_confidence", "wikidata_id", "notes"]


@query(POINTS_SQL + """, w AS (SELECT *, max(CASE WHEN match_status = 'ambiguous' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS amb FROM p),
t AS (SELECT o_custkey, count(DISTINCT canonical_slug) AS targets FROM p WHERE match_status = 'matched' GROUP BY 1),
b AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY points DESC, canonical_title DESC, wikipedia_url DESC, o_orderkey) = 1)
SELECT o_custkey, points::BIGINT AS match_quality, CASE WHEN points < 50 THEN 'demoted_weak_alias_match' WHEN coalesce(targets, 0) > 1 THEN 'retained_with_cluster_conflict' ELSE 'retained_best_alias_match' END AS match_action,
  CASE WHEN points < 50 THEN '' WHEN contains(notes, 'raw_qid_title_backfill_candidate') THEN 'some local title' ELSE canonical_title END AS canonical_title,
  CASE WHEN points >= 50 THEN match_status WHEN amb = 1 THEN 'ambiguous' ELSE 'unmatched' END AS match_status, CASE WHEN points < 50 THEN 'low' ELSE 'high' END AS match_confidence,
  CASE WHEN points < 50 THEN '' ELSE wikidata_id END AS wikidata_id,
  CASE WHEN points < 50 THEN notes || CASE WHEN contains(notes, 'raw_qid_title_backfill_candidate') THEN '; canonical_title_backfilled_from_local_title' ELSE '' END
    ELSE concat_ws('; ', CASE WHEN contains(notes, 'raw_qid_title_backfill_candidate') THEN 'canonical_title_backfilled_from_local_title' END, CASE WHEN coalesce(targets, 0) > 1 THEN 'cluster_has_multiple_canonical_targets' END) END AS notes
FROM b LEFT JOIN t USING (o_custkey)""")
def best_match(spark, d):
    b = M.best_match(matches(spark, d), "o_custkey", BEST_FIELDS, "first_year")
    return b.select("o_custkey", F.col("match_quality").cast("bigint").alias("match_quality"), "match_action", *BEST_FIELDS)


@query("""
SELECT o_orderkey, greatest(0, least(100, 35 + CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END + CASE o_orderkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 5 ELSE 0 END
  + CASE o_orderkey % 4 WHEN 0 THEN 20 WHEN 1 THEN 5 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 5 ELSE 0 END + CASE WHEN o_orderkey % 7 = 0 THEN 4 ELSE 0 END
  + CASE WHEN o_totalprice > 100000 THEN 3 ELSE 0 END + CASE o_orderkey % 6 WHEN 0 THEN -4 ELSE 0 END + CASE o_orderkey % 9 WHEN 0 THEN -10 WHEN 1 THEN -20 ELSE 0 END))::BIGINT AS data_quality_score FROM orders""")
def quality_score(spark, d):
    k = F.col("o_orderkey")
    row = {
        "content_class": F.when(F.col("o_orderstatus") == "F", "game"),
        "merge_confidence": F.when(k % 3 == 0, "high").when(k % 3 == 1, "medium"),
        "match_status": F.when(k % 4 == 0, "matched").when(k % 4 == 1, "ambiguous"),
        "wikipedia_url": F.when(k % 5 == 0, "u"),
        "wikidata_id": F.lit(""),
        "release_year": F.when(k % 7 == 0, "1999"),
        "categories": F.lit(""),
        "genres": F.when(F.col("o_totalprice") > 100000, "g"),
        "rating_value": F.lit(None),
        # Of several flags only the first is parted from its blank and counts.
        "cleanup_flags": F.when(k % 6 == 0, "split_compound_token; x").when(k % 6 == 1, "x; split_compound_token"),
        "match_notes": F.when(k % 9 == 0, "demoted_raw_qid_title").when(k % 9 == 1, "demoted_raw_qid_title; demoted_release_year_conflict"),
    }
    return table(spark, d, "orders").select("o_orderkey", R.quality_points(lambda n: safe(row[n])).cast("bigint").alias("data_quality_score"))
