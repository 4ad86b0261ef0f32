"""Queries of clusters, catalogues, staged extraction and the joins of the plans, each through the operator that the plans use.
Rows come from whole tables; the SQL states the rules from scratch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import audit as A
from ..operators import cleaning as C
from ..operators import cluster as G
from ..operators import extract as X
from ..operators import joins as J
from ..session import materialised, shared_path
from ..sources.state import State
from . import enrich, extraction, overlay, publish, resolve
from . import schemas as S
from .registry import query, sql_list, table

FLAGS = ["", "stripped_version_suffix", "split_compound_token; stripped_version_suffix", "stripped_disc_descriptor", "other; split_compound_token"]
SOURCES = ["disc-metadata-value", "vollversion-fullversion,disc-exe-name", "disc-manifest-path", "disc-metadata-command,disc-metadata-value"]
LEVELS = ["high", "medium", "low", ""]
CLASSES = ["game", "expansion_or_addon", "mod_or_conversion"]


def choice(values: list[str], n) -> F.Column:
    return F.get(F.split(F.lit("|".join(values)), r"\|"), n.cast("int"))


#: Every order as a cleaned candidate of an issue (its customer's remainder) and a game.
ROWS_SQL = f"""
SELECT 'I' || lpad((o_custkey % 40)::VARCHAR, 2, '0') AS issue_code, 'g' || (o_orderkey % 23) AS game_id, 'Title ' || (o_orderkey % 7) || CASE WHEN o_orderstatus = 'F' THEN ' Gold' ELSE '' END AS cleaned_title,
  ({sql_list(FLAGS)})[(o_custkey % 5 + 1)::INT] AS flags, ({sql_list(SOURCES)})[(o_orderkey % 4 + 1)::INT] AS kinds, ({sql_list(LEVELS)})[(o_orderkey % 31 % 4 + 1)::INT] AS confidence,
  (['', 'demo', 'full_version'])[(o_orderkey % 3 + 1)::INT] AS content_kind, (['demo_game', 'game_title'])[(o_custkey % 2 + 1)::INT] AS content_form,
  ({sql_list(CLASSES)})[(o_custkey % 3 + 1)::INT] AS content_class, year(o_orderdate)::VARCHAR AS year, o_orderkey AS o FROM orders"""


def cleaned_rows(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = table(spark, d, "orders").select(
        F.concat(F.lit("I"), F.lpad((c % 40).cast("string"), 2, "0")).alias("issue_code"), F.concat(F.lit("g"), (k % 23).cast("string")).alias("game_id"),
        F.concat(F.lit("Title "), (k % 7).cast("string"), F.when(F.col("o_orderstatus") == "F", " Gold").otherwise("")).alias("cleaned_title"),
        choice(FLAGS, c % 5).alias("title_cleanup_flags"), choice(SOURCES, k % 4).alias("source_kinds"), choice(LEVELS, k % 31 % 4).alias("confidence"),
        choice(["", "demo", "full_version"], k % 3).alias("content_kind"), choice(["demo_game", "game_title"], c % 2).alias("content_form"), choice(CLASSES, c % 3).alias("content_class"),
        F.year("o_orderdate").cast("string").alias("year"), F.lpad(k.cast("string"), 12, "0").alias("ordinal"), k.alias("o"),
    )
    title = F.concat("cleaned_title", F.lit(" v "), (F.col("o") % 3).cast("string"))
    return o.withColumns({"source_title": title, "source_normalized_title": F.lower(title), "representative_title": F.col("cleaned_title"), "archive_name": F.concat("issue_code", F.lit(".7z"))})


def _first_distinct(value: str, keys: str, source: str, order: str = "o") -> str:
    """SQL: (keys, v): the different non-blank values of a group in order of first occurrence, joined."""
    return f"SELECT {keys}, string_agg(v, '; ' ORDER BY pos) AS v FROM (SELECT {keys}, v, min(pos) AS pos FROM (SELECT {keys}, trim({value}) AS v, {order} AS pos FROM {source}) WHERE v <> '' GROUP BY {keys}, v) GROUP BY {keys}"


#: The rows with what the orders of choice need, and the issue clusters.
CLUSTERS_SQL = f"""
rows0 AS ({ROWS_SQL}), rows1 AS (SELECT *, cleaned_title || ' v ' || (o % 3) AS source_title, string_split(flags, ';') AS fl, string_split(kinds, ',') AS ks,
  CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END AS conf FROM rows0),
rows2 AS (SELECT *,
  row_number() OVER (PARTITION BY issue_code, game_id ORDER BY conf DESC, CASE WHEN list_contains(ks, 'vollversion-fullversion') THEN 3 ELSE 0 END + CASE WHEN list_contains(ks, 'disc-metadata-value') THEN 2 ELSE 0 END DESC,
    CASE WHEN list_contains(fl, 'split_compound_token') THEN 0 ELSE 1 END + CASE WHEN list_contains(fl, 'stripped_version_suffix') THEN 0 ELSE 1 END DESC,
    len(string_split(cleaned_title, ' ')) DESC, length(cleaned_title), cleaned_title DESC, o) AS best,
  row_number() OVER (PARTITION BY issue_code, game_id ORDER BY list_contains(fl, 'stripped_version_suffix'), list_contains(fl, 'stripped_disc_descriptor'), list_contains(fl, 'split_compound_token'), length(cleaned_title) DESC, cleaned_title, o) AS shown,
  row_number() OVER (PARTITION BY issue_code, game_id ORDER BY conf DESC, o) AS sure FROM rows1),
flat AS (SELECT issue_code, game_id, o, unnest(fl) AS f, generate_subscripts(fl, 1) AS n FROM rows1),
said AS ({_first_distinct('source_title', 'issue_code, game_id', 'rows1')}), saidn AS ({_first_distinct('lower(source_title)', 'issue_code, game_id', 'rows1')}),
cleanup AS ({_first_distinct('f', 'issue_code, game_id', 'flat', 'o * 10 + n')}),
kindset AS (SELECT issue_code, game_id, string_agg(DISTINCT k, '; ' ORDER BY k) AS v FROM (SELECT issue_code, game_id, unnest(ks) AS k FROM rows1) GROUP BY 1, 2),
flagset AS (SELECT issue_code, game_id, string_agg(DISTINCT trim(f), '; ' ORDER BY trim(f)) AS v FROM flat WHERE trim(f) <> '' GROUP BY 1, 2),
issues AS (SELECT issue_code, game_id, max(cleaned_title) FILTER (WHERE shown = 1) AS representative_title, lower(max(cleaned_title) FILTER (WHERE shown = 1)) AS normalized_title,
  max(o) FILTER (WHERE best = 1) AS best_row, max(cleaned_title) FILTER (WHERE best = 1) AS cleaned_title, max(source_title) FILTER (WHERE best = 1) AS source_title, max(content_class) FILTER (WHERE best = 1) AS content_class,
  max(content_kind) FILTER (WHERE best = 1) AS content_kind, max(content_form) FILTER (WHERE best = 1) AS content_form, max(year) FILTER (WHERE best = 1) AS year,
  max(confidence) FILTER (WHERE sure = 1) AS confidence, count(*) AS occurrence_count_in_issue, count(DISTINCT cleaned_title) AS n_titles, bool_or(NOT contains(flags, 'stripped_version_suffix')) AS plain,
  coalesce(string_agg(DISTINCT content_kind, '; ' ORDER BY content_kind) FILTER (WHERE content_kind <> ''), '') AS content_kinds_merged, string_agg(DISTINCT content_form, '; ' ORDER BY content_form) AS content_forms_merged
  FROM rows2 GROUP BY 1, 2),
clusters AS (SELECT i.*, said.v AS observed_title_variants, saidn.v AS source_normalized_variants, kindset.v AS source_kinds, coalesce(cleanup.v, '') AS title_cleanup_flags, coalesce(flagset.v, '') AS cleanup_flags,
  CASE WHEN contains(coalesce(flagset.v, ''), 'split_compound_token') OR (n_titles > 1 AND plain) THEN 'medium' ELSE 'high' END AS merge_confidence
  FROM issues i LEFT JOIN said USING (issue_code, game_id) LEFT JOIN saidn USING (issue_code, game_id) LEFT JOIN kindset USING (issue_code, game_id) LEFT JOIN cleanup USING (issue_code, game_id) LEFT JOIN flagset USING (issue_code, game_id))"""
CLUSTER_COLUMNS = "issue_code game_id representative_title normalized_title cleaned_title confidence occurrence_count_in_issue observed_title_variants source_normalized_variants source_kinds title_cleanup_flags cleanup_flags merge_confidence content_kinds_merged content_forms_merged".split()


@query(f"WITH {CLUSTERS_SQL} SELECT best_row, {', '.join(CLUSTER_COLUMNS)} FROM clusters")
def issue_clusters(spark, d):
    return G.issue_clusters(cleaned_rows(spark, d)).select(F.col("o").alias("best_row"), *CLUSTER_COLUMNS)


GAME_COLUMNS = "game_id representative_title normalized_title first_seen_issue first_seen_year last_seen_issue last_seen_year issue_count occurrence_count best_confidence source_kinds alias_count alias_titles content_class cleanup_flags merge_confidence observed_content_kinds".split()


@query(f"""
WITH {CLUSTERS_SQL}, c AS (SELECT *, string_split(title_cleanup_flags, ';') AS fl, (year, issue_code, issue_code || '.7z') AS seen,
  CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END AS conf FROM clusters),
r AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY list_contains(fl, 'stripped_version_suffix'), list_contains(fl, 'stripped_disc_descriptor'), list_contains(fl, 'split_compound_token'), length(cleaned_title) DESC, cleaned_title, issue_code) AS shown,
  row_number() OVER (PARTITION BY game_id ORDER BY conf DESC, issue_code) AS sure FROM c),
f AS (SELECT game_id, string_agg(DISTINCT trim(x), '; ' ORDER BY trim(x)) AS v FROM (SELECT game_id, unnest(fl) AS x FROM c) WHERE trim(x) <> '' GROUP BY 1),
k AS (SELECT game_id, string_agg(DISTINCT x, '; ' ORDER BY x) AS v FROM (SELECT game_id, trim(unnest(string_split(source_kinds, ';'))) AS x FROM c) GROUP BY 1),
g AS (SELECT game_id, max(cleaned_title) FILTER (WHERE shown = 1) AS representative_title, arg_min(issue_code, seen) AS first_seen_issue, arg_min(year, seen) AS first_seen_year, arg_max(issue_code, seen) AS last_seen_issue,
  arg_max(year, seen) AS last_seen_year, count(*) AS issue_count, sum(occurrence_count_in_issue)::BIGINT AS occurrence_count, max(confidence) FILTER (WHERE sure = 1) AS best_confidence,
  count(DISTINCT source_title) AS alias_count, string_agg(DISTINCT source_title, '; ' ORDER BY source_title) AS alias_titles, count(DISTINCT cleaned_title) AS n_titles, bool_or(NOT contains(title_cleanup_flags, 'stripped_version_suffix')) AS plain,
  max(CASE content_class WHEN 'expansion_or_addon' THEN 2 WHEN 'mod_or_conversion' THEN 1 ELSE 0 END) AS c,
  coalesce(string_agg(DISTINCT content_kind, '; ' ORDER BY content_kind) FILTER (WHERE content_kind <> ''), '') AS observed_content_kinds FROM r GROUP BY 1)
SELECT game_id, representative_title, lower(representative_title) AS normalized_title, first_seen_issue, first_seen_year, last_seen_issue, last_seen_year, issue_count, occurrence_count, best_confidence, k.v AS source_kinds, alias_count, alias_titles,
  CASE c WHEN 2 THEN 'expansion_or_addon' WHEN 1 THEN 'mod_or_conversion' ELSE 'game' END AS content_class, coalesce(f.v, '') AS cleanup_flags,
  CASE WHEN contains(coalesce(f.v, ''), 'split_compound_token') OR (n_titles > 1 AND plain) THEN 'medium' ELSE 'high' END AS merge_confidence, observed_content_kinds
FROM g LEFT JOIN f USING (game_id) LEFT JOIN k USING (game_id)""")
def game_clusters(spark, d):
    return G.games(materialised(G.issue_clusters(cleaned_rows(spark, d)))).select(GAME_COLUMNS)


@query(f"""
WITH r AS ({ROWS_SQL}), s AS (SELECT *, cleaned_title || ' v ' || (o % 3) AS source_title, string_split(flags, ';') AS fl FROM r),
k AS (SELECT game_id, string_agg(DISTINCT x, '; ' ORDER BY x) AS v FROM (SELECT game_id, unnest(string_split(kinds, ',')) AS x FROM r) GROUP BY 1),
t AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY list_contains(fl, 'stripped_version_suffix'), list_contains(fl, 'stripped_disc_descriptor'), list_contains(fl, 'split_compound_token'), length(cleaned_title) DESC, cleaned_title, o) AS shown FROM s)
SELECT game_id, max(cleaned_title) FILTER (WHERE shown = 1) AS representative_title, arg_min(content_class, o) AS content_class, count(DISTINCT issue_code) AS issue_count, count(*) AS occurrence_count,
  string_agg(DISTINCT source_title, '; ' ORDER BY source_title) AS alias_titles, max(k.v) AS source_kinds FROM t JOIN k USING (game_id) GROUP BY 1""")
def excluded_games(spark, d):
    return G.excluded(cleaned_rows(spark, d)).select(S.EXCLUDED)


#: Every event as a candidate of a user's archive.
PATHS = ["Demo/setup", "bonus/x", "Vollversionen/x", "games", "Inhalt"]
KINDS = ["disc-exe-name", "disc-metadata-value", "archiveorg-ocr", "redump-title", "vollversion-fullversion"]
FOUND_SQL = f"""
SELECT 'A' || user_id AS archive_name, event_type AS normalized_title, 'T' || (event_id % 11) AS candidate_title, ({sql_list(KINDS)})[(event_id % 97 % 5 + 1)::INT] AS source_kind,
  ({sql_list(PATHS)})[(event_id % 5 + 1)::INT] || lpad(event_id::VARCHAR, 9, '0') AS source_path, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN value > 50 THEN 3 WHEN value > 10 THEN 2 ELSE 1 END AS conf, event_id, user_id, event_type FROM events"""
RECORDS_SQL = "SELECT DISTINCT 'item' AS archive_item, 'A' || user_id AS archive_name, 'CBS' || lpad(user_id::VARCHAR, 4, '0') AS issue_code, (2000 + user_id % 20)::INT AS year, 'CD' AS variant FROM events"


def found(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id")
    return e.select(
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("archive_name"), F.col("event_type").alias("normalized_title"), F.concat(F.lit("T"), (k % 11).cast("string")).alias("candidate_title"), choice(KINDS, k % 97 % 5).alias("source_kind"),
        F.concat(choice(PATHS, k % 5), F.lpad(k.cast("string"), 9, "0")).alias("source_path"), F.when(F.col("value") > 50, "high").when(F.col("value") > 10, "medium").otherwise("low").alias("confidence"),
    )


def records(spark, d):
    u = table(spark, d, "events").select("user_id").distinct()
    return u.select(F.lit("item").alias("archive_item"), F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("archive_name"), F.concat(F.lit("CBS"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("issue_code"), (F.col("user_id") % 20 + 2000).cast("int").alias("year"), F.lit("CD").alias("variant"))


@query(f"""
WITH f AS ({FOUND_SQL}), b AS (SELECT *, row_number() OVER (PARTITION BY archive_name, normalized_title ORDER BY conf DESC, source_kind, source_path) AS k FROM f),
s AS (SELECT archive_name, normalized_title, string_agg(DISTINCT source_kind, ',' ORDER BY source_kind) AS source_kinds FROM f GROUP BY 1, 2)
SELECT archive_item, archive_name, issue_code, year::VARCHAR AS year, variant, normalized_title, candidate_title AS representative_title, source_kinds, confidence,
  CASE WHEN starts_with(source_path, 'Voll') OR source_kind LIKE 'vollversion-%' THEN 'full_version' WHEN starts_with(source_path, 'Demo') THEN 'demo' WHEN starts_with(source_path, 'bonus') THEN 'bonus' ELSE 'unknown' END AS content_kind
FROM b JOIN s USING (archive_name, normalized_title) JOIN ({RECORDS_SQL}) USING (archive_name) WHERE k = 1""")
def issue_title_best(spark, d):
    return extraction.issue_titles(found(spark, d), records(spark, d))


@query(f"""
WITH f AS ({FOUND_SQL}), g AS (SELECT archive_name, count(DISTINCT normalized_title) AS titles, bool_or(source_kind IN ('archiveorg-ocr', 'disc-metadata-value', 'vollversion-fullversion')) AS structured, bool_or(source_kind = 'vollversion-fullversion') AS "full" FROM f GROUP BY 1)
SELECT archive_name, titles, structured, "full", "full" OR titles >= 4 OR (titles >= 2 AND structured) AS enough FROM g""")
def sufficiency(spark, d):
    return extraction.enough(found(spark, d))


@query(f"""
WITH f AS (SELECT *, CASE event_id % 3 WHEN 0 THEN 'vollversion' WHEN 1 THEN 'ocr' ELSE 'redump' END AS strategy, event_id % 29 = 0 AS structured FROM ({FOUND_SQL})),
t AS (SELECT archive_name, normalized_title, count(DISTINCT strategy) AS n, bool_or(structured) AS structured, bool_or(strategy = 'vollversion' AND structured) AS page FROM f GROUP BY 1, 2),
g AS (SELECT archive_name, count(*) AS titles, count(*) FILTER (WHERE n >= 2) AS agreed, bool_or(structured) AS structured, bool_or(page) AS page FROM t GROUP BY 1),
r AS (SELECT *, CASE WHEN page THEN 'vollversion structured issue page' WHEN titles >= 3 AND structured THEN 'structured external list' WHEN titles >= 3 AND agreed >= 2 THEN 'multiple cheap strategies agree' ELSE 'cheap sources incomplete' END AS reason FROM g)
SELECT archive_name, titles, agreed, reason, reason <> 'cheap sources incomplete' AS enough FROM r""")
def cheap_sufficiency(spark, d):
    f = found(spark, d).withColumn("n", F.regexp_extract("source_path", r"(\d+)$", 1).cast("bigint"))
    f = f.withColumns({"strategy": F.when(F.col("n") % 3 == 0, "vollversion").when(F.col("n") % 3 == 1, "ocr").otherwise("redump"), "structured": F.col("n") % 29 == 0})
    return extraction.cheap_enough(f).select("archive_name", "titles", "agreed", "reason", "enough")


@query(f"""
WITH f AS ({FOUND_SQL}), u AS (SELECT archive_name, normalized_title, source_kind, left(source_path, 4) AS path, max(conf) AS conf FROM f GROUP BY 1, 2, 3, 4)
SELECT archive_name, normalized_title, source_kind, path AS source_path, row_number() OVER (PARTITION BY archive_name ORDER BY normalized_title,
  CASE source_kind {' '.join(f"WHEN '{k}' THEN {V.SOURCE_RANKS.get(k, 0)}" for k in KINDS)} ELSE 0 END DESC, conf DESC, path, source_kind) AS place FROM u""")
def merge_ranked(spark, d):
    m = extraction.merged(found(spark, d).withColumn("source_path", F.substring("source_path", 1, 4)))
    return m.select("archive_name", "normalized_title", "source_kind", "source_path", F.col("place").cast("bigint").alias("place"))


@query(f"""
WITH f AS (SELECT f.*, issue_code, year FROM ({FOUND_SQL}) f JOIN ({RECORDS_SQL}) USING (archive_name))
SELECT normalized_title, arg_min(candidate_title, (year, archive_name, source_path)) AS representative_title, arg_min(issue_code, (year, archive_name, source_path)) AS first_issue, count(*) AS occurrence_count, count(DISTINCT archive_name) AS archive_count FROM f GROUP BY 1""")
def titles_dedup(spark, d):
    return extraction.titles(found(spark, d), records(spark, d))


@query("""
WITH e AS (SELECT md5(user_id || ':' || event_type) AS sha1, 'f' || event_id AS exe_name, 'A' || user_id AS archive_name, strftime(ts, '%Y%m%d') AS year, 'c' || (event_id % 3) AS c, lpad(event_id::VARCHAR, 9, '0') AS p FROM events)
SELECT sha1, arg_min(exe_name, (year, archive_name, c, p)) AS exe_name, arg_min(archive_name, (year, archive_name, c, p)) AS first_archive, count(*) AS occurrence_count, count(DISTINCT archive_name) AS archive_count FROM e GROUP BY 1""")
def first_seen_dedup(spark, d):
    k, u = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    e = table(spark, d, "events").select(F.md5(F.concat(u, F.lit(":"), "event_type")).alias("sha1"), F.concat(F.lit("f"), k).alias("exe_name"), F.concat(F.lit("A"), u).alias("archive_name"), F.date_format("ts", "yyyyMMdd").alias("year"), F.concat(F.lit("c"), (F.col("event_id") % 3).cast("string")).alias("inner_container"), F.lpad(k, 9, "0").alias("exe_path"), F.lit("ok").alias("status"))
    return extraction.executables(e)


@query("""
SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS done, (SELECT count(*) FROM lineitem) AS titles, max(lpad(o_orderkey::VARCHAR, 9, '0')) FILTER (WHERE o_orderstatus = 'P') AS in_work,
  arg_max(lpad(o_orderkey::VARCHAR, 9, '0'), (o_orderdate, lpad(o_orderkey::VARCHAR, 9, '0'))) FILTER (WHERE o_orderstatus = 'F') AS last_done, strftime(max(o_orderdate) FILTER (WHERE o_orderstatus = 'F'), '%Y-%m-%d') AS finished_at FROM orders""")
def progress_summary(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "P", "started").otherwise("extract_failed")
    o = table(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("archive_name"), status.alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("finished_at"))
    return extraction.progress(o, table(spark, d, "lineitem").select("l_orderkey"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS strategy, event_type AS title, 'p' || user_id AS path, event_id % 2 = 0 AS structured, (event_id % 1000)::INT AS elapsed_ms, CASE WHEN event_type = 'error' THEN 'bad \"x\"' END AS error FROM events")
def json_fields(spark, d):
    """Results of strategies written as JSON and read again."""
    e, text = table(spark, d, "events"), lambda c: c.cast("string")
    one = F.struct(F.lit("k").alias("source_kind"), F.concat(F.lit("p"), text(F.col("user_id"))).alias("source_path"), F.col("event_type").alias("candidate_title"), F.lit(None).cast("string").alias("normalized_title"), F.lit("low").alias("confidence"), F.lit("unknown").alias("content_kind"))
    failed = F.col("event_type") == "error"
    r = e.select("event_id", F.when(~failed, F.col("event_type")).alias("strategy"), F.array(one).alias("candidates"), (F.col("event_id") % 2 == 0).alias("structured"), (F.col("event_id") % 1000).cast("int").alias("elapsed_ms"), F.when(failed, 'bad "x"').alias("error"), F.lit("").alias("notes"))
    back = extraction.deserialized(extraction.serialized(r, "event_id"), "event_id")
    return back.select("event_id", "strategy", F.col("candidates")[0]["candidate_title"].alias("title"), F.col("candidates")[0]["source_path"].alias("path"), "structured", "elapsed_ms", "error")


#: Damaged titles as they come, and what the repairs make of them.
DAMAGED = [("adash stadt der magie kapitel11", "Adash - Stadt der Magie - Kapitel 11"), ("2 ritter auf der suche nach der hinrei enden herzelinde", "2 Ritter - Auf der Suche nach der hinreißenden Herzelinde")]


@query("""
WITH s AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'adash stadt der magie kapitel11' WHEN 1 THEN '2 ritter auf der suche nach der hinrei enden herzelinde' ELSE 'supplier ' || s_suppkey END AS n, 'Harbour ' || s_name AS t FROM supplier)
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Adash - Stadt der Magie - Kapitel 11' WHEN 1 THEN '2 Ritter - Auf der Suche nach der hinreißenden Herzelinde' ELSE t END AS representative_title,
  CASE s_suppkey % 4 WHEN 0 THEN 'adash stadt der magie kapitel11' WHEN 1 THEN '2 ritter auf der suche nach der hinrei enden herzelinde' ELSE 'harbour supplier ' || split_part(t, '#', 2) END AS normalized_title FROM s""")
def dict_repair(spark, d):
    k = F.col("s_suppkey")
    n = F.when(k % 4 == 0, DAMAGED[0][0]).when(k % 4 == 1, DAMAGED[1][0]).otherwise(F.concat(F.lit("supplier "), k.cast("string")))
    return C.repair_titles(table(spark, d, "supplier").select("s_suppkey", n.alias("normalized_title"), F.concat(F.lit("Harbour "), "s_name").alias("representative_title"))).select("s_suppkey", "representative_title", "normalized_title")


@query("""
WITH b AS (SELECT 'c' || c_custkey AS n, c_name, lower(c_name) AS slug, 'wikimedia' AS src, CASE WHEN c_custkey % 10 = 0 THEN 'too new' END AS reason FROM customer WHERE c_acctbal > 0)
SELECT o_orderkey, coalesce(c_name, '') AS title, coalesce(slug, '') AS slug, coalesce(src, '') AS source, coalesce(reason, '') AS notes FROM orders LEFT JOIN b ON n = 'c' || o_custkey""")
def lookup_enrich(spark, d):
    n = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    c = table(spark, d, "customer").where("c_acctbal > 0")
    base = c.select(n.alias("normalized_title"), F.col("c_name").alias("canonical_title"), F.lower("c_name").alias("canonical_slug"), F.lit("wikimedia").alias("match_source"))
    no = c.where("c_custkey % 10 = 0").select(n.alias("normalized_title"), F.col("c_name").alias("rejected_candidate"), F.lit("WIKI").alias("source"), F.lit("too new").alias("reason"))
    rows = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("n"))
    out = publish.with_matches(rows, "n", base, no, "o_orderkey")
    return out.select("o_orderkey", F.col("alias_canonical_title").alias("title"), F.col("alias_canonical_slug").alias("slug"), F.col("alias_match_source").alias("source"), F.col("alias_rejection_notes").alias("notes"))


@query("""
SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 'utility' ELSE lang END AS content_class, coalesce(l.toxic = 1, false) OR coalesce(l.quality = 0, false) AS hidden, l.doc_id::VARCHAR AS reason
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def override_flag(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("game_id"), F.col("lang").alias("content_class"))
    say = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("game_id"), F.lit("").alias("representative_title"), F.when(F.col("quality") == 0, "utility").otherwise("").alias("content_class"), F.when(F.col("toxic") == 1, " FALSE ").otherwise("yes").alias("publishable"), F.col("doc_id").cast("string").alias("reason"))
    return J.overridden(rows, say, ["utility"]).select("doc_id", "content_class", "hidden", F.col("manual_content_reason").alias("reason"))


@query("""
WITH a AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS largest, min(o_orderkey) AS first_order FROM orders GROUP BY 1)
SELECT o_orderkey, n, largest, first_order FROM orders JOIN a USING (o_custkey)""")
def master_pushdown(spark, d):
    o = table(spark, d, "orders")
    a = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("largest"), F.min("o_orderkey").alias("first_order"))
    return J.pushed_down(o.select("o_orderkey", "o_custkey", F.lit("old").alias("largest")), a, "o_custkey", ["n", "largest", "first_order"]).select("o_orderkey", "n", "largest", "first_order")


@query("SELECT l_orderkey, l_linenumber, o_orderstatus AS reference_status, o_orderpriority AS reference_title FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def referential_check(spark, d):
    """A line without an order is an error."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("normalized_title"))
    known = table(spark, d, "orders").select(F.col("o_orderkey").alias("normalized_title"), F.col("o_orderstatus").alias("reference_status"), F.col("o_orderpriority").alias("reference_title"))
    return resolve.attach(rows, known, ["reference_status", "reference_title"]).drop("normalized_title")


@query("""
WITH o AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'matched' WHEN 'O' THEN 'ambiguous' ELSE 'unmatched' END AS s, o_orderkey % 101 AS q FROM orders)
SELECT count(*) AS master_rows, count(*) FILTER (WHERE s = 'matched') AS matched, count(*) FILTER (WHERE s = 'ambiguous') AS ambiguous, count(*) FILTER (WHERE s = 'unmatched') AS unmatched,
  count(*) FILTER (WHERE q >= 80) AS quality_80, count(*) FILTER (WHERE q >= 60) AS quality_60, (SELECT count(*) FROM lineitem) AS issue_rows, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS demotions FROM o""")
def status_counts(spark, d):
    s = F.when(F.col("o_orderstatus") == "F", "matched").when(F.col("o_orderstatus") == "O", "ambiguous").otherwise("unmatched")
    m = table(spark, d, "orders").select(s.alias("match_status"), (F.col("o_orderkey") % 101).alias("data_quality_score"))
    return enrich.audit({"enriched_master_games": m, "enriched_issue_titles": table(spark, d, "lineitem"), "match_demotions": table(spark, d, "customer").where("c_acctbal < 0")})


@query("""
WITH t AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS title FROM documents), k AS (
  SELECT title, regexp_replace(replace(replace(replace(replace(lower(title), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[^a-z0-9]+', '', 'g') AS key FROM t)
SELECT key, count(*) AS titles, md5(string_agg(title, ' | ' ORDER BY title)) AS members FROM k GROUP BY key HAVING count(*) > 1""")
def near_variant_groups(spark, d):
    """Lines of all documents."""
    t = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("title"))
    g = A.near_variants(t, "title")
    return g.select("key", F.size("members").cast("bigint").alias("titles"), F.md5(F.array_join("members", " | ")).alias("members"))


@query("SELECT c_custkey::VARCHAR AS archive_name FROM customer WHERE c_acctbal < 0 UNION SELECT o_custkey::VARCHAR FROM orders WHERE o_totalprice > 100000")
def set_union(spark, d):
    text = lambda c: F.col(c).cast("string").alias("archive_name")
    return overlay.archives(table(spark, d, "customer").where("c_acctbal < 0").select(text("c_custkey")), table(spark, d, "orders").where("o_totalprice > 100000").select(text("o_custkey")))


@query("SELECT user_id::VARCHAR AS archive_name FROM events WHERE event_type = 'view' INTERSECT SELECT user_id::VARCHAR FROM events WHERE event_type = 'purchase' AND value > 50")
def set_intersect(spark, d):
    e = table(spark, d, "events").withColumn("archive_name", F.col("user_id").cast("string"))
    return overlay.still_open(overlay.archives(e.where("event_type = 'view'")), e.where("event_type = 'purchase' and value > 50"))


@query("""
WITH a AS (SELECT DISTINCT o_custkey::VARCHAR AS k FROM orders WHERE o_orderdate < '1998-06-01'), b AS (SELECT DISTINCT o_custkey::VARCHAR AS k FROM orders WHERE o_orderdate >= '1998-06-01')
SELECT k, 'added' AS change FROM b WHERE k NOT IN (SELECT k FROM a) UNION ALL SELECT k, 'removed' FROM a WHERE k NOT IN (SELECT k FROM b)""")
def set_changes(spark, d):
    o = table(spark, d, "orders").withColumn("k", F.col("o_custkey").cast("string"))
    return J.changes(o.where("o_orderdate < '1998-06-01'"), o.where("o_orderdate >= '1998-06-01'"), "k")


@query("""
WITH a AS (SELECT user_id, count(*) AS n_before FROM events WHERE ts < '2024-01-16' GROUP BY 1), b AS (SELECT user_id, count(*) AS n_after FROM events WHERE ts >= '2024-01-16' GROUP BY 1)
SELECT user_id, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after, n_before IS NULL AS added, n_after IS NULL AS removed FROM a FULL JOIN b USING (user_id)""")
def delta_full_outer(spark, d):
    """Every event is in one of the two windows."""
    e = table(spark, d, "events")
    return J.delta(e.where("ts < '2024-01-16'"), e.where("ts >= '2024-01-16'"), "user_id")


@query("""
WITH p AS (SELECT p_partkey, p_name, p_brand, lower(p_name) AS n, CASE WHEN p_size % 2 = 0 THEN [p_name, p_type] ELSE [p_type] END AS o, CASE WHEN p_size % 3 = 0 THEN [lower(p_name)] ELSE [lower(p_name), upper(p_type)] END AS s FROM part),
a AS (SELECT p_brand, n AS normalized, p_name AS title FROM p UNION SELECT p_brand, unnest(s), unnest(o) FROM p WHERE len(s) = len(o))
SELECT DISTINCT p_brand, normalized, title FROM a""")
def alias_zip(spark, d):
    two = lambda c, a, b: F.when(c, F.concat_ws("; ", *a)).otherwise(F.concat_ws("; ", *b))
    p = table(spark, d, "part").select("p_brand", F.col("p_name").alias("source_title"), F.lower("p_name").alias("source_normalized_title"), two(F.col("p_size") % 2 == 0, ["p_name", "p_type"], ["p_type"]).alias("observed_title_variants"), two(F.col("p_size") % 3 == 0, [F.lower("p_name")], [F.lower("p_name"), F.upper("p_type")]).alias("source_normalized_variants"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("ordinal"))
    return X.alias_pairs(p, ["p_brand"]).select("p_brand", "normalized", "title")


@query(r"""
WITH n AS (SELECT p_partkey, lpad((p_partkey % 14)::VARCHAR, 2, '0') AS m, (CASE WHEN p_partkey % 3 = 0 THEN '2004' ELSE lpad((p_partkey % 100)::VARCHAR, 2, '0') END) AS y, (['', 'Gold', 'DVD'])[(p_partkey % 5 % 3 + 1)::INT] AS v, p_partkey % 7 = 0 AS bad FROM part)
SELECT p_partkey, CASE WHEN length(y) = 4 THEN 2004 WHEN y::INT <= 69 THEN 2000 + y::INT ELSE 1900 + y::INT END AS year, 'CBS' || m || y || v AS code, CASE WHEN v <> '' THEN v WHEN length(y) = 4 THEN 'CD' ELSE 'Standard' END AS variant
FROM n WHERE NOT bad AND m::INT BETWEEN 1 AND 12""", name="archive_names")
def archive_names(spark, d):
    from ..functions.text import archive_name

    k = F.col("p_partkey")
    name = F.concat(F.lit("x/CBS"), F.lpad((k % 14).cast("string"), 2, "0"), F.when(k % 3 == 0, "2004").otherwise(F.lpad((k % 100).cast("string"), 2, "0")), choice(["", "Gold", "DVD"], k % 5 % 3), F.when(k % 7 == 0, ".zip").otherwise(".7Z"))
    p = table(spark, d, "part").select("p_partkey", archive_name(name).alias("p")).where("p is not null")
    return p.select("p_partkey", "p.year", "p.code", "p.variant")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, 'base' AS version FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_partkey % 50 = 0)
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'rerun' FROM lineitem WHERE l_partkey % 50 = 0""")
def replace_units(spark, d):
    """A state whose units that are run again get their new rows only."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    s = State(spark, shared_path(spark, "units"), "l_orderkey bigint, l_linenumber int, l_partkey bigint, version string", "l_orderkey")
    s.append(li.withColumn("version", F.lit("base")))
    s.replace_all(li.where("l_partkey % 50 = 0").withColumn("version", F.lit("rerun")), "l_orderkey")
    return s.read()


@query("""
SELECT user_id || '/' || event_type AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS latest, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def upsert_incremental(spark, d):
    """The events of one week after another laid over a keyed state."""
    from ..streaming.incremental import batches

    e = table(spark, d, "events").select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("k"), "ts", "event_id", "value", F.date_trunc("week", "ts").alias("week"))
    s = State(spark, shared_path(spark, "events"), "k string, ts timestamp_ntz, event_id bigint, value double", "k")
    batches(s, e, "week", [F.col("ts"), F.col("event_id")])
    return s.read().select("k", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("latest"), "event_id", "value")
