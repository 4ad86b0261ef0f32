"""Queries of dedupe, aggregation, ranking, sampling and set operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import variant_fold
from ..operators import dedupe as D
from ..operators import joins as J
from ..operators import sampling as S
from .registry import query, table


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query("""
SELECT sha256(text) AS digest, min(doc_id) AS first_doc, count(*) AS n, count(DISTINCT source) AS sources
FROM documents GROUP BY 1""")
def content_hash_dedup(spark, d):
    t = table(spark, d, "documents")
    return t.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


@query("""
SELECT conv_id, role, turn, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS k FROM conversations) WHERE k = 1""")
def distinct_keep_first(spark, d):
    t = table(spark, d, "conversations")
    return D.distinct_first(t, ["conv_id", "role"], [F.asc("turn"), F.asc("text")]).select("conv_id", "role", "turn", "text")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_discount FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
    CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END DESC, l_discount DESC, l_linenumber DESC,
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax, l_shipdate) AS k FROM lineitem) WHERE k = 1""")
def best_row_composite(spark, d):
    t = table(spark, d, "lineitem")
    flag = R.rank(F.col("l_returnflag"), {"R": 3, "A": 2, "N": 1})
    order = [flag.desc(), F.desc("l_discount"), F.desc("l_linenumber"), *map(F.asc, ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_shipdate"])]
    return D.best_by(t, ["l_orderkey"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_discount")


@query("""
SELECT p_brand, p_name AS display, p_partkey, n FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name), p_name, p_partkey) AS k,
         count(*) OVER (PARTITION BY p_brand) AS n FROM part) WHERE k = 1""")
def best_display_pick(spark, d):
    p = table(spark, d, "part")
    order = [F.length("p_name"), F.col("p_name"), F.col("p_partkey")]
    return p.groupBy("p_brand").agg(D.first_of(F.col("p_name"), *order).alias("display"), D.first_of(F.col("p_partkey"), *order).alias("p_partkey"), F.count("*").alias("n"))


@query("""
WITH a AS (SELECT user_id, ts::DATE AS day, count(*) AS n, sum(value) AS v FROM events GROUP BY 1, 2)
SELECT user_id, count(*) AS days, sum(n)::BIGINT AS events, max(n) AS most, round(sum(v), 2) AS total FROM a GROUP BY 1""")
def two_level_rollup(spark, d):
    e = table(spark, d, "events")
    a = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    return a.groupBy("user_id").agg(F.count("*").alias("days"), F.sum("n").alias("events"), F.max("n").alias("most"), F.round(F.sum("v"), 2).alias("total"))


@query("""
SELECT lang, min(doc_id) AS first_doc, count(*) AS occurrence_count, count(DISTINCT source) AS issue_count,
       string_agg(DISTINCT source, ',' ORDER BY source) AS source_kinds, max(n_chars) AS longest
FROM documents GROUP BY 1""")
def master_rebuild(spark, d):
    t = table(spark, d, "documents")
    return t.groupBy("lang").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("occurrence_count"), F.count_distinct("source").alias("issue_count"), F.array_join(D.sorted_set(F.col("source")), ",").alias("source_kinds"), F.max("n_chars").alias("longest"))


@query("""
SELECT o_orderkey, year(o_orderdate)::BIGINT AS year,
  CASE WHEN year(o_orderdate) <= 2004 THEN 'early' WHEN year(o_orderdate) <= 2010 THEN 'late' ELSE 'modern' END AS year_bucket,
  CASE o_orderkey % 5 WHEN 0 THEN 'platin' WHEN 1 THEN 'gold' WHEN 2 THEN 'silber' WHEN 3 THEN 'dvd' ELSE 'standard' END AS variant_bucket,
  CASE WHEN length(o_orderpriority) <= 7 THEN 'new' ELSE 'old' END AS naming_bucket
FROM orders""")
def bucketize(spark, d):
    o = table(spark, d, "orders")
    variant = F.element_at(F.array(*map(F.lit, ["Platin Edition", "Goldausgabe", "CD Silber", "DVD9", "CD"])), (F.col("o_orderkey") % 5 + 1).cast("int"))
    year = F.year("o_orderdate")
    return o.select("o_orderkey", year.cast("bigint").alias("year"), R.year_bucket(year).alias("year_bucket"), R.variant_bucket(variant).alias("variant_bucket"), R.naming_bucket(F.col("o_orderpriority")).alias("naming_bucket"))


@query("""
WITH q AS (SELECT l_partkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
SELECT p_partkey, p_name, n, qty, row_number() OVER (ORDER BY n DESC, qty DESC, lower(p_name), p_partkey) AS place
FROM q JOIN part ON p_partkey = l_partkey ORDER BY n DESC, qty DESC, lower(p_name), p_partkey LIMIT 100""")
def top100_rank(spark, d):
    q = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    p = table(spark, d, "part")
    order = [F.desc("n"), F.desc("qty"), F.lower("p_name"), F.asc("p_partkey")]
    t = S.top(q.join(p, q.l_partkey == p.p_partkey).select("p_partkey", "p_name", "n", "qty"), order, 100)
    # Only the hundred rows that are left are numbered.
    return t.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@query("""
WITH h AS (SELECT doc_id, lang, source, md5('1|' || doc_id::VARCHAR) AS h FROM documents), s AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY h, doc_id) AS k FROM h)
SELECT doc_id, lang, source FROM s
ORDER BY CASE WHEN k = 1 THEN 0 ELSE 1 END, CASE WHEN k = 1 THEN lang ELSE '' END, CASE WHEN k = 1 THEN source ELSE '' END, h, doc_id LIMIT 200""")
def stratified_sample(spark, d):
    return S.stratified(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 200)


@query("""
WITH t AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS day FROM events)
SELECT (SELECT max(day) FROM t) AS latest, (SELECT max(day) FROM t WHERE day < (SELECT max(day) FROM t)) AS previous,
       count(*) AS n FROM events WHERE strftime(ts, '%Y%m%d') = (SELECT max(day) FROM t)""")
def latest_snapshot(spark, d):
    from ..sources.snapshots import latest

    e = table(spark, d, "events").select(F.date_format("ts", "yyyyMMdd").alias("day"), "event_id")
    days = e.groupBy("day").count()
    last = latest(days, "day").select(F.col("day").alias("latest"))
    before = latest(days.join(F.broadcast(last), F.col("day") < F.col("latest")), "day").select(F.col("day").alias("previous"))
    return days.join(F.broadcast(last), F.col("day") == F.col("latest")).crossJoin(F.broadcast(before)).select("latest", "previous", F.col("count").alias("n"))


@query("""
SELECT user_id FROM events WHERE event_type = 'view' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 50""")
def set_except(spark, d):
    e = table(spark, d, "events")
    a = e.where("event_type = 'view'").select("user_id")
    return a.distinct().join(e.where("event_type = 'purchase' and value > 50").select("user_id"), "user_id", "left_anti")


@query("""
SELECT o_custkey, count(DISTINCT o_orderpriority) AS targets, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS names
FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1""")
def conflict_targets(spark, d):
    o = table(spark, d, "orders")
    g = o.groupBy("o_custkey").agg(D.sorted_set(F.col("o_orderpriority")).alias("s"))
    return g.where(F.size("s") > 1).select("o_custkey", F.size("s").cast("bigint").alias("targets"), F.array_join("s", "; ").alias("names"))


@query("""
WITH s AS (SELECT event_type, count(*) AS candidates, count(DISTINCT user_id) AS titles FROM events GROUP BY 1 UNION ALL
           SELECT 'merged', count(*), count(DISTINCT user_id) FROM events WHERE event_type IN ('view', 'click')),
u AS (SELECT count(DISTINCT user_id) AS all_titles FROM events)
SELECT event_type AS strategy, candidates, titles, all_titles AS union_size, round(titles / all_titles, 6) AS recall FROM s, u""")
def recall_vs_union(spark, d):
    from ..operators.audit import recall

    e = table(spark, d, "events").select(F.col("event_type").alias("strategy"), F.col("user_id").alias("title"))
    return recall(e, {"merged": ["view", "click"]})


@query("""
SELECT count(*) AS n, true AS same FROM (SELECT o_custkey, count(*) AS c, min(o_orderkey) AS k FROM orders GROUP BY 1)""")
def determinism_hash(spark, d):
    from ..operators.audit import digest

    o = table(spark, d, "orders")
    a = o.groupBy("o_custkey").agg(F.count("*").alias("c"), F.min("o_orderkey").alias("k"))
    b = D.best_by(o.withColumn("c", F.count("*").over(Window.partitionBy("o_custkey"))), ["o_custkey"], [F.asc("o_orderkey")])
    x, y = digest(a), digest(b.select("o_custkey", "c", F.col("o_orderkey").alias("k")))
    return x.crossJoin(y.select(F.col("n").alias("n2"), F.col("digest").alias("digest2"))).select("n", ((F.col("n") == F.col("n2")) & (F.col("digest") == F.col("digest2"))).alias("same"))


@query("""
WITH a AS (SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS blockers,
  (SELECT count(*) FROM (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1)) AS caveats)
SELECT blockers, caveats, CASE WHEN blockers > 0 THEN 'not ready' WHEN caveats > 0 THEN 'ready with caveats' ELSE 'ready' END AS verdict FROM a""")
def verdict(spark, d):
    from ..operators.audit import verdict as decide

    orphans = J.orphans(table(spark, d, "lineitem").select("l_orderkey"), table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    twice = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("h")).count().where("count > 1")
    return decide(orphans, twice)


