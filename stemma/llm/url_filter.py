"""URL filters: each url is expanded into host suffixes and path prefixes, the expressions are equi-joined with the rules
on the first 32 bits of their digests, and the full digest and the rules' precedence decide. DataFrame operations only.

Defined cases: a null url, or one without "://", has an empty host and path and fits no rule; a url without a rule gets
the default verdict; the longest fitting rule (host and path together) wins, then the longer host, then block before
allow; of repeated pages each is judged; rules with a null host or verdict are dropped, a null path means "/"; an empty
rule table leaves the default to all; an empty table of pages gives no rows; urls are judged whole at any length. Extra
columns of either table are ignored.

The expansion makes, for a url, at most (most labels of a rule's host) x (distinct lengths of the rules' paths)
expressions, and neither bound drops anything: longer ones can't equal a rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, pick, table

#: The contract's rules (fixed values).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Below so many bytes of rules the rule side is broadcast; above, both sides are shuffled on the hash prefix.
BROADCAST_RULES = 100_000
SALTS = 32


def rest(url: Column) -> Column:
    """What follows the first "://"; null without it."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([(h, p, v) for h, p, v in rules], "host string, path string, verdict string")


def compiled(rules: DataFrame) -> DataFrame:
    """One row for each host and path: its digest, 32-bit prefix, text and verdict (block if both are given)."""
    r = pick(rules, host="string", path="string", verdict="string").where("host is not null and host <> '' and verdict is not null")
    r = r.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("/")).alias("path"), "verdict")
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # "block" sorts after "allow"
    full = digest(F.col("host"), F.col("path"))
    return r.select("host", "path", "verdict", full.alias("full"), F.substring(full, 1, 8).alias("prefix"), F.concat("host", "path").alias("rule"))


def verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages."""
    spark = pages.sparkSession
    r = compiled(rules)
    bounds = r.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.sort_array(F.collect_set(F.length("path"))).alias("lengths"), F.count("*").alias("n")).first()
    labels, lengths = bounds.labels or 0, list(bounds.lengths or [])
    p = pick(pages, page_id="bigint", url="string")
    p = p.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not labels:
        return p.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    def expressions(parts: Column) -> Column:
        """Structs (prefix, full) of every host suffix of up to `labels` labels with every path prefix of a rule's length,
        and an empty one that stands for the default, so that each url keeps a row."""
        suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
        fits = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path"))
        digests = F.flatten(F.transform(suffixes, lambda h: F.transform(fits, lambda n: digest(h, F.substring(F.col("path"), F.lit(1), n)))))
        return F.transform(F.array_union(digests, F.array(F.lit(""))), lambda d: F.struct(F.substring(d, 1, 8).alias("prefix"), d.alias("full")))

    # Repeated pages of a partition are counted, not told apart; the partition's number keeps such groups as small as a partition.
    urls = p.select(F.spark_partition_id().alias("part"), "page_id", "host", "path", F.explode(let(F.split("host", r"\."), expressions)).alias("e"))
    wide = urls.select("part", "page_id", "host", "path", "e.prefix", F.col("e.full").alias("url_full"))
    side = r.select("prefix", "full", "rule", "verdict", F.length("rule").alias("rule_length"), F.length("host").alias("host_length"))
    none = F.lit(None).cast("string")
    side = side.union(spark.range(1).select(F.lit("").alias("prefix"), F.lit("").alias("full"), none, F.lit(default), F.lit(-1), F.lit(-1)))
    if bounds.n * 400 <= BROADCAST_RULES:
        hit = wide.join(F.broadcast(side), "prefix")
    else:  # a suffix such as "com/" may be in most urls: its rows are spread over salts, the rules repeated for each
        side = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hit = wide.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")).join(side, ["prefix", "salt"])
    best = F.max_by(F.struct("rule", "verdict"), F.struct("rule_length", "host_length", F.col("verdict").alias("last")))
    one = hit.where("url_full = full").groupBy("part", "page_id", "host", "path").agg(best.alias("best"), F.count_if(F.col("full") == "").alias("n"))
    return one.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).drop("copy")


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "pages"), rule_table(spark))


#: The same from scratch: every rule against every url, the longest fitting one wins.
OP3_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(h, q, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT page_id, h || q AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC) AS k
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.k = 1
"""
