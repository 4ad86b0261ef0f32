"""The audit of a release: counts, literals, known noise, near variants, a sample to look at, repeatability, the verdict;
and the Markdown reports, each rendered from one aggregated row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules as R
from ..functions.text import lenient_int
from ..operators import audit as A
from ..operators import sampling as P
from ..operators.dedupe import distinct_first


#: Issues that are always looked at (fixed values), and the first year that counts as late.
NAMED_ISSUES = ["CBS122004DVD", "CBS012005DVD", "CBS122008DVD", "CBS122008DVDGold"]
LATE = "2007"


def sample(master: DataFrame, issues: DataFrame, top: int = 100, extra: int = 100, seed: int = 1, named: list[str] | None = None) -> DataFrame:
    """Rows to look at, classified: the most frequent games, others by a seeded digest, and all rows of the named issues and
    of one late issue, chosen by a seeded digest too."""
    m = master.withColumns({"n": lenient_int(F.col("issue_count")), "k": lenient_int(F.col("occurrence_count"))})
    low = F.lower(F.replace("representative_title", F.lit("ß"), F.lit("ss")))
    first = P.top(m, [F.desc("n"), F.desc("k"), low.asc(), F.asc("normalized_title")], top)
    rest = m.join(first.select("normalized_title"), "normalized_title", "left_anti")
    more = P.top(rest.withColumn("__h", P.seeded(seed, F.col("normalized_title"))), [F.asc("__h"), F.asc("normalized_title")], extra).drop("__h")
    columns = ["issue_code", "archive_name", "normalized_title", "representative_title", "issue_count", "source_kinds"]
    of_master = lambda t, bucket: t.select(F.lit(bucket).alias("sample_bucket"), F.lit("master").alias("row_kind"), F.col("first_seen_issue").alias("issue_code"), F.lit("").alias("archive_name"), *columns[2:])
    late = issues.where(F.col("year") >= LATE).agg(F.min_by("issue_code", F.struct(P.seeded(seed, F.col("issue_code")), "issue_code")).alias("late"))  # one row
    names = NAMED_ISSUES if named is None else named
    looked = issues.join(F.broadcast(late), F.col("issue_code").isin(names) | (F.col("issue_code") == F.col("late")))
    bucket = F.concat(F.when(F.col("issue_code") == F.col("late"), f"late-year-seed-{seed}:").otherwise("noisy-issue:"), "issue_code")
    of_issues = looked.select(bucket.alias("sample_bucket"), F.lit("issue").alias("row_kind"), "issue_code", "archive_name", "normalized_title", "representative_title", F.lit("").alias("issue_count"), "source_kinds")
    of_issues = distinct_first(of_issues, ["archive_name", "normalized_title"], [F.asc("issue_code"), F.asc("representative_title"), F.asc("source_kinds")])
    rows = of_master(first, f"top-{top}-by-issue-count").unionByName(of_master(more, f"random-{extra}-seed-{seed}")).unionByName(of_issues)
    return rows.withColumn("c", R.sample_class(F.col("representative_title"))).select("sample_bucket", "row_kind", *columns, "c.classification", "c.reason")


def histogram(sample: DataFrame) -> DataFrame:
    """How many rows of a sample are of each class, by bucket and in all (bucket null)."""
    return sample.groupingSets([["sample_bucket", "classification"], ["classification"]], "sample_bucket", "classification").agg(F.count("*").alias("n"))


def text_findings(files: DataFrame) -> DataFrame:
    """(path, finding, what) over tracked texts (path, text): personal literals, known noise, signs of wrong decoding."""
    personal = A.literal_hits(files, "path", F.col("text"), V.PERSONAL_LITERALS).select("path", F.lit("literal").alias("finding"), F.col("literal").alias("what"))
    noise = A.literal_hits(files, "path", F.lower("text"), V.KNOWN_NOISE).select("path", F.lit("noise").alias("finding"), F.col("literal").alias("what"))
    bad = A.mojibake(files, "path", "text").where("n > 0").select("path", F.lit("mojibake").alias("finding"), F.col("n").cast("string").alias("what"))
    return personal.unionByName(noise).unionByName(bad)


def readme_rows(readme: DataFrame, heading: str = "## Full Table") -> DataFrame:
    """(place, a, b, c) of the three-column table under a heading (column text, one row)."""
    tail = F.when(F.col("text").contains(heading), F.element_at(F.split("text", heading, 2), 2)).otherwise("")
    r = readme.select(F.posexplode(F.split(tail, "\n")).alias("place", "line")).where("line like '| %' and line not like '| Title |%' and line not like '| --- |%'")
    p = F.transform(F.split(F.btrim(F.trim("line"), F.lit("|")), r"\|"), lambda x: F.trim(x))
    return r.withColumn("p", p).where(F.size("p") == 3).select("place", *[F.get("p", i).alias(n) for i, n in enumerate("abc")])


def readme_counts(readme: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """One row of numbers that a text states, null where it doesn't."""
    return readme.select(*[F.regexp_extract("text", p, 1).try_cast("bigint").alias(n) for n, p in patterns.items()])


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, repeats included."""
    return A.digest(a).first() == A.digest(b.toDF(*a.columns)).first()


def tracked_difference(tracked: DataFrame, expected: DataFrame, optional: DataFrame) -> DataFrame:
    """(path, problem) for files that are missing or that nobody expects."""
    missing = expected.join(tracked, "path", "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(tracked.join(expected.union(optional), "path", "left_anti").withColumn("problem", F.lit("unexpected")))


def verdict(blockers: dict[str, DataFrame], caveats: dict[str, DataFrame]) -> tuple[str, list[str], list[str]]:
    """The verdict with the names of what stands against the release and what should be known; a non-empty table counts."""
    against = [n for n, t in blockers.items() if not t.isEmpty()]
    known = [n for n, t in caveats.items() if not t.isEmpty()]
    return ("not ready" if against else "ready with caveats" if known else "ready"), against, known


def counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    return {n: t.count() for n, t in tables.items()}


def markdown(title: str, numbers: dict, notes: list[str] = ()) -> str:
    return "\n".join([f"# {title}", "", *[f"- {k}: {v}" for k, v in numbers.items()], *(["", *notes] if notes else [])]) + "\n"


def cause_report(unresolved: DataFrame) -> str:
    rows = unresolved.groupBy("root_cause").count().orderBy("root_cause").collect()
    return markdown("Unresolved Summary", {"unresolved issues": sum(r["count"] for r in rows)} | {f"`{r.root_cause}`": r["count"] for r in rows})


def attribution(spark) -> DataFrame:
    rows = [("published release", "derived-csv", "observed titles, clusters, audit columns"), ("reference baseline", "derived-csv", "canonical entity, release year, categories, genres, ratings")]
    return spark.createDataFrame(rows, "source_name string, source_type string, fields_used string")


def audited(raw: dict[str, DataFrame], published: dict[str, DataFrame], again: dict[str, DataFrame] | None = None, enriched: dict[str, DataFrame] | None = None) -> tuple[str, DataFrame]:
    """(report, sample) of a release: row counts, the sample and its classes, near variants, whether a second run (again)
    gave the same tables, whether cleaned and dropped rows add up, and the verdict."""
    issues, master = published["publishable_issue_titles"], published["publishable_master_games"]
    looked = sample(master, issues)
    classes = {(r.sample_bucket, r.classification): r.n for r in histogram(looked).collect()}  # a few classes by a few buckets
    near = A.near_variants(master, "representative_title")
    n = counts(raw) | counts(published) | (counts(enriched) if enriched else {})
    stray = issues.join(master, "game_id", "left_anti")
    moved = [name for name, t in (again or {}).items() if not same_rows(published[name], t)]
    differ = master.sparkSession.createDataFrame([(x,) for x in moved], "name string")
    lost = raw["issue_titles"].sparkSession.range(abs(n["issue_titles"] - n.get("final_issue_titles", 0) - n.get("dropped_candidates", 0)))
    said, against, known = verdict({"issue rows without a game": stray, "tables that differ between two runs": differ, "raw rows neither cleaned nor dropped": lost}, {"near variants": near, "titles to look at": looked.where("classification <> 'keep'"), "unresolved issues": raw["unresolved_issues"]})
    numbers = {f"`{k}` rows": v for k, v in n.items()} | {f"sample `{k[1]}`": v for k, v in sorted(classes.items(), key=str) if k[0] is None}
    notes = [f"Verdict: {said}.", *[f"* blocker: {x}" for x in against], *[f"* caveat: {x}" for x in known]]
    return markdown("Release Audit", numbers, notes), looked
