"""Raw extraction over ingested tables: strategies as tables of one candidate schema, staged until each issue has enough,
and the exported catalogues. Downloads, mounts and unpacking are ingest jobs; a manifest or text table is their result."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules as R
from ..operators import dedupe as D
from ..operators import joins as J
from ..session import materialised

STRUCTURED = ["vollversion-fullversion", "vollversion-description", "archiveorg-ocr", "archiveorg-description", "archiveorg-subject", "disc-metadata-value", "disc-metadata-command"]


def pending(records: DataFrame, state: DataFrame, unresolved: DataFrame, retry_open: bool = True) -> DataFrame:
    """Records that need a run: no terminal status yet, or unresolved ones where these are to be tried again."""
    s = records.join(state.select("archive_name", "status"), "archive_name", "left").join(unresolved.select("archive_name", F.lit(True).alias("open")), "archive_name", "left")
    done = F.coalesce(F.col("status").isin(V.TERMINAL_STATUSES), F.lit(False))
    return s.where(~done | (F.coalesce("open", F.lit(False)) & F.lit(retry_open))).drop("status", "open")


def enough(found: DataFrame, key: str = "archive_name") -> DataFrame:
    """Per archive whether its candidates suffice."""
    g = found.groupBy(key).agg(F.count_distinct("normalized_title").alias("titles"), F.max(F.col("source_kind").isin(STRUCTURED)).alias("structured"), F.max(F.col("source_kind") == "vollversion-fullversion").alias("full"))
    return g.withColumn("enough", F.col("full") | (F.col("titles") >= 4) | ((F.col("titles") >= 2) & F.col("structured")))


def cheap_enough(found: DataFrame, key: str = "archive_name") -> DataFrame:
    """Per archive over results of strategies (strategy, structured, normalized_title): whether the cheap ones suffice."""
    t = found.groupBy(key, "normalized_title").agg(F.count_distinct("strategy").alias("n"), F.max("structured").alias("structured"), F.max((F.col("strategy") == "vollversion") & F.col("structured")).alias("page"))
    g = t.groupBy(key).agg(F.count("*").alias("titles"), F.count_if(F.col("n") >= 2).alias("agreed"), F.max("structured").alias("structured"), F.max("page").alias("page"))
    why = F.when(F.col("page"), "vollversion structured issue page").when((F.col("titles") >= 3) & F.col("structured"), "structured external list").when((F.col("titles") >= 3) & (F.col("agreed") >= 2), "multiple cheap strategies agree").otherwise("cheap sources incomplete")
    return g.withColumn("reason", why).withColumn("enough", F.col("reason") != "cheap sources incomplete")


#: Ways to resolve an issue.
MODES = ["auto", "disc-only", "external-only"]


def candidates_of(found: DataFrame, archive: str) -> DataFrame:
    """The good candidates of one archive, in order."""
    return exported(found).where(F.col("archive_name") == archive).orderBy("normalized_title", "source_kind", "source_path")


def resolved(records: DataFrame, cheap: DataFrame, quick: DataFrame, full: DataFrame, mode: str = "auto", force: bool = False, validate: bool = False, status: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates, resolutions). cheap: candidates of the external strategies (with strategy and structured); quick and
    full: those of the two scans of a disc. A record's scans count only as far as its way goes: none where the cheap sources
    suffice (unless force or validate), the full one where the quick one leaves too little (or with disc-only or
    validate). What is found so far, cheap candidates included, is judged together. status (archive_name, status, error):
    scans that failed. A resolution has the path of its steps, a reason, unresolved and status."""
    if mode not in MODES:
        raise ValueError(f"{mode} is none of {MODES}")
    ids = records.select("archive_name").distinct()
    cheap = cheap.join(ids, "archive_name", "left_semi") if mode != "disc-only" else cheap.where(F.lit(False))
    kept = [c for c in quick.columns if c in cheap.columns]
    said = cheap_enough(cheap).select("archive_name", F.col("reason").alias("cheap_reason"), F.col("enough").alias("cheap_enough"))
    steps = cheap.groupBy("archive_name").agg(F.array_sort(F.collect_set("strategy")).alias("steps"))
    way = ids.join(said, "archive_name", "left").join(steps, "archive_name", "left").withColumns({"cheap_enough": F.coalesce("cheap_enough", F.lit(False)), "steps": F.coalesce("steps", F.array().cast("array<string>"))})
    disc = F.lit(False) if mode == "external-only" else F.lit(mode == "disc-only" or force or validate) | ~F.col("cheap_enough")
    way = way.withColumn("disc", disc)
    q = quick.join(way.where("disc").select("archive_name"), "archive_name", "left_semi")
    so_far = cheap.select(kept).unionByName(q.select(kept))
    way = way.join(enough(so_far).select("archive_name", F.col("enough").alias("quick_enough")), "archive_name", "left")
    way = way.withColumn("full", F.col("disc") & (F.lit(mode == "disc-only" or validate) | ~F.coalesce("quick_enough", F.lit(False))))
    f = full.join(way.where("full").select("archive_name"), "archive_name", "left_semi")
    found = so_far.unionByName(f.select(kept))
    way = way.join(enough(found).select("archive_name", F.col("enough").alias("found_enough")), "archive_name", "left")
    if status is not None:
        way = way.join(status.select("archive_name", F.col("status").alias("disc_status"), F.col("error").alias("disc_error")), "archive_name", "left")
    else:
        way = way.withColumns({"disc_status": F.lit(None).cast("string"), "disc_error": F.lit(None).cast("string")})
    failed = F.col("disc") & F.coalesce(F.col("disc_status") != "ok", F.lit(False))
    open_ = F.when(F.lit(mode == "external-only"), ~F.col("cheap_enough")).otherwise(F.when(F.col("disc"), ~F.coalesce("found_enough", F.lit(False))).otherwise(F.lit(False)))
    path = F.concat("steps", F.when(F.col("disc"), F.array(F.lit("disc-quick"))).otherwise(F.array().cast("array<string>")), F.when(F.col("full"), F.array(F.lit("disc-full"))).otherwise(F.array().cast("array<string>")))
    none = F.when(F.col("disc"), "none").otherwise("external")
    reason = F.coalesce(F.when(failed, F.col("disc_error")), F.col("cheap_reason"), F.when(F.lit(mode == "external-only"), "cheap sources incomplete"), F.when(F.col("unresolved"), "insufficient titles after resolution path"), F.lit("disc used"))
    out = way.withColumn("unresolved", open_).select(
        "archive_name", F.lit(mode).alias("title_strategy"), F.when(F.size(path) > 0, F.array_join(path, ">")).otherwise(none).alias("resolution_path"), reason.alias("reason"), "unresolved", F.when(failed, F.col("disc_status")).otherwise("ok").alias("status"),
    )
    return found, out


def run_strategies(records: DataFrame, strategies: dict, clock=time.monotonic) -> tuple[DataFrame | None, DataFrame]:
    """(candidates, runs) of strategies: name -> function from records to candidates (with structured). Each is run and kept;
    one that fails gives a run with its error and no candidates, and the others go on. runs: strategy, archive_name,
    candidates, titles, structured, elapsed_ms, error; a record without candidates has a run all the same."""
    spark, found, runs = records.sparkSession, None, None
    for name, strategy in strategies.items():
        began, error, got = clock(), None, None
        try:
            got = materialised(strategy(records).withColumn("strategy", F.lit(name)))
        except Exception as e:  # a strategy's failure is a result like any other
            error = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}".strip()
        took = int(1000 * (clock() - began))
        if got is not None:
            found = got if found is None else found.unionByName(got)
            g = got.groupBy("archive_name").agg(F.count("*").alias("candidates"), F.count_distinct("normalized_title").alias("titles"), F.max("structured").alias("structured"))
        else:
            g = spark.createDataFrame([], "archive_name string, candidates bigint, titles bigint, structured boolean")
        run = records.select("archive_name").distinct().join(g, "archive_name", "left").na.fill(0, ["candidates", "titles"]).na.fill(False, ["structured"])
        run = run.select(F.lit(name).alias("strategy"), "archive_name", "candidates", "titles", "structured", F.lit(took).alias("elapsed_ms"), F.lit(error).cast("string").alias("error"))
        runs = run if runs is None else runs.unionByName(run)
    return found, runs


def merged(found: DataFrame) -> DataFrame:
    """Different (title, kind, path) of an archive, with place: their order within it by title, kind, confidence and path."""
    one = D.distinct_first(found, ["archive_name", "normalized_title", "source_kind", "source_path"], [-R.confidence_rank(F.col("confidence")), F.asc("candidate_title")])
    order = [F.asc("normalized_title"), F.desc(R.source_rank(F.col("source_kind"))), F.desc(R.confidence_rank(F.col("confidence"))), F.asc("source_path"), F.asc("source_kind")]
    return one.withColumn("place", F.row_number().over(Window.partitionBy("archive_name").orderBy(*order)))


def issue_titles(found: DataFrame, records: DataFrame) -> DataFrame:
    """One row per archive and title: the best candidate (confidence, then the first), all kinds, the kind of content told
    from its path, title and source."""
    order = [F.desc(R.confidence_rank(F.col("confidence"))), F.asc("source_kind"), F.asc("source_path"), F.asc("candidate_title")]
    best = D.best_by(found, ["archive_name", "normalized_title"], order)
    kinds = found.groupBy("archive_name", "normalized_title").agg(F.array_join(D.sorted_set(F.col("source_kind")), ",").alias("source_kinds"))
    content = R.content_kind(F.concat_ws(" ", "source_path", "candidate_title", "source_kind"))
    out = best.withColumn("content_kind", content).join(kinds, ["archive_name", "normalized_title"]).join(records, "archive_name")
    return out.withColumn("representative_title", F.col("candidate_title")).select("archive_item", "archive_name", "issue_code", F.col("year").cast("string").alias("year"), "variant", "normalized_title", "representative_title", "source_kinds", "confidence", "content_kind")


def executables(inventory: DataFrame) -> DataFrame:
    """One row per digest: the first place it was seen and how often."""
    o = [F.col(c) for c in ("year", "archive_name", "inner_container", "exe_path")]
    return inventory.where("status = 'ok'").groupBy("sha1").agg(D.first_of(F.col("exe_name"), *o).alias("exe_name"), D.first_of(F.col("archive_name"), *o).alias("first_archive"), F.count("*").alias("occurrence_count"), F.count_distinct("archive_name").alias("archive_count"))


def titles(found: DataFrame, records: DataFrame) -> DataFrame:
    """One row per normalized title over all archives: the first candidate and issue, how often and in how many archives."""
    f = found.where("normalized_title is not null and normalized_title <> ''").join(records.select("archive_name", "issue_code", "year"), "archive_name")
    o = [F.col(c) for c in ("year", "archive_name", "source_path", "source_kind", "candidate_title")]
    return f.groupBy("normalized_title").agg(D.first_of(F.col("candidate_title"), *o).alias("representative_title"), D.first_of(F.col("issue_code"), *o).alias("first_issue"), F.count("*").alias("occurrence_count"), F.count_distinct("archive_name").alias("archive_count"))


def exported(titles: DataFrame) -> DataFrame:
    """Rows of candidates that are exported: good ones with a title."""
    return titles.where("status = 'ok' and normalized_title is not null")


def open_issues(resolution: DataFrame) -> DataFrame:
    """Issues that are exported as unresolved."""
    return resolution.where("unresolved or status <> 'ok'")


def progress(archives: DataFrame, titles: DataFrame) -> DataFrame:
    """One row: archives done, titles found, the last archive in work, the last one done and when."""
    a = archives.agg(
        F.count_if(F.col("status") == "ok").alias("done"),
        F.max(F.when(F.col("status") == "started", F.col("archive_name"))).alias("in_work"),
        F.max(F.when(F.col("status") == "ok", F.struct("finished_at", "archive_name"))).alias("last"),
    )
    return a.crossJoin(F.broadcast(titles.agg(F.count("*").alias("titles")))).select("done", "titles", "in_work", F.col("last.archive_name").alias("last_done"), F.col("last.finished_at").alias("finished_at"))


#: A strategy's result as it is cached.
RESULT = "strategy string, candidates array<struct<source_kind string, source_path string, candidate_title string, normalized_title string, confidence string, content_kind string>>, structured boolean, elapsed_ms int, error string, notes string"


def serialized(results: DataFrame, key: str) -> DataFrame:
    """(key, strategy, payload): results (the columns of RESULT) as JSON."""
    return results.select(key, "strategy", F.to_json(F.struct("strategy", "candidates", "structured", "elapsed_ms", "error", "notes"), {"ignoreNullFields": "false"}).alias("payload"))


def deserialized(cached: DataFrame, key: str) -> DataFrame:
    return cached.select(key, F.from_json("payload", RESULT).alias("r")).select(key, "r.*")


def cached(keys: DataFrame, cache: DataFrame, fetched: DataFrame, keep_errors: bool = True) -> tuple[DataFrame, DataFrame]:
    """(what is known for each key, what to fetch): a cached error counts as known, so a failure isn't fetched again, unless
    errors are not kept."""
    cache = cache if keep_errors else cache.where("error is null")
    know = J.insert_absent(cache, fetched, ["cache_key"], [F.asc("payload"), F.asc("error")])
    return keys.join(know, "cache_key", "left"), keys.join(cache, "cache_key", "left_anti")


def failures(rows: DataFrame, status: Column, error: Column) -> DataFrame:
    """Failed units as data rows beside the good ones."""
    return rows.withColumn("status", status).withColumn("error", error)
