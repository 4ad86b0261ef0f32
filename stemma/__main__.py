"""The plans from the command line: python -m stemma publish | enrich | merge | audit, tables as CSV files in folders.
Folders may be on any file system that Spark reads. Run by spark-submit on a cluster, or as it is in local mode."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.fixed_values import MATCH_FIELDS
from .functions.text import safe
from .plans import enrich, overlay, publish, release
from .plans import schemas as S
from .plans.export import export, text
from .session import session
from .sources import csvio
from .sources.snapshots import latest_folder

RAW = ("issue_titles", "master_games", "unresolved_issues")
PUBLISHED = ("final_issue_titles", "dropped_candidates", "publishable_issue_titles", "publishable_master_games")


def tables(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    """The named tables of a folder; their headers must be the declared ones."""
    return {n: csvio.read(spark, f"{folder}/{n}.csv", S.EXPORTS[n][0]) for n in names}


def baseline(spark: SparkSession, path: str | None) -> DataFrame:
    """Known matches by normalized title; none without a path."""
    if path is None:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in ["normalized_title", *MATCH_FIELDS]))
    return csvio.read(spark, path)


def optional(spark: SparkSession, path: str | None, columns: list[str]) -> DataFrame:
    return csvio.read_optional(spark, path or "/nowhere.csv", columns)


def run_publish(spark: SparkSession, a) -> dict[str, DataFrame]:
    folder = a.input_dir or latest_folder(spark, a.results, needs=tuple(f"{n}.csv" for n in RAW))
    raw = tables(spark, folder, ("issue_titles", "unresolved_issues"))
    out = publish.publish(raw["issue_titles"], baseline(spark, a.baseline_enriched_master), optional(spark, a.manual_content_overrides, S.OVERRIDES), optional(spark, a.manual_rejections, S.REJECTIONS))
    unresolved = publish.unresolved(raw["unresolved_issues"])
    text(spark, f"{a.output_dir}/unresolved_summary.md", release.cause_report(unresolved))
    return out | {"final_unresolved_issues": unresolved}


def run_enrich(spark: SparkSession, a) -> dict[str, DataFrame]:
    status = "unmatched" if a.only_unmatched else "ambiguous" if a.only_ambiguous else None
    issues, master = csvio.read(spark, a.input_issues, S.PUBLISHED_ISSUES), csvio.read(spark, a.input_master, S.PUBLISHED_MASTER)
    out = enrich.enrich(issues, master, baseline(spark, a.baseline_enriched_master), optional(spark, a.manual_rejections, S.REJECTIONS), status, a.limit)
    text(spark, f"{a.output_dir}/enrichment_audit.md", release.markdown("Enrichment Audit", enrich.audit(out).first().asDict()))
    return out


def run_merge(spark: SparkSession, a) -> dict[str, DataFrame]:
    queue = csvio.read(spark, a.base_published_unresolved)
    out = overlay.merge(tables(spark, a.base_dir, RAW), tables(spark, a.retry_dir, RAW), queue)
    numbers = release.counts({n: out[n] for n in RAW}) | {f"titles {r.change}": r["count"] for r in out["titles"].groupBy("change").count().orderBy("change").collect()}
    text(spark, a.comparison_report or f"{a.output_dir}/comparison.md", release.markdown("Merge", numbers))
    return out


def run_audit(spark: SparkSession, a) -> dict[str, DataFrame]:
    raw, published = tables(spark, a.raw_dir, RAW), tables(spark, a.published_dir, PUBLISHED)
    again = publish.publish(raw["issue_titles"], baseline(spark, a.baseline_enriched_master), optional(spark, a.manual_content_overrides, S.OVERRIDES), optional(spark, a.manual_rejections, S.REJECTIONS)) if a.rerun else {}
    # As the files hold them: all text, nothing missing.
    again = {n: t.select([safe(F.col(c)).alias(c) for c in S.EXPORTS[n][0]]) for n, t in again.items() if n in published}
    enriched = tables(spark, a.enriched_dir, ("enriched_master_games",)) if a.enriched_dir else None
    report, looked = release.audited(raw, published, again, enriched)
    text(spark, a.report_path or f"{a.output_dir}/release_audit.md", report)
    return {"sample": looked}


def arguments(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="stemma", description=__doc__)
    sub = p.add_subparsers(dest="plan", required=True)

    def plan(name: str, run, say: str):
        s = sub.add_parser(name, help=say)
        s.set_defaults(run=run)
        s.add_argument("--output-dir", required=True)
        s.add_argument("--single-files", action="store_true", help="one CSV file a table, for small releases")
        return s

    s = plan("publish", run_publish, "raw snapshot to published tables")
    s.add_argument("--input-dir", help="raw snapshot; without it the latest dated folder below --results")
    s.add_argument("--results", default="results")
    for x in ("--baseline-enriched-master", "--manual-content-overrides", "--manual-rejections"):
        s.add_argument(x)
    s = plan("enrich", run_enrich, "published tables to an enriched release")
    for x in ("--input-master", "--input-issues"):
        s.add_argument(x, required=True)
    for x in ("--baseline-enriched-master", "--manual-rejections"):
        s.add_argument(x)
    s.add_argument("--limit", type=int)
    s.add_argument("--only-unmatched", action="store_true")
    s.add_argument("--only-ambiguous", action="store_true")
    s = plan("merge", run_merge, "a retry snapshot over a base snapshot")
    for x in ("--base-dir", "--retry-dir", "--base-published-unresolved"):
        s.add_argument(x, required=True)
    s.add_argument("--comparison-report")
    s = plan("audit", run_audit, "report, sample and verdict of a release")
    for x in ("--raw-dir", "--published-dir"):
        s.add_argument(x, required=True)
    for x in ("--enriched-dir", "--report-path", "--baseline-enriched-master", "--manual-content-overrides", "--manual-rejections"):
        s.add_argument(x)
    s.add_argument("--rerun", action="store_true", help="publish again and compare")
    return p.parse_args(argv)


def main(argv=None) -> list[str]:
    a = arguments(argv)
    spark = session()
    return export(a.run(spark, a), a.output_dir, a.single_files)


if __name__ == "__main__":
    main()
