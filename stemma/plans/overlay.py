"""A retry snapshot laid over a base snapshot: contract checks, merged tables, the per-archive and title deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cluster as G
from ..operators import joins as J
from ..sources.csvio import check_header
from . import schemas as S
from .publish import ORDER, ordered


class ContractError(ValueError):
    pass


def archives(*tables: DataFrame) -> DataFrame:
    out = None
    for t in tables:
        a = t.select("archive_name").where("archive_name <> ''")
        out = a if out is None else out.union(a)
    return out.distinct()


def still_open(tried: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Archives that were tried and are unresolved all the same."""
    return tried.select("archive_name").intersect(archives(unresolved))


def merge(base: dict[str, DataFrame], retry: dict[str, DataFrame], queue: DataFrame, candidates: DataFrame | None = None) -> dict[str, DataFrame]:
    """base and retry: issue_titles, master_games, unresolved_issues; queue: the archives that were to be retried."""
    for side, t in (("base", base), ("retry", retry)):
        for name, columns in (("issue_titles", S.ISSUE_TITLES), ("master_games", S.MASTER_GAMES), ("unresolved_issues", S.UNRESOLVED)):
            check_header(t[name].columns, columns, f"{side}/{name}")
    tried = archives(retry["issue_titles"], retry["unresolved_issues"], *([candidates] if candidates is not None else []))
    stray = J.orphans(tried, archives(queue), "archive_name").limit(5).collect()
    if stray:
        raise ContractError(f"archives outside the queue: {[r[0] for r in stray]}")
    issues = J.overlay(base["issue_titles"], retry["issue_titles"], "archive_name", tried).select(S.ISSUE_TITLES)
    open_ = J.overlay(base["unresolved_issues"], retry["unresolved_issues"], "archive_name", tried).select(S.UNRESOLVED)
    master = G.rebuilt_master(ordered(issues, ORDER)).select(S.MASTER_GAMES)
    count = lambda t, n: t.groupBy("archive_name").agg(F.count("*").alias(n))
    flag = lambda t, n: t.select("archive_name").withColumn(n, F.lit(True))
    report = tried
    for t, n in ((base["issue_titles"], "base_rows"), (retry["issue_titles"], "retry_rows"), (issues, "merged_rows")):
        report = report.join(count(t, n), "archive_name", "left")
    for t, n in ((archives(base["unresolved_issues"]), "open_before"), (archives(open_), "open_after"), (still_open(tried, retry["unresolved_issues"]), "still_open")):
        report = report.join(flag(t, n), "archive_name", "left")
    return {
        "issue_titles": issues,
        "master_games": master,
        "unresolved_issues": open_,
        "archives": report.na.fill(0, ["base_rows", "retry_rows", "merged_rows"]).na.fill(False, ["open_before", "open_after", "still_open"]),
        "titles": J.changes(base["master_games"], master, "normalized_title"),
    }
