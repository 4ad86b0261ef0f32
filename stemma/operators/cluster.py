"""Clusters of candidates: issue rows of a game, games with their best row, excluded clusters, the rebuilt master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import joined, lenient_int, public_title, safe
from .dedupe import first_of, last_of, ordered_list, sorted_set


def flag_parts(c: Column) -> Column:
    """Flags as scorers read them: parted at semicolons, not trimmed, so only the first of several matches by itself."""
    return F.split(safe(c), ";")


def best_order(ordinal: str) -> list[Column]:
    """Of several rows of an issue the best: confidence, source, clean title, words, shortness, title; the first of equals."""
    kinds = R.kind_list(F.col("source_kinds"))
    has = lambda k, n: F.when(F.array_contains(kinds, k), n).otherwise(0)
    flags = flag_parts(F.col("title_cleanup_flags"))
    lacks = lambda f: F.when(F.array_contains(flags, f), 0).otherwise(1)
    title = F.col("representative_title")
    points = [R.confidence_rank(F.col("confidence")), has("vollversion-fullversion", 3) + has("disc-metadata-value", 2), lacks("split_compound_token") + lacks("stripped_version_suffix"), F.size(R.word_list(title)), -F.length(title), title]
    return [*[p.desc() for p in points], F.asc(ordinal)]


def display_key(ordinal: Column) -> list[Column]:
    """Smallest for the row whose title is shown: no version or disc words taken off, not parted, longest, first in order."""
    flags = flag_parts(F.col("title_cleanup_flags"))
    title = F.col("cleaned_title")
    return [*[F.array_contains(flags, f) for f in ("stripped_version_suffix", "stripped_disc_descriptor", "split_compound_token")], -F.length(title), title, ordinal]


def all_flags() -> Column:
    """Aggregate: every flag of the group, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter(F.transform(flag_parts(F.col("title_cleanup_flags")), lambda x: F.trim(x)), lambda x: x != "")))))


def merge_confidence(flags: Column, titles: Column, some_without_version: Column) -> Column:
    torn = F.array_contains(flags, "split_compound_token") | ((titles > 1) & some_without_version)
    return F.when(torn, "medium").otherwise("high")


def kinds_of(c: str) -> Column:
    """Aggregate: the kinds of the group's rows, sorted."""
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(R.kind_list(F.col(c)))))), "; ")


def sorted_values(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.when(safe(F.col(c)) != "", F.col(c)))), "; ")


def best_confidence(ordinal: Column) -> Column:
    return first_of(F.col("confidence"), -R.confidence_rank(F.col("confidence")), ordinal)


def issue_clusters(rows: DataFrame) -> DataFrame:
    """One row per issue and game: its best row's columns, with what its rows say together. Needs ordinal."""
    from .dedupe import best_by

    keys = ["issue_code", "game_id"]
    o = F.col("ordinal")
    g = rows.groupBy(*keys).agg(
        first_of(F.col("cleaned_title"), *display_key(o)).alias("__display"),
        all_flags().alias("__flags"),
        F.count_distinct("cleaned_title").alias("__titles"),
        F.max(~F.col("title_cleanup_flags").contains("stripped_version_suffix")).alias("__plain"),
        F.count("*").alias("occurrence_count_in_issue"),
        joined(ordered_list(F.col("source_title"), o)).alias("observed_title_variants"),
        joined(ordered_list(F.col("source_normalized_title"), o)).alias("source_normalized_variants"),
        kinds_of("source_kinds").alias("__kinds"),
        best_confidence(o).alias("__confidence"),
        joined(F.flatten(F.transform(ordered_list(F.col("title_cleanup_flags"), o), lambda x: F.split(x, ";")))).alias("__cleanup"),
        sorted_values("content_kind").alias("content_kinds_merged"),
        sorted_values("content_form").alias("content_forms_merged"),
    )
    best = best_by(rows, keys, best_order("ordinal"))
    out = best.join(g, keys)
    return out.withColumns(
        {
            "representative_title": F.col("__display"),
            "normalized_title": public_title(F.col("__display")),
            "source_kinds": F.col("__kinds"),
            "confidence": F.col("__confidence"),
            "title_cleanup_flags": F.col("__cleanup"),
            "merge_confidence": merge_confidence(F.col("__flags"), F.col("__titles"), F.col("__plain")),
            "cleanup_flags": F.array_join("__flags", "; "),
        }
    ).drop("__display", "__flags", "__titles", "__plain", "__kinds", "__confidence", "__cleanup")


def games(issues: DataFrame) -> DataFrame:
    """One row per game over its issue rows (which come in the order of issue_code)."""
    o = F.col("issue_code")
    when_ = [F.col("year"), F.col("issue_code"), F.col("archive_name")]
    # Of equal rows the first counts; issue_code parts the rows of a game, so no two are equal.
    out = issues.groupBy("game_id").agg(
        first_of(F.col("cleaned_title"), *display_key(o)).alias("representative_title"),
        all_flags().alias("__flags"),
        F.count_distinct("cleaned_title").alias("__titles"),
        F.max(~F.col("title_cleanup_flags").contains("stripped_version_suffix")).alias("__plain"),
        first_of(F.col("issue_code"), *when_).alias("first_seen_issue"),
        first_of(F.col("year"), *when_).alias("first_seen_year"),
        last_of(F.col("issue_code"), *when_).alias("last_seen_issue"),
        last_of(F.col("year"), *when_).alias("last_seen_year"),
        F.count("*").alias("issue_count"),
        F.sum("occurrence_count_in_issue").alias("occurrence_count"),
        best_confidence(o).alias("best_confidence"),
        kinds_of("source_kinds").alias("source_kinds"),
        F.count_distinct("source_title").alias("alias_count"),
        joined(sorted_set(F.col("source_title"))).alias("alias_titles"),
        joined(sorted_set(F.col("source_normalized_title"))).alias("legacy_normalized_titles"),
        sorted_values("content_kind").alias("observed_content_kinds"),
        sorted_values("content_form").alias("observed_content_forms"),
        F.max(F.when(F.col("content_class") == "expansion_or_addon", 2).when(F.col("content_class") == "mod_or_conversion", 1).otherwise(0)).alias("__class"),
    )
    return out.withColumns(
        {
            "normalized_title": public_title(F.col("representative_title")),
            "content_class": F.when(F.col("__class") == 2, "expansion_or_addon").when(F.col("__class") == 1, "mod_or_conversion").otherwise("game"),
            "cleanup_flags": F.array_join("__flags", "; "),
            "merge_confidence": merge_confidence(F.col("__flags"), F.col("__titles"), F.col("__plain")),
            "__first_year": lenient_int(F.col("first_seen_year")),
        }
    ).drop("__flags", "__titles", "__plain", "__class")


def excluded(rows: DataFrame) -> DataFrame:
    """One row per game that is not published: shown title, class of its first row, counts, names and kinds."""
    o = F.col("ordinal")
    return rows.groupBy("game_id").agg(
        first_of(F.col("cleaned_title"), *display_key(o)).alias("representative_title"),
        first_of(F.col("content_class"), o).alias("content_class"),
        F.count_distinct("issue_code").alias("issue_count"),
        F.count("*").alias("occurrence_count"),
        joined(sorted_set(F.col("source_title"))).alias("alias_titles"),
        kinds_of("source_kinds").alias("source_kinds"),
    )


def rebuilt_master(rows: DataFrame) -> DataFrame:
    """One row per normalized title: its first issue and, of the rows with the best confidence, the first title."""
    o = F.col("ordinal")
    best = [-R.confidence_rank(F.col("confidence")), o]
    kinds = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(R.kind_list(F.col("source_kinds")))))), ",")
    return rows.groupBy("normalized_title").agg(
        first_of(F.col("representative_title"), *best).alias("representative_title"),
        first_of(F.col("issue_code"), o).alias("first_seen_issue"),
        F.count_distinct("archive_name").alias("issue_count"),
        F.count("*").alias("occurrence_count"),
        first_of(F.col("confidence"), *best).alias("best_confidence"),
        kinds.alias("source_kinds"),
    )
