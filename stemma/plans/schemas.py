"""Declared columns of the tables at the edges (fixed values: their names and order), all text."""

from __future__ import annotations

from ..functions.fixed_values import MATCH_FIELDS

ISSUE_TITLES = "archive_item archive_name issue_code year variant normalized_title representative_title source_kinds confidence content_kind".split()
MASTER_GAMES = "normalized_title representative_title first_seen_issue issue_count occurrence_count best_confidence source_kinds".split()
UNRESOLVED = "archive_item archive_name issue_code year variant title_strategy resolution_path reason status".split()
FINAL_ISSUES = [*ISSUE_TITLES, "clean_reason"]
FINAL_UNRESOLVED = [*UNRESOLVED, "root_cause", "retry_recommended", "suggestion"]
DROPPED = "archive_name issue_code normalized_title representative_title source_kinds confidence drop_reason".split()
EXCLUDED = "game_id representative_title content_class issue_count occurrence_count alias_titles source_kinds".split()
OVERRIDES = "game_id representative_title content_class publishable reason".split()
REJECTIONS = "normalized_title rejected_candidate source reason".split()
#: Columns of a match that master and issue rows carry.
PUSHED = "match_status match_confidence canonical_title canonical_slug entity_type release_year wikipedia_url wikidata_id wikidata_url categories genres themes match_action match_notes data_quality_score".split()
PUBLISHED_ISSUES = [*FINAL_ISSUES, *"game_id source_title cleaned_title source_normalized_title observed_title_variants source_normalized_variants occurrence_count_in_issue title_cleanup_flags content_class content_form content_kinds_merged content_forms_merged cleanup_flags merge_confidence".split(), *PUSHED]
PUBLISHED_MASTER = [*MASTER_GAMES, *"game_id first_seen_year last_seen_issue last_seen_year alias_count alias_titles legacy_normalized_titles observed_content_kinds observed_content_forms content_class cleanup_flags merge_confidence rating_value rating_scale rating_count rating_source rating_url metadata_sources".split(), *PUSHED]
#: Match columns that enrichment writes over a published master row, and those that no source fills yet.
ENRICHED = [f for f in MATCH_FIELDS if f != "notes"]
UNFILLED = "developer publisher franchise series original_language engine official_website steam_app_id steam_url mobygames_url igdb_id igdb_url usk_rating pegi_rating".split()
ALIASES = "game_id normalized_title representative_title cluster_title match_status match_confidence canonical_title canonical_slug alias_match_status alias_match_confidence alias_canonical_title alias_canonical_slug alias_rejection_notes".split()
AMBIGUOUS = "game_id normalized_title representative_title match_status match_confidence failure_reason candidate_1_title candidate_1_url candidate_2_title candidate_2_url candidate_3_title candidate_3_url".split()
UNMATCHED = "game_id normalized_title representative_title match_status match_confidence failure_reason search_variants".split()
DEMOTIONS = "game_id representative_title demotion_reason source_alias_titles candidate_match_statuses".split()
REFERENCE = "reference_url reference_source reference_lang reference_title reference_confidence reference_status".split()

SAMPLE = "sample_bucket row_kind issue_code archive_name normalized_title representative_title issue_count source_kinds classification reason".split()
ENRICHED_MASTER = [c for c in PUBLISHED_MASTER if c not in {*PUSHED, *UNFILLED}] + [c for c in dict.fromkeys([*PUSHED, *ENRICHED, *UNFILLED])]
ENRICHED_ISSUES = [c for c in PUBLISHED_ISSUES if c not in PUSHED] + [c for c in dict.fromkeys([*PUSHED, *ENRICHED])]
#: Of every exported table the columns and the order of its rows.
EXPORTS = {
    "issue_titles": (ISSUE_TITLES, ["archive_name", "normalized_title"]),
    "master_games": (MASTER_GAMES, ["normalized_title"]),
    "unresolved_issues": (UNRESOLVED, ["archive_name"]),
    "final_issue_titles": (FINAL_ISSUES, ["archive_name", "normalized_title"]),
    "final_master_games": (MASTER_GAMES, ["normalized_title"]),
    "final_unresolved_issues": (FINAL_UNRESOLVED, ["archive_name"]),
    "dropped_candidates": (DROPPED, ["archive_name", "normalized_title"]),
    "publishable_issue_titles": (PUBLISHED_ISSUES, ["archive_name", "issue_code", "game_id"]),
    "publishable_master_games": (PUBLISHED_MASTER, ["game_id"]),
    "excluded_non_game_titles": (EXCLUDED, ["game_id"]),
    "enriched_master_games": (ENRICHED_MASTER, ["game_id"]),
    "enriched_issue_titles": (ENRICHED_ISSUES, ["archive_name", "issue_code", "game_id"]),
    "title_aliases": (ALIASES, ["game_id", "normalized_title", "representative_title"]),
    "ambiguous_matches": (AMBIGUOUS, ["game_id"]),
    "unmatched_titles": (UNMATCHED, ["game_id"]),
    "match_demotions": (DEMOTIONS, ["game_id"]),
    "sample": (SAMPLE, ["sample_bucket", "row_kind", "issue_code", "representative_title"]),
}
