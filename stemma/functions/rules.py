"""Ordered rule chains as one CASE, and the predicates built from them."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .text import alternation, contains_any, lenient_int, let, public_title, safe


def first_match(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds; a null predicate doesn't."""
    out = F.lit(otherwise)
    for name, holds in reversed(rules):
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


def rank(c: Column, ranks: dict[str, int]) -> Column:
    """The rank of a value, 0 for others."""
    out = F.lit(0)
    for value, r in ranks.items():
        out = F.when(c == value, F.lit(r)).otherwise(out)
    return out


def confidence_rank(c: Column) -> Column:
    return rank(F.lower(safe(c)), V.CONFIDENCE_RANKS)


def source_rank(c: Column) -> Column:
    return rank(c, V.SOURCE_RANKS)


def kind_list(c: Column) -> Column:
    """Kinds of a text that separates them by comma or semicolon."""
    return F.filter(F.transform(F.split(F.replace(safe(c), F.lit(";"), F.lit(",")), ","), lambda x: F.trim(x)), lambda x: x != "")


def word_list(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


KEEP = ["vollversion-fullversion", "multiword", "singleword-titlecase"]


def title_features(title: Column, normalized: Column, kinds: Column) -> Column:
    """Struct of what the rules ask of a candidate, so that a row's words are looked at once: title, norm, low, kinds, digit,
    and of its words how many are of letters (alpha), of these of four or more (long) and of two or less (short), and
    whether one names a medium (media) or an edition (edition)."""
    title, norm = F.trim(title), F.lower(F.trim(normalized))

    def of_words(w: Column) -> Column:
        alpha = F.filter(w, lambda x: x.rlike(r"^\p{L}+$"))
        return F.struct(
            F.transform(alpha, F.length).alias("lengths"),
            F.exists(w, lambda x: x.isin("dvd", "cd", "gold", "spiele")).alias("media"),
            F.exists(w, lambda x: x.isin("normal", "bonus", "sonder", "gold")).alias("edition"),
        )

    def counted(w: Column) -> Column:
        n = lambda when: F.size(F.filter(w["lengths"], when))
        return F.struct(F.size(w["lengths"]).alias("alpha"), n(lambda x: x >= 4).alias("long"), n(lambda x: x <= 2).alias("short"), w["media"].alias("media"), w["edition"].alias("edition"))

    words = let(let(word_list(norm), of_words), counted)
    return F.struct(title.alias("title"), norm.alias("norm"), F.lower(title).alias("low"), F.split(safe(kinds), ",").alias("kinds"), words.alias("words"))


def reason_of(f: Column) -> Column:
    """Why a candidate with these features is kept (one of KEEP) or dropped: the first of 18 rules that holds."""
    title, norm, low, kinds, w = f["title"], f["norm"], f["low"], f["kinds"], f["words"]
    digit = norm.rlike("[0-9]")
    return first_match(
        [
            ("vollversion-fullversion", F.array_contains(kinds, "vollversion-fullversion")),
            ("issue-track", norm.rlike(r"^cbs\d+ track\d+")),
            ("numeric-only", norm.rlike(r"^\d+$")),
            ("issue-number-like", F.replace(norm, F.lit(" "), F.lit("")).rlike(r"^\d{4,}$")),
            ("bad-exact", norm.isin(V.BAD_EXACT)),
            ("bad-substring", contains_any(low, V.BAD_PARTS)),
            ("markup-noise", title.rlike(r"[<>\[\]]")),
            ("path-or-option", title.rlike(r"[\\|]")),
            ("short-code", norm.rlike(r"^[a-z]{1,4}\d{1,4}[a-z0-9]*$")),
            ("cbs-code", norm.startswith("cbs") & digit),
            ("media-or-magazine-label", w["media"]),
            ("numeric-leading-weak", norm.rlike("^[0-9]") & (w["alpha"] > 0) & (w["long"] == 0)),
            ("edition-or-mode-label", w["edition"] & digit),
            ("all-short-words", (w["alpha"] > 0) & (w["long"] == 0)),
            ("mostly-short-words", (w["alpha"] >= 3) & (w["long"] == 1) & (w["short"] >= 2)),
            ("manifest-noise", (F.array_join(kinds, ",") == "disc-manifest-path") & contains_any(low, V.MANIFEST_PARTS)),
            ("multiword", title.contains(" ")),
            ("singleword-titlecase", title.rlike(r"^\p{Lu}") & (title != F.upper(title)) & (F.length(title) >= 5)),
        ],
        "weak-singleword",
    )


def title_reason(title: Column, normalized: Column, kinds: Column) -> Column:
    return let(title_features(title, normalized, kinds), reason_of)


FULL_VERSION, DISC_VALUE = "vollversion-fullversion", "disc-metadata-value"


def may_be_published(kinds: Column) -> Column:
    """Whether kinds allow it at all, whatever the title."""
    return F.arrays_overlap(F.split(safe(kinds), ","), F.array(F.lit(FULL_VERSION), F.lit(DISC_VALUE)))


def always_published(kinds: Column) -> Column:
    """Whether kinds alone keep and publish a candidate: the first rule of reason_of and of publishable."""
    return F.array_contains(F.split(safe(kinds), ","), FULL_VERSION)


def publishable(title: Column, normalized: Column, kinds: Column) -> Column:
    """Whether a cleaned candidate may be published."""

    def of(f: Column) -> Column:
        w = f["words"]
        strict = (
            F.array_contains(f["kinds"], "disc-metadata-value")
            & ~f["norm"].isin(V.STRICT_EXACT)
            & ~contains_any(f["low"], V.STRICT_PARTS)
            & ((w["alpha"] == 0) | (w["long"] > 0))
            & ~((w["alpha"] >= 3) & (w["short"] >= 2))
        )
        return F.array_contains(f["kinds"], "vollversion-fullversion") | strict

    return let(title_features(title, normalized, kinds), of)


CONTENT_RULES = [
    ("disc_noise", V.NOISE_PATTERNS),
    ("guide_media", V.GUIDE_PATTERNS),
    ("editor_sdk", V.EDITOR_PATTERNS),
    ("utility", V.UTILITY_PATTERNS),
    ("expansion_or_addon", V.EXPANSION_PATTERNS),
]
NOT_GAMES = ["utility", "editor_sdk", "guide_media", "disc_noise"]


def content_class(title: Column) -> Column:
    """What a title names; one alternation for each class, in order."""
    return class_of(public_title(title))


def class_of(public: Column) -> Column:
    """content_class of a title in its public form, which is computed once: each rule looks at it."""

    def of(t: Column) -> Column:
        rules = [("disc_noise", t.isin(V.NOISE_TITLES))] + [(name, t.rlike(alternation(p))) for name, p in CONTENT_RULES]
        rules.append(("mod_or_conversion", t.rlike(alternation(V.MOD_PATTERNS)) & ~t.contains("mod kit") & ~t.contains("mod sdk")))
        return first_match(rules, "game")

    return let(public, of)


def class_named(public: Column) -> Column:
    """Whether a rule of class_of but for whole titles could fit. One automaton over Arrow batches looks for all patterns at
    once; tried one after another at each place of a title, they take longer than all other functions together."""
    some = alternation(p for patterns in [*(p for _, p in CONTENT_RULES), V.MOD_PATTERNS] for p in patterns)

    @F.arrow_udf("boolean")
    def of(titles: pa.Array) -> pa.Array:
        return pc.match_substring_regex(titles, some)

    return of(public)


def content_form(kind: Column, klass: Column) -> Column:
    kind = F.lower(F.trim(safe(kind)))
    more = klass.isin("expansion_or_addon", "mod_or_conversion")
    return (
        F.when(klass.isin(NOT_GAMES), klass)
        .when(more & (kind == "demo"), F.concat(klass, F.lit("_demo")))
        .when(more, klass)
        .when(kind == "full_version", F.lit("full_version_game"))
        .when(kind == "demo", F.lit("demo_game"))
        .otherwise(F.lit("game_title"))
    )


def content_kind(text: Column) -> Column:
    """The first kind of section whose words a text holds."""
    return first_match([(name, text.rlike(f"(?iu){p}")) for name, p in V.SECTION_MARKERS], "unknown")


def has_marker(text: Column) -> Column:
    return text.rlike("(?iu)" + alternation(p for _, p in V.SECTION_MARKERS))


def root_cause(reason: Column) -> Column:
    """Struct (root_cause, retry, suggestion) of a failure's text."""
    network = contains_any(F.lower(safe(reason)), ["could not resolve host", "503", "connection timed out", "broken pipe"])
    pick = lambda a, b: F.when(network, F.lit(a)).otherwise(F.lit(b))
    return F.struct(
        pick("network/download", "other").alias("root_cause"),
        pick("yes", "investigate").alias("retry_recommended"),
        pick("retry on a stable network or with a rerun focused on unresolved issues", "inspect raw error and source artifact manually").alias("suggestion"),
    )


SAMPLE_REASONS = {
    "known": ("keep", "known valid game title"),
    "drop": ("drop", "obvious non-game or resource/tool string"),
    "version": ("uncertain", "looks like version/build metadata"),
    "malformed": ("uncertain", "looks like concatenated or malformed extracted metadata"),
    "long": ("uncertain", "contains very long unbroken token"),
    "plain": ("keep", "looks like a plausible game title"),
}


def sample_rule(title: Column) -> Column:
    low = F.lower(F.replace(title, F.lit("ß"), F.lit("ss")))
    return first_match(
        [
            ("known", low.isin(V.SAMPLE_KNOWN)),
            ("drop", contains_any(low, V.SAMPLE_DROP)),
            ("version", low.rlike(r"\bv\s*\d") | low.rlike(r"v\d{2,}")),
            ("malformed", contains_any(low, V.SAMPLE_MALFORMED)),
            ("long", title.rlike("[A-Za-z]{18,}")),
        ],
        "plain",
    )


def sample_class(title: Column) -> Column:
    """Struct (verdict, reason) of a title in an audit sample."""
    rule = sample_rule(title)
    pick = lambda k: first_match([(v[k], rule == name) for name, v in SAMPLE_REASONS.items()], "")
    return F.struct(pick(0).alias("classification"), pick(1).alias("reason"))


def description_points(c: Column) -> Column:
    """+18 for a game's description, -18 for that of another work; both may hold."""
    low = F.lower(safe(c))
    return F.when(contains_any(low, V.GAME_MARKERS), 18).otherwise(0) - F.when(contains_any(low, V.NON_GAME_MARKERS), 18).otherwise(0)


def score_confidence(score: Column) -> Column:
    return F.when(score >= 95, "high").when(score >= 80, "medium").otherwise("low")


def is_qid(c: Column) -> Column:
    return F.trim(safe(c)).rlike(r"^Q\d+$")


def variant_bucket(c: Column) -> Column:
    low = F.lower(safe(c))
    return first_match([(name, low.contains(name)) for name in ("platin", "gold", "silber", "dvd")], "standard")


def naming_bucket(code: Column) -> Column:
    return F.when(F.length(code) <= 7, "new").otherwise("old")


def year_bucket(year: Column) -> Column:
    return F.when(year <= 2004, "early").when(year <= 2010, "late").otherwise("modern")


def match_quality(row, first_year: Column) -> Column:
    """Struct (points, notes) of a reference match. row: name -> Column of the match's fields (see MATCH_FIELDS), with
    source_title and alias_rejection_notes."""
    status = safe(row("match_status"))
    year = lenient_int(safe(row("release_year")))
    has = lambda name: safe(row(name)) != ""
    title = public_title(safe(row("source_title")))
    qid = is_qid(row("canonical_title"))
    in_time = first_year.isNull() | year.isNull() | (year <= first_year + 3)
    fill = (safe(row("entity_type")) == "game") & ~title.isin(V.PLAIN_QID_TITLES) & (F.size(word_list(title)) >= 2) & in_time
    conflict = F.coalesce(year > first_year + 3, F.lit(False))
    preview = F.coalesce((year > first_year) & ~conflict, F.lit(False))
    only_data = safe(row("match_source_url")).contains("wikidata.org/wiki/Q") & ~has("wikipedia_url")
    points = [
        (qid & fill, -4, "raw_qid_title_backfill_candidate"),
        (qid & ~fill, -45, "demoted_raw_qid_title"),
        (~qid, 10, None),
        (has("wikipedia_url"), 10, None),
        (has("wikidata_id"), 5, None),
        (has("categories") | has("genres"), 5, None),
        (has("release_year"), 5, None),
        (conflict, -50, "demoted_release_year_conflict"),
        (preview, 0, "release_after_first_issue_possible_preview"),
        (only_data, -10, "wikidata_only_match"),
        (has("alias_rejection_notes"), -60, "manual_rejection"),
    ]
    total = F.lit(60)
    for holds, n, _ in points:
        total = total + F.when(holds, F.lit(n)).otherwise(F.lit(0))
    notes = F.filter(F.array(*[F.when(holds, F.lit(note)) for holds, _, note in points if note]), lambda x: x.isNotNull())
    text = F.array
    return F.struct(
        F.when(status == "matched", total).when(status == "ambiguous", F.lit(25)).otherwise(F.lit(5)).alias("points"),
        F.when(status == "matched", notes).when(status == "ambiguous", text(F.lit("ambiguous_source_alias"))).otherwise(text(F.lit("unmatched_source_alias"))).alias("notes"),
    )


def quality_points(row) -> Column:
    """Data quality of a master row, 0 to 100. The flags are parted at semicolons without trimming, so only the first of
    several counts here, as it always has."""
    has = lambda name: safe(row(name)) != ""
    notes = safe(row("match_notes"))
    points = [
        (safe(row("content_class")) == "game", 10),
        (safe(row("merge_confidence")) == "high", 10),
        (safe(row("merge_confidence")) == "medium", 5),
        (safe(row("match_status")) == "matched", 20),
        (safe(row("match_status")) == "ambiguous", 5),
        (has("wikipedia_url"), 5),
        (has("wikidata_id"), 5),
        (has("release_year"), 4),
        (has("categories") | has("genres"), 3),
        (has("rating_value"), 3),
        (F.array_contains(F.split(safe(row("cleanup_flags")), ";"), "split_compound_token"), -4),
        (notes.contains("demoted_raw_qid_title"), -10),
        (notes.contains("demoted_release_year_conflict"), -10),
    ]
    total = F.lit(35)
    for holds, n in points:
        total = total + F.when(holds, F.lit(n)).otherwise(F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(100), total))
