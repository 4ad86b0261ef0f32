"""Reference lookup of titles over fetched pages. Fetching is an ingest job outside the engine; its contract here is three
tables: hits (normalized_title, source 'wikidata' or 'wikipedia', language, variant_no, place, id, label, description),
entities (id, labels map, aliases map of lists, sitelinks map) and failures (normalized_title, error, and if it is known
attempt, by which the errors of a title are joined in order)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import joined, public_reason, reference_title, safe, search_variants, wiki_url
from ..operators.dedupe import best_by, ordered_list
from ..operators.extract import preferred_link
from ..operators.matching import candidate_scores

LANGUAGES = ["en", "de"]
LEAST = {"wikidata": 68, "wikipedia": 80}


def first_hits(scored: DataFrame) -> DataFrame:
    """Only the candidates of the first language and variant that has any: later lookups would not have been made."""
    turn = F.array_position(F.array(*map(F.lit, LANGUAGES)), F.col("language")) * 100 + F.col("variant_no")
    s = scored.withColumn("__turn", turn)
    first = s.groupBy("normalized_title").agg(F.min("__turn").alias("__turn"))
    return s.join(first, ["normalized_title", "__turn"]).drop("__turn")


def scored_hits(titles: DataFrame, hits: DataFrame, texts: DataFrame, source: str) -> DataFrame:
    """Hits of one source with score; texts: (id or label of a hit, text to compare)."""
    keys = ["normalized_title", "language", "variant_no", "place", "id"]
    v = titles.select("normalized_title", F.explode(search_variants(F.col("representative_title"))).alias("variant"))
    pairs = hits.where(F.col("source") == source).select(*keys).join(texts, "id").join(v, "normalized_title")
    score = candidate_scores(pairs, keys, "variant", "text")
    h = hits.where(F.col("source") == source).join(score, keys)
    return h.withColumn("score", F.col("score") + R.description_points(F.col("description"))).where(F.col("score") >= LEAST[source])


def resolve(titles: DataFrame, hits: DataFrame, entities: DataFrame, failures: DataFrame) -> DataFrame:
    """One row per title (normalized_title, representative_title): status, link, confidence, method, reason, up to three
    candidates."""
    texts = F.concat(F.filter(F.array(*[F.try_element_at("labels", F.lit(x)) for x in LANGUAGES]), lambda x: x.isNotNull()), F.flatten(F.array(*[F.coalesce(F.try_element_at("aliases", F.lit(x)), F.array().cast("array<string>")) for x in LANGUAGES])))
    texts = F.when(F.size(texts) > 0, texts).otherwise(F.slice(F.map_values("labels"), 1, 1))
    e = entities.select("id", F.explode(texts).alias("text"))
    link = preferred_link(F.col("sitelinks"))
    linked = entities.select("id", link["site"].alias("site"), link["title"].alias("link_title"))
    data = first_hits(scored_hits(titles, hits, e, "wikidata")).join(linked, "id", "left")
    data = best_by(data, ["normalized_title", "id"], [F.desc("score"), F.asc("place")])
    lang = F.substring("site", F.lit(1), F.length("site") - 4)
    known = F.col("site").isNotNull()
    data = data.select("normalized_title", F.lit("wikidata-search").alias("method"), F.coalesce("link_title", "id").alias("label"), F.when(known, wiki_url(lang, F.col("link_title"))).otherwise(F.concat(F.lit("https://www.wikidata.org/wiki/"), "id")).alias("url"), F.when(F.col("site") == "enwiki", "wikipedia-en").when(F.col("site") == "dewiki", "wikipedia-de").when(known, "wikipedia-other").otherwise("wikidata").alias("source"), F.when(known, lang).otherwise("").alias("lang"), "score", F.col("id").alias("wikidata_id"))
    wiki_texts = hits.where("source = 'wikipedia'").select("id", F.col("label").alias("text")).distinct()
    wiki = first_hits(scored_hits(titles, hits, wiki_texts, "wikipedia"))
    wiki = wiki.select("normalized_title", F.lit("wikipedia-search").alias("method"), "label", wiki_url(F.col("language"), F.col("label")).alias("url"), F.concat(F.lit("wikipedia-"), "language").alias("source"), F.col("language").alias("lang"), "score", F.lit("").alias("wikidata_id"))
    order = [F.desc("score"), F.asc("source"), F.asc(F.lower("label")), F.asc("url")]
    top = best_by(data.unionByName(wiki), ["normalized_title", "method"], order, 3, "place")
    g = top.groupBy("normalized_title", "method").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "label", "url", "source", "lang", "score", "wikidata_id"))), lambda x: x).alias("c"))
    one, two = F.get("c", 0), F.get("c", 1)
    clear = (one["score"] >= 95) & (two.isNull() | (two["score"] <= one["score"] - 8))
    near = two.isNotNull() & (two["score"] >= one["score"] - 5)
    # Entity search falls through where nothing is clear or near; page search that found anything else is ambiguous.
    status = F.when(clear, "matched").when((F.col("method") == "wikipedia-search") | near, "ambiguous")
    g = g.withColumn("status", status).where("status is not null")
    g = best_by(g, ["normalized_title"], [F.asc("method")])
    rest = top.where("method = 'wikidata-search'").groupBy("normalized_title").agg(F.array_sort(F.collect_list(F.struct("place", "label", "url", "source", "lang", "score", "wikidata_id"))).alias("rest"))
    place = F.col("attempt") if "attempt" in failures.columns else F.col("error")
    f = failures.groupBy("normalized_title").agg(joined(ordered_list(public_reason(F.col("error")), place, F.col("error"))).alias("error"))
    out = titles.join(g, "normalized_title", "left").join(rest, "normalized_title", "left").join(f, "normalized_title", "left")
    failed = F.col("error").isNotNull()
    state = F.when(failed, "unmatched").otherwise(F.coalesce("status", F.lit("unmatched")))
    out = out.withColumn("reference_status", state).withColumn("m", F.col("reference_status") == "matched")
    value = lambda x: F.when(F.col("m"), F.get("c", 0)[x]).otherwise("")
    why = F.when(failed, F.col("error")).when(F.col("m"), "").when(F.col("reference_status") == "unmatched", "no confident Wikimedia match").when(F.col("method") == "wikidata-search", "multiple plausible Wikimedia entities").otherwise("multiple plausible Wikipedia search results")
    shown = F.when(failed | F.col("status").isNull(), F.col("rest")).otherwise(F.col("c"))
    return out.select(
        "normalized_title", "representative_title", "reference_status", value("label").alias("reference_title"), value("url").alias("reference_url"), value("source").alias("reference_source"), value("lang").alias("reference_lang"),
        F.when(F.col("m"), R.score_confidence(F.get("c", 0)["score"])).otherwise("").alias("reference_confidence"), F.when(F.col("m"), F.replace(reference_title(F.get("c", 0)["label"]), F.lit(" "), F.lit("-"))).otherwise("").alias("canonical_slug"),
        F.when(failed | F.col("status").isNull(), "wikimedia").otherwise(F.col("method")).alias("match_method"), value("wikidata_id").alias("wikidata_id"), why.alias("failure_reason"),
        *[safe(F.get(shown, i)[x]).alias(f"candidate_{i + 1}_{n}") for i in range(3) for n, x in (("title", "label"), ("url", "url"))],
    )


def attach(rows: DataFrame, resolved: DataFrame, columns: list[str]) -> DataFrame:
    """rows with the reference columns of their normalized title; a title without a resolution is an error."""
    missing = rows.join(resolved, "normalized_title", "left_anti").select("normalized_title").limit(1).collect()
    if missing:
        raise KeyError(missing[0][0])
    return rows.drop(*[c for c in columns if c in rows.columns]).join(resolved.select("normalized_title", *columns), "normalized_title")
