"""The cleaning of raw candidates: repair, reasons, the cleaned title with its key, class, form and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules as R
from ..functions.text import first_of_map, key_of, normalize_spaces, normalized_title, public_title, repair_tokens, safe, split_camel, strip_suffixes
from ..session import materialised
from .segment import repair_compounds


def title_repairs(spark) -> DataFrame:
    return spark.createDataFrame(list(V.TITLE_REPAIRS.items()), "normalized_title string, repaired string")


def repair_titles(rows: DataFrame, again: bool = False) -> DataFrame:
    """Damaged titles replaced by the fixed repairs (a table of under 100 rows), normalized titles made anew; again: rows come
    from here, so only repaired titles have another normalized one."""
    fix = F.broadcast(title_repairs(rows.sparkSession).withColumnRenamed("repaired", "__fix"))
    out = rows.join(fix, "normalized_title", "left").withColumn("representative_title", F.coalesce("__fix", "representative_title"))
    anew = F.coalesce(normalized_title(F.col("representative_title")), F.col("normalized_title"))
    anew = F.when(F.col("__fix").isNotNull(), anew).otherwise(F.col("normalized_title")) if again else anew
    return out.withColumn("normalized_title", anew).select(*rows.columns)


def repaired(again: bool = False):
    """repair_titles for one row: a function of a struct (representative_title, normalized_title)."""

    def of(s: Column) -> Column:
        title, norm = s["representative_title"], s["normalized_title"]
        fix = F.when(norm.isin(list(V.TITLE_REPAIRS)), first_of_map(V.TITLE_REPAIRS, norm))
        anew = F.coalesce(normalized_title(F.coalesce(fix, title)), norm)
        return F.struct(F.coalesce(fix, title).alias("representative_title"), (F.when(fix.isNotNull(), anew).otherwise(norm) if again else anew).alias("normalized_title"))

    return of


def publishable_titles(rows: DataFrame) -> DataFrame:
    """rows that are kept and may be published, repaired before, between and after, in one pass: what each step says of a
    title goes to the next in the row, so nothing is computed twice or written between, and rows whose kinds are never
    published are not looked at."""
    kinds = F.col("source_kinds")
    always = R.always_published(kinds)
    of = lambda f: lambda s: always | f(s["representative_title"], s["normalized_title"], kinds)
    one = F.transform(F.array(F.struct("representative_title", "normalized_title")), repaired())
    one = F.filter(one, of(lambda *x: R.title_reason(*x).isin(R.KEEP)))
    one = F.filter(F.transform(one, repaired(again=True)), of(R.publishable))
    others = [c for c in rows.columns if c not in ("representative_title", "normalized_title")]
    return rows.where(R.may_be_published(kinds)).select(*others, F.inline(F.transform(one, repaired(again=True))))


def with_reason(rows: DataFrame) -> DataFrame:
    """rows with reason and keep."""
    out = rows.withColumn("reason", R.title_reason(F.col("representative_title"), F.col("normalized_title"), F.col("source_kinds")))
    return out.withColumn("keep", F.col("reason").isin(R.KEEP))


def clean_titles(rows: DataFrame, title: str, kind: str, vocab: DataFrame) -> DataFrame:
    """rows with cleaned_title, cleaned_normalized, game_id, flags (sorted), content_class, content_form. Class and form are
    those of the title as it came."""
    out = rows.withColumn("__original", normalize_spaces(F.col(title)))
    out = out.withColumn("__public", public_title(F.col("__original"))).withColumn("__some", R.class_named(F.col("__public")))
    named = F.col("__some") | F.col("__public").isin(V.NOISE_TITLES)
    out = out.withColumn("content_class", F.when(named, R.class_of(F.col("__public"))).otherwise("game")).drop("__public", "__some")
    out = out.withColumn("content_form", R.content_form(safe(F.col(kind)) if kind else F.lit(""), F.col("content_class")))
    out = out.withColumn("__one", strip_suffixes(split_camel(F.col("__original")))).withColumn("cleaned_title", F.col("__one")["text"])
    out = repair_compounds(materialised(out), "cleaned_title", vocab)
    out = out.withColumn("__rep", repair_tokens(F.col("cleaned_title")))
    out = out.withColumn("__two", strip_suffixes(F.col("__rep")))
    flags = F.array(
        F.when(F.col("__rep") != F.col("cleaned_title"), F.lit("manual_token_repair")),
        F.when(F.col("split_any"), F.lit("split_compound_token")),
        F.when(F.col("__one")["descriptor"] | F.col("__two")["descriptor"], F.lit("stripped_disc_descriptor")),
        F.when(F.col("__one")["version"] | F.col("__two")["version"], F.lit("stripped_version_suffix")),
    )
    out = out.withColumn("flags", F.filter(flags, lambda x: x.isNotNull()))
    out = out.withColumn("cleaned_title", normalize_spaces(F.col("__two")["text"]))
    out = out.withColumn("cleaned_normalized", public_title(F.col("cleaned_title"))).withColumn("game_id", key_of(F.col("cleaned_normalized")))
    return out.drop("__original", "__one", "__two", "__rep", "split_any")
