"""Quality rules: a table of thresholds compiled into one projection of length, symbol, stop-word and line ratios.
Built-in functions only.

Defined cases: a null text is an empty one; a document without words has zero counts and fails (fewer than 50 words);
repeated rows are judged each; a null doc_id stays null; texts are measured whole at any length; an empty table gives no
rows; a measure that equals its bound passes. Extra columns are ignored. Ratios over zero count as zero.

The words of a 3-word window found twice or more are counted without comparing all pairs: the windows' hashes are sorted
beside their places, equal neighbours give the repeated windows, and the places they cover are counted once each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, pick, table

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Stop words of four languages (fixed values).
STOP_WORDS = "the of and to in is that it was for on with as this be at by an or are from der die das und ist zu den von nicht mit ein eine im auf für de la le les et un une des en que qui dans pour sur est du el los las y por con una se"
#: (measure, least, most); null: no bound. A document is kept if every measure lies within its bounds.
THRESHOLDS = [
    ("n_words", 50, None),
    ("repeat_ratio", None, 0.5),
    ("mean_word_length", 1.5, 16.0),
    ("symbol_ratio", None, 0.25),
    ("dup_line_ratio", None, 0.7),
    ("stop_words", 1, None),
    ("bang_ratio", None, 0.5),
]


def covered(starts: Column) -> Column:
    """How many places the 3-word windows at these sorted, distinct starts cover."""
    gaps = F.zip_with(F.slice(starts, F.lit(1), F.size(starts) - 1), F.slice(starts, F.lit(2), F.size(starts) - 1), lambda a, b: F.least(b - a, F.lit(3)))
    return F.when(F.size(starts) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda n, g: n + g))


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the array."""

    def marked(hashes: Column) -> Column:
        places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, k: same(k + 1, x) | same(k - 1, x))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        return let(let(places, starts), covered)

    # Most short texts have no repeated window, which a set of plain numbers tells; only the others sort places.
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    some = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(marked(h)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(some)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and every measure."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = pick(docs, doc_id="bigint", text="string")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS.split()])
    stats = let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_intersect(w, stop)).cast("long").alias("stop_words"),
        ),
    )
    d = d.select(
        "doc_id",
        stats.alias("s"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit("!!")).cast("long").alias("n_bangs"),
    )
    return d.select("doc_id", "s.*", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_bangs")


def compiled(thresholds=THRESHOLDS) -> Column:
    """The threshold table as one condition."""
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    value = {
        "n_words": F.col("n_words"),
        "stop_words": F.col("stop_words"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "mean_word_length": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "bang_ratio": ratio("n_bangs", "n_words"),
    }
    ok = F.lit(True)
    for name, least, most in thresholds:
        ok = ok & (F.lit(True) if least is None else value[name] >= least) & (F.lit(True) if most is None else value[name] <= most)
    return ok


def verdicts(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """doc_id, n_words, the four counts, base_failed, kept for every row of docs."""
    m = measures(docs)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & compiled(thresholds)).alias("kept"))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))


#: The same with windows told apart as texts, by unnesting every word.
OP7_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT rid, i + unnest([0, 1, 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
v AS (SELECT rid, count(DISTINCT p) AS n FROM r GROUP BY rid),
l AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT x) AS dup FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words,
    coalesce(l.n, 0) AS n_lines, (length(t) - length(replace(t, '!!', ''))) / 2 AS n_bangs,
    len(list_intersect(ws, string_split('{STOP_WORDS}', ' '))) AS stops
  FROM w LEFT JOIN v USING (rid) LEFT JOIN l USING (rid)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 1.5 AND 16 AND n_symbols / n_words <= 0.25 AND n_dup_lines / n_lines <= 0.7
  AND stops >= 1 AND n_bangs / n_words <= 0.5 AS kept
FROM f
"""
