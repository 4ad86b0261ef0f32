"""Word counts of a corpus of titles, and the parting of glued words by them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.fold import ascii_fold
from ..functions.text import ODD, PLAIN, normalize_spaces
from ..session import materialised

LETTERS = "A-Za-zÀ-ÿ'"
STOP_BONUS, BOOST_BONUS = 200, 25
SHORTEST, LONGEST, LEAST_SCORE, COST = 2, 20, 3.5, 0.25


def words(titles: DataFrame, column: str) -> DataFrame:
    """(word, n): the folded words of a column and how often each occurs. Runs of letters are counted as they stand, in one
    look at each title; only the different ones are parted at capitals and folded."""
    runs = F.regexp_extract_all(F.translate(F.coalesce(column, F.lit("")), ODD, PLAIN), F.lit(f"[{LETTERS}]+"), F.lit(0))
    counted = titles.select(F.explode(runs).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    parts = F.split(F.regexp_replace(F.regexp_replace("run", "(?<=[a-z])(?=[A-Z])", " "), "(?<=[A-Z])(?=[A-Z][a-z])", " "), " ")
    folded = counted.select(F.explode(parts).alias("part"), "n").select(F.lower(ascii_fold(F.col("part"))).alias("word"), "n")
    return folded.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counted: DataFrame) -> DataFrame:
    """counted (word, n), function words and boosted words counted extra."""
    fixed = counted.sparkSession.createDataFrame([(w, STOP_BONUS) for w in V.SMALL_WORDS] + [(w, BOOST_BONUS) for w in V.BOOSTED_WORDS], "word string, n bigint")
    return counted.unionByName(fixed).groupBy("word").agg(F.sum("n").alias("n"))


def hinted(folded: Column) -> Column:
    """Whether a hint stands within the word, a character or more from either end. One pattern: a function called for each
    hint would fold the word as often."""
    return folded.rlike(f"(?s).(?:{'|'.join(V.SEGMENT_HINTS)}).")


def changeable(token: Column) -> Column:
    """Whether a token could be parted, by its length and letters as they stand: a hint within it, or what folding changes."""
    ascii_ = F.octet_length(token) == F.length(token)
    return ~ascii_ | (F.length(token) >= 6) & (token.rlike(r"[^A-Za-z]") | hinted(F.lower(token)))


def best_path(length: int, by_start: dict[int, list[tuple[int, float]]]) -> tuple[float, list[int]] | None:
    """Score and ends of the best way over edges (start -> [(end, weight)]) from 0 to length. Built from the right: at each
    place the best edge and where it leads; equal scores go to the shorter first part. Scores are rounded to nine places,
    so that sums in another order decide alike. One look at each edge."""
    best: list[tuple[float, int] | None] = [None] * length + [(0.0, -length)]
    for i in range(length - 1, -1, -1):
        options = [(round(w + best[e][0], 9), -e) for e, w in by_start.get(i, ()) if best[e] is not None]
        best[i] = max(options, default=None)
    if best[0] is None:
        return None
    ends, at = [], 0
    while at < length:
        at = -best[at][1]
        ends.append(at)
    return best[0][0], ends


def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, parts) from (length of a token, edges of start, word, weight, known), where the best way is good enough. The
    words of a way are the whole token."""
    for b in batches:
        tokens, found = [], []
        for length, edges in zip(b.column("length").to_pylist(), b.column("edges"), strict=True):
            by_start: dict[int, list[tuple[int, float]]] = {}
            known = {}
            for x in edges.as_py():  # one token's at a time
                start, word = x["start"], x["word"]
                by_start.setdefault(start, []).append((start + len(word), x["weight"]))
                if x["known"]:
                    known[start, start + len(word)] = word
            way = best_path(length, by_start)
            if way and len(way[1]) >= 2 and way[0] >= LEAST_SCORE and all(x in known for x in zip([0, *way[1]], way[1])):
                found.append([known[x] for x in zip([0, *way[1]], way[1])])
                tokens.append("".join(found[-1]))
        yield pa.record_batch({"token": pa.array(tokens, pa.string()), "parts": pa.array(found, pa.list_(pa.string()))})


def segmentations(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """(token, parts) for the tokens (column token: folded, different) that the vocabulary parts into known words. Tokens
    find their pieces in the vocabulary by a join; the choice of a way is a loop over a token's places, which built-in
    functions can't say in time that grows with its length only. A row of the join holds a piece and a key of bounded
    length, never a long token, and neither join collects a side for a broadcast: rows then stay small at any length of a
    token, and the driver sees none."""
    w = tokens.select("token").where(F.col("token").rlike("^[a-z]{6,}$"))
    w = w.join(vocab.where("n >= 3").select(F.col("word").alias("token")).hint("merge"), "token", "left_anti")
    key = F.when(F.length("token") < 64, F.col("token")).otherwise(F.sha2("token", 256))  # 64 digits: no shorter token's
    windows = F.regexp_extract_all("token", F.lit(f"(?=(.{{{SHORTEST},{LONGEST}}}))"), F.lit(1))  # what begins at each place
    e = w.select(key.alias("key"), F.length("token").alias("length"), windows.alias("windows"))
    e = e.select("key", "length", F.posexplode("windows").alias("start", "window"))
    e = e.select("key", "length", "start", "window", F.explode(F.sequence(F.lit(SHORTEST), F.length("window"))).alias("size"))
    e = e.select("key", "length", "start", F.substring("window", F.lit(1), F.col("size")).alias("word"))
    known = (F.col("n") >= 2) | F.col("word").isin(V.SMALL_WORDS)
    e = e.join(vocab.hint("merge"), "word").select("key", "length", F.struct("start", "word", (F.ln(F.col("n") + 1.0) - COST).alias("weight"), known.alias("known")).alias("e"))
    g = e.groupBy("key", "length").agg(F.collect_list("e").alias("edges"))  # at most 19 for each letter of one token
    return g.select("length", "edges").mapInArrow(parted, "token string, parts array<string>")


def recased(part: Column, original: Column) -> Column:
    small = F.array(*[F.lit(x) for x in [*V.SMALL_WORDS, "de", "la", "le"]])
    first = F.substring(original, 1, 1)
    shout = (original == F.upper(original)) & (original != F.lower(original)) & (F.length(original) <= 5)
    return F.when(shout, F.upper(part)).when(F.array_contains(small, part), F.lower(part)).when((first == F.upper(first)) & (first != F.lower(first)), F.initcap(part)).otherwise(F.lower(part))


def repair_compounds(df: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """df with column's glued words parted and split_any telling whether any was. Only different tokens, and of
    these only hinted ones, are looked at; they come back to the rows by the title, so repeated rows are no matter."""
    titles = df.select(F.col(column).alias("__title"))
    words = titles.select("__title", F.posexplode(F.split(F.trim("__title"), r"\s+")).alias("place", "token")).where(changeable(F.col("token")))
    # Cut here, or the filter would be pushed below the distinct and fold every word of every title.
    tokens = materialised(words.select("token").distinct()).withColumn("bare", F.regexp_replace("token", f"[^{LETTERS}]", ""))
    tokens = materialised(tokens.withColumn("folded", F.lower(ascii_fold(F.col("bare")))))
    some = tokens.where((F.col("bare") != "") & hinted(F.col("folded")) & ~F.col("folded").isin("wii", "xfire"))
    seg = segmentations(some.select(F.col("folded").alias("token")).distinct(), vocab).select(F.col("token").alias("folded"), "parts")
    new = some.join(seg, "folded").withColumn("rebuilt", F.array_join(F.transform("parts", lambda p: recased(p, F.col("token"))), " "))
    new = new.select("token", F.replace("token", F.col("bare"), F.col("rebuilt")).alias("rebuilt"))
    new = words.join(materialised(new), "token").select("__title", "place", "rebuilt")
    changes = new.groupBy("__title").agg(F.map_from_entries(F.collect_set(F.struct("place", "rebuilt"))).alias("__new"))
    parts = F.transform(F.split(F.trim("__title"), r"\s+"), lambda t, i: F.coalesce(F.try_element_at(F.col("__new"), i), t))
    fixed = changes.select("__title", normalize_spaces(F.array_join(parts, " ")).alias("__fixed"))
    out = df.join(fixed, F.col(column) == F.col("__title"), "left").withColumn("split_any", F.col("__fixed").isNotNull())
    return out.withColumn(column, F.coalesce("__fixed", normalize_spaces(F.col(column)))).drop("__title", "__fixed")
