"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader
updates, scored as sparse dot products.

Defined cases: a null or empty text has no words and is scored by the bias feature alone; without labelled rows of
the learning folds, or with one class only, the model is all zero weights or whatever that class teaches (scores
from 0.5 up or down); an empty table gives no rows; texts and words are read whole at any length; equal texts get equal
scores and repeated rows are scored each; a document's label is the largest of its label rows; rows of labels with null
doc_id or label are ignored. Extra columns are ignored by score_table and kept by keep_good."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .common import cut, fold, kept, only, pick, small_batches, table

DIMS = 1 << 18
#: Documented bound: so many labelled documents of the learning folds are used for fitting, chosen by a hash of their id.
TRAIN_ROWS = 6000
#: Documented bound: so many bytes of their features at most.
TRAIN_BYTES = 200_000_000
THRESHOLD = 0.5
SCALE = 24.0
CACHE = 200_000
#: Feature 0 is the bias, 1 a word equal to the one before.
BIAS, AGAIN = 0, 1


def shape(word: str) -> str:
    """The word's kinds of character, runs as one: a lower, A upper, 0 digit, others as they are."""
    s = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return re.sub(r"(.)\1+", r"\1", s)


class Words(dict):
    """Word -> 32 bits of its hash and, above, 31 of its shape's."""

    def __missing__(self, word: str) -> int:
        import zlib

        if len(self) >= CACHE:
            self.clear()
        w = word.strip(".,;:").lower() or word
        self[word] = v = zlib.crc32(w.encode("utf-8", "replace")) | ((zlib.crc32(shape(word).encode("utf-8", "replace")) >> 1) << 32)
        return v


_words = kept(Words())


def indices(text: str | None) -> np.ndarray:
    """The hashed features of a whole text, repeats included (without the bias): word and shape 1- and 2-grams."""
    toks = (text or "").split()
    if not toks:
        return np.zeros(0, np.int64)
    v = np.fromiter(map(_words.__getitem__, toks), np.int64, len(toks))
    w, s = v & 0xFFFFFFFF, v >> 32
    mix = lambda x, salt: 2 + ((x * 0x9E3779B1 + salt * 0x85EBCA6B >> 13) & 0x7FFFFFFFFFFF) % (DIMS - 2)
    parts = [mix(w, 1), mix(s, 2)]
    if len(toks) > 1:
        parts += [mix(w[:-1] * 31 + w[1:], 3), mix(s[:-1] * 31 + s[1:], 4), np.full(int((w[1:] == w[:-1]).sum()), AGAIN)]
    return np.concatenate(parts)


def example(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features with their values: counts over the number of words, scaled; the bias has 1."""
    words = max(1, len((text or "").split()))
    i, n = np.unique(indices(text), return_counts=True)
    return np.append(i, BIAS).astype(np.int32), np.append(n * (SCALE / words), 1.0).astype(np.float32)


def score_texts(texts, weights: np.ndarray) -> np.ndarray:
    out = np.empty(len(texts))
    for k, t in enumerate(texts):
        i = indices(t)
        words = max(1, len((t or "").split())) if len(i) else 1
        out[k] = weights[BIAS] + SCALE / words * weights[i].sum(dtype=np.float64)
    return ftrl.sigmoid(out)


def sampled(docs: DataFrame, parts: int, held_out: int, rows: int) -> DataFrame:
    """doc_id of about `rows` different documents outside the held-out fold, whether labelled or not: those whose hash is
    small, so that one look at the ids' column finds them."""
    ids = pick(docs, doc_id="bigint").dropna()
    share = min(1.0, 1.2 * rows / max(1, docs.count()))
    some = ids.where((fold(F.col("doc_id"), parts) != held_out) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30))))
    return some.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def learn(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, rows: int, featurise, more: int = 0) -> list[tuple]:
    """(doc_id, label, indices, values) of at most `rows` labelled documents outside the held-out fold, and of at most
    `more` others (label None) that a hash of their ids chooses, in a fixed order. A document that occurs more than once
    counts once, with the smallest of its features. Documented bound: of these, in the order of their ids' hash, as many
    as TRAIN_BYTES of features hold."""
    spark = docs.sparkSession
    small_batches(spark)
    lab = pick(labels, doc_id="bigint", **{label: "int"}).dropna().groupBy("doc_id").agg(F.max(label).alias("y"))
    lab = lab.where(fold(F.col("doc_id"), parts) != held_out)
    ids = {r[0]: r[1] for r in lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()}  # at most `rows` pairs
    if more:
        other = sampled(docs, parts, held_out, more).join(lab, "doc_id", "left")
        ids = {r[0]: r[1] for r in other.collect()} | ids
    small = spark.createDataFrame(list(ids.items()) or [(-1, 0)], "doc_id bigint, y int").where(F.lit(bool(ids)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [featurise(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "i": [x[0].tobytes() for x in got], "v": [x[1].tobytes() for x in got]})

    found = pick(docs, doc_id="bigint", text="string").join(F.broadcast(small.select("doc_id")), "doc_id").mapInPandas(run, "doc_id bigint, i binary, v binary")
    found = cut(found.groupBy("doc_id").agg(F.min(F.struct("i", "v")).alias("x")).select("doc_id", "x.*"))
    size = F.octet_length("i") + F.octet_length("v")
    sizes = found.select("doc_id", size.alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # two numbers a row
    upto = accumulate(r.n for r in sizes)
    fits = [r.doc_id for r, n in zip(sizes, upto, strict=True) if n <= TRAIN_BYTES]
    if len(fits) < len(sizes):
        found = found.join(F.broadcast(spark.createDataFrame([(x,) for x in fits], "doc_id bigint")), "doc_id", "left_semi")
    return sorted(((r.doc_id, ids[r.doc_id], np.frombuffer(r.i, np.int32), np.frombuffer(r.v, np.float32)) for r in found.collect()), key=lambda r: r[0])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    got = learn(docs, labels, "quality", 3, 1, rows, example)
    y = np.array([r[1] for r in got], float)
    few = min(y.sum(), len(y) - y.sum()) if len(y) else 0
    share = np.where(y > 0, len(y) / max(1, 2 * y.sum()), len(y) / max(1, 2 * (len(y) - y.sum()))) ** 0.5 if few else np.ones(len(y))
    return ftrl.fit([r[2:] for r in got], y, share, DIMS)


def scorer(weights: np.ndarray):
    """A Column function text -> score. The weights are 1 MB, whatever the input."""
    raw = weights.tobytes()

    @F.pandas_udf("double")
    def score(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only(_words)
        w = np.frombuffer(raw, np.float32)
        for texts in it:
            yield pd.Series(score_texts(texts.tolist(), w), index=texts.index)

    return score


def score_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    score = scorer(train(docs, labels))
    d = pick(docs, doc_id="bigint", text="string")
    return d.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), score("text").alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns."""
    score = scorer(train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(docs["text"].cast("string")) >= THRESHOLD)


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
