"""License scans by diagonal voting. Every rolling k-gram of a document's words is joined on its hash to the places of
the license templates; a hit at place p of the document and t of the template votes for the diagonal p - t; votes are
gathered by diagonal, neighbouring diagonals (words put in or left out) are merged, and the merged span is verified: the
template words that its grams cover, word for word, and its length. DataFrame operations only.

Defined cases: a null text is an empty one (no words); a text shorter than a gram has no hits; a null doc_id stays null;
repeated rows are scanned each; overlapping places all count; of several templates of a label the best share is its
score; texts are scanned whole at any length; an empty table gives no rows. Extra columns are ignored. Only the small template table
is broadcast (under 1,000 rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3
#: Phrases that count only word for word (fixed values).
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
#: Notices that are found in altered form too (public license texts, first sentences).
NOTICES = [
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "licensed under the gnu general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Diagonals at most so far apart belong to one span; a span holds at least this share of the template's words.
SLACK, LEAST = 4, 0.8
#: Stands for the document itself among its grams; no word can hold this character.
MARK = "\x00"


def words_of(text: Column) -> Column:
    """The text's words, lower-cased. lower() may change letters outside ASCII too, which no template holds; the two that
    it would turn into ASCII letters are replaced before."""
    text = F.coalesce(text, F.lit(""))
    for odd in ("\u212a", "\u0130"):
        text = F.replace(text, F.lit(odd), F.lit("å"))
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def templates(spark: SparkSession) -> DataFrame:
    """A row for each k-gram of each template; tid 0 is the mark."""
    rows = [(0, "", False, 1, 0, MARK, "", "")]
    for tid, (label, text, exact) in enumerate([(*x, True) for x in PHRASES] + [(*x, False) for x in NOTICES], 1):
        w = text.split()
        rows += [(tid, label, exact, len(w), t, *w[t : t + K]) for t in range(len(w) - K + 1)]
    df = spark.createDataFrame(rows, "tid int, label string, exact boolean, length int, tpos int, t0 string, t1 string, t2 string")
    return df.withColumn("h", F.when(F.col("tid") == 0, F.xxhash64("t0")).otherwise(F.xxhash64("t0", "t1", "t2")))


def spans(docs: DataFrame) -> DataFrame:
    """A row for each document (tid 0: first = its number of words, hits = how often this row occurs) and each span of a
    template: label, exact, first and last word, share of the template's words, the exact places."""
    d = pick(docs, doc_id="bigint", text="string")
    # Equal rows of a partition are counted together: a copy then adds nothing but to the number of hits. The mark stands
    # first, so the words' places count from 1; the grams are hashed place by place in generated code, and the array of
    # words is never copied: only a hit's few columns leave the join.
    d = d.select(F.spark_partition_id().alias("part"), "doc_id", F.xxhash64("text").alias("th"), F.concat(F.array(F.lit(MARK)), words_of(F.col("text"))).alias("words"))
    d = d.select("*", F.posexplode("words").alias("at", "w0"))
    d = d.withColumns({"w1": F.get("words", F.col("at") + 1), "w2": F.get("words", F.col("at") + 2)})
    d = d.withColumn("h", F.when(F.col("at") == 0, F.xxhash64(F.lit(MARK))).otherwise(F.xxhash64("w0", "w1", "w2")))
    d = d.withColumn("pos", F.when(F.col("at") == 0, F.size("words") - 1).otherwise(F.col("at") - 1))
    # Not plain equalities, which would become join keys and cost a row of texts for each gram.
    same = F.coalesce(F.col("w0") == F.col("t0"), F.lit(False)) & ((F.col("tid") == 0) | (F.coalesce(F.col("w1") == F.col("t1"), F.lit(False)) & F.coalesce(F.col("w2") == F.col("t2"), F.lit(False))))
    hit = d.join(F.broadcast(templates(docs.sparkSession)), "h").where(same)
    doc, of = ["part", "doc_id", "th"], ["tid", "label", "exact", "length"]
    votes = hit.groupBy(*doc, *of, (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("at"), F.count("*").alias("hits"))
    w = Window.partitionBy(*doc, "tid").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > SLACK, F.lit(True)).cast("int")
    votes = votes.withColumn("apart", apart).withColumn("cluster", F.sum("apart").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = votes.groupBy(*doc, *of, "cluster").agg(
        F.min(F.col("diagonal") + F.array_min("at")).alias("first"),
        (F.max(F.col("diagonal") + F.array_max("at")) + K - 1).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        F.collect_list(F.when(F.col("exact") & (F.size("at") == F.col("length") - K + 1), F.col("diagonal"))).alias("places"),
        F.max("hits").alias("hits"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + K - 1)))))
    share = F.when(F.col("tid") > 0, F.least(F.lit(1.0), covered / F.col("length")))
    verified = (F.col("share") >= LEAST) & (F.col("last") - F.col("first") + 1 <= 1.5 * F.col("length") + SLACK)
    return merged.withColumn("share", share).where((F.col("tid") == 0) | (F.size("places") > 0) | (~F.col("exact") & verified)).drop("at", "cluster")


def summary(docs: DataFrame) -> DataFrame:
    """One row per row of docs: counts, labels and score."""
    s = spans(docs)
    labels = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    base, found = F.size("places") > 0, F.col("tid") > 0
    out = s.groupBy("part", "doc_id", "th").agg(
        F.max(F.when(F.col("tid") == 0, F.col("first"))).cast("long").alias("n_words"),
        F.sum(F.size("places")).cast("long").alias("n_base"),
        F.min(F.array_min("places")).cast("long").alias("first_word"),
        F.max(F.array_max("places")).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(found).alias("labels"),
        F.coalesce(F.max(F.when(base, F.lit(1.0)).otherwise(F.col("share"))), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("tid") == 0, F.col("hits"))).alias("copies"),
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("part", "th", "copies", "copy")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents"))
