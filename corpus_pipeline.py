"""The corpus pipeline: quality, toxicity, near-duplicates, secrets, packing; each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stemma.llm import packing, quality_classifier, secret_scan, simhash_dedup, toxicity
from stemma.llm.common import remove, scratch, table

#: Each takes (spark, docs, sf_dir). All but the last return the columns of docs: documents that the classifiers reject
#: go, one document of each group of near copies stays, secrets are masked; the last returns the packed pieces.
STAGES = [
    ("quality", quality_classifier.keep_good),
    ("toxicity", toxicity.drop_toxic),
    ("near_duplicates", simhash_dedup.keep_first),
    ("secrets", secret_scan.redact),
    ("packing", packing.pack_stage),
]

#: Learned models and hashing decide which rows stay; SQL can't express these stages (tests hold them against plain Python).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents, each stage's rows written as Parquet to the shared checkpoint folder and read again; what a
    stage has read is deleted once its own rows are written. The last one's rows stay, for the caller to read."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
