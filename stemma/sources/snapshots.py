"""Dated snapshots: the latest, or the latest before a date; folders and partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest(df: DataFrame, column: str, before: str | None = None) -> DataFrame:
    """One row with the largest value of a date column (text), optionally below a date; no rows if there is none."""
    d = df.where(F.col(column) < before) if before else df
    return d.agg(F.max(column).alias(column)).where(F.col(column).isNotNull())


def date_token(path) -> "F.Column":
    """The 8-digit date in a folder's name; null without one."""
    return F.nullif(F.regexp_extract(path, r"(?<!\d)(\d{8})(?!\d)[^/]*/?$", 1), F.lit(""))


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names below a folder of any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def latest_folder(spark: SparkSession, root: str, before: str | None = None, needs: tuple[str, ...] = ()) -> str | None:
    """The folder with the latest date token (below before) that holds all the files in needs."""
    import re

    dated = sorted((m[1], n) for n in folders(spark, root) if (m := re.search(r"(?<!\d)(\d{8})(?!\d)", n)) and (before is None or m[1] < before))
    for _, name in reversed(dated):
        if set(needs) <= set(folders(spark, f"{root}/{name}")):
            return f"{root}/{name}"
    return None
