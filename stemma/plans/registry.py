"""Queries by name, each with the SQL that must give the same rows (None where SQL can't say it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(map(sql_text, values)) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join(map(sql_text, values)) + ")"
