"""CSV at the edges: declared columns, every value text, missing and empty the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

READ = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "mode": "FAILFAST"}
WRITE = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}


class HeaderMismatch(ValueError):
    pass


def check_header(actual, expected: list[str], path: str) -> None:
    """Names and order must be the declared ones."""
    if list(actual) != list(expected):
        raise HeaderMismatch(f"{path}: columns {list(actual)}, expected {list(expected)}")


def read(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns as text, nulls as empty text; with columns, the header must be exactly these."""
    df = spark.read.options(**READ).csv(path)
    if columns is not None:
        check_header(df.columns, columns, path)
    return df.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_optional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An empty table where the file is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return read(spark, path, columns)


def write(df: DataFrame, path: str, columns: list[str], order: list[str] | None = None) -> None:
    """Exactly the declared columns, missing ones empty, in files of a new folder, each with a header. With an order (and
    all columns after it, so that equal keys are in order too) the files' names are in it, and so are the rows in each."""
    have = set(df.columns)
    out = df.select([(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in columns])
    if order is not None:
        out = out.orderBy(*order, *[c for c in columns if c not in order])
    out.write.mode("overwrite").options(**WRITE).csv(path)


def join_files(spark: SparkSession, path: str, target: str) -> int:
    """One file of the files in a folder, in the order of their names, with one header; returns its size. A stream of bytes
    through the driver, no rows: for reports and small releases."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    p, t = hadoop.Path(path), hadoop.Path(target)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(str(s.getPath()) for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    out = t.getFileSystem(spark._jsc.hadoopConfiguration()).create(t, True)
    size = 0
    for k, name in enumerate(parts):
        file, head = fs.open(hadoop.Path(name)), k > 0
        while len(block := bytes(file.readNBytes(1 << 20))):
            if head:
                block, head = block.split(b"\n", 1)[1] if b"\n" in block else b"", False
            out.write(bytearray(block))
            size += len(block)
        file.close()
    out.close()
    return size


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
