"""What the operators of this subpackage share: table access, checkpoints, batches of texts, caches of Python workers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast: pick(df, doc_id="bigint"). Extra columns, whatever their names, are gone after it."""
    return df.select(*[df[c].cast(kind).alias(c) for c, kind in columns.items()])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where the setting is missing, a temporary one, but only in local mode: on a
    cluster, executors and driver would each see their own."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = f"{tempfile.gettempdir()}/stemma-checkpoints"
    sc.setCheckpointDir(root)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read from there: its lineage ends, a lost executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path that this job made."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop(df: DataFrame) -> None:
    """Deletes what cut wrote for df, which nothing may read any more."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        remove(df.sparkSession, file.get())


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, like this one."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def let(value: Column, body) -> Column:
    """body(value) with value computed once for a row, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


_caches: list = []


def kept(cache):
    """Registers a cache (anything with clear()) of a Python worker."""
    _caches.append(cache)
    return cache


def only(cache) -> None:
    """Empties the other operators' caches: workers are used again by later stages, and their memory adds up."""
    for c in _caches:
        if c is not cache:
            c.clear()


#: Rows that reach a Python worker at once; a batch of Spark's default size can hold a gigabyte of long texts.
BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Sets the session's batch size for Python workers, unless the user has set one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:
        spark.conf.set(key, str(BATCH))


def map_texts(docs: DataFrame, work: Callable[[], Callable[[list], dict]], schema: str) -> DataFrame:
    """doc_id as it is and, for each row, what work()'s function makes of the texts of a batch: lists by column name.
    Arrow batches, so that a null id doesn't turn the others into floating-point numbers."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind = _parse_datatype_string("doc_id bigint, " + schema)
    assert isinstance(kind, StructType)
    fields = to_arrow_schema(kind)

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = work()
        for b in batches:
            got = f(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(got[x.name], x.type) for x in fields if x.name != "doc_id"]], schema=fields)

    return pick(docs, doc_id="bigint", text="string").mapInArrow(run, kind)
