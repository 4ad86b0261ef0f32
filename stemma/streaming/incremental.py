"""Incremental work over a keyed state: batches of a table one after another, and file streams with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.state import State, changed


def batches(state: State, rows: DataFrame, column: str, order: list) -> int:
    """Lays the rows over the state, a batch for each value of a column in its order: within a batch the last row of a key
    in this order counts, a later batch replaces what earlier ones left. Returns the number of batches. The driver sees
    the column's values only."""
    values = sorted(r[0] for r in rows.select(column).distinct().collect())
    for v in values:
        state.upsert(rows.where(F.col(column) == F.lit(v)), order)
        state.clean()
    return len(values)


def files(spark: SparkSession, source: str, schema, at_once: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", at_once).parquet(source)


def drained(stream: DataFrame, each: Callable[[DataFrame, int], object], checkpoint: str) -> None:
    """Gives every batch that the checkpoint hasn't seen to each, then ends."""
    stream.writeStream.foreachBatch(lambda batch, number: each(batch, number) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_stream(spark: SparkSession, source: str, schema, state: State, checkpoint: str, order: list) -> State:
    """Upserts the files below source that the checkpoint hasn't seen. A batch that is repeated after a failure leaves the
    same rows; after a run without new files the state is what it was."""
    drained(files(spark, source, schema), lambda batch, _: state.upsert(batch, order), checkpoint)
    return state


def insert_stream(spark: SparkSession, source: str, schema, state: State, checkpoint: str, order: list) -> State:
    """The same for keys that are to keep the first row ever seen: the state remembers them for good, not as long as a
    watermark allows."""
    drained(files(spark, source, schema), lambda batch, _: state.insert(batch, order), checkpoint)
    return state


def progress_stream(spark: SparkSession, summary: Callable[[], DataFrame], send: Callable[[str], None], every: str = "300 seconds"):
    """A running query that looks at a one-row summary at intervals and sends it as JSON when it differs from the last one."""
    last: dict[str, str | None] = {"digest": None}

    def look(_batch: DataFrame, _number: int) -> None:
        now = summary()
        digest, new = changed(now, last["digest"])
        if new:
            send(now.select(F.to_json(F.struct("*"))).first()[0])
            last["digest"] = digest

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.foreachBatch(look).trigger(processingTime=every).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events per type and window, for a stream or a table; rows later than the watermark are dropped from a stream."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))
