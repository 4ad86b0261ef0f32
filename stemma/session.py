"""Session settings, and the cut between the stages of a long plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"}


def session(**more) -> SparkSession:
    return SparkSession.builder.config(map=SETTINGS | more).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(root or f"{tempfile.gettempdir()}/stemma-checkpoints")
    return sc._jsc.sc().getCheckpointDir().get()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read from there. Stages that several outputs use are computed once,
    and what is built on them is planned by itself: predicates over long chains of expressions would otherwise be pushed
    down through all of them, and grow at each step."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
