import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """one(column function, *texts): what it makes of each text."""
    from pyspark.sql import functions as F

    def run(f, *texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r[0] for r in df.select(f(F.col("t")).alias("x"), "i").orderBy("i").select("x").collect()]

    return run
