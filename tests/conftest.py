import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from evalspark import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("evalspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield prepare(session)
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate an expression over one text column and list the results."""

    def evaluate(values, build, schema="string"):
        from pyspark.sql import functions as F

        data = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(data, f"i int, v {schema}").repartition(1)
        rows = df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()
        return [r["out"] for r in rows]

    return evaluate
