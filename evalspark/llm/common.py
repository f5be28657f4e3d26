"""Helpers the training-data operators share: session options, tables, lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evalspark.session import prepare, shared_dir

#: Bytes of one Arrow batch. Tasks hold a few multiples of it in numpy arrays.
BATCH_BYTES = "16m"


def ready(spark: SparkSession) -> SparkSession:
    """Set the runtime options of these operators; call before building a query."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    # A step's shuffle files go once its result is written; nothing reads them again.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the cluster's shared scratch space."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that read this table,
    and every later use sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
