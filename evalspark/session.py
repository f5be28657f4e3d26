"""Session settings the library relies on, and its scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options that queries need; call before building them."""
    # A repeated key in an object keeps its last value instead of failing to parse.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Parsing and aligning texts costs far more per byte than starting a task does,
    # so small shuffles keep their cores busy instead of merging into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    # Texts and vectors differ in size by orders of magnitude: bound batches by bytes.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    # Rows go to their partition's open file; sorting them by partition first would hold a task's whole share.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "32")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The scratch folder that every executor reaches.

    That is ``spark.checkpoint.dir``; where it is unset, the session's checkpoint folder, and
    else a folder beside the warehouse's tables. On a cluster a warehouse on a local disk is an error: every
    executor would write to its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith("file:") or "://" not in warehouse
    if local and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there, and every use sees the same rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/evalspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
