"""Evaluation tables laid out for the jobs that read them: by run, and by prompt.

Runs of an evaluation are partitions of one table, so that a run is rewritten without touching the
others and read without listing them. Tables that meet on a prompt's id are bucketed and sorted
by it, so that joins and aggregates on the id need no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

RUN = "run"
#: Prompts of one bucket; a task sorts some rows of each.
BUCKET_PROMPTS = 80_000


def _tag(run: str) -> str:
    if not re.fullmatch(r"[\w.-]+", run, re.ASCII):
        raise ValueError(f"a run tag is letters, digits, dots, dashes and underscores: {run!r}")
    return run


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Put ``df`` in place of one run's rows; the other runs' files stay as they are.

    A run without rows takes the place of the old one too.
    """
    df.drop(RUN).write.mode("overwrite").parquet(f"{path}/{RUN}={_tag(run)}")


def write_runs(df: DataFrame, path: str) -> None:
    """Replace every run that ``df`` has rows of, by its column ``run``, in one job."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(RUN).parquet(path)


def read_runs(
    spark: SparkSession, path: str, schema: str, runs: Sequence[str] | None = None
) -> DataFrame:
    """A table of runs with its column ``run``; only the files of the runs asked for are read.

    A run that was never written has no rows.
    """
    table = spark.read.schema(f"{schema}, {RUN} STRING").parquet(path)
    return table if runs is None else table.filter(F.col(RUN).isin(*runs))


def bucket_count(prompts: int, least: int = 8) -> int:
    """Buckets for tables of so many prompts, a bounded number of them in each.

    Tables that meet get theirs from the same number.
    """
    return max(least, -(-prompts // BUCKET_PROMPTS))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as a table of ``buckets`` files, each with its share of the keys in order.

    Tables that are to be joined on their keys need the same number of buckets and keys of one type. A
    bucket is read by one task, so their number follows the size of the data and the skew of its keys: a
    prompt's rows are few, whatever the number of prompts.
    """
    dealt = df.repartition(buckets, key)  # the buckets' own hash: every task writes one file
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)
