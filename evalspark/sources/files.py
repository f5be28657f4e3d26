"""JSON Lines tables and CSV reports on any file system Spark can reach."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from evalspark import schemas
from evalspark.operators.compare import NO_SUMMARY, to_key_value


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """JSON Lines under an explicit schema; a malformed line fails the job.

    Blank lines are skipped. Paths that do not exist are left out; if none of them exists,
    the table is empty.
    """
    found = _read_found(spark, [path] if isinstance(path, str) else list(path), schema)
    return spark.createDataFrame([], schema) if found is None else found


def _read_found(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame | None:
    """The files that exist as one table, or nothing."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    try:
        return reader.json(list(paths)) if paths else None
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    if len(paths) == 1:
        return None
    parts = [p for p in (_read_found(spark, [one], schema) for one in paths) if p is not None]
    return reduce(DataFrame.union, parts) if parts else None


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The files under paths or patterns: file, path, modified, length; none where none exists.

    Spark lists them, empty ones excepted, and no content is read. ``file`` is what ``_metadata.file_path`` says of their rows,
    ``path`` is what a reader takes.
    """
    schema = "file STRING, path STRING, modified TIMESTAMP, length BIGINT"
    parts = []
    for one in [path] if isinstance(path, str) else path:
        try:
            parts.append(spark.read.format("binaryFile").load(one).select("_metadata.file_path", "path", "modificationTime", "length"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    found = reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)
    return found.toDF("file", "path", "modified", "length").distinct()


def literal(path: str) -> str:
    """A path that readers don't take for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_found_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files under an explicit schema; an empty table where the folder does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], schema)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines with every field of every row, nulls included."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    """Instruction rows from parquet or, for any other suffix, JSON Lines."""
    if path.rstrip("/").endswith(".parquet"):
        columns = [c.split()[0] for c in schemas.INSTRUCTIONS.split(", ")]
        return spark.read.parquet(path).select(*columns)
    return read_jsonl(spark, path, schemas.INSTRUCTIONS)


def find_judgements(spark: SparkSession, glob: str) -> DataFrame | None:
    """All judgement files that match a pattern, with the file each row is from; None without any."""
    found = _read_found(spark, [glob], schemas.PAIR_JUDGEMENTS)
    if found is None:
        return None
    return found.withColumn("source_file", F.col("_metadata.file_name"))


def read_judgements(spark: SparkSession, glob: str) -> DataFrame:
    """The same, as an empty table where no file matches."""
    found = find_judgements(spark, glob)
    if found is not None:
        return found
    return spark.createDataFrame([], f"{schemas.PAIR_JUDGEMENTS}, source_file STRING")


def tagged(path: str, run_tag: str = "") -> str:
    """``path`` with the tag of a run as a suffix before its extension."""
    tag = run_tag.strip()
    if not tag:
        return path
    folder, slash, name = path.rpartition("/")
    stem, dot, extension = name.rpartition(".")
    named = f"{stem}_{tag}.{extension}" if dot else f"{name}_{tag}"
    return f"{folder}{slash}{named}"


def write_report(df: DataFrame, path: str, columns: Sequence[str], run_tag: str = "") -> str:
    """CSV with a header and fixed columns; returns the path written.

    A report has one row per checkpoint or label, so its file is a single one.
    """
    target = tagged(path, run_tag)
    report = df.select(*columns).coalesce(1)
    writer = report.write.mode("overwrite").option("header", "true").option("emptyValue", "")
    writer.option("escape", '"').csv(target)  # quotes in a value are doubled
    return target


def write_key_value(df: DataFrame, path: str, run_tag: str = "") -> str:
    """Summary records as key/value CSV, or a line of text when there is none.

    Several records follow each other; each names its checkpoints in its first keys.
    """
    target = tagged(path, run_tag)
    if df.isEmpty():
        note = df.sparkSession.range(0, 1, 1, 1).select(F.lit(NO_SUMMARY).alias("value"))
        note.write.mode("overwrite").text(target)
        return target
    return write_report(to_key_value(df), target, ("key", "value"))
