"""Metrics kept up to date as files come, change and go, without scoring the others again.

A store is a folder with two tables that are only ever added to. ``partials`` holds the sums that metrics
are made of, one row per file and group; ``ledger`` holds each file's path, modification time and
length, and whether it was there. Both are partitioned by the number of the update. A file counts with the
sums of its latest ledger row, so replacing a file takes its old sums back, and removing it all of
them. The ledger of an update is written last: an update that fails on the way is as if it had not been.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from evalspark import schemas
from evalspark.operators import jsoneval, judge, textmetrics
from evalspark.prompts import DIMENSIONS
from evalspark.sources import list_files, literal, read_found_parquet

FILE = "source_file"
_LEDGER = f"{FILE} STRING, modified TIMESTAMP, length BIGINT, present BOOLEAN, update BIGINT"


class Kind(NamedTuple):
    """A kind of file: its rows, the sums taken per file, and the schema of these."""

    rows: str
    sums: Callable[[DataFrame], DataFrame]
    partials: str


_SCORES = ", ".join(f"{side}_{d} DOUBLE" for side in ("a", "b") for d in DIMENSIONS)

#: Predictions scored as JSON.
JSON = Kind(
    schemas.PREDICTIONS,
    lambda rows: jsoneval.metric_sums(jsoneval.score_json(rows), FILE),
    f"{FILE} STRING, checkpoint STRING, total BIGINT, valid BIGINT, compliant BIGINT, exact BIGINT,"
    " f1_sum DOUBLE, f1_rows BIGINT, extraction BIGINT, label_counts ARRAY<BIGINT>",
)
#: Predictions scored as free text.
TEXT = Kind(
    schemas.PREDICTIONS,
    lambda rows: textmetrics.text_sums(rows, by=(FILE,)),
    f"{FILE} STRING, checkpoint STRING, samples BIGINT, n_tokens BIGINT, completed BIGINT,"
    " rouge1_f1 DOUBLE, rouge2_f1 DOUBLE, rougeL_f1 DOUBLE",
)
#: Pairwise judgements.
JUDGEMENTS = Kind(
    schemas.PAIR_JUDGEMENTS,
    lambda rows: judge.pair_sums(rows, by=(FILE,)),
    f"{FILE} STRING, checkpoint_a STRING, checkpoint_b STRING, won_a BIGINT, won_b BIGINT, tied BIGINT,"
    f" n BIGINT, {_SCORES}",
)


def _ledger(spark: SparkSession, store: str) -> DataFrame:
    return read_found_parquet(spark, f"{store}/ledger", _LEDGER)


def _latest(ledger: DataFrame) -> DataFrame:
    """Each file's row of its last update."""
    last = ledger.groupBy(FILE).agg(F.max("update").alias("update"))
    return ledger.join(last, [FILE, "update"])


def current_files(spark: SparkSession, store: str) -> DataFrame:
    """The files that count: source_file, modified, length, update."""
    return _latest(_ledger(spark, store)).filter("present").drop("present")


def changes(spark: SparkSession, kind: Kind, paths: str | Sequence[str], store: str) -> DataFrame:
    """What has happened to the files since the last update: source_file, path, modified, length, change.

    ``change`` is new, replaced (another time or length) or gone. File names only are read.
    """
    known = current_files(spark, store).select(
        FILE, F.col("modified").alias("_modified"), F.col("length").alias("_length")
    )
    there = list_files(spark, paths).withColumnRenamed("file", FILE)
    both = there.join(known, FILE, "full")
    same = F.col("modified").eqNullSafe(F.col("_modified")) & F.col("length").eqNullSafe(F.col("_length"))
    change = F.when(F.col("modified").isNull(), "gone").when(F.col("_modified").isNull(), "new").otherwise("replaced")
    return both.filter(~same).select(FILE, "path", "modified", "length", change.alias("change"))


def update(spark: SparkSession, kind: Kind, paths: str | Sequence[str], store: str) -> dict[str, int]:
    """Bring a store up to date with the files under ``paths``; how many were new, replaced or gone.

    Only files that are new or replaced are read. Updates of one store follow each other.
    """
    found = changes(spark, kind, paths, store).collect()  # one row per changed file
    if not found:
        return {}
    number = (_ledger(spark, store).agg(F.max("update")).first()[0] or 0) + 1
    changed = [literal(r["path"]) for r in found if r["change"] != "gone"]
    if changed:
        rows = spark.read.schema(kind.rows).option("mode", "FAILFAST").json(changed)
        rows = rows.withColumn(FILE, F.col("_metadata.file_path"))
        part = f"{store}/partials/update={number}"
        kind.sums(rows).write.mode("overwrite").parquet(part)
    entries = [(r[FILE], r["modified"], r["length"], r["change"] != "gone") for r in found]
    ledger = spark.createDataFrame(entries, _LEDGER.rpartition(",")[0])
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{store}/ledger/update={number}")
    return {c: sum(r["change"] == c for r in found) for c in sorted({r["change"] for r in found})}


def partials(spark: SparkSession, kind: Kind, store: str) -> DataFrame:
    """The sums of the files that count, each as of its last update."""
    kept = read_found_parquet(spark, f"{store}/partials", f"{kind.partials}, update BIGINT")
    return kept.join(current_files(spark, store).select(FILE, "update"), [FILE, "update"], "left_semi")


def json_metrics(spark: SparkSession, store: str, labels: Sequence[str] | None = None) -> DataFrame:
    """``jsoneval.json_metrics`` of all files that count."""
    sums = jsoneval.add_metric_sums(partials(spark, JSON, store))
    wanted = sums if labels is None else sums.filter(F.col("checkpoint").isin(*labels))
    return jsoneval.metrics_table(wanted, labels)


def error_taxonomy(spark: SparkSession, store: str) -> DataFrame:
    return jsoneval.taxonomy_of(jsoneval.add_metric_sums(partials(spark, JSON, store)))


def text_metrics(spark: SparkSession, store: str) -> DataFrame:
    """``textmetrics.text_metrics`` of all files that count, without embedding F1."""
    sums = textmetrics.add_text_sums(partials(spark, TEXT, store))
    return textmetrics.text_metrics_of(sums).withColumn("bertscore_f1_avg", F.lit(None).cast("double"))


def judge_stats(spark: SparkSession, store: str, labels: Sequence[str]) -> DataFrame:
    """``judge.judge_stats`` of all files that count."""
    return judge.stats_of(partials(spark, JUDGEMENTS, store), labels)
