"""Tables across checkpoints, and reports as key/value rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# --- fixed values ---------------------------------------------------------
COMPARISON_COLUMNS = (
    "checkpoint",
    "alpaca_judge_win_rate",
    "rougeL_f1",
    "bertscore_f1_avg",
    "json_validity_rate",
    "schema_compliance_rate",
    "exact_match_rate",
)
NO_SUMMARY = "no forgetting summary found"
# --------------------------------------------------------------------------


def join_metrics(labels: DataFrame, *metrics: DataFrame) -> DataFrame:
    """Metrics next to each label, blank where a checkpoint has none.

    Metrics tables hold one row per checkpoint; Spark picks the join by their size.
    """
    joined = labels
    for table in metrics:
        joined = joined.join(table, "checkpoint", "left")
    return joined


def checkpoint_comparison(
    labels: DataFrame, stats: DataFrame, text_metrics: DataFrame, json_metrics: DataFrame
) -> DataFrame:
    """Win rate, text and JSON metrics of every label, in label order."""
    return (
        join_metrics(
            labels,
            stats.select("checkpoint", F.col("win_rate").alias("alpaca_judge_win_rate")),
            text_metrics.select("checkpoint", "rougeL_f1", "bertscore_f1_avg"),
            json_metrics.select("checkpoint", *COMPARISON_COLUMNS[4:]),
        )
        .orderBy("position")
        .select(*COMPARISON_COLUMNS)
    )


def first_document(df: DataFrame, keys: Sequence[str], order_by: str = "idx") -> DataFrame:
    """The first record per key, in the order of a column that tells a key's records apart.

    The smallest value of each key meets the rows again, so that only first records are carried further.
    Records that share it are ranked by the hash of their content. A key where the column is always
    null has no record.
    """
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    first = df.groupBy(*(F.col(f"`{k}`").alias(n) for k, n in names.items()))
    first = first.agg(F.min(order_by).alias("_first"))
    same = F.col(f"`{order_by}`") == F.col("_first")
    for k, n in names.items():
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(n))
    met = df.join(first, same).drop("_first", *names.values())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(_content_hash(df)))
    return met.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _content_hash(df: DataFrame) -> Column:
    """A hash of all columns; maps and variants go by their JSON."""
    return F.xxhash64(
        *(F.to_json(F.col(f"`{c}`")) if t.startswith(("map", "variant")) else F.col(f"`{c}`") for c, t in df.dtypes)
    )


def prefer(sources: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Per key, the record of the first source that has one.

    Each source gives the keys that none before it has; sources hold one record per key.
    """
    found = sources[0]
    for source in sources[1:]:
        if keys:
            taken = found.select(*(F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)))
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
            rest = source.join(taken, same, "left_anti")
        else:
            rest = source.filter(~found.exists())
        found = found.unionByName(rest)
    return found


def _as_text(field: T.StructField) -> Column:
    nested = isinstance(field.dataType, (T.MapType, T.StructType, T.ArrayType))
    value = F.col(field.name)
    return F.to_json(value, {"ignoreNullFields": "false"}) if nested else value.cast("string")


def to_key_value(df: DataFrame) -> DataFrame:
    """A record as rows of key and value, nested values as JSON."""
    names = [f.name for f in df.schema]
    return df.select(*(_as_text(f).alias(f.name) for f in df.schema)).unpivot(
        [], names, "key", "value"
    )
