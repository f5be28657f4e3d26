"""From judgements, predictions and metrics to the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from evalspark.operators import compare, forgetting, jsoneval, judge, textmetrics
from evalspark.prompts import DIMENSIONS
from evalspark.sources import write_jsonl, write_key_value, write_report, write_run

UNTAGGED = "untagged"


def json_evaluation(preds: DataFrame, labels: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Scores, metrics (of every label asked for) and error counts of JSON predictions."""
    scored = jsoneval.score_json(preds)
    return {
        "scores": scored,
        "metrics": jsoneval.json_metrics(scored, labels),
        "taxonomy": jsoneval.error_taxonomy(scored),
    }


def comparison(
    labels: Sequence[str], stats: DataFrame, text_metrics: DataFrame, json_metrics: DataFrame
) -> DataFrame:
    """One row per label with its judge, text and JSON results.

    ``stats`` are ``judge.judge_stats``, or ``judge.absent_stats`` where there is no judge file.
    """
    return compare.checkpoint_comparison(
        judge.label_frame(stats.sparkSession, labels),
        stats,
        text_metrics,
        json_metrics,
    )


def write_evaluation(
    out_dir: str,
    labels: Sequence[str],
    text_preds: DataFrame,
    json_preds: DataFrame,
    judgements: DataFrame | None,
    contested: DataFrame,
    first: str,
    second: str,
    token_embeddings: DataFrame | None = None,
    run_tag: str = "",
) -> None:
    """Write every table of an evaluation under ``out_dir``.

    ``judgements`` holds all pairs, or is None without a judge file; ``contested`` those of
    the labels ``first`` and ``second``, with the ``idx`` of their prompt.

    Metrics are written first and read back for the tables that combine them, so
    predictions are scored once. They are partitions of tables by run: the tag of this one is
    replaced, all others stay for ``forgetting.run_deltas``. Without a tag the run is UNTAGGED.
    """
    spark = contested.sparkSession
    metrics, tables = f"{out_dir}/metrics", f"{out_dir}/tables"
    run = run_tag.strip() or UNTAGGED

    def kept(df: DataFrame, name: str) -> DataFrame:
        write_run(df, f"{metrics}/{name}", run)
        return spark.read.schema(df.schema).parquet(f"{metrics}/{name}/run={run}")

    json_table = kept(jsoneval.json_metrics(jsoneval.score_json(json_preds), labels), "json_metrics")
    text_table = kept(textmetrics.text_metrics(text_preds, token_embeddings), "text_metrics")
    stats = (
        judge.absent_stats(spark, labels)
        if judgements is None
        else judge.judge_stats(judgements, labels)
    )
    stats_table = kept(stats, "judge_stats")

    write_report(
        json_table,
        f"{tables}/json_metrics.csv",
        [c for c in json_table.columns if c not in ("total", "error_taxonomy_counts")],
        run_tag,
    )
    write_report(
        json_table.selectExpr("checkpoint", "explode(error_taxonomy_counts) AS (category, count)"),
        f"{tables}/json_error_taxonomy.csv",
        ("checkpoint", "category", "count"),
        run_tag,
    )
    write_report(
        text_table, f"{tables}/text_metrics.csv", text_table.columns, run_tag
    )
    write_report(
        comparison(labels, stats_table, text_table, json_table),
        f"{tables}/comparison.csv",
        compare.COMPARISON_COLUMNS,
        run_tag,
    )
    write_report(
        judge.judge_summary(stats_table),
        f"{tables}/judge_summary.csv",
        ("checkpoint", "win_rate", "tie_rate", *(f"avg_{d}" for d in DIMENSIONS)),
        run_tag,
    )
    summary = forgetting.forgetting_summary(
        contested,
        text_preds,
        text_table,
        first,
        second,
        {name: f"{metrics}/{name}/run={run}" for name in ("json_metrics", "text_metrics")},
    )
    summary_path = f"{metrics}/forgetting_{first}_vs_{second}"
    write_jsonl(summary, summary_path)
    write_key_value(
        spark.read.schema(summary.schema).json(summary_path),
        f"{tables}/forgetting_summary.csv",
        run_tag,
    )
