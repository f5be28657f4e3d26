"""Pairwise judging: what to compare, and what the verdicts add up to."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evalspark import prompts
from evalspark.functions import text
from evalspark.operators.jsoneval import rate
from evalspark.prompts import DIMENSIONS

# --- fixed values ---------------------------------------------------------
# Winner letters, lower-cased.
FIRST, SECOND, TIES = "a", "b", ("tie", "ties")
PAIR_PROMPT_ID = "alpaca_eval_%05d"
JSON_PROMPT_ID = "json_eval_%05d"
# --------------------------------------------------------------------------


def label_frame(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """The caller's labels with their position: checkpoint, position."""
    array = F.array(*(F.lit(label) for label in labels))
    return spark.range(1).select(F.posexplode(array).alias("position", "checkpoint"))


def winner_letter() -> Column:
    """The winner in lower case; empty for none."""
    return F.lower(text.or_empty(F.col("winner")))


# --- plan ---------------------------------------------------------------------


def comparison_plan(preds: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per prompt and pair of checkpoints, in the order of ``labels``.

    Rows meet on ``id`` alone: a prompt's outputs come together once, unsorted, and its
    pairs are read off, so no prompt is joined to itself. A pair exists where
    both checkpoints have an output; two outputs of one checkpoint for one prompt are an error.
    """
    position = F.array_position(F.lit(list(labels)), F.col("checkpoint")).alias("position")
    together = (
        preds.filter(F.col("checkpoint").isin(*labels))
        .groupBy("id")
        .agg(F.collect_list(F.struct(position, "instruction", "input", "prediction")).alias("_rows"))
    )
    rows = F.col("_rows")
    seen = F.transform(rows, lambda r: r["position"])
    twice = F.raise_error(
        F.format_string("id %s has two outputs of one checkpoint", F.col("id").cast("string"))
    )
    checked = together.withColumn(
        "_rows", F.when(F.size(F.array_distinct(seen)) < F.size(seen), twice).otherwise(rows)
    )
    first = F.array_min("_rows")  # of the first label; positions differ

    def of(position: int) -> Column:
        return F.get(F.filter("_rows", lambda r: r["position"] == position), F.lit(0))

    wide = checked.select(
        "id",
        first["instruction"].alias("instruction"),
        first["input"].alias("input"),
        *(of(i + 1).alias(f"_{i}") for i in range(len(labels))),
    )
    # Adjacent checkpoints come first, then those further apart.
    order = sorted(combinations(range(len(labels)), 2), key=lambda p: (p[1] - p[0], p[0]))
    pairs = F.array(
        *(
            F.when(
                F.col(f"_{i}").isNotNull() & F.col(f"_{j}").isNotNull(),
                F.struct(
                    F.lit(labels[i]).alias("checkpoint_a"),
                    F.lit(labels[j]).alias("checkpoint_b"),
                    F.col(f"_{i}.prediction").alias("response_a"),
                    F.col(f"_{j}.prediction").alias("response_b"),
                ),
            )
            for i, j in order
        )
    )
    return wide.select(
        F.col("id").alias("idx"), "instruction", "input", F.inline(F.array_compact(pairs))
    )


def apply_swap(pairs: DataFrame) -> DataFrame:
    """Exchange the two sides of the pairs marked ``swapped``."""

    def side(this: str, that: str) -> Column:
        return F.when(F.col("swapped"), F.col(that)).otherwise(F.col(this))

    return pairs.withColumns(
        {
            "checkpoint_a": side("checkpoint_a", "checkpoint_b"),
            "checkpoint_b": side("checkpoint_b", "checkpoint_a"),
            "response_a": side("response_a", "response_b"),
            "response_b": side("response_b", "response_a"),
        }
    )


def pairwise_prompt(pairs: DataFrame, template: str = prompts.PAIRWISE_JUDGE) -> DataFrame:
    names = ("instruction", "input", "response_a", "response_b", "checkpoint_a", "checkpoint_b")
    return pairs.withColumn("prompt", text.fill(template, {n: F.col(n) for n in names}))


def json_judge_prompt(preds: DataFrame, template: str = prompts.JSON_JUDGE) -> DataFrame:
    names = ("instruction", "input", "prediction", "reference", "checkpoint")
    return preds.withColumn("prompt", text.fill(template, {n: F.col(n) for n in names}))


def teacher_prompt(pool: DataFrame, template: str = prompts.TEACHER) -> DataFrame:
    names = ("json_example", "instruction", "input")
    filled = {n: F.col(n) for n in names}
    filled["json_example"] = F.coalesce("json_example", F.lit("{}"))
    return pool.withColumn("prompt", text.fill(template, filled))


# --- verdicts ------------------------------------------------------------------


def complete_judgements(
    verdicts: DataFrame, plan: DataFrame, trust_model_labels: bool = False
) -> DataFrame:
    """Judge answers with prompt id, labels and swap flag.

    ``verdicts`` holds idx and pair columns of the plan besides the model's own
    prompt_id, checkpoint_a and checkpoint_b (null when it gave none). By default
    ids and labels come from the plan, swap included, and the model's are kept as
    ``raw_*``, a ``swapped`` of its own included. With ``trust_model_labels`` the model's win, and
    the labels that fill its gaps ignore the swap. A key the model wrote with null counts as a
    gap.
    """
    given = ("prompt_id", "checkpoint_a", "checkpoint_b")
    raw = verdicts.withColumnsRenamed({c: f"raw_{c}" for c in (*given, "swapped")})
    joined = raw.join(
        plan.select("idx", "first", "second", "swapped"), ["idx", "first", "second"]
    )
    planned_id = F.format_string(PAIR_PROMPT_ID, "idx")
    if trust_model_labels:
        ids = (
            F.coalesce("raw_prompt_id", planned_id),
            F.coalesce("raw_checkpoint_a", "first"),
            F.coalesce("raw_checkpoint_b", "second"),
        )
    else:
        swapped = F.col("swapped")
        ids = (
            planned_id,
            F.when(swapped, F.col("second")).otherwise(F.col("first")),
            F.when(swapped, F.col("first")).otherwise(F.col("second")),
        )
    if trust_model_labels and "raw_swapped" in joined.columns:
        joined = joined.withColumn("swapped", F.coalesce("raw_swapped", "swapped"))
    return joined.withColumns(dict(zip(given, ids)))


def complete_json_judgements(verdicts: DataFrame) -> DataFrame:
    """JSON judge answers, with missing ids and labels from the prompt they answer.

    ``verdicts`` holds idx and asked_checkpoint besides the model's own columns.
    """
    return verdicts.withColumns(
        {
            "prompt_id": F.coalesce("prompt_id", F.format_string(JSON_PROMPT_ID, "idx")),
            "checkpoint": F.coalesce("checkpoint", "asked_checkpoint"),
        }
    )


def for_labels(judgements: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Judgements between two of the caller's labels; the filter reaches the scan."""
    return judgements.filter(
        F.col("checkpoint_a").isin(*labels) & F.col("checkpoint_b").isin(*labels)
    )


def judge_stats(
    judgements: DataFrame, labels: Sequence[str], dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """Tallies, rates and score averages per checkpoint, one row for every label.

    A judgement counts for both of its checkpoints. A winner that is none of the
    known letters adds to the comparisons only. Averages divide by all
    comparisons of a checkpoint, with absent scores as 0.
    """
    sums = pair_sums(for_labels(judgements, labels), dimensions)
    return stats_of(sums, labels, dimensions)


def pair_sums(
    judgements: DataFrame, dimensions: Sequence[str] = DIMENSIONS, by: Sequence[str] = ()
) -> DataFrame:
    """What the statistics are made of, per ordered pair of checkpoints and the columns ``by``.

    Counts of wins of either side, ties and judgements, and sums of scores: they can be added up.
    """
    winner = winner_letter()
    return judgements.groupBy(*by, "checkpoint_a", "checkpoint_b").agg(
        F.count_if(winner == FIRST).alias("won_a"),
        F.count_if(winner == SECOND).alias("won_b"),
        F.count_if(winner.isin(*TIES)).alias("tied"),
        F.count(F.lit(1)).alias("n"),
        *(
            F.coalesce(F.sum(F.col(f"response_{side}_scores")[d]), F.lit(0.0)).alias(f"{side}_{d}")
            for side in ("a", "b")
            for d in dimensions
        ),
    )


def stats_of(
    sums: DataFrame, labels: Sequence[str], dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """``judge_stats`` of the labels, from ``pair_sums`` of any parts of their judgements."""

    def side(this: str, that: str) -> Column:
        return F.struct(
            F.col(f"checkpoint_{this}").alias("checkpoint"),
            F.col(f"won_{this}").alias("won"),
            F.col(f"won_{that}").alias("lost"),
            "tied",
            "n",
            *(F.col(f"{this}_{d}").alias(d) for d in dimensions),
        )

    total = F.sum("n")
    tallied = (
        for_labels(sums, labels)
        .select(F.inline(F.array(side("a", "b"), side("b", "a"))))
        .groupBy("checkpoint")
        .agg(
            F.sum("won").alias("wins"),
            F.sum("lost").alias("losses"),
            F.sum("tied").alias("ties"),
            total.alias("total_compares"),
            *(rate(F.sum(d), total).alias(f"avg_{d}") for d in dimensions),
        )
    )
    counts = ("wins", "losses", "ties", "total_compares")
    complete = label_frame(sums.sparkSession, labels).join(
        F.broadcast(tallied), "checkpoint", "left"  # at most one row per label
    )
    filled = complete.select(
        "checkpoint",
        "position",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        *(F.coalesce(f"avg_{d}", F.lit(0.0)).alias(f"avg_{d}") for d in dimensions),
    )
    return filled.withColumns(
        {
            "win_rate": rate(F.col("wins"), F.col("wins") + F.col("losses")),
            "tie_rate": rate(F.col("ties"), F.col("total_compares")),
            "loss_rate": rate(F.col("losses"), F.col("total_compares")),
        }
    )


def absent_stats(
    spark: SparkSession, labels: Sequence[str], dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """The statistics where no judge file was found: counts of 0, rates and averages blank."""
    blank = F.lit(None).cast("double")
    return label_frame(spark, labels).select(
        "checkpoint",
        "position",
        *(F.lit(0).cast("bigint").alias(c) for c in ("wins", "losses", "ties", "total_compares")),
        *(blank.alias(f"avg_{d}") for d in dimensions),
        *(blank.alias(c) for c in ("win_rate", "tie_rate", "loss_rate")),
    )


def judge_summary(stats: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Report columns of the judge statistics, in label order."""
    return stats.orderBy("position").select(
        "checkpoint", "win_rate", "tie_rate", *(f"avg_{d}" for d in dimensions)
    )
