"""Logs of calls made to a model, reduced to the answers that count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions import jsonx, text


def _first(attempt: Column, condition: Column) -> Column:
    """Smallest attempt number that meets a condition."""
    return F.min(F.when(condition, attempt))


def _with_text(calls: DataFrame, accepted: DataFrame) -> DataFrame:
    """The answers of accepted attempts.

    Both sides come from one shuffle of ``calls`` by prompt. The accepted numbers make the hash table, so no
    text is sorted or put into an aggregate.
    """
    texts = calls.filter("usable").select("idx", "attempt", "text")
    return texts.join(accepted.hint("shuffle_hash"), ["idx", "attempt"]).select("idx", "attempt", "text")


def accept_attempts(
    log: DataFrame, max_retries: int = 4, max_invalid_retries: int = 1
) -> DataFrame:
    """Accepted answer per prompt: idx, attempt, text.

    API errors use up ``max_retries``; the first real answer ends that phase and
    is taken when it is valid JSON. Otherwise up to ``max_invalid_retries``
    further calls follow, where any error fails the prompt. Prompts without an
    accepted answer have no row.

    ``attempt`` counts from 0 without gaps, and idx and attempt name a call. Attempts past both
    budgets cannot be accepted, so they are dropped before the shuffle; what is left per prompt is
    bounded by the budgets, which are at most 62 together.
    """
    most = max_retries + max_invalid_retries
    if most > 62:
        raise ValueError("the budgets are at most 62 together")
    status, attempt = F.col("status"), F.col("attempt")
    usable = F.when(status == "ok", jsonx.is_valid(F.col("text"))).otherwise(False)
    calls = (
        log.filter(attempt.between(0, most))
        .withColumn("usable", usable)
        .select("idx", "attempt", "status", "usable", F.when(F.col("usable"), F.col("text")).alias("text"))
        .repartition("idx")
    )
    one = F.lit(1).cast("bigint")
    bit = F.call_function("shiftleft", one, attempt)
    reduced = calls.groupBy("idx").agg(
        _first(attempt, status != "api_error").alias("answered"),
        _first(attempt, F.col("usable")).alias("attempt"),
        F.bit_or(F.when(status != "ok", bit).otherwise(0)).alias("failed"),
    )
    answered = F.col("answered")
    within = (answered <= max_retries) & (attempt <= answered + max_invalid_retries)
    # Calls that failed from the first answer on, up to the accepted one.
    between = F.call_function("shiftleft", one, attempt) - F.call_function("shiftleft", one, answered)
    accepted = reduced.filter(within & (F.col("failed").bitwiseAND(between) == 0))
    return _with_text(calls, accepted.select("idx", "attempt"))


def accept_judge_attempts(log: DataFrame, max_retries: int = 3) -> DataFrame:
    """First parsed object per prompt: idx, attempt, text, verdict (VARIANT).

    Empty texts, texts without an object and API errors are retried; any other
    error ends the prompt. Prompts without a verdict have no row. idx and attempt name a call.
    """
    status, attempt = F.col("status"), F.col("attempt")
    found = F.when(status == "ok", jsonx.parse_object(F.col("text"))["error"].isNull())
    calls = (
        log.filter(attempt <= max_retries)
        .withColumn("usable", F.coalesce(found, F.lit(False)))
        .select("idx", "attempt", "status", "usable", F.when(F.col("usable"), F.col("text")).alias("text"))
        .repartition("idx")
    )
    reduced = calls.groupBy("idx").agg(
        _first(attempt, F.col("usable")).alias("attempt"),
        _first(attempt, status == "error").alias("stopped"),
    )
    in_time = F.col("stopped").isNull() | (attempt < F.col("stopped"))
    answers = _with_text(calls, reduced.filter(attempt.isNotNull() & in_time).select("idx", "attempt"))
    return answers.withColumn("verdict", jsonx.parse_object(F.col("text"))["value"])


def pending(prompts: DataFrame, accepted: DataFrame, key: str = "idx") -> DataFrame:
    """Prompts that still have no accepted answer."""
    return prompts.join(accepted.select(key), key, "left_anti")


def assemble_predictions(rows: DataFrame, preds: DataFrame, checkpoint: str) -> DataFrame:
    """Dataset rows with one checkpoint's output; rows without output get ""."""
    outputs = preds.select("idx", F.col("prediction"))

    def column(name: str) -> Column:
        return text.or_empty(F.col(name)) if name in rows.columns else F.lit("")

    return rows.join(outputs, "idx", "left").select(
        F.col("idx").alias("id"),
        F.lit(checkpoint).alias("checkpoint"),
        column("instruction").alias("instruction"),
        column("input").alias("input"),
        column("task_type").alias("task_type"),
        text.or_empty(F.col("prediction")).alias("prediction"),
        column("output").alias("reference"),
    )
