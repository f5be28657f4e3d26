"""From raw instructions, or a prompt pool and its call log, to train and eval sets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from evalspark.operators import attempts, jsoneval, prep


def instruction_dataset(raw: DataFrame, key: str, fraction: float = 0.95, seed: int = 42) -> DataFrame:
    """Cleaned instruction rows with their side of the split."""
    return prep.split_fraction(prep.normalise_instructions(raw), key, fraction, seed)


def json_dataset(
    pool: DataFrame,
    log: DataFrame,
    eval_size: int,
    train_cap: int | None = None,
    seed: int = 42,
    by: str = "content",
) -> DataFrame:
    """Accepted teacher answers for a pool, validated and split.

    ``pool`` has idx besides the prompt columns; ``log`` is its call log.
    """
    accepted = attempts.accept_attempts(log).select("idx", "text")
    records = prep.teacher_records(
        pool.select("idx", "instruction", "input", "task_type").join(accepted, "idx")
    )
    return prep.split_capped(
        jsoneval.valid_rows(records), "idx", eval_size, train_cap, seed, by
    )
