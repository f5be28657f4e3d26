"""What the second checkpoint lost or gained against the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions.text import CATEGORY_KEYWORDS, instruction_category, or_empty
from evalspark.operators.jsoneval import rate
from evalspark.operators.judge import FIRST, SECOND, TIES, winner_letter


def _winning_label() -> Column:
    """Label of the side that won; null for a tie, an unknown winner or no label."""
    return F.when(winner_letter() == FIRST, F.col("checkpoint_a")).when(
        winner_letter() == SECOND, F.col("checkpoint_b")
    )


def _rates(counts: DataFrame) -> DataFrame:
    total = F.col("total_pairs")
    return counts.withColumns(
        {
            "ckpt1_win_rate": rate(F.col("ckpt1_wins"), total),
            "ckpt2_win_rate": rate(F.col("ckpt2_wins"), total),
            "tie_rate": rate(F.col("ties"), total),
        }
    )


def head_to_head(
    judgements: DataFrame, first: str, second: str, positional: bool = False
) -> DataFrame:
    """Wins of two checkpoints and ties, as counts and as rates over all pairs.

    A judgement that names no label on one side, or no known winner, stays in the
    total only. ``positional=True`` ignores labels: a is the first, b the second
    and anything else a tie.
    """
    winner = winner_letter()
    if positional:
        won1, won2 = winner == FIRST, winner == SECOND
        tied = ~(won1 | won2)
    else:
        named = (or_empty(F.col("checkpoint_a")) != "") & (or_empty(F.col("checkpoint_b")) != "")
        won1 = named & (_winning_label() == first)
        won2 = named & (_winning_label() == second)
        tied = named & winner.isin(*TIES)
    return _rates(
        judgements.agg(
            F.count(F.lit(1)).alias("total_pairs"),
            F.count_if(won1).alias("ckpt1_wins"),
            F.count_if(won2).alias("ckpt2_wins"),
            F.count_if(tied).alias("ties"),
        )
    )


# Categories by number, so that aggregates hold numbers and need no sort.
_CATEGORIES = (*(name for name, _ in CATEGORY_KEYWORDS), "open_ended")


def _outcomes(judgements: DataFrame, preds: DataFrame, first: str, second: str) -> DataFrame:
    """Judgements with their prompt's category, whether both outputs exist, and the side that won.

    Texts stay in the scan: what a prompt sends on is a category number and two counts.
    """
    names = F.array(*(F.lit(c) for c in _CATEGORIES))
    is_first = F.col("checkpoint") == first
    code = F.array_position(names, instruction_category(F.col("instruction")))
    prompts = (
        preds.filter(F.col("checkpoint").isin(first, second))
        .groupBy(F.col("id").alias("idx"))
        .agg(
            F.min(F.when(is_first, code)).alias("code"),
            F.count_if(is_first).alias("n1"),
            F.count_if(~is_first).alias("n2"),
        )
    )
    twice = F.raise_error(
        F.format_string("id %s has two outputs of one checkpoint", F.col("idx").cast("string"))
    ).cast("boolean")
    both = F.coalesce((F.col("n1") == 1) & (F.col("n2") == 1), F.lit(False))
    label = _winning_label()
    return judgements.join(prompts, "idx", "left").select(
        "idx",
        "winner",
        "checkpoint_a",
        "checkpoint_b",
        F.coalesce(F.get(names, F.col("code").cast("int") - 1), F.lit(_CATEGORIES[-1])).alias("category"),
        F.when((F.col("n1") > 1) | (F.col("n2") > 1), twice).otherwise(both).alias("complete"),
        F.coalesce(label == first, F.lit(False)).alias("won1"),
        F.coalesce(label == second, F.lit(False)).alias("won2"),
    )


def _earliest(won: str) -> Column:
    """The lowest index of the won pairs that have both predictions."""
    return F.min(F.when(F.col(won) & F.col("complete"), F.col("idx")))


def _examples(found: DataFrame, preds: DataFrame, first: str, second: str) -> DataFrame:
    """The texts of the pairs a record names: kind, idx, category and so on; two rows at most.

    One scan brings the outputs of both checkpoints, four rows at most, which are then put side by side.
    """
    kinds = F.array(
        *(
            F.struct(F.lit(k).alias("kind"), F.col(f"{k}_idx").alias("idx"), F.lit(w).alias("winner"))
            for k, w in (("regression", first), ("improvement", second))
        )
    )
    picked = found.select(F.inline(kinds)).filter("idx IS NOT NULL")
    outputs = preds.filter(F.col("checkpoint").isin(first, second)).join(
        F.broadcast(picked), F.col("id") == F.col("idx")
    )

    def of(label: str, column: str) -> Column:
        return F.max(F.when(F.col("checkpoint") == label, or_empty(F.col(column))))

    return (
        outputs.groupBy("kind", "idx", "winner")
        .agg(
            of(first, "instruction").alias("instruction"),
            of(first, "input").alias("input"),
            of(first, "prediction").alias("prediction_ckpt1"),
            of(second, "prediction").alias("prediction_ckpt2"),
        )
        .select(
            "kind",
            "idx",
            instruction_category(F.col("instruction")).alias("category"),
            "instruction",
            "input",
            "prediction_ckpt1",
            "prediction_ckpt2",
            "winner",
        )
    )


def _by_category(outcomes: DataFrame, *more: Column) -> DataFrame:
    return outcomes.groupBy("category").agg(
        F.count_if("won1").alias("ckpt1_wins"),
        F.count_if("won2").alias("ckpt2_wins"),
        F.count_if(~F.col("won1") & ~F.col("won2")).alias("ties"),
        F.count(F.lit(1)).alias("total"),
        *more,
    )


def category_breakdown(
    judgements: DataFrame, preds: DataFrame, first: str, second: str
) -> DataFrame:
    """Wins and ties per instruction category; here every other outcome is a tie."""
    return _by_category(_outcomes(judgements, preds, first, second))


# Groupings of ``outcome_report``, each by the columns it keeps apart.
LEVELS = {
    "total": (),
    "pair": ("first", "second"),
    "category": ("category",),
    "swapped": ("swapped",),
    "pair, category": ("first", "second", "category"),
    "pair, swapped": ("first", "second", "swapped"),
}


def outcome_report(
    judgements: DataFrame, preds: DataFrame, labels: Sequence[str], levels: Sequence[str] = tuple(LEVELS)
) -> DataFrame:
    """Wins, ties and examples of all pairs of checkpoints, by several groupings at once.

    ``judgements`` holds, besides its own columns, the ``first`` and ``second`` label of the plan and
    ``swapped``. One row per group of every level: level, first, second, category, swapped (null where a level
    does not keep them apart), total, wins_first, wins_second, ties and undecided (neither won), their
    rates over the total, and the lowest idx of a pair with both outputs that either side won. A level
    "pair" row is the ``head_to_head`` of its pair, "pair, category" the ``category_breakdown``, whose ties are
    the undecided here, and its examples those of ``exemplars``. Judgements of other labels are left out.

    Judgements and predictions are read once and meet once. All groupings come from one aggregation:
    rows are summed up where they are, and what goes through its shuffle are groups. Where
    both tables are bucketed by prompt, that is the only shuffle.
    """
    names = F.array(*(F.lit(c) for c in _CATEGORIES))
    code = F.array_position(names, instruction_category(F.col("instruction")))

    def mine(label: str) -> Column:
        return F.col("checkpoint") == label

    prompts = (
        preds.filter(F.col("checkpoint").isin(*labels))
        .groupBy(F.col("id").alias("idx"))
        .agg(
            *(F.min(F.when(mine(x), code)).alias(f"_code{i}") for i, x in enumerate(labels)),
            *(F.count_if(mine(x)).alias(f"_n{i}") for i, x in enumerate(labels)),
        )
    )

    def of(side: str, prefix: str) -> Column:
        chosen = F.lit(None)
        for i, x in enumerate(labels):
            chosen = F.when(F.col(side) == x, F.col(f"{prefix}{i}")).otherwise(chosen)
        return chosen

    n1, n2 = of("first", "_n"), of("second", "_n")
    twice = F.raise_error(
        F.format_string("id %s has two outputs of one checkpoint", F.col("idx").cast("string"))
    ).cast("boolean")
    complete = F.when((n1 > 1) | (n2 > 1), twice).otherwise(F.coalesce((n1 == 1) & (n2 == 1), F.lit(False)))
    named = (or_empty(F.col("checkpoint_a")) != "") & (or_empty(F.col("checkpoint_b")) != "")
    winner = _winning_label()
    rows = (
        judgements.filter(F.col("first").isin(*labels) & F.col("second").isin(*labels))
        .join(prompts, "idx", "left")
        .select(
            "idx",
            "first",
            "second",
            "swapped",
            F.coalesce(F.get(names, of("first", "_code").cast("int") - 1), F.lit(_CATEGORIES[-1])).alias("category"),
            complete.alias("complete"),
            F.coalesce(winner == F.col("first"), F.lit(False)).alias("won1"),
            F.coalesce(winner == F.col("second"), F.lit(False)).alias("won2"),
            (named & winner_letter().isin(*TIES)).alias("tied"),
            named.alias("named"),
        )
    )
    won1, won2 = F.col("named") & F.col("won1"), F.col("named") & F.col("won2")
    keys = ("first", "second", "category", "swapped")
    sets = [[F.col(c) for c in LEVELS[level]] for level in levels]
    level = None
    for name in levels:  # grouping_id has a bit for every key that is summed over
        gid = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in LEVELS[name])
        hit = F.grouping_id() == gid
        level = F.when(hit, name) if level is None else level.when(hit, name)
    total = F.count(F.lit(1))
    counted = rows.groupingSets(sets, *keys).agg(
        level.alias("level"),
        total.alias("total"),
        F.count_if(won1).alias("wins_first"),
        F.count_if(won2).alias("wins_second"),
        F.count_if("tied").alias("ties"),
        F.count_if(~F.col("won1") & ~F.col("won2")).alias("undecided"),
        _earliest("won1").alias("regression_idx"),
        _earliest("won2").alias("improvement_idx"),
    )
    counts = ("wins_first", "wins_second", "ties")
    return counted.select(
        "level", *keys, "total", *counts, "undecided",
        *(rate(F.col(c), F.col("total")).alias(f"{c}_rate") for c in counts),
        "regression_idx", "improvement_idx",
    )


def exemplars(judgements: DataFrame, preds: DataFrame, first: str, second: str) -> DataFrame:
    """First pair the first checkpoint won (regression) and first the second won (improvement)."""
    found = _outcomes(judgements, preds, first, second).agg(
        _earliest("won1").alias("regression_idx"), _earliest("won2").alias("improvement_idx")
    )
    return _examples(found, preds, first, second)


def metric_deltas(text_metrics: DataFrame, first: str, second: str) -> DataFrame:
    """ROUGE-L and embedding F1 of both checkpoints and their change; absent counts as 0."""
    names = {"rougeL_f1": "rougeL_f1", "bertscore_f1": "bertscore_f1_avg"}

    def of(label: str, column: str) -> Column:
        value = F.max(F.when(F.col("checkpoint") == label, F.col(column)))
        return F.coalesce(value, F.lit(0.0))

    values = text_metrics.agg(
        *(
            of(label, column).alias(f"{name}_ckpt{i}")
            for name, column in names.items()
            for i, label in ((1, first), (2, second))
        )
    )
    return values.withColumns(
        {
            f"delta_{name}_ckpt2_minus_ckpt1": F.col(f"{name}_ckpt2") - F.col(f"{name}_ckpt1")
            for name in names
        }
    )


def run_deltas(table: DataFrame, first: str, second: str, columns: Sequence[str]) -> DataFrame:
    """Metrics of every checkpoint in two runs, and their change; an absent run counts as 0.

    ``table`` holds a row per run and checkpoint, as ``sources.read_runs`` reads it: only the two runs'
    partitions are scanned. Columns: checkpoint, and of each metric x x_run1, x_run2, delta_x.
    """

    def of(run: str, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("run") == run, F.col(column))), F.lit(0.0))

    both = table.filter(F.col("run").isin(first, second)).groupBy("checkpoint")
    values = both.agg(
        *(of(run, c).alias(f"{c}_run{i}") for c in columns for i, run in ((1, first), (2, second)))
    )
    return values.withColumns({f"delta_{c}": F.col(f"{c}_run2") - F.col(f"{c}_run1") for c in columns})


def forgetting_summary(
    judgements: DataFrame,
    preds: DataFrame,
    text_metrics: DataFrame,
    first: str,
    second: str,
    metric_files: dict[str, str] | None = None,
) -> DataFrame:
    """One record: head-to-head, metric changes, categories and examples.

    Judgements are read and joined once: the categories are the first level of
    the aggregation, everything else is summed up from their few rows. The summed record is one scalar
    value, which the report and the search for its examples share.
    """
    named = (or_empty(F.col("checkpoint_a")) != "") & (or_empty(F.col("checkpoint_b")) != "")
    per_category = _by_category(
        _outcomes(judgements, preds, first, second),
        F.count_if(named & F.col("won1")).alias("named_wins1"),
        F.count_if(named & F.col("won2")).alias("named_wins2"),
        F.count_if(named & winner_letter().isin(*TIES)).alias("named_ties"),
        _earliest("won1").alias("regression_idx"),
        _earliest("won2").alias("improvement_idx"),
    )
    entry = F.struct(
        F.col("category").alias("key"),
        F.struct("ckpt1_wins", "ckpt2_wins", "ties", "total").alias("value"),
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    counts = per_category.agg(
        total("total").alias("total_pairs"),
        total("named_wins1").alias("ckpt1_wins"),
        total("named_wins2").alias("ckpt2_wins"),
        total("named_ties").alias("ties"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("category_breakdown"),
        F.min("regression_idx").alias("regression_idx"),
        F.min("improvement_idx").alias("improvement_idx"),
    )
    summed = judgements.sparkSession.range(1).select(counts.select(F.struct("*")).scalar().alias("_counts"))
    summed = summed.select("_counts.*")
    shown = _examples(summed, preds, first, second)
    content = F.struct(*(c for c in shown.columns if c != "kind"))
    both = shown.agg(
        *(F.max(F.when(F.col("kind") == k, content)).alias(k) for k in ("regression", "improvement"))
    )
    deltas = metric_deltas(text_metrics, first, second)
    record = _rates(summed).withColumns(
        {
            "metrics": deltas.select(F.struct("*")).scalar(),
            "examples": both.select(F.struct("*")).scalar(),
        }
    ).select("*", "examples.regression", "examples.improvement")
    files = metric_files or {}
    return record.select(
        F.lit(first).alias("ckpt1"),
        F.lit(second).alias("ckpt2"),
        "total_pairs",
        "ckpt1_wins",
        "ckpt2_wins",
        "ties",
        "ckpt1_win_rate",
        "ckpt2_win_rate",
        "tie_rate",
        (F.col("ckpt2_win_rate") - F.col("ckpt1_win_rate")).alias(
            "delta_win_rate_ckpt2_minus_ckpt1"
        ),
        "metrics.*",
        "category_breakdown",
        F.col("regression").alias("representative_regression_example"),
        F.col("improvement").alias("representative_improvement_example"),
        F.create_map(*(F.lit(x) for item in files.items() for x in item))
        .cast("map<string,string>")
        .alias("available_metrics_files"),
    )
