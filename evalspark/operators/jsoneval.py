"""Scoring of predicted JSON against reference JSON, row by row and per checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions import jsonx
from evalspark.functions.text import or_empty


# --- fixed values ---------------------------------------------------------
# Error labels, in the order in which the checks assign them.
ERROR_LABELS = (
    "reference_parse_failed",
    "truncated_output",
    "invalid_json",
    "not_object",
    "non_object",
    "key_mismatch",
    "wrong_types",
    "exact_mismatch",
)
# --------------------------------------------------------------------------


def valid_rows(df: DataFrame, column: str = "output") -> DataFrame:
    """Rows whose ``column`` holds JSON under the tolerant parse."""
    return df.filter(jsonx.is_valid(F.col(column)))


def validity_counts(df: DataFrame, column: str = "output", by: tuple[str, ...] = ()) -> DataFrame:
    """How many rows are valid JSON, out of how many."""
    return df.groupBy(*by).agg(
        F.count_if(jsonx.is_valid(F.col(column))).alias("kept"),
        F.count(F.lit(1)).alias("total"),
    )


def _labels(s: dict[str, Column]) -> Column:
    """Error labels of a row; the first three stop the checks that follow them."""
    prediction = or_empty(F.col("prediction"))
    truncated = prediction.contains("{") & ~prediction.contains("}")
    return (
        F.when(~s["reference_ok"], F.array(F.lit("reference_parse_failed")))
        .when(
            ~s["valid"],
            F.array(F.when(truncated, "truncated_output").otherwise("invalid_json")),
        )
        .when(~s["is_object"], F.array(F.lit("not_object")))
        .otherwise(
            F.array_compact(
                F.array(F.col("schema.reason"), F.when(~F.col("equal"), "exact_mismatch"))
            )
        )
    )


def score_json(preds: DataFrame, python_equality: bool = True) -> DataFrame:
    """Add the outcome of every JSON check to each prediction.

    Purely row-wise, and no shuffle is needed. A reference that is JSON null, or no JSON,
    counts as failed. Texts whose numbers VARIANT would change are read once more, with
    numbers as texts; all others are compared as they were parsed.
    """
    parsed = preds.withColumns(
        {
            "ref_value": jsonx.parse_json(F.col("reference")),
            "cand_value": jsonx.parse_json(F.col("prediction")),
        }
    )
    cand, ref = F.col("cand_value"), F.col("ref_value")
    # The checks past parsing only run on rows that reach them.
    usable = ref.isNotNull() & ~jsonx.is_null_literal(ref)
    gated = parsed.withColumns(
        {
            "ref_ok": usable,
            "scorable": cand.isNotNull() & usable & jsonx.is_object(cand),
            "exact_numbers": jsonx.has_exact_numbers(F.col("prediction"))
            | jsonx.has_exact_numbers(F.col("reference")),
        }
    )
    scorable, exact = F.col("scorable"), F.col("exact_numbers")
    texts = gated.withColumns(
        {
            "cand_text": F.when(scorable & ~exact, F.to_json(cand)),
            "ref_text": F.when(scorable & ~exact, F.to_json(ref)),
            "cand_json": F.when(scorable & exact, jsonx.json_text(F.col("prediction"))),
            "ref_json": F.when(scorable & exact, jsonx.json_text(F.col("reference"))),
        }
    )
    cand_json, ref_json = F.col("cand_json"), F.col("ref_json")
    read = texts.withColumns(
        {
            "cand_form": F.when(exact, jsonx.comparable(cand_json, python_equality)),
            "ref_form": F.when(exact, jsonx.comparable(ref_json, python_equality)),
            "cand_shape": F.when(exact, jsonx.shape(cand_json)).otherwise(cand),
            "ref_shape": F.when(exact, jsonx.shape(ref_json)).otherwise(ref),
        }
    )
    cand_text, ref_text = F.col("cand_text"), F.col("ref_text")
    same = ~exact & (cand_text == ref_text)
    forms = F.to_json("cand_form") == F.to_json("ref_form")
    plain = jsonx.plain_equal(cand_text, ref_text, python_equality)
    # F1 always takes true and 1 for equal.
    f1_forms = (
        (F.col("cand_form"), F.col("ref_form"))
        if python_equality
        else (jsonx.comparable(cand_json), jsonx.comparable(ref_json))
    )
    checked = read.withColumns(
        {
            "schema": F.when(scorable & same, jsonx.full_compliance()).when(
                scorable, jsonx.schema_compliance(F.col("cand_shape"), F.col("ref_shape"))
            ),
            "equal": F.when(scorable, F.when(exact, forms).otherwise(same | plain)),
            "f1": F.when(
                scorable & jsonx.is_extraction(ref),
                jsonx.field_f1(
                    F.when(exact, f1_forms[0]).otherwise(cand),
                    F.when(exact, f1_forms[1]).otherwise(ref),
                ),
            ),
        }
    )
    state = {
        "reference_ok": F.col("ref_ok"),
        "valid": F.col("ref_ok") & cand.isNotNull(),
        "is_object": F.col("scorable"),
    }
    return checked.select(
        *preds.columns,
        *(value.alias(name) for name, value in state.items()),
        F.coalesce(F.col("schema.ok"), F.lit(False)).alias("compliant"),
        F.coalesce(F.col("equal"), F.lit(False)).alias("exact"),
        F.col("f1").isNotNull().alias("extraction"),
        F.col("f1.macro").alias("extraction_f1"),
        F.col("schema").alias("schema_details"),
        _labels(state).alias("labels"),
    )


def rate(part: Column, whole: Column) -> Column:
    """part / whole, and 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def metric_sums(scored: DataFrame, *by: str) -> DataFrame:
    """What the metrics of a checkpoint are made of, as counts and sums that can be added up.

    One row per checkpoint and value of the columns ``by``, from one pass over the rows.
    """
    counts = F.array(
        *(F.count_if(F.array_contains("labels", label)) for label in ERROR_LABELS)
    )
    return scored.groupBy(*by, "checkpoint").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("valid").alias("valid"),
        F.count_if("compliant").alias("compliant"),
        F.count_if("exact").alias("exact"),
        F.sum("extraction_f1").alias("f1_sum"),
        F.count("extraction_f1").alias("f1_rows"),
        F.count_if("extraction").alias("extraction"),
        counts.alias("label_counts"),
    )


def add_metric_sums(sums: DataFrame) -> DataFrame:
    """``metric_sums`` of parts of the rows as those of all of them, per checkpoint."""
    added = F.array(*(F.sum(F.col("label_counts")[i]) for i in range(len(ERROR_LABELS))))
    numbers = ("total", "valid", "compliant", "exact", "f1_sum", "f1_rows", "extraction")
    return sums.groupBy("checkpoint").agg(*(F.sum(c).alias(c) for c in numbers), added.alias("label_counts"))


def metrics_of(sums: DataFrame) -> DataFrame:
    """All rates and error counts of a checkpoint."""
    counts = F.array(
        *(
            F.struct(F.lit(label).alias("category"), F.col("label_counts")[i].alias("count"))
            for i, label in enumerate(ERROR_LABELS)
        )
    )
    total, valid = F.col("total"), F.col("valid")
    return sums.select(
        "checkpoint",
        "total",
        rate(valid, total).alias("json_validity_rate"),
        rate(F.col("compliant"), valid).alias("schema_compliance_rate"),
        rate(F.col("exact"), total).alias("exact_match_rate"),
        rate(F.col("f1_sum"), F.col("f1_rows")).alias("extraction_field_level_f1_avg"),
        F.col("extraction").alias("extraction_prompts"),
        counts.alias("counts"),
    )


def json_metrics(scored: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Metrics record per checkpoint, with its error counts as a map.

    Each rate has the denominator its definition asks for: all rows for validity
    and exact match, valid rows for schema compliance. With ``labels`` there is one record for
    each of them, of zeros where it has no row, and none for others.
    """
    wanted = scored if labels is None else scored.filter(F.col("checkpoint").isin(*labels))
    return metrics_table(metric_sums(wanted), labels)


def metrics_table(sums: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """The same from the sums of each checkpoint."""
    seen = F.filter("counts", lambda x: x["count"] > 0)
    found = metrics_of(sums).withColumn("error_taxonomy_counts", F.map_from_entries(seen)).drop("counts")
    if labels is None:
        return found
    asked = sums.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(label) for label in labels))).alias("checkpoint")
    )
    # At most one row per label.
    full = asked.join(F.broadcast(found), "checkpoint", "left")
    none = F.create_map().cast("map<string,bigint>")
    return full.select(
        "checkpoint",
        *(F.coalesce(c, none if c == "error_taxonomy_counts" else F.lit(0).cast(t)).alias(c)
          for c, t in found.dtypes if c != "checkpoint"),
    )


def error_taxonomy(scored: DataFrame) -> DataFrame:
    """Rows per checkpoint and error label; labels that never occur are left out."""
    return taxonomy_of(metric_sums(scored))


def taxonomy_of(sums: DataFrame) -> DataFrame:
    """The same from the sums of each checkpoint."""
    return metrics_of(sums).select("checkpoint", F.inline("counts")).filter(F.col("count") > 0)
