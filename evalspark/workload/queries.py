"""Registered queries: one or more per operator, over whole tables.

Each takes a session and the folder of the driver's tables. Doubles are rounded
to six places, since sums of floats depend on their order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evalspark import schemas
from evalspark.functions import jsonx, segment, text
from evalspark.operators import (
    attempts,
    compare,
    forgetting,
    incremental,
    jsoneval,
    judge,
    nearsplit,
    prep,
    textmetrics,
)
from evalspark.plans import datasets, reports
from evalspark.session import prepare, shared_dir
from evalspark.sources import (
    bucket_count,
    find_judgements,
    read_instructions,
    read_judgements,
    read_jsonl,
    read_runs,
    write_bucketed,
    write_jsonl,
    write_report,
    write_run,
)
from evalspark.streaming import attempt_stream
from evalspark.workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST, SECOND = fx.CHECKPOINTS[1], fx.CHECKPOINTS[2]
MARKERS = ("<|user|>\n", "<|end|>\n<|assistant|>\n")


def query(build: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir.rstrip("/"))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(r6(n).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes))


def joined(c: Column) -> Column:
    return F.array_join(c, ",")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/evalspark/{name}-{uuid.uuid4().hex}"


# --- JSON extraction and scoring ------------------------------------------------


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsoneval.score_json(fx.json_predictions(spark, sf_dir))


@query
def json_metrics(spark, sf_dir):
    """Validity, schema compliance, exact match and extraction F1 per checkpoint."""
    return rounded(jsoneval.json_metrics(scored(spark, sf_dir)).drop("error_taxonomy_counts"))


@query
def json_metrics_document(spark, sf_dir):
    """Metrics with the error counts of a checkpoint as one map."""
    counts = F.map_entries("error_taxonomy_counts")
    shown = F.transform(counts, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return jsoneval.json_metrics(scored(spark, sf_dir)).select(
        "checkpoint", "total", joined(F.array_sort(shown)).alias("error_taxonomy_counts")
    )


@query
def json_error_taxonomy(spark, sf_dir):
    return jsoneval.error_taxonomy(scored(spark, sf_dir))


@query
def json_scores(spark, sf_dir):
    """Every check of every prediction."""
    return scored(spark, sf_dir).select(
        "id",
        "checkpoint",
        "reference_ok",
        "valid",
        "is_object",
        "compliant",
        "exact",
        "extraction",
        r6("extraction_f1").alias("extraction_f1"),
        joined(F.col("labels")).alias("labels"),
    )


def hard_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsoneval.score_json(fx.json_hard_predictions(spark, sf_dir))


@query
def json_hard_scores(spark, sf_dir):
    """Every check of texts with odd numbers, repeated keys, escapes and unusable references."""
    return hard_scored(spark, sf_dir).select(
        "id",
        "reference_ok",
        "valid",
        "is_object",
        "compliant",
        "exact",
        "extraction",
        r6("extraction_f1").alias("extraction_f1"),
        joined(F.col("labels")).alias("labels"),
    )


@query
def json_hard_metrics(spark, sf_dir):
    """Metrics over the same texts, error counts included."""
    found = jsoneval.json_metrics(hard_scored(spark, sf_dir), fx.CHECKPOINTS + ("ckpt9_absent",))
    counts = F.map_entries("error_taxonomy_counts")
    shown = F.transform(counts, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return rounded(found.withColumn("error_taxonomy_counts", joined(F.array_sort(shown))))


@query
def teacher_records_hard(spark, sf_dir):
    """The hard texts written out again as values."""
    rows = fx.json_hard_predictions(spark, sf_dir).select(
        "id", F.lit("Prompt").alias("instruction"), F.lit(None).cast("string").alias("input"),
        F.lit("t").alias("task_type"), F.col("reference").alias("text"),
    )
    return prep.teacher_records(jsoneval.valid_rows(rows, "text")).select("id", "output")


@query
def json_valid_rows(spark, sf_dir):
    preds = fx.json_predictions(spark, sf_dir)
    return jsoneval.valid_rows(preds, "prediction").select("id", "checkpoint", "prediction")


@query
def json_validity_counts(spark, sf_dir):
    preds = fx.json_predictions(spark, sf_dir)
    return jsoneval.validity_counts(preds, "prediction", by=("checkpoint",))


@query
def json_text(spark, sf_dir):
    """The part of each output that is read as JSON."""
    return fx.json_predictions(spark, sf_dir).select(
        "id", "checkpoint", jsonx.json_text(F.col("prediction")).alias("json_text")
    )


@query
def json_spans(spark, sf_dir):
    """Top-level brace spans: how many, and the last one."""
    spans = fx.json_predictions(spark, sf_dir).select(
        "id", "checkpoint", jsonx.object_spans(F.col("prediction")).alias("spans")
    )
    return spans.select(
        "id",
        "checkpoint",
        F.size("spans").alias("n_spans"),
        F.try_element_at("spans", F.lit(-1)).alias("last_span"),
    )


@query
def json_stripped(spark, sf_dir):
    """Outputs without reasoning blocks, and without code fences."""
    prediction = F.col("prediction")
    return fx.json_predictions(spark, sf_dir).select(
        "id",
        "checkpoint",
        jsonx.strip_reasoning(prediction).alias("no_reasoning"),
        jsonx.strip_fences(prediction).alias("no_fences"),
        jsonx.repair_commas(prediction).alias("repaired"),
    )


@query
def json_object_parse(spark, sf_dir):
    """Objects, or why an output is none."""
    parsed = jsonx.parse_object(F.col("prediction"))
    return (
        fx.json_predictions(spark, sf_dir)
        .select("id", "checkpoint", parsed.alias("parsed"))
        .select(
            "id",
            "checkpoint",
            F.col("parsed.value").isNotNull().alias("has_value"),
            F.col("parsed.error").alias("error"),
        )
    )


@query
def json_required_keys(spark, sf_dir):
    required = {"name": "str", "age": "int"}
    value = jsonx.parse_json(F.col("prediction"))
    return fx.json_predictions(spark, sf_dir).select(
        "id", "checkpoint", jsonx.has_keys(value, required).alias("has_keys")
    )


@query
def schema_compliance(spark, sf_dir):
    details = jsonx.schema_compliance(F.col("candidate"), F.col("expected"))
    return (
        fx.json_predictions(spark, sf_dir)
        .select(
            "id",
            "checkpoint",
            jsonx.parse_json(F.col("prediction")).alias("candidate"),
            jsonx.parse_json(F.col("reference")).alias("expected"),
        )
        .select("id", "checkpoint", details.alias("details"))
        .select(
            "id",
            "checkpoint",
            "details.ok",
            "details.reason",
            joined(F.col("details.missing")).alias("missing"),
            joined(F.col("details.extra")).alias("extra"),
            joined(F.col("details.wrong")).alias("wrong"),
        )
    )


@query
def field_f1(spark, sf_dir):
    """Mean and per-field F1 of object outputs whose reference is an extraction."""
    pairs = fx.json_predictions(spark, sf_dir).select(
        "id",
        "checkpoint",
        jsonx.parse_json(F.col("prediction")).alias("candidate"),
        jsonx.parse_json(F.col("reference")).alias("expected"),
    )
    wanted = jsonx.is_object(F.col("candidate")) & jsonx.is_extraction(F.col("expected"))
    f1 = jsonx.field_f1(F.col("candidate"), F.col("expected"))
    result = pairs.select("id", "checkpoint", F.when(wanted, f1).alias("f1"))
    return result.filter(F.col("f1").isNotNull()).select(
        "id",
        "checkpoint",
        r6("f1.macro").alias("macro"),
        *(
            F.try_element_at("f1.per_field", F.lit(k)).alias(k)
            for k in ("entities", "location", "date")
        ),
    )


@query
def json_equality(spark, sf_dir):
    """Deep equality, with booleans apart from numbers or not."""
    n = (F.col("user_id") + 1).cast("string")
    left, right = F.col("a"), F.col("b")
    pairs = F.element_at(
        F.array(
            F.struct(F.format_string('{"a":%s,"b":[1,2]}', n).alias("a"),
                     F.format_string('{"b":[1,2],"a":%s.0}', n).alias("b")),
            F.struct(F.format_string('{"a":[%s,2]}', n).alias("a"),
                     F.format_string('{"a":[2,%s]}', n).alias("b")),
            F.struct(F.lit('{"a":true}').alias("a"), F.lit('{"a":1}').alias("b")),
            F.struct(F.format_string('{"a":"%s"}', n).alias("a"),
                     F.format_string('{"a":%s}', n).alias("b")),
            F.struct(F.format_string('{"a":{"x":%s00}}', n).alias("a"),
                     F.format_string('{"a":{"x":%se2}}', n).alias("b")),
        ),
        (F.col("event_id") % 5 + 1).cast("int"),
    )
    events = fx.spread_table(spark, sf_dir, "events", "event_id", "user_id")
    values = events.select("event_id", pairs.alias("p")).select("event_id", "p.a", "p.b")
    return values.select(
        "event_id",
        jsonx.json_equal(left, right).alias("equal"),
        jsonx.json_equal(left, right, python_equality=False).alias("strictly_equal"),
    )


@query
def json_type_compatibility(spark, sf_dir):
    """Value classes of the reference's first member and of the prediction's under that key."""
    preds = fx.json_predictions(spark, sf_dir)
    first = F.get(F.json_object_keys("reference"), F.lit(0))
    values = preds.select(
        "id",
        "checkpoint",
        first.alias("key"),
        jsonx.as_map(jsonx.parse_json(F.col("reference"))).alias("ref"),
        jsonx.as_map(jsonx.parse_json(F.col("prediction"))).alias("cand"),
    ).select(
        "id",
        "checkpoint",
        F.try_element_at("ref", "key").alias("a"),
        F.try_element_at("cand", "key").alias("b"),
    )
    return values.select(
        "id",
        "checkpoint",
        jsonx.value_class(F.col("a")).alias("class_a"),
        jsonx.value_class(F.col("b")).alias("class_b"),
        jsonx.type_compatible(F.col("a"), F.col("b")).alias("compatible"),
    )


@query
def response_text(spark, sf_dir):
    """Answer texts of stored chat responses of every shape."""
    kind = F.col("event_type")
    message = '{"choices":[{"message":%s}]}'
    shapes = F.array(
        F.format_string(message % '{"content":"  hi %s "}', kind),
        F.format_string(
            message % '{"content":[{"type":"text","text":"%s "},{"type":"image"},"end"]}', kind
        ),
        F.format_string(message % '{"content":"","reasoning_content":" because %s"}', kind),
        F.format_string(message % '{"content":null,"refusal":"no %s"}', kind),
        F.lit('{"choices":[]}'),
        F.format_string(message % '{"content":[],"reasoning_content":"%s"}', kind),
        F.lit('{"choices":[{"finish_reason":"stop"}]}'),
    )
    events = fx.spread_table(spark, sf_dir, "events", "event_id", "event_type")
    document = F.element_at(shapes, (F.col("event_id") % 7 + 1).cast("int"))
    return events.select("event_id", jsonx.response_text(document).alias("answer"))


# --- texts and prompts --------------------------------------------------------------


def raw_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 4
    return d.select(
        "doc_id",
        F.when(kind == 0, F.concat(F.lit(" 　"), "text", F.lit("\n\t")))
        .when(kind == 1, F.col("text"))
        .when(kind == 2, "")
        .otherwise("   ")
        .alias("instruction"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(" x ")).alias("input"),
        F.concat(F.lit("\x1c"), "text", F.lit("\xa0")).alias("output"),
    )


@query
def instruction_normalise(spark, sf_dir):
    """Stripped records; empty instructions go, those of spaces stay."""
    return prep.normalise_instructions(raw_instructions(spark, sf_dir))


@query
def instruction_dataset(spark, sf_dir):
    """The whole job from raw instructions to both sides of a split."""
    rows = datasets.instruction_dataset(raw_instructions(spark, sf_dir), "doc_id")
    return rows.select("doc_id", "instruction", "split")


@query
def train_text(spark, sf_dir):
    t = fx.turns(spark, sf_dir)
    return t.select(
        "idx",
        text.training_text(F.col("instruction"), F.lit(""), F.col("reference")).alias("text"),
    )


@query
def generation_prompt(spark, sf_dir):
    """Plain prompts and prompts in a chat template, of every user turn."""
    t = fx.user_turns(spark, sf_dir)
    input_ = F.when(F.col("idx") % 2 == 0, F.lit(" with spaces "))
    return t.select(
        "idx",
        text.generation_prompt(F.col("instruction"), input_).alias("plain"),
        text.chat_prompt(F.col("instruction"), input_).alias("untemplated"),
        text.chat_prompt(F.col("instruction"), input_, MARKERS).alias("chat"),
    )


@query
def prompt_pool(spark, sf_dir):
    """Five prompt families from seed rows, every prompt twice."""
    return pool(spark, sf_dir)


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("user"), "user_id").alias("name"),
        (18 + F.col("user_id") % 60).alias("age"),
        F.concat(F.lit("city"), F.col("user_id") % 50).alias("city"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "event_type",
        "props",
    )
    types = F.array(*(F.lit(t) for t in fx.TASK_TYPES))
    malformed = F.format_string('{"name":"%s","age": %s,}', "name", F.col("age").cast("string"))
    seeds = e.select(
        "event_id",
        F.element_at(types, (F.col("event_id") % 5 + 1).cast("int")).alias("task_type"),
        "name",
        "age",
        "city",
        "date",
        F.col("name").alias("first"),
        F.col("event_type").alias("second"),
        F.col("city").alias("location"),
        F.col("props").alias("text"),
        F.col("event_type").alias("label"),
        malformed.alias("malformed"),
    )
    return prep.pool_from(seeds, copies=2, keep=("event_id",))


@query
def teacher_prompt(spark, sf_dir):
    """Teacher prompts of the pool; placeholders are filled one after the other."""
    template = "Shape: __JSON_EXAMPLE__\nDo: __INSTRUCTION__\nWith: __INPUT__"
    return judge.teacher_prompt(pool(spark, sf_dir), template).select(
        "event_id", "copy_no", "prompt"
    )


@query
def pairwise_prompt(spark, sf_dir):
    template = "__INSTRUCTION__|__INPUT__|__CHECKPOINT_A__|__RESPONSE_A__|__CHECKPOINT_B__|__RESPONSE_B__"
    return judge.pairwise_prompt(swapped_plan(spark, sf_dir), template).select(
        "idx", "checkpoint_a", "checkpoint_b", "prompt"
    )


@query
def json_judge_prompt(spark, sf_dir):
    template = "__INSTRUCTION__|__INPUT__|__CHECKPOINT__|__PREDICTION__|__REFERENCE__"
    preds = fx.json_predictions(spark, sf_dir)
    return judge.json_judge_prompt(preds, template).select("id", "checkpoint", "prompt")


@query
def token_budget(spark, sf_dir):
    """Outputs cut to 64 tokens, which is the operator's own limit."""
    budget = text.token_budget(F.col("prediction"), 64)
    return (
        fx.text_predictions(spark, sf_dir)
        .select("id", "checkpoint", budget.alias("budget"))
        .select(
            "id",
            "checkpoint",
            F.array_join("budget.tokens", " ").alias("kept"),
            "budget.n_tokens",
            "budget.truncated",
        )
    )


@query
def token_budget_segmented(spark, sf_dir):
    """The same with the longest pieces of a vocabulary as tokens."""
    budget = text.token_budget(F.col("prediction"), 64, segment.longest_match(fx.VOCABULARY))
    rows = fx.text_predictions(spark, sf_dir).select("id", "checkpoint", budget.alias("budget"))
    return rows.select(
        "id",
        "checkpoint",
        F.array_join("budget.tokens", "|").alias("kept"),
        "budget.n_tokens",
        "budget.truncated",
    )


@query
def task_completion(spark, sf_dir):
    """Completion of each answer, with refusals and short answers among them."""
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    kind = F.col("doc_id") % 6
    answer = (
        F.when(kind == 0, F.concat(F.lit("SORRY, "), "text"))
        .when(kind == 1, F.concat("text", F.lit(" {}")))
        .when(kind == 2, "          too short          ")
        .when(kind == 3, F.lit(None))
        .otherwise(F.col("text"))
    )
    return d.select("doc_id", text.task_completed(answer).alias("completed"))


@query
def instruction_category(spark, sf_dir):
    """Category of every document read as an instruction, and of the judged ones."""
    documents = fx.table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("i")
    )
    judged = fx.judged_predictions(spark, sf_dir)
    judged = judged.filter(F.col("checkpoint") == FIRST).select(
        F.lit("events").alias("origin"), "id", F.col("instruction").alias("i")
    )
    return documents.unionByName(judged).select(
        "origin", "id", text.instruction_category(F.col("i")).alias("category")
    )


@query
def teacher_records(spark, sf_dir):
    """Accepted answers as rows of the JSON dataset."""
    accepted = attempts.accept_attempts(fx.attempt_log(spark, sf_dir))
    prompts = F.concat(F.lit("Prompt "), F.col("idx").cast("string"))
    rows = accepted.select(
        "idx",
        prompts.alias("instruction"),
        F.lit(None).cast("string").alias("input"),
        F.lit(None).cast("string").alias("task_type"),
        "text",
    )
    return prep.teacher_records(rows)


@query
def json_dataset(spark, sf_dir):
    """The whole job from a prompt pool and its call log to both sides of a split."""
    prompts = fx.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 5).alias("idx"))
    pool = prompts.distinct().select(
        "idx",
        F.concat(F.lit("Prompt "), F.col("idx").cast("string")).alias("instruction"),
        F.lit("").alias("input"),
        F.lit("t").alias("task_type"),
    )
    rows = datasets.json_dataset(pool, fx.attempt_log(spark, sf_dir), eval_size=50)
    return rows.select("idx", "output", "task_type", "split")


# --- order and splits ------------------------------------------------------------------


@query
def shuffled_order(spark, sf_dir):
    return prep.shuffled(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query
def head_limit(spark, sf_dir):
    """The first 25 rows of the shuffled order."""
    order = prep.shuffled(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return prep.head(order, 25)


@query
def positional_ids(spark, sf_dir):
    """Row numbers in file order, and batches of 16 of them."""
    c = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return prep.with_batch_id(prep.with_idx(c, "conv_id", "turn"), 16)


@query
def split_fraction(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").select("doc_id")
    return prep.split_fraction(d, "doc_id", 0.95)


@query
def split_fraction_by_hash(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").select("doc_id")
    return prep.split_fraction(d, "doc_id", 0.95, exact=False)


def split_pool(spark: SparkSession, sf_dir: str, by: str, train_cap: int | None = None) -> DataFrame:
    keyed = fx.leaky_pool(spark, sf_dir).withColumn("row_key", F.concat_ws("-", "doc_id", "copy_no"))
    return prep.split_capped(keyed, "row_key", 100, train_cap, by=by)


@query
def split_capped(spark, sf_dir):
    """Split by position with stated sizes of both sides: copies may be on both."""
    return split_pool(spark, sf_dir, "position", 80).select("doc_id", "copy_no", "split")


@query
def split_uncapped(spark, sf_dir):
    """Split by position; all rows past the eval side are train."""
    return split_pool(spark, sf_dir, "position").select("doc_id", "copy_no", "split")


@query
def split_leakfree(spark, sf_dir):
    """Split by content: all copies of a prompt share a side."""
    return split_pool(spark, sf_dir, "content").select("doc_id", "copy_no", "split")


@query
def split_overlap(spark, sf_dir):
    """Prompts on both sides, for either way of splitting."""
    found = None
    for by in ("position", "content"):
        one = prep.split_overlap(split_pool(spark, sf_dir, by), "instruction", "input")
        one = one.select(F.lit(by).alias("by"), "n_overlap")
        found = one if found is None else found.unionByName(one)
    return found


@query
def split_near_copies(spark, sf_dir):
    """Split by groups of near copies: no prompt has one on the other side."""
    return nearsplit.split_near(fx.leaky_pool(spark, sf_dir), 100).select("doc_id", "copy_no", "split")


@query
def near_copy_overlap(spark, sf_dir):
    """Eval prompts with a near copy among train, for three ways of splitting."""
    pool = fx.leaky_pool(spark, sf_dir)
    rows = nearsplit.contents(pool, "instruction", "input")  # of all three, which split the same pool
    ways = {
        "position": split_pool(spark, sf_dir, "position"),
        "content": split_pool(spark, sf_dir, "content"),
        "near copies": nearsplit.split_near(pool, 100, rows=rows),
    }
    return nearsplit.near_overlaps(ways, "instruction", "input", rows=rows)


# --- text metrics ---------------------------------------------------------------------


@query
def rouge1(spark, sf_dir):
    scores = textmetrics.rouge_n(fx.text_predictions(spark, sf_dir), 1, use_stemmer=False)
    return scores.select("id", "checkpoint", r6("rouge1_f1").alias("rouge1_f1"))


@query
def rouge2(spark, sf_dir):
    scores = textmetrics.rouge_n(fx.text_predictions(spark, sf_dir), 2, use_stemmer=False)
    return scores.select("id", "checkpoint", r6("rouge2_f1").alias("rouge2_f1"))


@query
def rougeL(spark, sf_dir):
    scores = textmetrics.rouge_l(fx.text_predictions(spark, sf_dir), use_stemmer=False)
    return scores.select("id", "checkpoint", r6("rougeL_f1").alias("rougeL_f1"))


@query
def rouge_stemmed(spark, sf_dir):
    """All three scores with stemming, the default mode."""
    return rounded(
        textmetrics.rouge(fx.text_predictions(spark, sf_dir)).select(
            "id", "checkpoint", "rouge1_f1", "rouge2_f1", "rougeL_f1"
        )
    )


@query
def output_length(spark, sf_dir):
    return rounded(textmetrics.output_length(fx.text_predictions(spark, sf_dir)))


@query
def output_length_segmented(spark, sf_dir):
    """Lengths in pieces of a vocabulary."""
    tokenizer = segment.longest_match(fx.VOCABULARY)
    return rounded(textmetrics.output_length(fx.text_predictions(spark, sf_dir), tokenizer))


@query
def completion_rate(spark, sf_dir):
    return rounded(textmetrics.completion_rate(fx.text_predictions(spark, sf_dir)))


@query
def embedding_f1(spark, sf_dir):
    return rounded(textmetrics.embedding_f1(fx.token_embeddings(spark, sf_dir)))


def text_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textmetrics.text_metrics(
        fx.text_predictions(spark, sf_dir), fx.token_embeddings(spark, sf_dir)
    )


@query
def text_metrics(spark, sf_dir):
    return rounded(text_scores(spark, sf_dir))


# --- predictions, judging -------------------------------------------------------------


@query
def predictions(spark, sf_dir):
    """Every turn with the assistant turn behind it as output, or none."""
    c = fx.table(spark, sf_dir, "conversations")
    idx = F.col("conv_id") * 1000 + F.col("turn")
    rows = c.select(idx.alias("idx"), F.col("text").alias("instruction"))
    outputs = c.filter(F.col("role") == "assistant").select(
        (idx - 1).alias("idx"), F.col("text").alias("prediction")
    )
    return attempts.assemble_predictions(rows, outputs, fx.CHECKPOINTS[0])


def swapped_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = judge.comparison_plan(fx.text_predictions(spark, sf_dir), fx.CHECKPOINTS)
    drawn = prep.assign_swap(plan, key=("checkpoint_a", "checkpoint_b", "idx"))
    return judge.apply_swap(drawn)


@query
def pair_plan(spark, sf_dir):
    return swapped_plan(spark, sf_dir).select(
        "idx", "checkpoint_a", "checkpoint_b", "swapped", "response_a", "response_b"
    )


def completed(spark: SparkSession, sf_dir: str, trust: bool) -> DataFrame:
    asked = planned(fx.pair_judgements(spark, sf_dir))
    plan = asked.select("idx", "first", "second", "swapped")
    # Every fifth answer claims a swap of its own.
    claimed = F.when(F.col("idx") % 5 == 0, ~F.col("swapped"))
    verdicts = asked.withColumns({"prompt_id": F.lit(None).cast("string"), "swapped": claimed})
    return judge.complete_judgements(verdicts, plan, trust_model_labels=trust).select(
        "idx", "pair", "prompt_id", "checkpoint_a", "checkpoint_b", "swapped"
    )


@query
def completed_judgements(spark, sf_dir):
    """Prompt ids and labels from the comparison plan."""
    return completed(spark, sf_dir, trust=False)


@query
def completed_judgements_trusting(spark, sf_dir):
    """Prompt ids and labels from the judge's answer where it gave them."""
    return completed(spark, sf_dir, trust=True)


@query
def completed_json_judgements(spark, sf_dir):
    preds = fx.json_predictions(spark, sf_dir)
    verdicts = preds.select(
        F.col("id").alias("idx"),
        F.col("checkpoint").alias("asked_checkpoint"),
        F.when(F.col("task_type") == "json_repair", F.lit("given")).alias("prompt_id"),
        F.when(F.col("task_type") == "tool_call_args", F.lit("other")).alias("checkpoint"),
    )
    return judge.complete_json_judgements(verdicts)


@query
def allowed_judgements(spark, sf_dir):
    """Judgements between known labels, per pair."""
    allowed = judge.for_labels(fx.pair_judgements(spark, sf_dir), fx.CHECKPOINTS)
    return allowed.groupBy("pair").agg(
        F.count(F.lit(1)).alias("n"), F.sum("idx").alias("sum_idx")
    )


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.judge_stats(fx.pair_judgements(spark, sf_dir), fx.CHECKPOINTS)


@query
def win_tally(spark, sf_dir):
    return rounded(
        stats(spark, sf_dir).select(
            "checkpoint",
            "wins",
            "losses",
            "ties",
            "total_compares",
            "win_rate",
            "tie_rate",
            "loss_rate",
        )
    )


@query
def judge_summary(spark, sf_dir):
    return rounded(judge.judge_summary(stats(spark, sf_dir)))


def contested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgements of the second checkpoint against the first."""
    return fx.pair_judgements(spark, sf_dir).filter(F.col("pair") == "1v2")


@query
def head_to_head(spark, sf_dir):
    return rounded(forgetting.head_to_head(contested(spark, sf_dir), FIRST, SECOND))


@query
def head_to_head_positional(spark, sf_dir):
    return rounded(
        forgetting.head_to_head(contested(spark, sf_dir), FIRST, SECOND, positional=True)
    )


@query
def category_breakdown(spark, sf_dir):
    return forgetting.category_breakdown(
        contested(spark, sf_dir), fx.judged_predictions(spark, sf_dir), FIRST, SECOND
    )


@query
def exemplars(spark, sf_dir):
    return forgetting.exemplars(
        contested(spark, sf_dir), fx.judged_predictions(spark, sf_dir), FIRST, SECOND
    )


@query
def metric_deltas(spark, sf_dir):
    return rounded(forgetting.metric_deltas(text_scores(spark, sf_dir), FIRST, SECOND))


@query
def forgetting_summary(spark, sf_dir):
    """The whole summary as key/value rows."""
    summary = forgetting.forgetting_summary(
        contested(spark, sf_dir),
        fx.judged_predictions(spark, sf_dir),
        text_scores(spark, sf_dir),
        FIRST,
        SECOND,
    )
    nested = (
        "category_breakdown",
        "representative_regression_example",
        "representative_improvement_example",
    )
    return compare.to_key_value(
        rounded(summary.drop("available_metrics_files")).select(
            *(
                F.format_string("%.6f", c).alias(c) if t == "double" else F.col(c)
                for c, t in summary.drop("available_metrics_files").dtypes
                if c not in nested
            ),
            *nested,
        )
    )


@query
def checkpoint_comparison(spark, sf_dir):
    return rounded(
        reports.comparison(
            fx.CHECKPOINTS,
            stats(spark, sf_dir),
            text_scores(spark, sf_dir),
            jsoneval.json_metrics(scored(spark, sf_dir), fx.CHECKPOINTS),
        )
    )


@query
def evaluation_report(spark, sf_dir):
    """A whole evaluation written as files; its comparison table read back."""
    out = scratch(spark, "evaluation")
    reports.write_evaluation(
        out,
        fx.CHECKPOINTS,
        fx.text_predictions(spark, sf_dir),
        fx.json_predictions(spark, sf_dir),
        fx.pair_judgements(spark, sf_dir),
        contested(spark, sf_dir),
        FIRST,
        SECOND,
        fx.token_embeddings(spark, sf_dir),
        run_tag="all",
    )
    kinds = ", ".join(
        f"{c} {'STRING' if c == 'checkpoint' else 'DOUBLE'}" for c in compare.COMPARISON_COLUMNS
    )
    table = spark.read.schema(kinds).option("header", "true")
    return rounded(table.csv(f"{out}/tables/comparison_all.csv"))


@query
def comparison_without_judgements(spark, sf_dir):
    """The comparison where no judge file is found, with a label that has no rows at all."""
    labels = (*fx.CHECKPOINTS, "ckpt9_absent")
    found = find_judgements(spark, f"{scratch(spark, 'no-judge')}/*.jsonl")
    judged = judge.absent_stats(spark, labels) if found is None else judge.judge_stats(found, labels)
    return rounded(
        reports.comparison(
            labels,
            judged,
            text_scores(spark, sf_dir),
            jsoneval.json_metrics(scored(spark, sf_dir), labels),
        )
    )


# --- attempt logs ------------------------------------------------------------------------


@query
def accepted_attempts(spark, sf_dir):
    return attempts.accept_attempts(fx.attempt_log(spark, sf_dir))


@query
def accepted_judge_attempts(spark, sf_dir):
    accepted = attempts.accept_judge_attempts(fx.attempt_log(spark, sf_dir))
    return accepted.select("idx", "attempt", "text")


@query
def pending_prompts(spark, sf_dir):
    """Prompts whose calls gave no accepted answer."""
    log = fx.attempt_log(spark, sf_dir)
    prompts = fx.table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 5).alias("idx")
    )
    return attempts.pending(prompts.distinct(), attempts.accept_attempts(log))


# --- attempt logs as streams ---------------------------------------------------------------


def streamed(spark: SparkSession, sf_dir: str, follow: Callable[..., DataFrame]) -> DataFrame:
    """Outcomes of the log read as a stream: rows dealt over files at random, a restart in between.

    Prompts are announced, and a last call hours later moves the watermark past all that came before.
    """
    start = F.lit(1_700_000_000)
    log = fx.attempt_log(spark, sf_dir).withColumn("at", F.timestamp_seconds(start + F.col("attempt") * 60 + F.col("idx") % 60))
    prompts = fx.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 5).alias("idx")).distinct()
    none = {c: F.lit(None).cast(t) for c, t in (("attempt", "int"), ("status", "string"), ("text", "string"))}
    rows = log.unionByName(prompts.withColumns(none).withColumn("at", F.timestamp_seconds(start)))
    last = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("idx"), F.lit(0).alias("attempt"), F.lit("api_error").alias("status"),
        F.lit(None).cast("string").alias("text"), F.timestamp_seconds(start + 36_000).alias("at"),
    )
    side = text.hash32(F.concat_ws("|", "idx", "attempt")) % 2
    root = scratch(spark, "attempt-stream")
    for part in (rows.filter(side == 0), rows.filter(side == 1), last):
        write_jsonl(part, f"{root}/log", mode="append")
        outcomes = follow(attempt_stream.read_log(spark, f"{root}/log"))
        attempt_stream.start(outcomes, f"{root}/outcomes", f"{root}/checkpoint").awaitTermination()
    return attempt_stream.settled(spark, f"{root}/outcomes")


@query
def streamed_attempts(spark, sf_dir):
    """Accepted answers of a log that is read as a stream."""
    found = streamed(spark, sf_dir, attempt_stream.follow_attempts)
    return found.filter(F.col("outcome") == attempt_stream.ACCEPTED).drop("outcome")


@query
def streamed_judge_attempts(spark, sf_dir):
    found = streamed(spark, sf_dir, attempt_stream.follow_judge_attempts)
    return found.filter(F.col("outcome") == attempt_stream.ACCEPTED).drop("outcome")


@query
def streamed_pending(spark, sf_dir):
    """Prompts that a stream of calls has failed or given up."""
    return attempt_stream.pending(streamed(spark, sf_dir, attempt_stream.follow_attempts)).select("idx")


# --- metrics kept up to date ------------------------------------------------------------------


FILE_ROWS = 500_000


def kept_up_to_date(spark: SparkSession, rows: DataFrame, kind: incremental.Kind, key: str) -> str:
    """A store after two updates: of three sets of files, then of one more, one replaced and one gone.

    What is there in the end are ``rows``, dealt over three sets; until then one set holds other
    rows, and another should not be there at all. Each task writes files of a set, of FILE_ROWS rows at most, so that
    tasks that read them are even; as texts that are much alike they are compressed. Rows are made once:
    a set that has the rows of another is a copy of its lines.
    """
    root = scratch(spark, "incremental")
    folder, store = f"{root}/files", f"{root}/store"
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(FILE_ROWS)}

    def writer(part: DataFrame, options: dict[str, str]):
        return part.write.mode("overwrite").options(**options)

    def put(name: int, part: DataFrame, options: dict[str, str] = packed) -> None:
        writer(part, options).option("ignoreNullFields", "false").json(f"{folder}/part={name}")

    def copy(name: int, of: int) -> None:
        writer(spark.read.text(f"{folder}/part={of}"), packed).text(f"{folder}/part={name}")

    def third(k: int) -> DataFrame:
        return rows.filter(F.pmod(F.col(key), F.lit(3)) == k)

    put(0, third(0))
    copy(1, of=0)
    put(3, third(2))
    incremental.update(spark, kind, f"{folder}/*", store)
    put(1, third(1))
    copy(2, of=3)
    put(3, rows.limit(0), {})  # a file of no bytes
    incremental.update(spark, kind, f"{folder}/*", store)
    return store


@query
def incremental_json_metrics(spark, sf_dir):
    """JSON metrics of prediction files that came, changed and went."""
    store = kept_up_to_date(spark, fx.json_predictions(spark, sf_dir), incremental.JSON, "id")
    return rounded(incremental.json_metrics(spark, store).drop("error_taxonomy_counts"))


@query
def incremental_error_taxonomy(spark, sf_dir):
    store = kept_up_to_date(spark, fx.json_predictions(spark, sf_dir), incremental.JSON, "id")
    return incremental.error_taxonomy(spark, store)


@query
def incremental_text_metrics(spark, sf_dir):
    """ROUGE, length and completion of prediction files that came, changed and went."""
    preds = fx.text_predictions(spark, sf_dir)
    store = kept_up_to_date(spark, preds, incremental.TEXT, "id")
    return rounded(incremental.text_metrics(spark, store).drop("bertscore_f1_avg"))


@query
def incremental_judge_stats(spark, sf_dir):
    """Judge statistics of judgement files that came, changed and went."""
    judged = fx.pair_judgements(spark, sf_dir).withColumn("justification", F.lit(""))
    rows = judged.withColumn("prompt_id", F.format_string(judge.PAIR_PROMPT_ID, "idx"))
    store = kept_up_to_date(spark, rows, incremental.JUDGEMENTS, "idx")
    found = incremental.judge_stats(spark, store, fx.CHECKPOINTS)
    return rounded(found.select("checkpoint", "wins", "losses", "ties", "total_compares", "win_rate", "tie_rate", "loss_rate"))


# --- tables by run and by prompt ----------------------------------------------------------------


@query
def run_deltas(spark, sf_dir):
    """Changes of the judge statistics between two runs; one of them was written twice."""
    path, columns = scratch(spark, "runs"), ("win_rate", "tie_rate", "avg_clarity")
    judged = fx.pair_judgements(spark, sf_dir)

    def stats_where(condition: Column) -> DataFrame:
        return judge.judge_stats(judged.filter(condition), fx.CHECKPOINTS).select("checkpoint", *columns)

    odd = F.col("idx") % 2
    write_run(stats_where(F.lit(True)), path, "base")
    write_run(stats_where(odd == 0), path, "ablation")
    write_run(stats_where(odd == 0), path, "other")
    write_run(stats_where(odd == 1), path, "ablation")
    schema = "checkpoint STRING, win_rate DOUBLE, tie_rate DOUBLE, avg_clarity DOUBLE"
    table = read_runs(spark, path, schema, ("base", "ablation"))
    return rounded(forgetting.run_deltas(table, "base", "ablation", columns))


def bucketed(spark: SparkSession, df: DataFrame, key: str, prompts: DataFrame) -> DataFrame:
    """``df`` in buckets, as many as the number of rows of ``prompts`` asks for."""
    name = f"evalspark_{uuid.uuid4().hex}"
    return write_bucketed(df, name, key, bucket_count(prompts.count()), f"{scratch(spark, 'tables')}/{name}")


@query
def bucketed_pair_plan(spark, sf_dir):
    """The comparison plan over predictions bucketed by prompt."""
    preds = bucketed(spark, fx.text_predictions(spark, sf_dir), "id", fx.table(spark, sf_dir, "conversations"))
    plan = judge.comparison_plan(preds, fx.CHECKPOINTS)
    drawn = prep.assign_swap(plan, key=("checkpoint_a", "checkpoint_b", "idx"))
    return judge.apply_swap(drawn).select(
        "idx", "checkpoint_a", "checkpoint_b", "swapped", "response_a", "response_b"
    )


@query
def bucketed_category_breakdown(spark, sf_dir):
    """Wins per category over judgements and predictions bucketed by prompt."""
    events = fx.table(spark, sf_dir, "events")
    return forgetting.category_breakdown(
        bucketed(spark, contested(spark, sf_dir), "idx", events),
        bucketed(spark, fx.judged_predictions(spark, sf_dir), "id", events),
        FIRST,
        SECOND,
    )


def planned(judged: DataFrame) -> DataFrame:
    """Judgements with the labels of their pair in the plan's order."""
    ends = {f"{a}v{b}": (fx.CHECKPOINTS[a], fx.CHECKPOINTS[b]) for a, b in fx.PAIRS}
    sides = [
        F.create_map(*(F.lit(x) for pair, side in ends.items() for x in (pair, side[i])))
        for i in (0, 1)
    ]
    return judged.withColumns({"first": sides[0][F.col("pair")], "second": sides[1][F.col("pair")]})


def reported(judged: DataFrame, preds: DataFrame) -> DataFrame:
    return rounded(forgetting.outcome_report(planned(judged), preds, fx.CHECKPOINTS))


@query
def outcome_report(spark, sf_dir):
    """Wins and ties by pair, category, order and in all, from one aggregation."""
    return reported(fx.pair_judgements(spark, sf_dir), fx.judged_predictions(spark, sf_dir))


@query
def bucketed_outcome_report(spark, sf_dir):
    """The same over bucketed tables."""
    events = fx.table(spark, sf_dir, "events")
    return reported(
        bucketed(spark, fx.pair_judgements(spark, sf_dir), "idx", events),
        bucketed(spark, fx.judged_predictions(spark, sf_dir), "id", events),
    )


# --- sources and sinks --------------------------------------------------------------------


@query
def jsonl_roundtrip(spark, sf_dir):
    """Instruction rows written as JSON Lines and read back."""
    rows = fx.turns(spark, sf_dir).select(
        "instruction",
        F.lit(None).cast("string").alias("input"),
        F.col("reference").alias("output"),
    )
    path = scratch(spark, "instructions")
    write_jsonl(rows, path)
    return read_jsonl(spark, path, schemas.INSTRUCTIONS)


@query
def missing_paths(spark, sf_dir):
    """Two files that exist and one that does not, read as one table."""
    rows = fx.turns(spark, sf_dir).select(
        "instruction", F.lit("").alias("input"), F.col("reference").alias("output"), "idx"
    )
    root = scratch(spark, "parts")
    for k in (0, 1):
        write_jsonl(rows.filter(F.col("idx") % 2 == k).drop("idx"), f"{root}/{k}.jsonl")
    paths = [f"{root}/{name}.jsonl" for name in ("0", "none", "1")]
    return read_jsonl(spark, paths, schemas.INSTRUCTIONS)


@query
def instruction_source(spark, sf_dir):
    """Instruction rows of documents, from parquet and from JSON Lines."""
    rows = fx.table(spark, sf_dir, "documents").select(
        F.col("text").alias("instruction"), F.col("lang").alias("input"), F.col("source").alias("output"), "n_chars"
    )
    root = scratch(spark, "instructions")
    rows.write.parquet(f"{root}/rows.parquet")
    write_jsonl(rows.drop("n_chars"), f"{root}/rows.jsonl")
    found = None
    for kind in ("parquet", "jsonl"):
        one = read_instructions(spark, f"{root}/rows.{kind}").select(F.lit(kind).alias("kind"), "*")
        found = one if found is None else found.unionByName(one)
    return found


@query
def judgement_files(spark, sf_dir):
    """One file set per pair, found by a pattern and read as one table."""
    root = scratch(spark, "judge")
    fx.pair_judgements(spark, sf_dir).select(
        "pair",
        F.format_string(judge.PAIR_PROMPT_ID, "idx").alias("prompt_id"),
        "checkpoint_a",
        "checkpoint_b",
        "response_a_scores",
        "response_b_scores",
        "winner",
        F.lit("").alias("justification"),
        "swapped",
    ).write.partitionBy("pair").option("ignoreNullFields", "false").json(root)
    found = read_judgements(spark, f"{root}/pair=*v*")
    return rounded(
        judge.judge_stats(found, fx.CHECKPOINTS).select(
            "checkpoint", "wins", "losses", "ties", "total_compares", "avg_clarity"
        )
    )


@query
def report_csv(spark, sf_dir):
    """The judge summary written as a tagged CSV report and read back."""
    columns = ("checkpoint", "win_rate", "tie_rate")
    report = rounded(judge.judge_summary(stats(spark, sf_dir)))
    path = write_report(report, f"{scratch(spark, 'reports')}/summary.csv", columns, "run2")
    schema = "checkpoint STRING, win_rate DOUBLE, tie_rate DOUBLE"
    return spark.read.schema(schema).option("header", "true").csv(path)


@query
def first_documents(spark, sf_dir):
    """The first event of every user, as a first row per key."""
    e = fx.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props")
    return compare.first_document(e, ["user_id"], "event_id")


@query
def preferred_source(spark, sf_dir):
    """A user's first purchase or, where there is none, the first event."""
    e = fx.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    purchases = e.filter(F.col("event_type") == "purchase")
    return compare.prefer(
        [compare.first_document(x, ["user_id"], "event_id") for x in (purchases, e)], ["user_id"]
    )


@query
def key_value_report(spark, sf_dir):
    """Counts of two checkpoints as key/value rows."""
    counts = forgetting.head_to_head(contested(spark, sf_dir), FIRST, SECOND)
    return compare.to_key_value(
        counts.select("total_pairs", "ckpt1_wins", "ckpt2_wins", "ties")
    )
