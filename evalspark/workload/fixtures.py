"""Tables in the shapes the operators expect, derived from the driver's parquet.

Every rule is integer arithmetic, string concatenation or md5, so the SQL twins
in ``oracle`` build the same rows without sharing code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from evalspark.functions.text import hash32
from evalspark.operators.prep import POOL_INSTRUCTIONS
from evalspark.prompts import DIMENSIONS

CHECKPOINTS = ("ckpt0_base", "ckpt1_stage1", "ckpt2_stage2")
PAIRS = ((0, 1), (1, 2), (0, 2))
TASK_TYPES = tuple(POOL_INSTRUCTIONS)


# Pieces of words, some of which begin others, and one with a space.
VOCABULARY = (
    "a", "an", "and", "ar", "are", "be", "ca", "can", "de", "den", "e", "en", "er", "ers", "es", "est",
    "ha", "have", "i", "in", "ing", "ingen", "is", "l", "la", "le", "les", "o", "on", "or", "ou", "que",
    "re", "s", "st", "t", "te", "ter", "th", "the", "ther", "this", "to", "un", "und", "us", ". ", ", ",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, dealt over the shuffle partitions by the first of them.

    For work that is heavy per row, as the driver's files are few and hold one split each.
    """
    return table(spark, sf_dir, name).select(*columns).repartition(columns[0])


def _case(selector: Column, branches: dict[int, Column]) -> Column:
    chosen = None
    for value, result in branches.items():
        hit = selector == value
        chosen = F.when(hit, result) if chosen is None else chosen.when(hit, result)
    return chosen


def _text(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


# --- predictions in free text, from conversations --------------------------


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that answers them: idx, instruction, reference."""
    c = spread_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    following = Window.partitionBy("conv_id").orderBy("turn")
    answer = F.lead(F.struct("turn", "role", "text")).over(following)
    pairs = c.withColumn("_next", answer).filter(
        (F.col("role") == "user")
        & (F.col("_next.role") == "assistant")
        & (F.col("_next.turn") == F.col("turn") + 1)
    )
    return pairs.select(
        "conv_id",
        "turn",
        F.col("text").alias("instruction"),
        F.col("_next.text").alias("reference"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("idx"),
    )


def user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All user turns, answered or not: idx, instruction."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("idx"), F.col("text").alias("instruction"))


def text_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three checkpoints: the reference, every other word of it, another conversation's answer."""
    t = turns(spark, sf_dir)
    other = t.select(
        (F.col("conv_id") - 1).alias("conv_id"), "turn", F.col("reference").alias("other")
    )
    words = F.split("reference", " ")
    half = F.array_join(F.filter(words, lambda w, i: i % 2 == 0), " ")
    versions = F.array(
        F.struct(F.lit(CHECKPOINTS[0]).alias("checkpoint"), F.col("reference").alias("prediction")),
        F.struct(F.lit(CHECKPOINTS[1]).alias("checkpoint"), half.alias("prediction")),
        F.struct(
            F.lit(CHECKPOINTS[2]).alias("checkpoint"),
            F.coalesce("other", F.lit("")).alias("prediction"),
        ),
    )
    return t.join(other, ["conv_id", "turn"], "left").select(
        F.col("idx").alias("id"),
        "instruction",
        F.lit("").alias("input"),
        F.lit("").alias("task_type"),
        "reference",
        F.inline(versions),
    )


# --- predictions in JSON, from events ---------------------------------------


def _json_parts(e: DataFrame) -> DataFrame:
    """Per event: task family, key/value texts of its reference, damage counter."""
    user = _text('"user', F.col("user_id").cast("string"), '"')
    city = _text('"city', (F.col("user_id") % 50).cast("string"), '"')
    day = _text('"', F.date_format("ts", "yyyy-MM-dd"), '"')
    age = (18 + F.col("user_id") % 60).cast("string")
    label = F.element_at(
        F.array(F.lit('"positive"'), F.lit('"neutral"'), F.lit('"negative"')),
        (F.col("user_id") % 3 + 1).cast("int"),
    )
    entities = _text("[", user, ',"', F.col("event_type"), '"]')
    arguments = _text('{"city":', city, ',"date":', day, "}")

    def members(*pairs: tuple[str, Column]) -> Column:
        return F.array(
            *(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in pairs)
        )

    return e.select(
        "event_id",
        (F.col("event_id") % 5).alias("family"),
        F.floor(F.col("event_id") / 5).alias("m"),
        _case(
            F.col("event_id") % 5,
            {
                0: members(("entities", entities), ("location", city), ("date", day)),
                1: members(("name", user), ("age", age), ("city", city)),
                2: members(("label", label)),
                3: members(("name", user), ("age", age)),
                4: members(("function", F.lit('"weather"')), ("arguments", arguments)),
            },
        ).alias("members"),
    )


def _object(members: Column) -> Column:
    inner = F.transform(members, lambda m: F.concat(F.lit('"'), m["k"], F.lit('":'), m["v"]))
    return F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}"))


def _damaged(kind: Column) -> Column:
    """The prediction text of damage class ``kind``."""
    members, ref = F.col("members"), F.col("reference")
    first = F.struct(F.get(members, F.lit(0))["k"].alias("k"), F.lit("7").alias("v"))
    rest = F.slice(members, F.lit(2), F.size(members))
    before_brace = F.substr(ref, F.lit(1), F.instr(ref, "}") - 1)
    return _case(
        kind,
        {
            0: ref,
            1: _object(F.reverse(members)),
            2: _text("```json\n", ref, "\n```"),
            3: _text('<think>{"x":1}</think>\n', ref),
            4: _text("Here it is: ", ref, " Hope it helps."),
            5: _text(F.substr(ref, F.lit(1), F.length(ref) - 1), ",}"),
            6: before_brace,
            7: F.lit("I could not find any data."),
            8: _object(rest),
            9: _text(F.substr(ref, F.lit(1), F.length(ref) - 1), ',"zz":0}'),
            10: _object(F.concat(F.array(first), rest)),
            11: F.lit("[1,2,3]"),
        },
    )


def json_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instruction row with its valid JSON answer per event."""
    parts = _json_parts(
        spread_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    )
    return parts.withColumn("reference", _object(F.col("members")))


def json_predictions(
    spark: SparkSession, sf_dir: str, checkpoints: tuple[str, ...] = CHECKPOINTS
) -> DataFrame:
    """Some of three checkpoints per event, each damaged by its own counter."""
    refs = json_references(spark, sf_dir)
    versions = F.array(
        *(
            F.struct(F.lit(name).alias("checkpoint"), (F.col("m") % n).alias("kind"))
            for name, n in zip(CHECKPOINTS, (12, 7, 9))
            if name in checkpoints
        )
    )
    task = F.element_at(
        F.array(*(F.lit(t) for t in TASK_TYPES)), (F.col("family") + 1).cast("int")
    )
    return (
        refs.select("event_id", "family", "members", "reference", F.inline(versions))
        .select(
            F.col("event_id").alias("id"),
            "checkpoint",
            _text("Answer event ", F.col("event_id").cast("string")).alias("instruction"),
            F.lit("").alias("input"),
            task.alias("task_type"),
            _damaged(F.col("kind")).alias("prediction"),
            "reference",
        )
    )


# Reference and prediction texts that are hard to read or compare; %s is a number of the event.
HARD_CASES = (
    ("null", "null"),
    ("not json", '{"a":%s}'),
    ('[{"a":%s}]', '{"a":%s}'),
    ('{"a":%s,"b":[1,2.50]}', '{"b":[1.0,25e-1],"a":%s.0}'),
    ('{"a":1e22,"n":%s}', '{"a":10000000000000000000000,"n":%s}'),
    ('{"a":1%s0000000000000000000000000000000000000001}', '{"a":1%s0000000000000000000000000000000000000002}'),
    ('{"a":{"x":[1,{"y":%s}]}}', '{"a":{"x":[1,{"y":%s}]},"a":{"x":[{"y":%s},1]}}'),
    ('{"a":%s,"a":"last"}', '{"a":"last"}'),
    ('{"a":"caf\\u00e9 %s"}', '{"a":"café %s"}'),
    ('{"a":%s}', '{"a":"%s"}'),
    ('{"a":1.5,"b":"%s"}', '{"a":"1.5","b":"%s"}'),
    ('{"entities":["u%s",1.0,"x"],"location":null}', '{"entities":["u%s",1],"location":null}'),
    ('{"a":1234567890123456789.0,"b":%s}', '{"a":1234567890123456789,"b":%s}'),
    ('{"a":%s,"b":true}', '{"a":%s,"b":1}'),
    ('{"a":%s}', "[%s]"),
    ('{"a":%s}', '{"a":%s'),
)


def json_hard_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per event and one of the hard cases each."""
    e = spread_table(spark, sf_dir, "events", "event_id", "user_id")
    number = F.col("user_id").cast("string")

    def filled(side: int) -> Column:
        texts = F.array(*(F.lit(case[side]) for case in HARD_CASES))
        chosen = F.element_at(texts, (F.col("event_id") % len(HARD_CASES) + 1).cast("int"))
        return F.replace(chosen, F.lit("%s"), number)

    return e.select(
        F.col("event_id").alias("id"),
        F.element_at(
            F.array(*(F.lit(c) for c in CHECKPOINTS)), (F.col("user_id") % 3 + 1).cast("int")
        ).alias("checkpoint"),
        filled(0).alias("reference"),
        filled(1).alias("prediction"),
    )


# --- pairwise judgements, from events ---------------------------------------


def pair_judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One judgement per event and pair of checkpoints."""
    e = spread_table(spark, sf_dir, "events", "event_id")
    plan = F.array(
        *(
            F.struct(
                F.lit(f"{a}v{b}").alias("pair"),
                F.lit(CHECKPOINTS[a]).alias("first"),
                F.lit(CHECKPOINTS[b]).alias("second"),
            )
            for a, b in PAIRS
        )
    )
    keyed = e.select("event_id", F.inline(plan)).withColumn(
        "k", hash32(_text(F.col("pair"), "|", F.col("event_id").cast("string")))
    )
    k = F.col("k")
    label_a = F.when(k % 89 == 0, F.lit(None)).when(k % 97 == 0, "other").otherwise(F.col("first"))

    def scores(side: str) -> Column:
        return F.map_from_entries(
            F.filter(
                F.array(
                    *(
                        F.when(
                            (k % 11 != 0) | (F.lit(d) != "clarity"),
                            F.struct(
                                F.lit(d).alias("key"),
                                (
                                    1 + hash32(_text(f"{side}|{d}|", k.cast("string"))) % 5
                                ).cast("double").alias("value"),
                            ),
                        )
                        for d in DIMENSIONS
                    )
                ),
                lambda x: x.isNotNull(),
            )
        )

    swapped = k % 2 == 1
    w = k % 20
    return keyed.select(
        F.col("event_id").alias("idx"),
        "pair",
        F.when(swapped, F.col("second")).otherwise(label_a).alias("checkpoint_a"),
        F.when(swapped, label_a).otherwise(F.col("second")).alias("checkpoint_b"),
        F.when(swapped, scores("b")).otherwise(scores("a")).alias("response_a_scores"),
        F.when(swapped, scores("a")).otherwise(scores("b")).alias("response_b_scores"),
        F.when(w <= 7, "A")
        .when(w <= 12, "b")
        .when(w <= 17, "tie")
        .when(w == 18, "TIES")
        .otherwise("unclear")
        .alias("winner"),
        swapped.alias("swapped"),
    )


def judged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with the instructions the judgements of ``pair_judgements`` are about."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    instruction = (
        F.when(kind == "click", "Summarize this")
        .when(kind == "view", "Please rephrase it")
        .when(kind == "signup", "Give me ideas")
        .when(kind == "error", "Tell me what is wrong")
        .otherwise("What is this?")
    )
    labels = F.array(*(F.lit(c) for c in CHECKPOINTS))
    return e.select(
        F.col("event_id").alias("id"),
        instruction.alias("instruction"),
        F.lit("").alias("input"),
        "user_id",
        F.explode(labels).alias("checkpoint"),
    ).select(
        "id",
        "checkpoint",
        "instruction",
        "input",
        _text(F.col("checkpoint"), " says ", F.col("user_id").cast("string")).alias("prediction"),
    )


# --- token embeddings, pools and attempt logs -------------------------------


def token_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten vectors per row, five for each side."""
    v = table(spark, sf_dir, "embeddings")
    return v.select(
        F.element_at(
            F.array(*(F.lit(c) for c in CHECKPOINTS)),
            (F.floor(F.col("vec_id") / 10) % 3 + 1).cast("int"),
        ).alias("checkpoint"),
        F.floor(F.col("vec_id") / 10).alias("row_id"),
        F.when(F.col("vec_id") % 10 < 5, "candidate").otherwise("reference").alias("side"),
        (F.col("vec_id") % 5).cast("int").alias("pos"),
        F.col("embedding").alias("vector"),
    )


def leaky_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as prompts, every one of them twice; exact copies exist besides."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("copy_no"),
        F.col("text").alias("instruction"),
        F.lit("").alias("input"),
    )


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five attempts per prompt; a quarter of the calls failed."""
    first = json_predictions(spark, sf_dir, CHECKPOINTS[:1])
    draw = hash32(_text("s|", F.col("id").cast("string"))) % 16
    status = F.when(draw < 4, "api_error").when(draw == 4, "error").otherwise("ok")
    return first.select(
        F.floor(F.col("id") / 5).alias("idx"),
        (F.col("id") % 5).cast("int").alias("attempt"),
        status.alias("status"),
        F.when(status == "ok", F.col("prediction")).alias("text"),
    )
