"""Dataset preparation: clean-up, prompt pools, ordering, splits and swaps."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from evalspark.functions import jsonx, text

# --- fixed values ---------------------------------------------------------
# Instruction texts and seed columns of the five prompt families.
POOL_INSTRUCTIONS = {
    "json_extraction": "Extract entities and dates into JSON.",
    "schema_generation": (
        "You are given a JSON schema. Generate a profile object that matches the schema exactly. "
        "Return only valid JSON."
    ),
    "exact_label_classification": (
        "Classify the sentiment into exactly one label from [positive, neutral, negative]. "
        "Return JSON in the required shape only."
    ),
    "json_repair": "Repair malformed JSON. Return ONLY valid JSON (no explanations).",
    "tool_call_args": (
        "Create JSON arguments for a function call. Return ONLY the JSON argument object."
    ),
}
POOL_SEED_COLUMNS = {
    "json_extraction": ("first", "second", "location", "date"),
    "schema_generation": ("name", "age", "city"),
    "exact_label_classification": ("text", "label"),
    "json_repair": ("malformed", "name", "age"),
    "tool_call_args": ("city", "date"),
}
POOL_INPUTS = {
    "json_extraction": "%s met %s in %s on %s.",
    "schema_generation": (
        "Schema: {schema}\nUser preference: generate a profile for %s aged %s living in %s."
    ),
    "tool_call_args": "Get {function} for %s %s.",
}
POOL_EXAMPLES = {
    "json_extraction": '{"entities": [%s, %s], "location": %s, "date": %s}',
    "schema_generation": '{"name": %s, "age": %s, "city": %s}',
    "exact_label_classification": '{"label": %s}',
    "json_repair": '{"name": %s, "age": %s}',
    "tool_call_args": '{"function": "weather", "arguments": {"city": %s, "date": %s}}',
}
PROFILE_SCHEMA = '{"required": ["name", "age", "city"]}'
TOOL_FUNCTION = "weather"
# --------------------------------------------------------------------------

# Buckets of a hash order: the first four hex digits of md5.
_BUCKET_DIGITS = 4
# Key ranges of a sorted numbering, and how many share a group when a row looks up its own.
RANGES, _STEP = 1024, 32


def normalise_instructions(df: DataFrame) -> DataFrame:
    """Drop rows without an instruction, then strip the three fields.

    The test comes before the strip: an instruction of spaces stays, as "".
    """
    return df.filter(F.length("instruction") > 0).select(
        *(text.strip(text.or_empty(F.col(c))).alias(c) for c in ("instruction", "input", "output")),
        *(c for c in df.columns if c not in ("instruction", "input", "output")),
    )


# --- prompt pool ------------------------------------------------------------


def _quoted(c: Column) -> Column:
    """JSON text of a string."""
    inside = F.to_json(F.array(c), {"writeNonAsciiCharacterAsCodePoint": "true"})
    return F.substr(inside, F.lit(2), F.length(inside) - 2)


def _family_texts() -> dict[str, tuple[Column, Column]]:
    """Input text and example answer of each family, over its seed columns."""
    c = F.col
    whole = {"age"}  # numbers; all other seeds are texts

    def example(task_type: str, *names: str) -> Column:
        values = (c(n).cast("string") if n in whole else _quoted(c(n)) for n in names)
        return F.format_string(POOL_EXAMPLES[task_type], *values)

    def sentence(task_type: str, *names: str) -> Column:
        shape = POOL_INPUTS[task_type].format(schema=PROFILE_SCHEMA, function=TOOL_FUNCTION)
        return F.format_string(shape, *(c(n).cast("string") for n in names))

    extraction, profile = (POOL_SEED_COLUMNS[t] for t in ("json_extraction", "schema_generation"))
    call = POOL_SEED_COLUMNS["tool_call_args"]
    return {
        "json_extraction": (
            sentence("json_extraction", *extraction), example("json_extraction", *extraction)
        ),
        "schema_generation": (
            sentence("schema_generation", *profile), example("schema_generation", *profile)
        ),
        "exact_label_classification": (c("text"), example("exact_label_classification", "label")),
        "json_repair": (c("malformed"), example("json_repair", "name", "age")),
        "tool_call_args": (sentence("tool_call_args", *call), example("tool_call_args", *call)),
    }


def prompt_family(seeds: DataFrame, task_type: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prompts of one family from its seed rows; ``keep`` names columns to carry along."""
    input_, example = _family_texts()[task_type]
    return seeds.select(
        *keep,
        F.lit(task_type).alias("task_type"),
        F.lit(POOL_INSTRUCTIONS[task_type]).alias("instruction"),
        input_.alias("input"),
        example.alias("json_example"),
    )


def replicate(df: DataFrame, copies: int) -> DataFrame:
    """Every row ``copies`` times, told apart by ``copy_no``."""
    numbers = F.array(*(F.lit(i) for i in range(copies)))
    return df.withColumn("copy_no", F.explode(numbers))


def build_pool(
    seeds: Mapping[str, DataFrame], copies: int = 2, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Union of the families in their fixed order, each prompt ``copies`` times."""
    pool = None
    for task_type in POOL_INSTRUCTIONS:
        if task_type in seeds:
            family = prompt_family(seeds[task_type], task_type, keep)
            pool = family if pool is None else pool.unionByName(family)
    return replicate(pool, copies)


def pool_from(seeds: DataFrame, copies: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same in one pass over a table with ``task_type`` and every seed column.

    Columns that a family does not use may be null; rows of other types are left out.
    """
    texts = {t: v for t, v in _family_texts().items() if set(POOL_SEED_COLUMNS[t]) <= set(seeds.columns)}

    def chosen(of: Callable[[str], Column]) -> Column:
        result = None
        for task_type in texts:
            hit = F.col("task_type") == task_type
            result = F.when(hit, of(task_type)) if result is None else result.when(hit, of(task_type))
        return result

    pool = seeds.filter(F.col("task_type").isin(*texts)).select(
        *keep,
        "task_type",
        chosen(lambda t: F.lit(POOL_INSTRUCTIONS[t])).alias("instruction"),
        chosen(lambda t: texts[t][0]).alias("input"),
        chosen(lambda t: texts[t][1]).alias("json_example"),
    )
    return replicate(pool, copies)


def teacher_records(df: DataFrame) -> DataFrame:
    """Accepted answers as dataset rows: the parsed JSON is written out again."""
    records = df.select(
        "instruction",
        text.or_empty(F.col("input")).alias("input"),
        jsonx.json_text(F.col("text")).alias("output"),
        F.coalesce("task_type", F.lit("unknown")).alias("task_type"),
        *(c for c in df.columns if c not in ("instruction", "input", "text", "task_type")),
    )
    return jsonx.rewrite_json(records, "output")


# --- row numbers and order ---------------------------------------------------


def _ranges(df: DataFrame, order_by: tuple[str, ...]) -> Column:
    """Bounds of RANGES key ranges, picked by hash, in groups of _STEP, as one scalar value.

    They only decide where a row is ranked, never its rank.
    """
    key = F.struct(*order_by)
    some = df.select(key.alias("_key")).orderBy(F.xxhash64(*order_by), "_key").limit(RANGES)
    sorted_keys = F.array_sort(F.collect_list("_key"))
    groups = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size("_all") / _STEP).cast("int") - 1),
        lambda g: F.slice("_all", g * _STEP + 1, F.lit(_STEP)),
    )
    found = some.agg(sorted_keys.alias("_all"))
    return found.select(F.when(F.size("_all") > 0, groups)).scalar()


def _range_of(key: Column, groups: Column) -> Column:
    """How many bounds are up to ``key``: first the group, then the place in it."""
    group = F.size(F.filter(groups, lambda g: g[0] <= key)) - 1
    inside = F.size(F.filter(F.get(groups, group), lambda b: b <= key))
    return F.when(group < 0, 0).otherwise(group * _STEP + inside)


def with_idx(df: DataFrame, *order_by: str, name: str = "idx") -> DataFrame:
    """Dense row numbers from 0 in the order of columns that identify a row.

    Fixed key ranges are counted, ranked inside, and offset by the ranges before. Counts and
    ranks come from the same bounds, so nothing is kept between them and no job runs
    until the result is computed.
    """
    placed = df.withColumn("_bounds", _ranges(df, order_by))
    placed = placed.withColumn("_range", _range_of(F.struct(*order_by), F.col("_bounds"))).drop("_bounds")
    placed = placed.repartition("_range")  # counts and ranks read this one shuffle
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_range")  # RANGES rows and one at most
    rank = F.row_number().over(W.partitionBy("_range").orderBy(*order_by))
    return numbered.select(*df.columns, (F.col("_offset") + rank - 1).cast("bigint").alias(name))


def _rank_key(key: Column, seed: int) -> Column:
    """Pseudo-random order of unique keys: md5 of seed and key, then the key itself."""
    as_text = key.cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}|"), as_text)), F.lit("|"), as_text)


def _bucket(rank_key: Column) -> Column:
    number = F.conv(F.substring(rank_key, 1, _BUCKET_DIGITS), 16, 10).cast("int")
    # Never null, so joins add no null filter and both uses of the keys share one scan.
    return F.coalesce(number, F.lit(0))


def _bucket_offsets(keys: DataFrame) -> DataFrame:
    """Rows per hash bucket, rows before it and rows in all; at most 65,536 rows."""
    sizes = keys.groupBy(_bucket(F.col("_rank_key")).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_size")
    )
    order = W.orderBy("_bucket")
    return sizes.select(
        "_bucket",
        "_size",
        (F.sum("_size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("_size")).alias(
            "_offset"
        ),
        F.sum("_size").over(W.partitionBy(F.lit(1))).alias("_total"),
    )


def shuffled(df: DataFrame, key: str, seed: int = 42, name: str = "idx") -> DataFrame:
    """Dense row numbers from 0 in a seeded pseudo-random order of a unique key.

    Hashes of unique keys fill the buckets evenly, so each bucket ranks its rows
    on its own and adds the number of rows before it.
    """
    keyed = df.withColumn("_rank_key", _rank_key(F.col(key), seed))
    offsets = _bucket_offsets(keyed.select("_rank_key")).select("_bucket", "_offset")
    placed = keyed.withColumn("_bucket", _bucket(F.col("_rank_key"))).join(
        F.broadcast(offsets), "_bucket"  # at most 65,536 rows
    )
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy("_rank_key"))
    return placed.select(*df.columns, (F.col("_offset") + rank - 1).cast("bigint").alias(name))


def head(df: DataFrame, n: int, order_by: str = "idx") -> DataFrame:
    """The first ``n`` rows of a dense row number from 0; none for a negative ``n``."""
    return df.filter(F.col(order_by) < n)


def with_batch_id(df: DataFrame, batch_size: int = 16, order_by: str = "idx") -> DataFrame:
    """Consecutive batches of a dense row number."""
    return df.withColumn("batch_id", F.floor(F.col(order_by) / batch_size))


# --- splits --------------------------------------------------------------------


def _with_bounds(
    keyed: DataFrame, keys: DataFrame, bounds: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """Add flags: is a row's ``_rank_key`` among the first rows up to each bound?

    A bound is a number of ``keys`` computed from their total. Keys are counted
    per bucket, and only the buckets that hold a bound are sorted. The keys found
    there make one record, and rows compare their own key with it: no row of
    ``keyed`` is shuffled.
    """
    offsets = _bucket_offsets(keys)
    wanted = F.array(
        *(
            F.struct(F.lit(name).alias("_bound"), count(F.col("_total")).alias("_at"))
            for name, count in bounds.items()
        )
    )
    holding = (
        offsets.select("_bucket", "_offset", "_size", F.inline(wanted))
        .filter(
            (F.col("_at") > F.col("_offset"))
            & (F.col("_at") <= F.col("_offset") + F.col("_size"))
        )
        .select("_bucket", "_bound", (F.col("_at") - F.col("_offset")).alias("_nth"))
    )
    inside = keys.withColumn("_bucket", _bucket(F.col("_rank_key"))).join(
        F.broadcast(holding), "_bucket"  # one row per bound
    )
    rank = F.row_number().over(W.partitionBy("_bound").orderBy("_rank_key"))
    found = inside.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_nth"))
    record = found.agg(
        *(F.max(F.when(F.col("_bound") == name, F.col("_rank_key"))).alias(name) for name in bounds)
    )
    at = record.select(F.struct(*bounds)).scalar()
    # A bound of 0 has no key, and no row is among the first 0.
    return keyed.withColumn("_at", at).withColumns(
        {
            name: F.coalesce(F.col("_rank_key") <= F.col("_at")[name], F.lit(False))
            for name in bounds
        }
    ).drop("_at")


def split_fraction(
    df: DataFrame, key: str, fraction: float = 0.95, seed: int = 42, exact: bool = True
) -> DataFrame:
    """Add ``split``: train for the first ``int(n * fraction)`` rows, eval for the rest.

    The order is the seeded order of a unique key. No row is shuffled: two passes
    find the key at the boundary, and every row compares its own key with it.
    ``exact=False`` takes each row by its hash alone, in one pass.
    """
    keyed = df.withColumn("_rank_key", _rank_key(F.col(key), seed))
    if exact:
        keys = keyed.select("_rank_key")
        bounds = {"_train": lambda n: F.floor(n * F.lit(float(fraction)))}
        flagged = _with_bounds(keyed, keys, bounds)
    else:
        draw = F.conv(F.substring("_rank_key", 1, 8), 16, 10).cast("double")
        flagged = keyed.withColumn("_train", draw < F.lit(fraction * 2**32))
    side = F.when(F.col("_train"), "train").otherwise("eval")
    return flagged.withColumn("split", side).drop("_rank_key", "_train")


def content_key(*columns: str) -> Column:
    """Digest of a row's content; the separator keeps field borders apart."""
    return F.sha2(F.concat_ws("\x1f", *(text.or_empty(F.col(c)) for c in columns)), 256)


def split_capped(
    df: DataFrame,
    key: str,
    eval_size: int,
    train_cap: int | None = None,
    seed: int = 42,
    by: str = "content",
    content: tuple[str, ...] = ("instruction", "input"),
) -> DataFrame:
    """``min(eval_size, n - 1)`` rows as eval, and all others, or ``train_cap`` of them, as train.

    ``by="position"`` ranks rows by their unique key, so copies of one prompt can
    end up on both sides. ``by="content"`` ranks distinct contents, and all copies
    of a content share its side. One row, or one content, cannot be split: it is an error.
    """
    if by == "content":
        unit = content_key(*content)
        keyed = df.withColumn("_rank_key", _rank_key(unit, seed))
        keys = keyed.select("_rank_key").distinct()
    elif by == "position":
        keyed = df.withColumn("_rank_key", _rank_key(F.col(key), seed))
        keys = keyed.select("_rank_key")
    else:
        raise ValueError("by is content or position")

    def eval_rows(n: Column) -> Column:
        single = F.raise_error(F.lit("a split needs at least two rows")).cast("bigint")
        return F.when(n == 1, single).otherwise(F.least(F.lit(eval_size), n - 1))

    bounds = {"_eval": eval_rows}
    if train_cap is not None:
        bounds["_kept"] = lambda n: F.least(eval_rows(n) + max(0, train_cap), n)
    flagged = _with_bounds(keyed, keys, bounds)
    if train_cap is not None:
        flagged = flagged.filter("_kept").drop("_kept")
    side = F.when(F.col("_eval"), "eval").otherwise("train")
    return flagged.withColumn("split", side).drop("_rank_key", "_eval")


def split_overlap(df: DataFrame, *columns: str) -> DataFrame:
    """Number of contents that occur on both sides of a split."""
    sides = df.groupBy(content_key(*columns).alias("_content")).agg(
        F.bool_or(F.col("split") == "train").alias("in_train"),
        F.bool_or(F.col("split") == "eval").alias("in_eval"),
    )
    return sides.agg(F.count_if(F.col("in_train") & F.col("in_eval")).alias("n_overlap"))


# --- judging order ---------------------------------------------------------------


def assign_swap(
    pairs: DataFrame, seed: int = 42, enabled: bool = True, key: tuple[str, ...] = ("idx",)
) -> DataFrame:
    """Add ``swapped``: half of the pairs, by hash of seed and key, trade places."""
    parts = (F.lit(str(seed)), *(F.col(c).cast("string") for c in key))
    draw = text.hash32(F.concat_ws("|", *parts)) % 2
    return pairs.withColumn("swapped", (draw == 1) & F.lit(enabled))
