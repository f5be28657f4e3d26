"""Splits that keep near copies of a prompt together, and the audit of any split for them.

Two contents are near copies if their sets of WORDS-word runs have a Jaccard similarity of 4/5 or more.
They are found by band sketches: BANDS hashes, each of ROWS minima of the set under fixed random functions.
Near copies agree in at least one band but for 3 in a million. Contents that share a band are
compared on their whole sets; a band that more than BUCKET contents share links them all without
comparing, which can only make a group larger. Texts are never shuffled: what moves is
hashes, and the sets of the contents that are compared.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, Window as W, functions as F

from evalspark.functions import text
from evalspark.operators.graph import components
from evalspark.operators.prep import _bucket, _rank_key, _with_bounds, content_key
from evalspark.session import materialise

WORDS, BANDS, ROWS = 5, 24, 4
#: Contents of one band that are compared with each other.
BUCKET = 64
MULTIPLIER = np.uint64(0xD1B54A32D192ED03)
#: Hashes that are sketched at once.
CACHED = 1 << 14


def run_hashes(texts: pa.Array) -> pa.Array:
    """Hashes of all runs of WORDS words of each text; a shorter text is one run, one without words has none."""
    parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = parts.flatten()
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(full)))
    bounds = before[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
    code = words.filter(pa.array(full)).dictionary_encode()
    known = hash_array(code.dictionary.to_numpy(zero_copy_only=False).astype(object)).astype(np.uint64)
    hashes = known[code.indices.to_numpy()]
    sizes = np.diff(bounds)
    runs = np.where(sizes > 0, np.maximum(sizes - (WORDS - 1), 1), 0)
    stops = np.cumsum(runs)
    at = np.arange(runs.sum()) + np.repeat(bounds[:-1] - (stops - runs), runs)
    ends = np.repeat(bounds[1:], runs)
    found = np.zeros(len(at), np.uint64)
    for k in range(WORDS):  # past a short text's end there are no words
        word = hashes[np.minimum(at + k, max(len(hashes) - 1, 0))]
        found = _mixed(found * MULTIPLIER + np.where(at + k < ends, word, np.uint64(0)) + np.uint64(k + 1))
    offsets = np.concatenate(([0], stops)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.view(np.int64)))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(WORDS)
    factors = rng.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 2**63, BANDS * ROWS, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def band_sketches(sets: pa.Array) -> pa.Array:
    """BANDS hashes of each list of 64-bit hashes, however often it repeats them; empty lists have those of the number 0."""
    lengths = pc.list_value_length(sets).to_numpy()
    values = sets.flatten().to_numpy().view(np.uint64)
    filled = np.maximum(lengths, 1)
    stops = np.cumsum(filled, dtype=np.int64)
    every = np.zeros(int(filled.sum()), np.uint64)
    every[np.repeat(lengths > 0, filled)] = values
    out = np.zeros((len(lengths), BANDS), np.uint64)
    factors, shifts = _functions()
    at = 0
    while at < len(lengths):  # so few lists at once that their numbers stay in the processor's cache
        begin = int(stops[at] - filled[at])
        to = max(at + 1, int(np.searchsorted(stops, begin + CACHED, "right")))
        part, starts = every[begin : int(stops[to - 1])], stops[at:to] - filled[at:to] - begin
        moved = np.empty_like(part)
        for k in range(BANDS * ROWS):
            np.multiply(part, factors[k], out=moved)
            np.add(moved, shifts[k], out=moved)
            band = out[at:to, k // ROWS]
            out[at:to, k // ROWS] = _mixed(band + np.minimum.reduceat(moved, starts) + np.uint64(k // ROWS + 1))
        at = to
    offsets = np.arange(0, out.size + 1, BANDS, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1).view(np.int64)))


def contents(df: DataFrame, *columns: str) -> DataFrame:
    """The contents of ``df``: content, node (its hash), shingles, bands; written once.

    Copies of a content are sketched once where they come in one batch of rows, and can else have a row each. Shingles
    may repeat. Splits and audits of the same rows can share this table.
    """
    joined = F.concat_ws(" ", *(text.or_empty(F.col(c)) for c in columns))
    key = content_key(*columns)
    rows = df.select(key.alias("content"), F.xxhash64(key).alias("node"), F.lower(joined).alias("text"))

    def sketch(batches):
        for batch in batches:
            code = batch.column(0).dictionary_encode().indices.to_numpy()
            once = batch.take(pa.array(np.sort(np.unique(code, return_index=True)[1])))
            sets = run_hashes(once.column(2))
            columns = [once.column(0), once.column(1), sets, band_sketches(sets)]
            yield pa.RecordBatch.from_arrays(columns, ["content", "node", "shingles", "bands"])

    kinds = "content string, node bigint, shingles array<bigint>, bands array<bigint>"
    return materialise(rows.mapInArrow(sketch, kinds), "contents")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of nodes whose sets are similar enough; ``sets`` has (node, shingles), perhaps repeated.

    Similarity |A & B| / |A | B| >= 4/5, in whole numbers.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = sets.select("node", "shingles").join(ends, "node", "left_semi")
    # Copies of a content have one set: any of them will do, and arrays are not aggregated.
    rank = F.row_number().over(W.partitionBy("node").orderBy(F.lit(0)))
    once = wanted.withColumn("_rank", rank).filter("_rank = 1").select("node", F.array_distinct("shingles").alias("shingles"))
    once = materialise(once, "sets")
    met = pairs
    for end in ("a", "b"):
        met = met.join(once.select(F.col("node").alias(end), F.col("shingles").alias(f"set_{end}")), end)
    a, b = F.size("set_a"), F.size("set_b")
    likely = (5 * F.least(a, b) >= 4 * F.greatest(a, b))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return met.filter(likely).filter(9 * common >= 4 * (a + b)).select("a", "b")


def _links(rows: DataFrame) -> DataFrame:
    """(a, b) of nodes that belong together."""
    # Rows move once: copies of a node meet in its bands' partitions.
    keys = rows.select("node", F.explode("bands").alias("band")).repartition("band").distinct()
    bucket = W.partitionBy("band")
    buckets = keys.withColumn("n", F.count(F.lit(1)).over(bucket)).withColumn("first", F.min("node").over(bucket))
    members = materialise(buckets.filter("n > 1"), "band-members")
    large = members.filter(F.col("n") > BUCKET).select(F.col("first").alias("a"), F.col("node").alias("b"))
    small = members.filter(F.col("n") <= BUCKET)
    other = small.select("band", F.col("node").alias("b"))
    pairs = small.select("band", F.col("node").alias("a")).join(other, "band").filter("a < b")
    pairs = materialise(pairs.select("a", "b").distinct(), "band-pairs")
    return _alike(pairs, rows).union(large.filter("a <> b")).distinct()


def near_groups(df: DataFrame, *columns: str) -> DataFrame:
    """Contents of ``df`` that have near copies: content, group (its smallest content), size (in contents).

    Content is that of the columns, null as empty. Contents without words are near copies of each other.
    Groups are closed: a near copy of a near copy is in the group. Contents without near copies have no row.
    """
    return _grouped(contents(df, *columns))


def _grouped(rows: DataFrame) -> DataFrame:
    roots = components(materialise(_links(rows), "near-links"))
    named = rows.select("content", "node").join(roots, "node").distinct()
    groups = named.groupBy("root").agg(F.min("content").alias("group"), F.count(F.lit(1)).alias("size"))
    return materialise(named.join(groups, "root").select("content", "group", "size"), "near-groups")


def split_near(
    df: DataFrame,
    eval_size: int,
    seed: int = 42,
    content: tuple[str, ...] = ("instruction", "input"),
    rows: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``: eval for ``min(eval_size, n - 1)`` of the n contents, train for all others.

    Near copies, and all copies of a content, share a side. Groups of near copies come in seeded
    order, as many whole ones as their share of the eval side holds, and contents without near copies fill it
    up to its size; it stays smaller only where they run out. One content alone is an error; an empty
    table gives none. Jobs run at the call: the groups have to be known. ``rows``: the ``contents`` of ``df``,
    if they have been made.
    """
    rows = contents(df, *content) if rows is None else rows
    grouped = _grouped(rows)
    alone = materialise(rows.select("content").join(grouped, "content", "left_anti").distinct(), "singles")
    n_grouped = grouped.count()
    n = n_grouped + alone.count()
    if n == 1:
        raise ValueError("a split needs at least two contents")
    target = max(0, min(eval_size, n - 1))
    groups = grouped.select("group", "size").distinct().withColumn("_rank_key", _rank_key(F.col("group"), seed))
    share = target * n_grouped // n if n else 0
    chosen = _up_to(groups, share)
    taken = materialise(grouped.join(chosen.select("group"), "group", "left_semi"), "eval-groups")
    left = target - taken.count()
    singles = alone.withColumn("_rank_key", _rank_key(F.col("content"), seed))
    keys = singles.select("_rank_key")
    fill = _with_bounds(singles, keys, {"_eval": lambda total: F.least(F.lit(left).cast("bigint"), total)})
    evals = materialise(taken.select("content").union(fill.filter("_eval").select("content")), "evals")
    evals = evals.withColumn("_eval", F.lit(True))
    marked = df.withColumn("_content", content_key(*content)).join(
        evals.withColumnRenamed("content", "_content"), "_content", "left"
    )
    side = F.when(F.col("_eval"), "eval").otherwise("train")
    return marked.select(*(f"`{c}`" for c in df.columns), side.alias("split"))


def _up_to(groups: DataFrame, budget: int) -> DataFrame:
    """The first groups in order of ``_rank_key`` whose sizes add up to ``budget`` at most.

    Hash buckets are summed up first, 65,536 rows at most, and every bucket adds up its own groups.
    """
    placed = groups.withColumn("_bucket", _bucket(F.col("_rank_key")))
    sums = placed.groupBy("_bucket").agg(F.sum("size").alias("_sum"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_bucket").orderBy("_rank_key").rowsBetween(W.unboundedPreceding, 0)
    ends = placed.join(F.broadcast(offsets), "_bucket").withColumn(
        "_end", F.col("_before") + F.sum("size").over(inside)
    )
    return ends.filter(F.col("_end") <= budget).select("group", "size")


def near_overlap(df: DataFrame, *columns: str) -> DataFrame:
    """Number of eval contents that have a near copy, or themselves, among train: n_near_overlap.

    ``df`` has a split. Every eval content meets all train contents that share a band with it, in whatever
    number, and is compared with each on the whole sets.
    """
    return near_overlaps({"": df}, *columns).select("n_near_overlap")


def near_overlaps(splits: Mapping[str, DataFrame], *columns: str, rows: DataFrame | None = None) -> DataFrame:
    """``near_overlap`` of each of several splits: by (its name), n_near_overlap.

    ``rows``: ``contents`` that have all those of the splits, if they have been made. Contents are
    compared once for all splits.
    """
    if rows is None:
        rows = contents(reduce(DataFrame.unionByName, (df.select(*columns) for df in splits.values())), *columns)
    node = F.xxhash64(content_key(*columns)).alias("node")
    named = (df.select(F.lit(by).alias("by"), node, "split") for by, df in splits.items())
    sides = reduce(DataFrame.unionByName, named).groupBy("by", "node").agg(
        F.bool_or(F.col("split") == "eval").alias("in_eval"), F.bool_or(F.col("split") == "train").alias("in_train")
    )
    sides = materialise(sides, "sides")
    evals = materialise(sides.filter("in_eval AND NOT in_train").select("by", F.col("node").alias("a")), "eval-nodes")
    some = rows.select(F.col("node").alias("a"), "bands").join(evals.select("a").distinct(), "a", "left_semi")
    some = materialise(some.select("a", F.explode("bands").alias("band")).distinct(), "eval-bands")
    every = rows.select(F.col("node").alias("b"), F.explode("bands").alias("band"))
    met = materialise(some.join(every, "band").select("a", "b").distinct(), "side-pairs")
    trains = sides.filter("in_train").select("by", F.col("node").alias("b"))
    pairs = materialise(met.join(evals, "a").join(trains, ["by", "b"]).select("by", "a", "b"), "side-pairs")
    alike = _alike(pairs.select("a", "b").distinct(), rows)
    found = pairs.join(alike, ["a", "b"]).select("by", F.col("a").alias("node"))
    found = found.union(sides.filter("in_eval AND in_train").select("by", "node")).distinct()
    found = materialise(found, "near-overlap")
    # A split without any has a row too.
    counts = (found.filter(F.col("by") == by).agg(F.count(F.lit(1)).alias("n_near_overlap")) for by in splits)
    named = (n.select(F.lit(by).alias("by"), "n_near_overlap") for by, n in zip(splits, counts))
    return reduce(DataFrame.unionByName, named)
