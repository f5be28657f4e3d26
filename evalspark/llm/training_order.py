"""Token sequences written in training order, as shards of fixed stride.

Documents are cut into sequences of at most ``stride`` tokens. A document reserves as many numbers
as its bytes could give sequences, so numbers need no tokenizing first. A keyed Feistel
permutation shuffles the numbers: the network permutes the next power of four, and a
value outside the range walks on through it until it falls inside (cycle-walking).
Shards are equal ranges of permuted numbers; each partition sorts its shards and writes
fixed-size records one after the other. A sequence's slot is the rank of its permuted number:
the records of the shards before plus its place in its own, so slots have no gaps, and a reader
that knows each shard's first slot resumes anywhere with one seek.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from evalspark.llm.common import materialise, scratch, text_or_empty
from evalspark.llm.files import read_range, write_file
from evalspark.llm.tokens import END_OF_TEXT, default_path, encoder

STRIDE, KEY, ROUNDS = 512, 20_240_601, 6
#: Text bytes whose tokens make up a shard, about.
SHARD_BYTES = 16 << 20
#: No text has more tokens than so many times its bytes, lower-casing and composing included.
MOST_TOKENS = 4
ID_BYTES = 2  # the vocabulary has fewer than 65,536 ids


def _round(half: np.ndarray, key: int, number: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = half + np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """Slots of dense numbers: a permutation of 0..total-1 set by ``key``."""
    if total <= 1:
        return index.copy()
    half = np.uint64(max(1, ((total - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    slot = index.astype(np.uint64)
    walking = np.ones(len(slot), bool)
    while walking.any():
        x = slot[walking]
        left, right = x >> half, x & mask
        for number in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, number) & mask)
        slot[walking] = (left << half) | right
        walking = slot >= np.uint64(total)
    return slot.astype(np.int64)


class Layout(NamedTuple):
    """Where a written order lies and how to seek in it."""

    uri: str
    total: int
    stride: int
    shards: np.ndarray  # numbers of the shards, ascending
    first: np.ndarray  # each shard's first slot

    def read(self, slot: int, count: int = 1) -> np.ndarray:
        """Sequences slot..slot+count-1 in training order, read shard by shard."""
        out, width = [], self.stride * ID_BYTES
        stop = min(slot + count, self.total)
        ends = np.append(self.first[1:], self.total)
        while slot < stop:
            k = int(np.searchsorted(self.first, slot, side="right")) - 1
            n = min(stop, int(ends[k])) - slot
            at = slot - int(self.first[k])
            raw = read_range(shard_uri(self.uri, int(self.shards[k])), at * width, n * width)
            out.append(np.frombuffer(raw, "<u2").reshape(n, self.stride))
            slot += n
        return np.concatenate(out) if out else np.zeros((0, self.stride), "<u2")


def shard_uri(uri: str, shard: int) -> str:
    return f"{uri}/shard-{shard:08d}.bin"


def training_order(
    docs: DataFrame,
    uri: str | None = None,
    stride: int = STRIDE,
    shard_bytes: int = SHARD_BYTES,
    key: int = KEY,
    path: str | None = None,
) -> tuple[DataFrame, Layout]:
    """(slot, doc_id, start, n_tokens, ids_crc32, shard, byte_offset) of every sequence, and the layout.

    Input: doc_id (integer), text, as a table that gives the same rows in the same order whenever
    it is read; other columns are not read. A document's ids end with END_OF_TEXT, which also
    fills up its last sequence; n_tokens counts without the filling. Null and empty texts
    have that one id. Repeated rows are written each. An empty table writes and gives nothing.
    """
    spark = docs.sparkSession
    uri, path = uri or scratch(spark, "training-order"), path or default_path()
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    size = F.octet_length("text").cast("bigint")
    most = F.ceil((size * MOST_TOKENS + 1) / F.lit(stride)).cast("bigint")
    # One row per task of the scan.
    tasks = texts.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(most).alias("n"), F.sum(size).alias("bytes"))
    bases, total = {}, 0
    sums = sorted(tuple(r) for r in tasks.collect())
    for part, n, _ in sums:
        bases[part] = (total, n)
        total += n
    shards = max(1, -(-sum(r[2] for r in sums) // shard_bytes))
    per_shard = max(1, -(-total // shards))
    first = spark.sparkContext.broadcast(bases)
    kind = dict(docs.dtypes)["doc_id"]
    names = ["number", "doc_id", "start", "n_tokens", "ids"]

    def cut(batches):
        words = encoder(path, plain_specials=True)
        base, reserved = first.value.get(TaskContext.get().partitionId(), (0, 0))
        used = 0
        for batch in batches:
            ids, bounds = words.encode(batch.column(1))
            ids = ids.astype("<u2")
            lengths = np.diff(bounds) + 1
            each = -(-lengths // stride)
            width = pc.binary_length(batch.column(1)).to_numpy().astype(np.int64)
            room = -(-(width * MOST_TOKENS + 1) // stride)
            begin = base + used + np.cumsum(room) - room
            used += int(room.sum())
            if (each > room).any():
                raise ValueError("a text has more tokens than MOST_TOKENS allows")
            owner = np.repeat(np.arange(len(batch)), each)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
            start = step * stride
            size = np.minimum(stride, lengths[owner] - start)
            for a in range(0, len(owner), 4096):
                o, s, n = owner[a : a + 4096], start[a : a + 4096], size[a : a + 4096]
                rows = np.full((len(o), stride), END_OF_TEXT, "<u2")
                for k, (doc, at, m) in enumerate(zip(o.tolist(), s.tolist(), n.tolist())):
                    part = ids[bounds[doc] + at : min(bounds[doc] + at + m, bounds[doc + 1])]
                    rows[k, : len(part)] = part
                numbers = permute(begin[o] + step[a : a + 4096], total, key)
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(stride * ID_BYTES), len(o), [None, pa.py_buffer(rows.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers), batch.column(0).take(pa.array(o)), pa.array(s), pa.array(n), raw.cast(pa.binary())],
                    names,
                )
        if used != reserved:
            raise ValueError("the table gave other rows than when they were counted")

    def write(batches):
        shard, chunks, rows = None, [], []

        def close():
            write_file(shard_uri(uri, shard), chunks)
            types = (doc_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], done)

        for batch in batches:
            doc_type = batch.column(1).type
            for number, doc, start, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if number // per_shard != shard:
                    if rows:
                        yield close()
                    shard, chunks, rows = number // per_shard, [], []
                rows.append((doc, start, n, zlib.crc32(raw), shard, len(chunks)))
                chunks.append(raw)
        if rows:
            yield close()

    done = ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "place"]
    schema = f"number bigint, doc_id {kind}, start bigint, n_tokens bigint, ids binary"
    cuts = texts.mapInArrow(cut, schema).withColumn("_shard", F.floor(F.col("number") / F.lit(per_shard)).cast("int"))
    # Shards are ranges of numbers and their numbers the partitions': no sample is needed.
    ordered = cuts.repartitionById(shards, F.col("_shard")).sortWithinPartitions("number").drop("_shard")
    result = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint, shard bigint, place bigint"
    written = materialise(ordered.mapInArrow(write, result), "sequences")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy("shard").agg(F.count("*").alias("_n"))
    starts = counts.select("shard", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    known = sorted((r["shard"], r["_first"], r["_n"]) for r in starts.collect())  # one row per shard
    layout = Layout(
        uri,
        sum(r[2] for r in known),
        stride,
        np.array([r[0] for r in known], np.int64),
        np.array([r[1] for r in known], np.int64),
    )
    rows = written.join(F.broadcast(starts), "shard").select(
        (F.col("_first") + F.col("place")).alias("slot"),
        "doc_id",
        "start",
        "n_tokens",
        "ids_crc32",
        "shard",
        (F.col("place") * (stride * ID_BYTES)).alias("byte_offset"),
    )
    return rows, layout
