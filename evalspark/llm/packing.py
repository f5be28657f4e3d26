"""Pack token sequences into windows by non-negative least squares over length patterns.

A document is cut into whole windows and one rest. Shallow patterns (pairs and triples of
rest lengths that fill a window exactly) get repeat counts by non-negative least squares
against the histogram of rests; counts are rounded, and what they leave is packed
greedily: first into patterns that still fit, then cut into powers of two, laid out
from large to small, which fills window after window without a gap. The last window is split into
sequences of powers of two, so nothing is padded at all.

Only the histogram (one row per length below the window) reaches the driver. Every row has
a rank among the rests of its length, made of its rank within its task and the
sum over the tasks before; its place follows from the rank and the plan. Checksums of
all pieces that the plan may ask for are taken in the one pass that tokenizes.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from evalspark.llm.common import materialise, text_or_empty
from evalspark.llm.tokens import default_path, encoder

WINDOW, END_ID = 2048, 1
#: Triples tried at most, those of the most frequent lengths first; a bound on the
#: size of the least-squares problem, not on the rows it places.
TRIPLES = 6_000
SWEEPS = 40


class Plan(NamedTuple):
    """slots: (rest, lo, hi, sequence, offset), ranks lo..hi-1 take one sequence each.
    cut: (rest, lo, size, line), the rows from rank lo are cut and their piece of ``size``
    lies at line + (rank - lo) * size. sequences: number of pattern sequences; line: tokens
    laid out in cut pieces."""

    slots: list[tuple[int, int, int, int, int]]
    cut: list[tuple[int, int, int, int]]
    sequences: int
    line: int


def patterns(counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Pairs and triples of present lengths that sum to the window."""
    present = np.flatnonzero(counts)
    found = [(int(a), int(window - a)) for a in present if a <= window - a and counts[window - a]]
    triples = [np.zeros((3, 0), np.int64)]
    for a in present[present * 3 <= window]:  # one at a time, as the driver has no room for all pairs
        b = present[present >= a]
        c = window - a - b
        b, c = b[(b <= c) & (c > 0)], c[(b <= c) & (c > 0)]
        b, c = b[counts[c] > 0], c[counts[c] > 0]
        triples.append(np.stack((np.full(len(b), a), b, c)))
    a, b, c = np.concatenate(triples, axis=1)
    order = np.argsort(-np.minimum(np.minimum(counts[a], counts[b]), counts[c]), kind="stable")[:TRIPLES]
    return found + [tuple(map(int, t)) for t in zip(a[order], b[order], c[order])]


def least_squares(columns: list[tuple[int, ...]], counts: np.ndarray) -> np.ndarray:
    """x >= 0 with the least squared difference of used and present lengths.

    Coordinate descent: every step solves one pattern's count exactly.
    """
    parts = [tuple({n: col.count(n) for n in col}.items()) for col in columns]
    x = [0.0] * len(columns)
    left = counts.astype(float).tolist()
    for _ in range(SWEEPS):
        moved = 0.0
        for j, part in enumerate(parts):
            up = sum(left[n] * m for n, m in part) / sum(m * m for _, m in part)
            step = max(up, -x[j])
            if step:
                x[j] += step
                for n, m in part:
                    left[n] -= m * step
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return np.array(x)


def plan_windows(counts: np.ndarray, window: int = WINDOW) -> Plan:
    """Where the rests of each length go; ``counts[n]`` rests have n tokens."""
    left = counts.astype(np.int64).copy()
    taken = np.zeros(len(counts), np.int64)
    columns = patterns(counts, window)
    wish = np.rint(least_squares(columns, counts)).astype(np.int64)
    slots: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for rounded in (True, False):
        for j in np.argsort(-wish, kind="stable"):
            col = columns[j]
            fits = min(int(left[n]) // col.count(n) for n in col)
            repeat = min(int(wish[j]), fits) if rounded else fits
            if not repeat:
                continue
            offset = 0
            for n in col:
                slots.append((n, int(taken[n]), int(taken[n]) + repeat, sequence, offset))
                taken[n] += repeat
                left[n] -= repeat
                offset += n
            sequence += repeat
    cut, line, size = [], 0, window // 2
    while size:
        for n in np.flatnonzero(left):
            if int(n) & size:
                cut.append((int(n), int(taken[n]), size, line))
                line += int(left[n]) * size
        size //= 2
    return Plan(slots, cut, sequence, line)


def token_pieces(docs: DataFrame, window: int, path: str) -> DataFrame:
    """One row per document: its counts, ranks within the task, and checksums of its pieces."""
    sizes = [1 << k for k in range(window.bit_length() - 2, -1, -1)]

    def scan(batches):
        words = encoder(path)
        part = TaskContext.get().partitionId()
        seen, full_seen = np.zeros(window, np.int64), 0
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids, bounds = words.encode(batch.column(1))
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            out = {k: [] for k in ("n", "full", "rest", "rest_crc", "bits", "rank", "full_rank")}
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                n = b - a + 1

                def crc(lo, hi, a=a, b=b, n=n):
                    last = hi == n
                    value = zlib.crc32(raw[4 * (a + lo) : 4 * (a + hi - last)])
                    return zlib.crc32(end, value) if last else value

                whole, rest = divmod(n, window)
                at, bits = whole * window, []
                for size in sizes:
                    if rest & size:
                        bits.append(crc(at, at + size))
                        at += size
                out["n"].append(n)
                out["full"].append([crc(k * window, (k + 1) * window) for k in range(whole)])
                out["rest"].append(rest)
                out["rest_crc"].append(crc(whole * window, n) if rest else 0)
                out["bits"].append(bits)
                out["rank"].append(int(seen[rest]))
                out["full_rank"].append(full_seen)
                seen[rest] += 1
                full_seen += whole
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64())
            arrays = [pa.array(v, t) for v, t in zip(out.values(), kinds)]
            arrays = [batch.column(0), pa.array([part] * len(batch), pa.int32()), *arrays]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "_part", *(f"_{k}" for k in out)])

    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, _part int, _n bigint, _full array<bigint>, _rest int, _rest_crc bigint,"
        " _bits array<bigint>, _rank bigint, _full_rank bigint"
    )
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(scan, schema)


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    Input: doc_id (integer), text; other columns are not read. A document's ids are those
    of the tokenizer at ``path`` for its text, then END_ID; a null text has that one id only.
    ``window`` is a power of two. Every id lies in one piece; sequences are gapless from 0
    and have ``window`` tokens, but for at most log2(window) of smaller powers of two.
    Repeated rows are packed each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = materialise(token_pieces(docs, window, path or default_path()), "pieces")
    counts = np.zeros(window, np.int64)
    for r in rows.filter("_rest > 0").groupBy("_rest").count().collect():  # under `window` rows
        counts[r["_rest"]] = r["count"]
    plan = plan_windows(counts, window)

    # Ranks over all tasks: what the tasks before hold of a length, or of whole windows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy("_part", "_rest").agg(F.count("*").alias("_c"))
    base = F.coalesce(F.sum("_c").over(before.partitionBy("_rest")), F.lit(0)).alias("_base")
    first = first.select("_part", "_rest", base)
    whole = rows.groupBy("_part").agg(F.sum(F.size("_full")).alias("_c"))
    whole = whole.select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_windows"))
    ranked = rows.join(first.join(F.broadcast(whole), "_part"), ["_part", "_rest"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base"))

    # The plan has fewer than `window` lengths with a bounded number of slots: broadcast.
    by: dict[int, tuple[list, list]] = {}
    for n, *slot in plan.slots:
        by.setdefault(n, ([], []))[0].append(tuple(slot))
    for n, *piece in plan.cut:
        by.setdefault(n, ([], []))[1].append(tuple(piece))
    layout = spark.createDataFrame(
        [(n, s, c) for n, (s, c) in by.items()],
        "_rest int, _slots array<struct<lo:bigint,hi:bigint,sequence:bigint,offset:bigint>>,"
        " _cut array<struct<lo:bigint,size:bigint,line:bigint>>",
    )
    placed = ranked.join(F.broadcast(layout), "_rest", "left")
    lines = plan.line // window
    tail, segments, at = plan.line % window, [], lines * window
    for k in range(window.bit_length() - 2, -1, -1):
        if tail & (1 << k):
            segments.append((at, at + (1 << k), plan.sequences + lines + len(segments)))
            at += 1 << k
    after = plan.sequences + lines + len(segments)

    def piece(start, length, crc, sequence, offset):
        named = {"start": start, "length": length, "ids_crc32": crc, "sequence_id": sequence, "offset": offset}
        return F.struct(*(v.cast("bigint").alias(k) for k, v in named.items()))

    def at_line(line):
        sequence, offset = F.lit(plan.sequences) + F.floor(line / window), line % window
        for lo, hi, number in segments:
            inside = (line >= lo) & (line < hi)
            sequence = F.when(inside, F.lit(number)).otherwise(sequence)
            offset = F.when(inside, line - lo).otherwise(offset)
        return sequence, offset

    begin = F.size("_full") * F.lit(window).cast("bigint")
    rank = F.col("_rank")
    wholes = F.transform(
        "_full",
        lambda c, i: piece(
            i * F.lit(window).cast("bigint"), F.lit(window), c,
            F.lit(after) + F.col("_windows") + F.col("_full_rank") + i, F.lit(0),
        ),
    )
    slot = F.get(F.filter("_slots", lambda s: (rank >= s.lo) & (rank < s.hi)), F.lit(0))
    kept = F.array(
        piece(begin, F.col("_rest"), F.col("_rest_crc"), slot.sequence + rank - slot.lo, slot.offset)
    )

    def cut_piece(c, i):
        # Larger pieces of the same rest come before: its bits above this one.
        ahead = F.col("_rest") - F.col("_rest") % (c["size"] * 2)
        return piece(begin + ahead, c["size"], F.get("_bits", i), *at_line(c.line + (rank - c.lo) * c["size"]))

    pieces = F.concat(
        wholes,
        F.when(F.col("_rest") == 0, F.array().cast(wholes_type()))
        .when(slot.isNotNull(), kept)
        .otherwise(F.transform("_cut", cut_piece)),
    )
    return placed.select("doc_id", F.col("_n").alias("doc_tokens"), F.inline(pieces)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def wholes_type() -> str:
    fields = ",".join(f"{k}:bigint" for k in ("start", "length", "ids_crc32", "sequence_id", "offset"))
    return f"array<struct<{fields}>>"
