"""Remove repeated byte strings of LENGTH bytes, by sorting suffixes around shared anchors.

A suffix matters here by its first LENGTH bytes, its window. Sorting the suffixes of all
bytes would move each byte a hundred times, so three steps narrow them down first; every step
keeps all windows that may repeat.

1. Every window is tied to its least GRAM-byte hash. Neighbouring windows tied to one place form a
   block; equal windows always have equal anchors. (anchor, block hash, place) is
   shuffled, no text. Of blocks equal in both hashes all but the first are repeats.
2. An anchor with one kind of block needs nothing more. Where kinds differ, as at the edges
   of a shared passage, the first block of each kind is fetched with its bytes.
3. These blocks' suffixes are sorted per anchor: by their first eight bytes, then by a
   mergesort whose comparisons find the common extension of two suffixes by binary search on
   prefix polynomial hashes. Neighbours that share LENGTH bytes, verified byte by byte, repeat.

Anchors with more than HOT kinds of blocks go by window instead: each window is a row of its
own and meets its equals under its own hash, so a passage found everywhere is spread out. Repeats
within one batch are settled there and never shuffled, so no group holds more than a
few rows per batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from evalspark.llm.common import materialise, text_or_empty

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM + 1  # grams in a window
HOT, LOCAL_HOT = 256, 64
PIECE = 1 << 21  # windows of one text handled at once; less than 2**22 with the rest
SORTED_AT_ONCE = 4 << 20  # bytes of blocks, with some ten 8-byte numbers each; groups are never cut
SIGNAL, BLOCK, PROBE, HOT_PROBE, MARK = range(5)
LAST = 2**63 - 1

_U = np.uint64
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


LETTERS = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1 << 16), base, _U)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


class Prefixes:
    """Polynomial hashes of all prefixes; any substring's hash follows from two."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(LETTERS[data] * powers(BASE, len(data)), out=self.sums[1:])
        self.shift = powers(INVERSE, len(data) + 1)

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.shift[at]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values, from minima of blocks' heads and tails."""
    n = len(values)
    filled = np.full(-(-n // width) * width, _U(2**64 - 1))
    filled[:n] = values
    rows = filled.reshape(-1, width)
    heads = np.minimum.accumulate(rows, axis=1).ravel()
    tails = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tails[: n - width + 1], heads[width - 1 : n])


def blocks(data: np.ndarray, sizes: np.ndarray):
    """(anchor, block hash, text, start, windows) of all blocks of joined texts."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64, np.int64))
    ends = np.cumsum(sizes)
    known = Prefixes(data)
    place = np.arange(len(data) - GRAM + 1)
    gram = mix(known.of(place, GRAM))
    # The place in the low bits takes the leftmost of equal grams.
    least = sliding_min((gram & _U(~0x3FFFFF & (2**64 - 1))) | place.astype(_U), REACH)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends[owner])
    if not len(starts):
        return blocks(data[:0], sizes[:0])
    anchor = (least[starts] & _U(0x3FFFFF)).astype(np.int64)
    owner = owner[starts]
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.concatenate((first[1:] - 1, [len(starts) - 1]))
    a, b = starts[first], starts[last]
    count = b - a + 1
    whole = mix(known.of(a, count + LENGTH - 1) + count.astype(_U) * _U(0x9E3779B97F4A7C15))
    text = owner[first]
    return gram[anchor[first]], whole, text, a - (ends - sizes)[text], count


def pieces(buffers: list[memoryview]):
    """Texts in portions of bounded size: (joined bytes, row of each piece, its offset, size).

    A longer text is cut so that each window lies whole in exactly one piece.
    """
    held, rows, offsets, total = [], [], [], 0
    for row, text in enumerate(buffers):
        for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
            part = text[at : at + PIECE + LENGTH - 1]
            if held and total + len(part) > PIECE + LENGTH:
                yield np.frombuffer(b"".join(held), np.uint8), np.array(rows), np.array(offsets), np.array([len(x) for x in held])
                held, rows, offsets, total = [], [], [], 0
            held.append(part)
            rows.append(row)
            offsets.append(at)
            total += len(part)
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.array(rows), np.array(offsets), np.array([len(x) for x in held])


def buffers_of(column: pa.Array) -> list[memoryview]:
    return [memoryview(v.as_buffer()) for v in column.cast(pa.large_binary())]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _table(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


BLOCK_NAMES = ["kind", "anchor", "block", "doc", "row", "start", "n"]
BLOCK_SCHEMA = "kind int, anchor bigint, block bigint, doc bigint, row bigint, start bigint, n bigint"


def _new(*keys: np.ndarray) -> np.ndarray:
    """Where any key differs from the row before."""
    out = np.zeros(len(keys[0]), bool)
    if len(out):
        out[0] = True
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def find_blocks(batches):
    """Step 1 of a task: blocks of its texts; repeats within a batch are settled here."""
    for batch in batches:
        doc, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        found = []
        for data, rows, offsets, sizes in pieces(buffers_of(batch.column(2))):
            anchor, whole, text, start, count = blocks(data, sizes)
            found.append((_signed(anchor), _signed(whole), rows[text], start + offsets[text], count))
        if not found:
            continue
        anchor, whole, text, start, count = map(np.concatenate, zip(*found))
        order = np.lexsort((start, row[text], doc[text], whole, anchor))
        anchor, whole, text, start, count = (x[order] for x in (anchor, whole, text, start, count))
        head = _new(anchor)
        kind_head = _new(anchor, whole)
        group = np.cumsum(head) - 1
        hot = np.bincount(group, kind_head)[group] > LOCAL_HOT
        kind = np.where(~kind_head, MARK, np.where(hot, HOT_PROBE, BLOCK)).astype(np.int32)
        yield _table(BLOCK_NAMES, kind, anchor, whole, doc[text], row[text], start, count)
        if (said := head & hot).any():
            n = int(said.sum())
            nothing = np.zeros(n, np.int64)
            yield _table(BLOCK_NAMES, np.full(n, SIGNAL, np.int32), anchor[said], nothing, nothing, nothing, nothing, nothing)


def compare_blocks(batches):
    """Step 2 of a task: rows sorted by (anchor, kind, block, doc, row, start) in; marks and probes out.

    Of the anchor that is open at a batch's end only its kinds of blocks so far, HOT + 1 at most,
    are held for the next batch.
    """
    held = None  # columns of rows carried over, whether they are out already, and whether the anchor is hot
    for batch in _with_end(_columns_of(batches)):
        final = batch is None
        if final:
            if held is None:
                return
            columns, done, hot_before = held[0], held[1], held[2]
        elif held is None:
            columns, done, hot_before = batch, np.zeros(len(batch[0]), bool), None
        else:
            columns = [np.concatenate(x) for x in zip(held[0], batch)]
            done = np.concatenate((held[1], np.zeros(len(batch[0]), bool)))
            hot_before = held[2]
        kind, anchor, block, doc, row, start, n = columns
        if not len(kind):
            continue
        loose = (kind == MARK) | (kind == HOT_PROBE)
        if loose.any():
            yield _table(BLOCK_NAMES, *(c[loose] for c in columns))
            columns, done = [c[~loose] for c in columns], done[~loose]
            kind, anchor, block, doc, row, start, n = columns
            if not len(kind):
                held = (columns, done, hot_before)
                continue
        head = _new(anchor)
        group = np.cumsum(head) - 1
        signal = kind == SIGNAL
        first = _new(anchor, block, signal) & ~signal
        kinds = np.bincount(group, first)
        hot = (kinds > HOT) | (np.bincount(group, signal) > 0)
        if hot_before is not None and anchor[0] == hot_before:
            hot[0] = True
        open_group = group == group[-1] if not final else np.zeros(len(group), bool)
        again = ~first & ~signal & ~done
        ready = first & ~done & (hot[group] | (~open_group & (kinds[group] > 1)))
        out = again | ready
        if out.any():
            new_kind = np.where(again, MARK, np.where(hot[group], HOT_PROBE, PROBE)).astype(np.int32)
            yield _table(BLOCK_NAMES, new_kind[out], *(c[out] for c in columns[1:]))
        if final:
            return
        if hot[-1]:  # only the last block need be known from here on
            keep = np.array([len(kind) - 1])
            held = ([c[keep] for c in columns], np.array([True]), anchor[-1])
        else:
            keep = np.flatnonzero(open_group & first)
            held = ([c[keep] for c in columns], done[keep], None)


def _columns_of(batches):
    for batch in batches:
        yield [c.to_numpy() for c in batch.columns]


def _with_end(items):
    yield from items
    yield None


SUFFIX_NAMES = ["route", "doc", "row", "start", "n", "bytes"]
SUFFIX_SCHEMA = "route bigint, doc bigint, row bigint, start bigint, n bigint, bytes binary"


def fetch_bytes(batches):
    """Step 3 of a task, where the texts are: the bytes of its probes, hot ones window by window.

    Rows without bytes are repeats found within the batch.
    """
    for batch in batches:
        doc, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = buffers_of(batch.column(2))
        lists = batch.column(3)
        owner = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy())
        probe = lists.flatten()
        anchor, start, n, hot = (probe.field(k).to_numpy(zero_copy_only=False) for k in range(4))
        parts = [bytes(texts[o][s : s + c + LENGTH - 1]) for o, s, c in zip(owner.tolist(), start.tolist(), n.tolist())]
        cold = np.flatnonzero(~hot)
        if len(cold):
            data = pa.array([parts[i] for i in cold], pa.binary())
            yield _table(SUFFIX_NAMES, anchor[cold], doc[owner[cold]], row[owner[cold]], start[cold], n[cold], data)
        warm = np.flatnonzero(hot)
        for at in range(0, len(warm), 4096):
            some = warm[at : at + 4096]
            data = np.frombuffer(b"".join(parts[i] for i in some), np.uint8)
            begin = np.cumsum(n[some] + LENGTH - 1) - (n[some] + LENGTH - 1)
            which = np.repeat(some, n[some])
            step = np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
            spot = np.repeat(begin, n[some]) + step
            code = _signed(mix(Prefixes(data).of(spot, LENGTH)))
            place = start[which] + step
            order = np.lexsort((place, row[owner[which]], doc[owner[which]], code))
            code, which, spot, place = (x[order] for x in (code, which, spot, place))
            head = _new(code)
            words = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
            same = np.ones(len(code), bool)  # as the head of its run, byte by byte
            lead = np.maximum.accumulate(np.where(head, np.arange(len(code)), 0))
            for a in range(0, len(code), 100_000):
                b = a + 100_000
                same[a:b] = (words[spot[a:b]] == words[spot[lead[a:b]]]).all(axis=1)
            sent = head | ~same
            raw = pa.array([words[i].tobytes() for i in spot[sent]], pa.binary())
            one = np.ones(int(sent.sum()), np.int64)
            yield _table(SUFFIX_NAMES, code[sent], doc[owner[which[sent]]], row[owner[which[sent]]], place[sent], one, raw)
            rest = ~sent
            if rest.any():
                void = pa.nulls(int(rest.sum()), pa.binary())
                o = owner[which[rest]]
                yield _table(SUFFIX_NAMES, code[rest], doc[o], row[o], place[rest], np.ones(int(rest.sum()), np.int64), void)


class Suffixes:
    """Comparisons of suffixes of one buffer by their first LENGTH bytes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.hashes = Prefixes(data)
        padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(_U)
        self.words = np.zeros(len(data) + 1, _U)
        for k in range(8):
            self.words[:-1] |= padded[k : k + len(data)] << _U(56 - 8 * k)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension, up to LENGTH, by binary search on hashes."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), LENGTH, np.int64)
        for _ in range(LENGTH.bit_length()):
            middle = (low + high + 1) // 2
            equal = self.hashes.of(x, middle) == self.hashes.of(y, middle)
            low = np.where(equal, middle, low)
            high = np.where(equal, high, middle - 1)
        return low

    def sign(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at x is before, equal to or after the one at y."""
        share = self.common(x, y)
        at = np.minimum(share, LENGTH - 1)
        a, b = self.data[x + at].astype(np.int64), self.data[y + at].astype(np.int64)
        return np.where(share >= LENGTH, 0, np.sign(a - b))

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether LENGTH bytes agree, read from the bytes themselves."""
        same = np.ones(len(x), bool)
        for at in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
            same &= self.words[x + at] == self.words[y + at]
        return same


def merge_sort(suffixes: Suffixes, spots: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Stable order of ``spots`` within each run (numbered without gaps, rows of a run adjacent).

    All merges of a level happen at once: each suffix finds its rank in its sibling by
    binary search, and its new place is its own rank plus that.
    """
    begin = np.flatnonzero(_new(run))
    size = np.diff(np.concatenate((begin, [len(run)])))
    begin, size = np.repeat(begin, size), np.repeat(size, size)
    order = np.arange(len(spots))
    width = 1
    while width < (size.max() if len(size) else 0):
        live = np.flatnonzero(size > width)
        at = live - begin[live]
        block = at // width
        other = block ^ 1
        low = np.minimum(other * width, size[live])
        high = np.minimum(low + width, size[live])
        base, right = low.copy(), block % 2 == 1
        mine = spots[order[live]]
        while True:
            going = np.flatnonzero(low < high)
            if not len(going):
                break
            middle = (low[going] + high[going]) // 2
            theirs = spots[order[begin[live[going]] + middle]]
            before = suffixes.sign(theirs, mine[going])
            less = np.where(right[going], before <= 0, before < 0)
            low[going] = np.where(less, middle + 1, low[going])
            high[going] = np.where(less, high[going], middle)
        place = begin[live] + np.minimum(block, other) * width + (at - block * width) + (low - base)
        moved = order.copy()
        moved[place] = order[live]
        order = moved
        width *= 2
    return order


def repeats(route: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For every window of every block, in the order given, whether an earlier one equals it.

    Blocks are ordered by (route, document, place); ``sizes`` has their windows and ``data`` their bytes.
    """
    suffixes = Suffixes(data)
    width = sizes + LENGTH - 1
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    spots = np.repeat(np.cumsum(width) - width, sizes) + step
    group = np.repeat(np.cumsum(_new(route)) - 1, sizes)
    order = np.lexsort((suffixes.words[spots], group))  # stable: earlier windows first
    key = suffixes.words[spots[order]]
    run = np.cumsum(_new(group[order], key)) - 1
    # A run whose windows all have one hash is in order already; others are merged.
    full = suffixes.hashes.of(spots[order], LENGTH)
    mixed = np.bincount(run, _new(run, full)) > 1
    busy = np.flatnonzero(mixed[run])
    if len(busy):
        inner = merge_sort(suffixes, spots[order[busy]], run[busy])
        order[busy] = order[busy][inner]
    full = suffixes.hashes.of(spots[order], LENGTH)
    head = _new(run, full)
    same = np.zeros(len(order), bool)
    same[1:] = ~head[1:] & suffixes.equal(spots[order[1:]], spots[order[:-1]])
    clash = ~head & ~same
    if clash.any():  # a hash collision: settle its run by the bytes
        for r in np.unique(run[clash]):
            seen = set()
            for i in np.sort(order[run == r]):
                text = data[spots[i] : spots[i] + LENGTH].tobytes()
                same[np.flatnonzero(order == i)] = text in seen
                seen.add(text)
    out = np.zeros(len(order), bool)
    out[order] = same
    return out


MARK_NAMES = ["row", "start", "n"]
MARK_SCHEMA = "row bigint, start bigint, n bigint"


def sort_suffixes(batches):
    """Step 3 of a task, sorted by (route, doc, row, start): repeats, as runs of windows."""

    def settle(table: pa.Table):
        route, row, start, n = (table.column(k).to_numpy() for k in (0, 2, 3, 4))
        data = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8)
        again = repeats(route, n, data)
        block = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
        hits = np.flatnonzero(again)
        if len(hits):
            cut = np.flatnonzero(np.concatenate(([True], (np.diff(hits) > 1) | (np.diff(block[hits]) > 0))))
            count = np.diff(np.concatenate((cut, [len(hits)])))
            lead = hits[cut]
            yield _table(MARK_NAMES, row[block[lead]], start[block[lead]] + step[lead], count)

    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        void = batch.column(5).is_null()
        if pc.any(void).as_py():
            done = batch.filter(void)
            yield pa.RecordBatch.from_arrays([done.column(k) for k in (2, 3, 4)], MARK_NAMES)
            batch = batch.filter(pc.invert(void))
        if not len(batch):
            continue
        held.append(batch)
        held_bytes += pc.sum(batch.column(4)).as_py() + len(batch) * (LENGTH - 1)
        if held_bytes < SORTED_AT_ONCE:
            continue
        table = pa.Table.from_batches(held)
        route = table.column(0).to_numpy()
        last = int(np.flatnonzero(route == route[-1])[0]) if len(route) else 0
        total = np.cumsum(table.column(4).to_numpy() + LENGTH - 1)
        at = 0
        while at < last:  # whole groups, as many as fit
            limit = np.searchsorted(total, (total[at - 1] if at else 0) + SORTED_AT_ONCE)
            stop = min(last, max(int(limit), at + 1))
            while stop < last and route[stop] == route[stop - 1]:
                stop += 1
            yield from settle(table.slice(at, stop - at))
            at = stop
        held = table.slice(last).combine_chunks().to_batches()
        held_bytes = int(total[-1] - (total[last - 1] if last else 0))
    if held:
        yield from settle(pa.Table.from_batches(held))


RESULT_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def cut_texts(batches):
    """Remove the marked windows' bytes from each text."""
    for batch in batches:
        out = {k: [] for k in RESULT_NAMES[1:]}
        marks = batch.column(2).to_pylist()
        for text, spans in zip(buffers_of(batch.column(1)), marks):
            kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
            for span in sorted((s["start"], s["start"] + s["n"] + LENGTH - 1) for s in spans or ()):
                if span[0] > at or not runs:
                    kept.update(text[at : span[0]])
                    runs += 1
                    at = span[0]
                if span[1] > at:
                    removed += span[1] - at
                    at = span[1]
            kept.update(text[at:])
            for k, v in zip(out, (len(text), removed, runs, kept.hexdigest())):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v) for v in out.values())], RESULT_NAMES)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(row, start, n): windows start..start+n-1 of a row that an earlier place repeats.

    ``docs`` has doc, row and text. It is read twice and must give the same rows both times, as
    files do.
    """
    found = docs.mapInArrow(find_blocks, BLOCK_SCHEMA)
    alone = F.col("kind").isin(MARK, HOT_PROBE)
    # Marks only pass through: by their row, they are spread evenly.
    spread = found.repartition(F.when(alone, F.hash("row", "start").cast("bigint")).otherwise(F.col("anchor")))
    ordered = spread.sortWithinPartitions("anchor", "kind", "block", "doc", "row", "start")
    step = materialise(ordered.mapInArrow(compare_blocks, BLOCK_SCHEMA).drop("block", "doc"), "blocks")
    probes = (
        step.filter(F.col("kind") != MARK)
        .groupBy(F.col("row").alias("_row"))
        .agg(F.collect_list(F.struct("anchor", "start", "n", (F.col("kind") == HOT_PROBE).alias("hot"))).alias("probes"))
    )
    met = docs.join(probes, F.col("row") == F.col("_row")).select("doc", "row", "text", "probes")
    suffixes = met.mapInArrow(fetch_bytes, SUFFIX_SCHEMA)
    route = F.when(F.col("bytes").isNull(), F.hash("row", "start").cast("bigint")).otherwise(F.col("route"))
    ordered = suffixes.repartition(route).sortWithinPartitions("route", "doc", "row", "start")
    marks = materialise(ordered.mapInArrow(sort_suffixes, MARK_SCHEMA), "suffix-marks")
    return step.filter(F.col("kind") == MARK).select(*MARK_NAMES).union(marks)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Input: doc_id (integer), text; other columns are not read. A byte goes if a LENGTH-byte string
    over it also starts earlier: under a smaller doc_id, or further ahead in the same text. Rows that
    repeat a doc_id are ordered as they are read; rows without doc_id come last. A null text is empty;
    texts shorter than LENGTH stay whole. An empty table gives no rows. The rows are numbered and
    written once, since a number given anew at a later reading would depend on how the table is split then.
    """
    numbered = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        text_or_empty().alias("text"),
        "doc_id",
    )
    rows = materialise(numbered, "numbered-texts")
    marks = (
        repeated_windows(rows.drop("doc_id"))
        .groupBy(F.col("row").alias("_row"))
        .agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    )
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    met = rows.join(marks, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "marks")
    return met.mapInArrow(cut_texts, schema)
