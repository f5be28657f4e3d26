"""Near-duplicates by SimHash, linked through multi-index hashing.

A fingerprint's bit is set if more than half of its 3-word shingles' hashes set it. Two
fingerprints at most RADIUS bits apart differ in at most one bit of one of their two
32-bit segments, so each segment's Hamming ball of radius one is enumerated and looked up
in that segment's table; a hit is verified over all 64 bits within the join itself.
Only one row per distinct fingerprint is indexed, and of a pair that differs in a bit
only the side whose bit is clear probes, so a fingerprint has about 34 probes and no
pair is built but the links themselves. Components of the links are found by contraction.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from evalspark.llm.common import materialise, text_or_empty
from evalspark.llm.graph import components

SHINGLE, SEED, RADIUS, SEGMENT = 3, 42, 3, 32
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of a UTF-8 text; 0 without words."""
    words = WORD.findall(text.lower())  # bytes.lower touches A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - SHINGLE + 1].tolist()
    stops = (ends[SHINGLE - 1 :] - 1).tolist()
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65_536):
        part = zip(starts[at : at + 65_536], stops[at : at + 65_536])
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(total * 2 > len(starts)).tolist()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, _text, _fp) of every row: a hash of the text, and the fingerprint as a signed number."""

    def scan(batches):
        for batch in batches:
            values = [fingerprint(v.as_buffer().to_pybytes() if v.is_valid else b"") for v in batch.column(2).cast(pa.binary())]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "_text", "_fp"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("_text"), text_or_empty().alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, _text bigint, _fp bigint")


def links(prints: DataFrame) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints at most RADIUS bits apart."""
    low, high = F.col("_fp").bitwiseAND(F.lit(2**SEGMENT - 1)), F.shiftrightunsigned("_fp", SEGMENT)
    parts = F.explode(F.array(*(F.struct(F.lit(i).alias("s"), v.alias("v")) for i, v in enumerate((low, high)))))
    segments = prints.select("_fp", parts.alias("_part")).select("_fp", "_part.s", "_part.v")
    index = segments.select("s", "v", F.col("_fp").alias("b"))
    bit = lambda j: F.expr(f"shiftleft(1L, {j})")
    flips = [F.when(F.col("v").bitwiseAND(bit(j)) == 0, F.col("v").bitwiseOR(bit(j))) for j in range(SEGMENT)]
    probes = segments.select(
        F.col("_fp").alias("a"), "s", F.col("v").alias("own"), F.explode(F.array(F.col("v"), *flips)).alias("v")
    ).filter("v IS NOT NULL")
    differs = F.col("a").bitwiseXOR(F.col("b"))
    close = F.bit_count(differs) <= RADIUS
    # An equal segment is met from both sides: take the pair once. What the first
    # segment's ball has found already is not taken again from the second.
    first = (F.col("s") == 0) | (F.bit_count(differs.bitwiseAND(F.lit(2**SEGMENT - 1))) > 1)
    probes = probes.withColumnsRenamed({"s": "ps", "v": "pv"})
    same = (F.col("ps") == F.col("s")) & (F.col("pv") == F.col("v"))
    once = (F.col("own") != F.col("pv")) | (F.col("a") < F.col("b"))
    return probes.join(index, same & (F.col("a") != F.col("b")) & close & once & first).select("a", "b")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), n_links.

    Input: doc_id (integer), text; other columns are not read. One output row per input
    row. Null and empty texts have fingerprint zero and are linked like others. Equal
    fingerprints are linked, so repeated rows share a component. n_links counts other
    fingerprints within RADIUS bits. A component without any doc_id has component_id
    null. An empty table gives no rows.
    """
    return _grouped(docs).drop("_text", "_root")


def _grouped(docs: DataFrame) -> DataFrame:
    """``near_groups`` with _text, a hash of the row's text, and _root, which names its component."""
    rows = materialise(fingerprints(docs), "fingerprints")
    prints = rows.groupBy("_fp").agg(F.min("doc_id").alias("_first"))
    found = materialise(links(prints), "near-links")
    degree = found.select(F.explode(F.array("a", "b")).alias("_fp")).groupBy("_fp").count()
    roots = components(found).select(F.col("node").alias("_fp"), F.col("root").alias("_root"))
    member = prints.join(roots, "_fp", "left").join(degree, "_fp", "left")
    member = member.withColumn("_root", F.coalesce("_root", "_fp"))
    smallest = member.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = member.join(smallest, "_root").select(
        "_fp", "_root", "component_id", F.coalesce("count", F.lit(0)).cast("long").alias("n_links")
    )
    return rows.join(named, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links", "_text", "_root"
    )


def drop_near(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its own columns: of each component the row with the smallest id.

    Null and empty texts are linked like others. Rows without an id come after all others, and one of them
    stays in a component that has no id. Of rows that share the smallest id the one with the smallest hash of
    its text stays. Rows are told apart by id and text: rows that repeat both stay or go together. An
    empty table gives no rows.
    """
    rows = _grouped(docs).select("doc_id", "_text", "_root")
    order = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "_text")
    keepers = rows.groupBy("_root").agg(F.min(order).alias("_keeper"))
    goes = rows.join(keepers, "_root").filter(~order.eqNullSafe(F.col("_keeper")))
    goes = goes.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash")).distinct()
    mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_or_empty()) == F.col("_hash"))
    return docs.join(goes, mine, "left_anti").select(*(f"`{c}`" for c in docs.columns))
