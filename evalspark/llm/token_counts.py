"""Count documents' tokens in flat token files by their separators.

A flat file is all ids of many documents, two bytes each, with END_OF_TEXT after every document
and no index. Files are cut into blocks of BLOCK_BYTES without regard to documents. A task
searches each block for separators in one vectorised comparison and reports how many
tokens lie before the first, between neighbours, and after the last. What a document has in
earlier blocks follows from a prefix scan over the blocks of its file: the number of separators
before a block, and the place of the last of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from evalspark.llm.common import materialise, scratch, text_or_empty
from evalspark.llm.files import read_range, sizes, write_file
from evalspark.llm.tokens import END_OF_TEXT, default_path, encoder

BLOCK_BYTES = 1 << 20
ID_BYTES = 2


def write_flat(docs: DataFrame, uri: str, path: str | None = None) -> DataFrame:
    """Write flat files, one per task; (doc_id, file, ordinal) says which document lies where.

    Special tokens' strings in a text are ordinary text, so only documents end in END_OF_TEXT.
    """
    path = path or default_path()

    def scan(batches):
        words = encoder(path, plain_specials=True)
        file = f"{uri}/part-{TaskContext.get().partitionId():06d}.bin"
        owners: list[pa.Array] = []

        def chunks():
            for batch in batches:
                ids, bounds = words.encode(batch.column(1))
                yield np.insert(ids, bounds[1:], END_OF_TEXT).astype("<u2").tobytes()
                owners.append(batch.column(0))

        write_file(file, chunks())
        at = 0
        for own in owners:
            n = len(own)
            arrays = [own, pa.array([file] * n, pa.string()), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "file", "ordinal"])
            at += n

    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return texts.mapInArrow(scan, f"doc_id {kind}, file string, ordinal bigint")


def scan_block(ids: np.ndarray, end: int = END_OF_TEXT):
    """(separators, tokens before the first, tokens after the last, tokens between neighbours)."""
    found = np.flatnonzero(ids == end)
    if not len(found):
        return 0, len(ids), len(ids), found
    return len(found), int(found[0]), len(ids) - 1 - int(found[-1]), np.diff(found) - 1


def count_tokens(spark: SparkSession, uri: str, block_bytes: int = BLOCK_BYTES, end: int = END_OF_TEXT) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in the flat files (*.bin) of a folder.

    n_tokens is without the separator. Tokens after a file's last separator are one more
    document; empty files, and folders without files, give no rows. block_bytes is even.
    """
    files = spark.createDataFrame(sizes(uri, ".bin"), "file string, size bigint")
    step = F.lit(block_bytes).cast("bigint")
    begins = F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, step)
    blocks = files.filter("size > 0").select("file", "size", F.explode(begins).alias("begin"))
    blocks = blocks.repartition(F.col("file"), F.col("begin"))
    names = ["file", "begin", "last", "ends", "head", "tail", "inner"]

    def scan(batches):
        for batch in batches:
            for file, size, begin in zip(*(c.to_pylist() for c in batch.columns)):
                raw = read_range(file, begin, min(block_bytes, size - begin))
                ends, head, tail, inner = scan_block(np.frombuffer(raw, "<u2"), end)
                values = ([file], [begin // ID_BYTES], [begin + block_bytes >= size], [ends], [head], [tail], [inner.tolist()])
                types = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    schema = "file string, begin bigint, last boolean, ends bigint, head bigint, tail bigint, inner array<bigint>"
    seen = blocks.mapInArrow(scan, schema)
    # The scan is over blocks, a few hundred bytes each, file by file.
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    stop = F.when(F.col("ends") > 0, F.col("begin") + F.col("length") - F.col("tail"))
    length = F.when(F.col("ends") > 0, F.col("head") + 1 + F.col("tail") + F.aggregate("inner", F.lit(0).cast("bigint"), lambda n, x: n + x + 1))
    placed = seen.withColumn("length", F.coalesce(length, F.col("head"))).withColumns(
        {
            "first": F.coalesce(F.sum("ends").over(before), F.lit(0)),
            "carried": F.col("begin") - F.coalesce(F.max(stop).over(before), F.lit(0)),
        }
    )
    zero = F.lit(0).cast("bigint")
    closed = F.when(F.col("ends") > 0, F.concat(F.array(F.col("carried") + F.col("head")), F.col("inner")))
    left = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("tail"))
    open_end = F.when(F.col("last") & (left > zero), F.array(left))
    none = F.array().cast("array<bigint>")
    counts = F.concat(F.coalesce(closed, none), F.coalesce(open_end, none))
    each = placed.select("file", "first", F.posexplode(counts).alias("at", "n_tokens"))
    return each.select("file", (F.col("first") + F.col("at")).alias("ordinal"), "n_tokens")


def document_tokens(docs: DataFrame, uri: str | None = None, path: str | None = None) -> DataFrame:
    """doc_id, file, ordinal, n_tokens: flat files of all documents, counted by their separators.

    Input: doc_id, text; other columns are not read. A null text has no tokens. Repeated rows are
    counted each; an empty table gives no rows.
    """
    uri = uri or scratch(docs.sparkSession, "flat-tokens")
    owners = materialise(write_flat(docs, uri, path), "flat-owners")
    counted = count_tokens(docs.sparkSession, uri)
    # Both sides have a row per document: compressed they look small, but they grow with the input.
    return owners.join(counted.hint("merge"), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
