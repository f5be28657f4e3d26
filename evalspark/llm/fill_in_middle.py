"""Fill-in-the-middle documents by piece tables.

A document starts as one descriptor (buffer, start, stop) over its UTF-8 bytes, which are never
copied or changed. Cutting it at two line ends splits the descriptor, an arrangement permutes the
parts and puts descriptors over the sentinels' buffer between them. Only writing out the result
touches bytes, one descriptor at a time, and so does hashing it. To restore a document its output
becomes the immutable buffer: cutting it at the sentinels gives the parts, and the inverse
permutation puts them back in their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from evalspark.llm.common import text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: What stands in front of the three parts, and the order in which an output holds them.
MARKS = (PREFIX, MIDDLE, SUFFIX)
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
PLAIN = "plain"
SEED, RATE, SPM_RATE = 7, 100, 50

_SENTINELS = "".join(MARKS).encode()


class Piece(NamedTuple):
    """A run of bytes in one of the two buffers."""

    mark: bool  # in the sentinels' buffer, else in the text
    start: int
    stop: int


def _mark(part: int) -> Piece:
    begin = sum(len(m) for m in MARKS[:part])
    return Piece(True, begin, begin + len(MARKS[part]))


def cut(piece: Piece, *places: int) -> list[Piece]:
    """One descriptor split at ascending places of its buffer."""
    ends = (piece.start, *places, piece.stop)
    return [Piece(piece.mark, a, b) for a, b in zip(ends, ends[1:])]


def arrange(parts: list[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of a form, each behind its sentinel."""
    return [p for k in ORDERS[form] for p in (_mark(k), parts[k])]


def stream(text: memoryview, pieces: list[Piece]) -> Iterator[memoryview]:
    """The bytes that descriptors stand for, without copying them."""
    marks = memoryview(_SENTINELS)
    return ((marks if p.mark else text)[p.start : p.stop] for p in pieces)


def parts_of(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an output that give back its document, in the document's order.

    A transformed text holds no sentinel of its own and no sentinel overlaps another, so each is
    found once.
    """
    if form == PLAIN:
        return [Piece(False, 0, len(output))]
    starts = [output.index(MARKS[k].encode()) for k in ORDERS[form]]
    found = []
    for k, a, b in zip(ORDERS[form], starts, [*starts[1:], len(output)]):
        found.append((k, Piece(False, a + len(MARKS[k].encode()), b)))
    return [piece for _, piece in sorted(found)]


def _line_ends(text: memoryview) -> np.ndarray:
    """Where each line of a text ends; a last line without a line feed counts."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    return ends


def _characters(text: memoryview) -> int:
    """Code points in UTF-8 bytes: all but the continuation bytes."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def _draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def _buffers(column: pa.Array) -> Iterator[memoryview]:
    """The texts of an Arrow column as views of its one data buffer; a null is empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    return (data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))


def _plan(text: memoryview, doc_id: int | None, seed: int, rate: int, spm_rate: int):
    """(lines, form, descriptors, code points of prefix and middle) of one document."""
    h1, h2, h3, h4 = _draws(doc_id, seed)
    ends = _line_ends(text)
    whole, n = Piece(False, 0, len(text)), len(ends)
    raw = bytes(text) if n else b""
    if not n or any(m.encode() in raw for m in MARKS) or h3 % 100 >= rate:
        return n, PLAIN, [whole], None, None
    places = [int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
    parts = cut(whole, *places)
    form = "spm" if h4 % 100 < spm_rate else "psm"
    prefix, middle = (_characters(text[p.start : p.stop]) for p in parts[:2])
    return n, form, arrange(parts, form), prefix, middle


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE
) -> DataFrame:
    """Documents cut at line ends and rearranged: doc_id, n, form, prefix_chars, middle_chars,
    output, output_sha256, pieces.

    Input: doc_id (integer), text; other columns are not read. ``n`` counts lines. Prefix and
    middle end after line counts drawn from a hash of ``seed`` and doc_id; ``rate`` percent of the
    documents are transformed, ``spm_rate`` percent of those with the suffix first. Empty texts and
    texts that hold a sentinel stay as they are (form "plain", no character counts); a null
    text is empty, and a null doc_id is hashed as no digits. ``pieces`` lists the descriptors of the
    output (mark: over the sentinels, else over the text; start and stop in bytes). One row per
    input row, repeated rows included; an empty table gives none. Nothing is shuffled, and a task
    holds one Arrow batch.
    """
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"]
    piece = pa.struct([("mark", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64())])
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(piece)]

    def transform(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), _buffers(batch.column(1))):
                n, form, pieces, prefix, middle = _plan(text, doc_id, seed, rate, spm_rate)
                digest = hashlib.sha256()
                for run in stream(text, pieces):
                    digest.update(run)
                output = b"".join(stream(text, pieces))
                rows.append((n, form, prefix, middle, output, digest.hexdigest(), [p._asdict() for p in pieces]))
            columns = [
                pa.array(c, pa.binary()).cast(t) if t == pa.string() and name == "output" else pa.array(c, t)
                for name, c, t in zip(names[1:], zip(*rows), types)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = (
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string,"
        " output_sha256 string, pieces array<struct<mark: boolean, start: bigint, stop: bigint>>"
    )
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(transform, schema)


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` with ``text`` and ``restored_sha256``, rebuilt from output and form alone.

    Other columns pass through, whatever they hold. A null output is the empty text and a null form
    "plain". A form's sentinel that the output lacks is an error.
    """
    columns = [c for c in transformed.columns if c not in ("text", "restored_sha256")]
    places = columns.index("output"), columns.index("form")
    kept = transformed.select(*(f"`{c}`" for c in columns))
    strings = [T.StructField(c, T.StringType()) for c in ("text", "restored_sha256")]
    schema = T.StructType([*kept.schema.fields, *strings])

    def rebuild(batches):
        for batch in batches:
            texts, digests = [], []
            forms = batch.column(places[1]).to_pylist()
            for output, form in zip(_buffers(batch.column(places[0])), forms):
                pieces = parts_of(bytes(output), form or PLAIN)
                digest = hashlib.sha256()
                for run in stream(output, pieces):
                    digest.update(run)
                digests.append(digest.hexdigest())
                texts.append(b"".join(stream(output, pieces)))
            more = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*columns, "text", "restored_sha256"])

    # Spark looks a function's columns up by name, which no dot may be part of.
    return kept.toDF(*(f"_{k}" for k in range(len(columns)))).mapInArrow(rebuild, schema)


FILL_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS s,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
h AS (
    SELECT *, len(u) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
           ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
    SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre,
           coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
           coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
