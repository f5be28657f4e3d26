"""Web archives: written with one gzip member per record, read back front to back.

A writer task puts its pages into archives of bounded size. Pages whose payload is stored
elsewhere become revisit records, which keep the headers, length and digest of their payload but not
the payload. A reader opens an archive as a stream and inflates it a block at a time. A record's
content length frames it: header lines, that many bytes, two line ends, and there its gzip member
has to end too. Digests are taken as the bytes go by and compared with those in the header, so a record
of any size is checked in the memory of one block.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evalspark.llm.common import materialise, scratch, text_or_empty
from evalspark.llm.files import open_stream, sizes, write_file

#: Payloads below this many bytes are always stored.
LEAST_REVISIT = 100
#: Runs that rows of one payload are spread over when they look up who stores it.
RUNS = 256
#: Bytes of content after which a writer begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Compressed bytes read, and inflated bytes held, at a time.
BLOCK = 256 << 10

# --- fixed values ---------------------------------------------------------
VERSION = "WARC/1.1"
SUFFIX = ".warc.gz"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# --------------------------------------------------------------------------

PAGE_ID = "X-Page-ID"


# --- who stores a payload ------------------------------------------------------


def stored_by(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with payload digest, length and ``refers_to``, the page whose record they revisit.

    Input: page_id (integer), url, html; other columns are not read. Of equal payloads of at least
    ``least`` bytes the smallest page_id is stored, in every row that repeats it; the others refer
    to it, null ids included. Where no page of a payload has an id, all are stored. Rows look a
    payload up by (run, digest), RUNS of them to a digest, so a payload of a third of all pages is
    no task's alone; html stays out of every shuffle but the one that meets the answer.
    """
    html = text_or_empty("html")
    rows = pages.select(
        F.col("page_id"),
        F.col("url"),
        html.alias("html"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"),
        F.sha2(html, 256).alias("payload_digest"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(RUNS)).cast("int").alias("_run"),
    )
    runs = rows.filter(F.col("payload_bytes") >= least).groupBy("_run", "payload_digest")
    leaves = runs.agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    top = leaves.groupBy("payload_digest").agg(F.min("_first").alias("_first"), F.sum("_n").alias("_n"))
    # Payloads of a single page need no answer.
    shared = top.filter((F.col("_n") > 1) & F.col("_first").isNotNull()).drop("_n")
    answers = leaves.select("_run", "payload_digest").join(shared, "payload_digest")
    met = rows.join(answers, ["_run", "payload_digest"], "left")
    other = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return met.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest", F.when(other, F.col("_first")).alias("refers_to")
    )


# --- writing -----------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    """A page's record id; a page without an id gets a random one."""
    return f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"


def _line(name: str, value: str) -> bytes:
    """A header line; characters that would end it, and spaces at its ends, are percent-encoded."""
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value) if name == "WARC-Target-URI" else value
    return f"{name}: {safe}\r\n".encode()


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE
) -> bytes:
    """One response record, or a revisit record where ``refers_to`` names a page; not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    header = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        *([] if url is None else [("WARC-Target-URI", url)]),
        *([] if page_id is None else [(PAGE_ID, str(page_id))]),
        *([] if refers_to is None else [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(refers_to))]),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = f"{VERSION}\r\n".encode() + b"".join(_line(n, v) for n, v in header)
    return head + b"\r\n" + block + b"\r\n\r\n"


def member(content: bytes, level: int = 6) -> bytes:
    """``content`` as a gzip member of its own."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def write_archives(
    pages: DataFrame, uri: str | None = None, archive_bytes: int = ARCHIVE_BYTES, least: int = LEAST_REVISIT
) -> DataFrame:
    """Write a record per page; (archive, bytes, records) of the archives written.

    Input as for ``stored_by``; null html is an empty payload, a null url has no header line. An
    archive is named by its attempt, and only those of tasks that ended are listed, so a lost executor's
    half of an archive is never read. An empty table writes nothing.
    """
    uri = uri or scratch(pages.sparkSession, "warc")

    def write(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        ahead = next(rows, None)
        while ahead is not None:
            name, counts = f"{uri}/{uuid.uuid4().hex}{SUFFIX}", [0]

            def members():
                nonlocal ahead
                held = 0
                while ahead is not None and held < archive_bytes:
                    page_id, url, html, digest, refers_to = ahead
                    payload = html.encode()
                    yield member(record(page_id, url, payload, digest, refers_to))
                    held += len(payload)
                    counts[0] += 1
                    ahead = next(rows, None)

            size = write_file(name, members())
            yield pa.RecordBatch.from_pydict({"archive": [name], "bytes": [size], "records": counts})

    rows = stored_by(pages, least).select("page_id", "url", "html", "payload_digest", "refers_to")
    return materialise(rows.mapInArrow(write, "archive string, bytes bigint, records bigint"), "archives")


def find_archives(spark: SparkSession, uri: str) -> DataFrame:
    """(archive, bytes, records) of a folder's archives; records is not known, so null."""
    found = [(name, size, None) for name, size in sizes(uri, SUFFIX)]
    return spark.createDataFrame(found, "archive string, bytes bigint, records bigint")


# --- reading -----------------------------------------------------------------------


class Record(NamedTuple):
    """What a record's header says, and what its bytes were found to be."""

    header: dict[str, str]  # names in lower case
    http: dict[str, str]  # likewise, of the message within
    payload_bytes: int
    payload_digest: str  # sha256, of what is stored
    payload: bytes | None


class _Inflater:
    """Bytes of one gzip member after the other, at most a few blocks at once."""

    def __init__(self, source: BinaryIO):
        self.source, self.packed, self.ready = source, b"", bytearray()
        self.unpacker = None

    def _fill(self) -> bool:
        """Inflate some more of the open member; False at its end."""
        while not self.unpacker.eof:
            self.packed = self.packed or self.source.read(BLOCK)
            if not self.packed:
                raise ValueError("an archive ends within a record")
            more = self.unpacker.decompress(self.packed, BLOCK)
            self.packed = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            if more:
                self.ready += more
                return True
        return False

    def begin(self) -> bool:
        """Open the next member; False where the archive ends."""
        self.packed = self.packed or self.source.read(BLOCK)
        self.unpacker = zlib.decompressobj(31)
        return bool(self.packed)

    def end(self) -> None:
        """The open member has nothing left."""
        if self.ready or self._fill():
            raise ValueError("a gzip member goes on behind its record")

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, a piece at a time."""
        while size:
            if not self.ready and not self._fill():
                raise ValueError("a gzip member ends within its record")
            piece = bytes(self.ready[:size])
            del self.ready[:size]
            size -= len(piece)
            yield piece

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        """What comes before ``mark``, which is passed over."""
        seen = 0
        while (at := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if seen > most or not self._fill():
                raise ValueError("a header does not end")
        found = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return found


def _fields(lines: Iterable[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and last:  # a line that goes on
            out[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


class _Digests:
    """The algorithms a record names and sha256, over bytes as they pass."""

    def __init__(self, *stated: str | None):
        names = {s.partition(":")[0].lower().replace("-", "") for s in stated if s}
        self.hashes = {n: hashlib.new(n) for n in names & {"sha1", "sha256", "sha512", "md5"} | {"sha256"}}

    def update(self, piece: bytes) -> None:
        for h in self.hashes.values():
            h.update(piece)

    def check(self, stated: str | None, what: str, of: str) -> None:
        """Compare with a stated digest in hexadecimal or base 32; an unknown algorithm is passed over."""
        name, _, value = (stated or "").partition(":")
        found = self.hashes.get(name.lower().replace("-", ""))
        if found is None or not value:
            return
        forms = found.hexdigest(), base64.b32encode(found.digest()).decode().rstrip("=").lower()
        if value.rstrip("=").lower() not in forms:
            raise ValueError(f"the {what} of record {of} has another digest than its header states")


def read_records(source: BinaryIO, payloads: bool = False) -> Iterator[Record]:
    """The records of an archive in their order, framed by content length and checked.

    Raises where a record is cut short, goes past its length, or has other bytes than its digests say.
    """
    stream = _Inflater(source)
    while stream.begin():
        first, *lines = stream.until(b"\r\n\r\n").split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError("a gzip member does not begin with a record")
        header = _fields(lines)
        name, left = header.get("warc-record-id", "?"), int(header["content-length"])
        stated_block, stated = header.get("warc-block-digest"), header.get("warc-payload-digest")
        block, payload = _Digests(stated_block), _Digests(stated)
        http, kept, size = {}, [] if payloads else None, 0
        inside = header.get("content-type", "").startswith("application/http")
        head = bytearray()
        for piece in stream.take(left):
            block.update(piece)
            if inside:
                head += piece
                at = head.find(b"\r\n\r\n")
                if at < 0 and len(head) <= 1 << 20:
                    continue
                http = _fields(bytes(head[:at]).split(b"\r\n")[1:]) if at >= 0 else {}
                piece, inside = bytes(head[at + 4 :]) if at >= 0 else bytes(head), False
            payload.update(piece)
            size += len(piece)
            if kept is not None:
                kept.append(piece)
        if inside:  # the message is all header, and does not even end it
            http = _fields(bytes(head).split(b"\r\n")[1:])
        block.check(stated_block, "block", name)
        if header.get("warc-type") != "revisit":  # a revisit's payload is elsewhere
            payload.check(stated, "payload", name)
        if b"".join(stream.take(4)) != b"\r\n\r\n":
            raise ValueError(f"record {name} does not end after its content length")
        stream.end()
        yield Record(header, http, size, payload.hashes["sha256"].hexdigest(), b"".join(kept) if payloads else None)


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


_COLUMNS = (
    "archive string, place bigint, warc_type string, record_id string, refers_to_id string, target_uri string,"
    " warc_date string, page_id bigint, refers_to bigint, stored_bytes bigint, payload_bytes bigint,"
    " payload_digest string, payload binary"
)


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the listed archives, checked: its place, header, payload length and digest.

    ``archives`` is what ``write_archives`` or ``find_archives`` lists (archive, records). Each archive is
    read once, as a stream, by one task. A revisit record has the length and digest that its headers state
    of the payload it refers to (null where they state none, or no sha256 digest); ``stored_bytes`` is what the
    record holds itself. ``payload`` is null unless asked for. An archive with another number of records
    than listed, and any fault in framing or digests, is an error.
    """

    def read(batches):
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held, place = [], 0, 0
                with open_stream(name) as source:
                    for r in read_records(source, payloads):
                        h, revisit = r.header, r.header.get("warc-type") == "revisit"
                        size, digest = r.payload_bytes, r.payload_digest
                        if revisit:
                            stated = r.http.get("content-length", "")
                            kind, _, value = h.get("warc-payload-digest", "").partition(":")
                            size = int(stated) if stated.isdigit() else None
                            digest = value.lower() if kind == "sha256" else None
                        own = h.get(PAGE_ID.lower())
                        rows.append(
                            (name, place, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"),
                             h.get("warc-target-uri"), h.get("warc-date"), int(own) if own else None,
                             _page(h.get("warc-refers-to")), r.payload_bytes, size, digest, r.payload)
                        )
                        place += 1
                        held += len(r.payload or b"")
                        if len(rows) == 10_000 or held > 16 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if records is not None and records != place:
                    raise ValueError(f"{name} has {place} records, not {records}")
                if rows:
                    yield _batch(rows)

    listed = archives.select("archive", F.col("records").cast("bigint"))
    return listed.repartition("archive").mapInArrow(read, _COLUMNS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    types = (text, number, text, text, text, text, text, number, number, number, number, text, pa.binary())
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def broken_revisits(records: DataFrame) -> DataFrame:
    """What revisit records claim and no response record holds: refers_to_id, payload_digest, payload_bytes.

    Claims are told apart before they meet the responses, so a payload that a third of all pages
    revisit is one claim.
    """
    claim = ["refers_to_id", "payload_digest", "payload_bytes"]
    claims = records.filter("warc_type = 'revisit'").select(*claim).distinct()
    held = records.filter("warc_type = 'response'").select(F.col("record_id").alias("refers_to_id"), *claim[1:])
    return claims.join(held, claim, "left_anti")


def archived_pages(pages: DataFrame, uri: str | None = None) -> DataFrame:
    """Pages written to archives, and what reading the archives finds of each.

    page_id, payload_bytes, payload_digest, record_type, refers_to. One row per input row. A revisit
    whose payload no response record holds is an error.
    """
    records = materialise(read_archives(write_archives(pages, uri)).drop("payload"), "records")
    broken = broken_revisits(records).first()
    if broken is not None:
        raise ValueError(f"no response record holds what a revisit refers to: {broken.asDict()}")
    kind = dict(pages.dtypes)["page_id"]

    def typed(name: str) -> Column:
        return F.col(name).cast(kind).alias(name)

    return records.select(
        typed("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), typed("refers_to")
    )


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
     k AS (SELECT payload_digest, min(page_id) AS keep FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""
