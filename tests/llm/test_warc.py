import base64
import gzip
import hashlib
import io
import re

import pytest

from evalspark.llm import warc
from evalspark.llm.common import scratch
from evalspark.llm.files import write_file

LONG = "<p>é</p>" * 20
SCHEMA = "page_id bigint, url string, html string, archive string, payload string, _run int, _first int, records int"
ROWS = [
    (5, "https://a.example/x", LONG), (3, "https://b.example/\r\nX-Evil: 1", LONG), (9, None, LONG),
    (1, "u", "short"), (2, "u", "short"), (4, "", ""), (6, "u", None), (7, "ü rl", "x" * 99), (8, "u", "x" * 99),
    (10, "u", "y" * 100), (11, "u", "y" * 100), (11, "u", "y" * 100), (10, "u", "y" * 100),
    (None, "u", LONG), (None, "u", "only nulls " * 30), (None, None, "only nulls " * 30),
    (12, "u", "\r\n\r\nWARC/1.1\r\n" * 40), (13, "u", "big " * 500_000), (14, "u", "big " * 500_000),
]


def pages(spark, rows=ROWS, parts=3):
    return spark.createDataFrame([(*r, "a", "p", 1, 2, 3) for r in rows], SCHEMA).repartition(parts)


def brute(rows):
    out, first = [], {}
    for i, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 100 and i is not None:
            first[payload] = min(i, first.get(payload, i))
    for i, _, html in rows:
        payload = (html or "").encode()
        keep = first.get(payload)
        revisit = keep is not None and keep != i
        kind = "revisit" if revisit else "response"
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), kind, keep if revisit else None))
    return sorted(out, key=str)


def test_pages_come_back_as_brute_force_says(spark):
    found = [tuple(r) for r in warc.archived_pages(pages(spark)).collect()]
    assert sorted(found, key=str) == brute(ROWS)


def test_hot_payload_small_archives_and_empty_table(spark):
    rows = [(i, "u", LONG) for i in range(700)] + [(i, "u", f"{i} {LONG}") for i in range(700, 900)]
    uri = scratch(spark, "hot")
    listed = warc.write_archives(pages(spark, rows), uri, archive_bytes=2_000).collect()
    assert len(listed) > 5 and sum(r.records for r in listed) == 900
    again = warc.read_archives(warc.find_archives(spark, uri)).collect()
    assert len(again) == 900 and {r.refers_to for r in again if r.page_id in range(1, 700)} == {0}
    empty = pages(spark).limit(0)
    assert warc.write_archives(empty).collect() == [] and warc.archived_pages(empty).collect() == []
    assert warc.read_archives(warc.find_archives(spark, scratch(spark, "none"))).collect() == []


def test_payloads_urls_and_places(spark):
    listed = warc.write_archives(pages(spark, [(r[0], r[1], r[2]) for r in ROWS], 1))
    found = warc.read_archives(listed, payloads=True).collect()
    texts = {r[0]: (r[2] or "") for r in ROWS if r[0] is not None}
    for r in found:
        if r.warc_type == "response" and r.page_id is not None:
            assert r.payload.decode() == texts[r.page_id] and r.stored_bytes == r.payload_bytes
        if r.warc_type == "revisit":
            assert r.payload == b"" and r.stored_bytes == 0
    uris = {r.page_id: r.target_uri for r in found}
    assert uris[3] == "https://b.example/%0D%0AX-Evil:%201" and uris[9] is None and uris[7] == "ü%20rl"
    for name in {r.archive for r in found}:
        assert sorted(r.place for r in found if r.archive == name) == list(range(sum(r.archive == name for r in found)))


def member(**change):
    raw = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    for a, b in change.values():
        assert a in raw
        raw = raw.replace(a, b)
    return warc.member(raw)


def read(content):
    return list(warc.read_records(io.BytesIO(content), payloads=True))


@pytest.mark.parametrize(
    "content, message",
    [
        (member(a=(b"payload\r\n\r\n", b"paylord\r\n\r\n")), "another digest"),
        (member(a=(b"WARC-Block-Digest: sha256:", b"WARC-Block-Digest: sha256:0")), "another digest"),
        (re.sub(rb"$", b"", member())[:-12], "ends within a record"),
        (warc.member(gzip.decompress(member()) + b"more"), "goes on behind"),
        (warc.member(gzip.decompress(member())[:-4]), "ends within its record"),
        (warc.member(gzip.decompress(member())[:-4] + b"\r\n\n\n"), "does not end after"),
        (warc.member(b"HTTP/1.1 200 OK\r\n\r\n"), "does not begin with a record"),
        (warc.member(b"WARC/1.1\r\nno end"), "header does not end"),
    ],
)
def test_faults_are_found(content, message):
    assert [r.payload for r in read(member() * 2)] == [b"payload"] * 2
    with pytest.raises(ValueError, match=message):
        read(member() + content)


def test_records_of_other_writers():
    sha1 = base64.b32encode(hashlib.sha1(b"text").digest()).decode()
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nX-Folded: one\r\n\ttwo\r\nContent-Length: 4\r\nWARC-Block-Digest: sha1:%s\r\n\r\ntext\r\n\r\n"
    found = read(warc.member(info % sha1.encode()) + member())
    assert found[0].header["x-folded"] == "one two" and found[0].payload == b"text"
    assert found[1].http["content-length"] == "7"
    with pytest.raises(ValueError, match="another digest"):
        read(warc.member(info % base64.b32encode(hashlib.sha1(b"else").digest())))


def test_a_record_larger_than_the_block_is_read_in_pieces(monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 16)
    body = bytes(range(256)) * 50
    one = warc.member(warc.record(1, "u", body, hashlib.sha256(body).hexdigest(), None))
    assert [r.payload for r in read(one * 3)] == [body] * 3


def test_lost_response_and_wrong_count_are_errors(spark):
    uri = scratch(spark, "lost")
    sha = hashlib.sha256(b"z" * 100).hexdigest()
    write_file(f"{uri}/one{warc.SUFFIX}", [warc.member(warc.record(2, "u", b"z" * 100, sha, 1))])
    records = warc.read_archives(warc.find_archives(spark, uri))
    assert [r.refers_to_id for r in warc.broken_revisits(records).collect()] == ["<urn:page:1>"]
    listed = spark.createDataFrame([(f"{uri}/one{warc.SUFFIX}", 7)], "archive string, records int")
    with pytest.raises(Exception, match="has 1 records, not 7"):
        warc.read_archives(listed).collect()
