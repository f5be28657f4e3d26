"""The encoder, packing, training order and separator counts, against the tokenizer itself."""

import random
import zlib

import llm_data
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from evalspark.llm import packing, token_counts, tokens, training_order
from evalspark.llm.common import scratch

ODD = [
    "", None, "  a\tb\x0bc\x0c d\r\ne f g <|endoftext|>x a<|startoftext|>b'S don't I'LL x'd ''s ",
    "e\u0301 \u0301x y\u00a0\u00a0A\u030angstro\u0308m \u0130stanbul ªº ×÷ \u3000z \x1ca\x1d b 1½2 naïve:café's",
    "\ud55c\uad6d \U0001f600\U0001f600a q\ufeff w' §x¦", "word " * 30_000,
]
ROWS = [*enumerate([*ODD, *llm_data.sentences(200, 4, (1, 900))]), (3, ODD[3]), (None, "no id")]


def reference(plain):
    tok = Tokenizer.from_file(tokens.default_path())
    tok.encode_special_tokens = plain
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("bound", [tokens.CACHED_WORDS, 50])
def test_words_encode_as_whole_texts(plain, bound, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", bound)
    encoder, whole = tokens.WordEncoder(tokens.default_path(), plain), reference(plain)
    texts = [t or "" for _, t in ROWS]
    for at in range(0, len(texts), 30):
        some = texts[at : at + 30]
        ids, bounds = encoder.encode(pa.array(some, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [whole(t) for t in some]
        assert encoder.count(pa.array(some, pa.string())).tolist() == np.diff(bounds).tolist()


@pytest.mark.parametrize("window", [2048, 64])
def test_packing_loses_nothing_and_pads_nothing(spark, window):
    whole = reference(False)
    found = packing.pack(llm_data.documents(spark, ROWS), window).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc in {i for i, _ in ROWS}:
        texts = [t for i, t in ROWS if i == doc]
        ids = np.array([*whole(texts[0]), packing.END_ID], "<u4")
        assert {r.doc_tokens for r in by_doc[doc]} == {len(ids)}
        spans = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[doc])
        covered = np.zeros(len(ids), int)
        for start, length, crc in spans:
            covered[start : start + length] += 1
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
        assert (covered == len(texts)).all()
    short = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at & (at - 1) == 0 and at <= window
        short += at < window
    assert short <= window.bit_length()
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_patterns_take_most_of_a_rich_histogram():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.integers(1, 256, 50_000), minlength=256)
    plan = packing.plan_windows(counts, 256)
    used = sum((hi - lo) for _, lo, hi, *_ in plan.slots)
    assert used > 0.9 * counts.sum()
    for n in range(256):
        spans = sorted((lo, hi) for m, lo, hi, *_ in plan.slots if m == n)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert packing.plan_windows(np.zeros(256, int), 256) == packing.Plan([], [], 0, 0)


def test_empty_tables(spark):
    empty = llm_data.documents(spark, ROWS[:3]).limit(0)
    assert packing.pack(empty).collect() == []
    assert training_order.training_order(empty)[0].collect() == []
    assert token_counts.document_tokens(empty).collect() == []


@pytest.mark.parametrize("total", [0, 1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation(total):
    slots = training_order.permute(np.arange(total), total)
    assert sorted(slots.tolist()) == list(range(total))
    if total >= 1000:
        assert not np.array_equal(slots, training_order.permute(np.arange(total), total, key=5))
        assert abs(np.corrcoef(slots, np.arange(total))[0, 1]) < 0.15


def test_shards_read_back_in_order(spark, tmp_path):
    whole = reference(True)
    docs = llm_data.stored(spark, tmp_path, ROWS)
    rows, layout = training_order.training_order(docs, stride=64, shard_bytes=50_000)
    rows = rows.collect()
    assert sorted(r.slot for r in rows) == list(range(layout.total))
    assert len(layout.shards) > 5
    every = layout.read(0, layout.total)
    assert np.array_equal(layout.read(37, 500), every[37:537]) and len(layout.read(layout.total, 5)) == 0
    slots = {(r.doc_id, r.start): r.slot for r in rows if r.doc_id is not None}
    order = np.argsort([slots[k] for k in sorted(slots)])
    assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.1
    texts = {}
    first = dict(zip(layout.shards.tolist(), layout.first.tolist()))
    for r in sorted(rows, key=lambda r: r.start):
        assert r.byte_offset == (r.slot - first[r.shard]) * 128
        assert zlib.crc32(every[r.slot].tobytes()) == r.ids_crc32
        texts.setdefault(r.doc_id, []).append((r.start, every[r.slot][: r.n_tokens].tolist()))
    for doc, parts in texts.items():
        ids = [*whole(dict(ROWS)[doc]), tokens.END_OF_TEXT]
        assert all(ids[s : s + len(p)] == p for s, p in parts)
        assert sum(len(p) for _, p in parts) == len(ids) * sum(1 for i, _ in ROWS if i == doc)


def test_separator_scan_at_any_block_size(spark):
    whole = reference(True)
    docs = llm_data.documents(spark, ROWS)
    found = token_counts.document_tokens(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == sorted((str(i), len(whole(t))) for i, t in ROWS)
    uri = found[0].file.rpartition("/")[0]
    want = sorted((r.file, r.ordinal, r.n_tokens) for r in found)
    for size in (2048, 10_000):
        assert sorted(map(tuple, token_counts.count_tokens(spark, uri, size).collect())) == want


def test_separator_scan_of_hand_made_files(spark):
    from evalspark.llm.files import write_file

    rng = random.Random(2)
    uri, want = scratch(spark, "flat-test"), []
    for f in range(4):
        lengths = [rng.choice([0, 0, 1, 2, 9]) for _ in range(rng.randint(1, 30))]
        data, last = [], f % 2 * 3  # two files end within a document
        for n in lengths:
            data += [7] * n + [tokens.END_OF_TEXT]
        data += [7] * last
        write_file(f"{uri}/part-{f}.bin", [np.array(data, "<u2").tobytes()])
        want += [(f"{uri}/part-{f}.bin", k, n) for k, n in enumerate([*lengths, last] if last else lengths)]
    write_file(f"{uri}/part-9.bin", [])
    for size in (2, 4, 6, 64):
        assert sorted(map(tuple, token_counts.count_tokens(spark, uri, size).collect())) == sorted(want)
    assert token_counts.count_tokens(spark, f"{uri}/none").collect() == []
