import hashlib
import random

import llm_data
import numpy as np
import pytest

from evalspark.llm import substring_dedup as sd


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - sd.LENGTH + 1):
            window = data[p : p + sd.LENGTH]
            if window in seen:
                gone[p : p + sd.LENGTH] = b"\1" * sd.LENGTH
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def cases(n=250):
    rng = random.Random(1)
    voc = llm_data.vocabulary(60)
    shared = [" ".join(rng.choices(voc, k=40)) for _ in range(5)]
    rows = [(0, ""), (1, None), (2, "a" * 1000), (3, "ab" * 400), (4, "x" * 99), (5, "a" * 300), (None, shared[0])]
    for i in range(6, n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices(voc, k=rng.randint(3, 60))) for _ in range(rng.randint(1, 5))]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("hot,local,piece", [(256, 64, 1 << 21), (6, 3, 700)])
def test_matches_brute_force(spark, tmp_path, monkeypatch, hot, local, piece):
    for name, value in (("HOT", hot), ("LOCAL_HOT", local), ("PIECE", piece), ("SORTED_AT_ONCE", 5000)):
        monkeypatch.setattr(sd, name, value)
    rows = cases()
    found = {r[0]: tuple(r)[1:] for r in sd.dedup_substrings(llm_data.stored(spark, tmp_path, rows, 5)).collect()}
    assert found == brute(rows)


def test_repeated_rows_and_empty_table(spark, tmp_path):
    text = " ".join(llm_data.sentences(3))
    docs = llm_data.stored(spark, tmp_path, [(1, text), (1, text), (1, text)])
    removed = sorted(r.n_removed for r in sd.dedup_substrings(docs).collect())
    assert removed == [0, len(text.encode()), len(text.encode())]
    assert sd.dedup_substrings(docs.filter("doc_id < 0")).collect() == []


def test_merge_sort_orders_suffixes():
    rng = random.Random(3)
    data = np.frombuffer("".join(rng.choices("ab", k=3000)).encode() + b"c" * sd.LENGTH, np.uint8)
    spots = np.array(rng.sample(range(2900), 500))
    run = np.sort(np.array([rng.randrange(7) for _ in spots]))
    run = np.unique(run, return_inverse=True)[1]
    order = sd.merge_sort(sd.Suffixes(data), spots, run)
    key = lambda k: (run[k], data[spots[k] : spots[k] + sd.LENGTH].tobytes())
    assert order.tolist() == sorted(range(500), key=key)


def test_another_split_at_the_second_reading_changes_nothing(spark, tmp_path):
    rows = cases()
    llm_data.documents(spark, rows, 1).write.parquet(str(tmp_path / "one.parquet"))
    names = ["spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        spark.conf.set(names[1], 1)
        result = sd.dedup_substrings(spark.read.parquet(str(tmp_path / "one.parquet")))
        spark.conf.set(names[0], 17)
        spark.conf.set(names[2], 4096)
        assert {r[0]: tuple(r)[1:] for r in result.collect()} == brute(rows)
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
