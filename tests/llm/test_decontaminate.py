import re

import llm_data
import pytest

from evalspark.llm import decontaminate

VOC = llm_data.vocabulary(400, 5)
ITEMS = llm_data.sentences(12, 6, (15, 30), VOC)
CLEAN = llm_data.sentences(60, 7, (0, 60), VOC)


def tables(spark):
    rows = [(i, t) for i, t in enumerate(CLEAN)]
    rows += [(100 + i, f"{CLEAN[i]} {t.upper()}! {CLEAN[-i - 1]}") for i, t in enumerate(ITEMS)]
    for i, t in enumerate(ITEMS):  # one word in seven replaced
        words = [("zzz" if k % 7 == 3 else w) for k, w in enumerate(t.split())]
        rows.append((200 + i, f"{CLEAN[i + 20]} {' '.join(words)}"))
    rows += [(300, None), (301, ""), (302, ITEMS[0]), (302, ITEMS[0]), (None, ITEMS[1])]
    bench = [(i, t) for i, t in enumerate(ITEMS)] + [(50, ITEMS[2].upper()), (51, None), (52, ""), (53, "a few uncommon words")]
    return llm_data.documents(spark, rows), spark.createDataFrame(bench, "item_id bigint, text string")


def brute(docs, bench):
    """All alignments of all items, window by window."""
    import re

    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    items = {}
    for r in bench.collect():
        items.setdefault(tuple(words(r.text)), []).append(r.item_id)
    out = set()
    for d in docs.collect():
        mine = words(d.text)
        for theirs, ids in items.items():
            if not theirs:
                continue
            width = min(decontaminate.WINDOW, len(theirs))
            for shift in range(-len(theirs), len(mine)):
                same = [0 <= shift + k < len(mine) and mine[shift + k] == w for k, w in enumerate(theirs)]
                if any(sum(same[k : k + width]) >= 0.8 * width for k in range(len(theirs) - width + 1)):
                    out.add((d.doc_id, min(ids)))
    return out


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_SEEDS, 0])
def test_finds_planted_passages_and_nothing_else(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", limit)
    docs, bench = tables(spark)
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    planted = {(100 + i, i) for i in range(12)} | {(200 + i, i) for i in range(12)} | {(302, 0), (None, 1)}
    assert planted <= found
    assert found == brute(docs, bench)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_SEEDS, 0])
def test_items_of_every_length_equal_brute_force(spark, monkeypatch, limit):
    import random

    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", limit)
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 16)
    rng, items, rows = random.Random(9), [], []
    for n in range(1, 17):
        item = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        for wrong in range(4):  # so many words replaced, anywhere, and texts that begin or end within an item
            for k in range(6):
                words = [f"x{wrong}" if j in rng.sample(range(n), min(wrong, n)) else w for j, w in enumerate(item)]
                around = [f"c{rng.randrange(99)}" for _ in range(rng.randrange(4))]
                words = around + words + around[:1] if k < 4 else words[wrong:] + around if k < 5 else around + words[: max(0, n - wrong)]
                rows.append((len(rows), " ".join(words)))
    docs, bench = llm_data.documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == brute(docs, bench) and {i for _, i in found} == set(range(1, 17))


def test_drop_and_empty_tables(spark):
    docs, bench = tables(spark)
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {*range(60), 300, 301, None}
    assert decontaminate.contaminated(docs.limit(0), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_both_branches_verify_every_place_of_a_repeated_phrase(spark, monkeypatch):
    rows, bench = [], []
    for i in range(12):
        w = [f"w{i}x{k}" for k in range(24)]
        phrase = [f"p{i}x{k}" for k in range(9)]
        item = w[:8] + phrase + w[8:16] + phrase + w[16:]
        bench.append((i, " ".join(item)))
        rows += [(10 * i, " ".join(item[4:21])), (10 * i + 1, " ".join(item[21:38]))]  # the one place, the other
    docs, items = llm_data.documents(spark, rows), spark.createDataFrame(bench, "item_id bigint, text string")
    found = []
    for limit in (decontaminate.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", limit)
        found.append(sorted(tuple(r) for r in decontaminate.contaminated(docs, items).collect()))
    assert found[0] == found[1] and {r[0] for r in found[0]} == {i for i, _ in rows}


def test_stage_decides_by_id_and_text(spark, tmp_path):
    import corpus_pipeline

    rows = [(1, ITEMS[0]), (1, CLEAN[40] + " clean"), (2, "clean"), (None, ITEMS[1]), (None, "clean too"), (None, None)]
    spark.createDataFrame([(0, ITEMS[0]), (1, ITEMS[1])], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = corpus_pipeline.benchmark_stage(spark, llm_data.documents(spark, rows), str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted((rows[k] for k in (1, 2, 4, 5)), key=str)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_SEEDS, 0])
def test_rows_of_unrolled_places_are_never_whole_texts(spark, monkeypatch, limit):
    """All that has places is generated code: between its parts each row would be a copy of the words, or of the filter."""
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", limit)
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 16)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = decontaminate.contaminated(*tables(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    places = [x for x in plan.split("\n") if "_at#" in x and re.search("(Generate|Project|Filter|Join|Aggregate) ", x)]
    assert any("Generate" in x for x in places)
    assert [x for x in places if "*(" not in x] == []


def test_filter_holds_all_seeds_and_few_others(spark):
    from pyspark.sql import functions as F

    seeds = spark.range(2000).select(F.xxhash64("id").alias("_seed"))
    bits = decontaminate.filter_bits(2000)
    assert bits == 1 << 15 and decontaminate.filter_bits(10**9) == decontaminate.FILTER_BITS
    words = decontaminate.seed_filter(seeds, bits)
    other = spark.range(2000, 52000).select(F.xxhash64("id").alias("_seed"))
    passed = [df.filter(decontaminate.may_hold(words, bits, F.col("_seed"))).count() for df in (seeds, other)]
    assert passed[0] == 2000 and passed[1] < 1000
