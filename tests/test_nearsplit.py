import random
import re

import numpy as np
import pyarrow as pa
import pytest

from evalspark.operators import nearsplit as ns

SCHEMA = "k int, instruction string, input string, content string, node int, split string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())


def runs(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    x, y = runs(a), runs(b)
    return 9 * len(x & y) >= 4 * (len(x) + len(y))


def prompts(n=40, seed=1):
    rng = random.Random(seed)
    voc = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    texts = [" ".join(rng.choices(voc, k=rng.randint(3, 80))) for _ in range(n)]
    for t in texts[: n // 2]:
        w = t.split()
        for k in range(rng.randint(1, 3)):  # near copies, some of them of near copies
            w = list(w)
            w[rng.randrange(len(w))] = f"new{k}"
            texts.append(" ".join(w))
    texts += ["", None, "  \t", "one two", "ONE  two", texts[0], texts[0].upper()]
    rng.shuffle(texts)
    return texts


def table(spark, texts):
    return spark.createDataFrame([(i, t, None, "x", 7, "y") for i, t in enumerate(texts)], SCHEMA).drop("split").repartition(3)


def closed_groups(texts):
    distinct = sorted({t or "" for t in texts})
    root = {t: t for t in distinct}

    def find(t):
        return t if root[t] == t else find(root[t])

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if alike(a, b):
                root[find(a)] = find(b)
    groups = {}
    for t in distinct:
        groups.setdefault(find(t), set()).add(t)
    return [g for g in groups.values() if len(g) > 1]


def test_groups_match_brute_force(spark):
    texts = prompts()
    df = table(spark, texts).withColumn("key", ns.content_key("instruction", "input"))
    by_key = {r.key: r.instruction or "" for r in df.collect()}
    found = {}
    for r in ns.near_groups(table(spark, texts), "instruction", "input").collect():
        found.setdefault(r.group, set()).add(by_key[r.content])
        assert r.size >= 2
    wanted = closed_groups(texts)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted))


@pytest.mark.parametrize("size", [0, 1, 15, 60, 10_000])
def test_no_near_copies_on_both_sides(spark, size):
    texts = prompts(60, 2)
    found = ns.split_near(table(spark, texts), size)
    rows = found.collect()
    assert len(rows) == len(texts) and found.columns == [*table(spark, texts).columns, "split"]
    sides = {}
    for r in rows:
        sides.setdefault(r.instruction or "", set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    evals = {t for t, s in sides.items() if s == {"eval"}}
    assert not any(alike(a, b) for a in evals for b in sides.keys() - evals)
    singles = len(sides) - sum(map(len, closed_groups(texts)))
    target = min(size, len(sides) - 1)
    assert len(evals) <= target and (len(evals) == target or target > singles)
    assert ns.near_overlap(found, "instruction", "input").first()[0] == 0


def test_the_audit_counts_eval_contents_with_near_copies_in_train(spark):
    texts = prompts(50, 3)
    rng = random.Random(4)
    sides = {t or "": rng.choice(["eval", "train"]) for t in texts}
    rows = [(i, t, "", "x", 1, sides[t or ""]) for i, t in enumerate(texts)]
    rows.append((900, texts[5], "", "x", 1, {"eval": "train", "train": "eval"}[sides[texts[5] or ""]]))
    both = {(t or "", s) for _, t, _, _, _, s in rows}
    wanted = {a for a, s in both if s == "eval" and any(x == "train" and (a == b or alike(a, b)) for b, x in both)}
    found = ns.near_overlap(spark.createDataFrame(rows, SCHEMA), "instruction", "input").first()[0]
    assert found == len(wanted) > 5


def test_a_hot_band_links_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(ns, "BUCKET", 4)
    base = " ".join(f"w{i}" for i in range(120))
    texts = [base.replace("w60 ", f"new{k} ") for k in range(40)] + [f"other {k} text of its own words" for k in range(5)]
    groups = ns.near_groups(table(spark, texts), "instruction", "input").collect()
    assert {r.size for r in groups} == {40}
    found = ns.split_near(table(spark, texts), 3).filter("split = 'eval'").collect()
    assert len(found) == 3 and all(r.instruction.startswith("other") for r in found)


def test_small_tables(spark):
    assert ns.split_near(table(spark, ["a", "b"]).limit(0), 5).collect() == []
    assert ns.near_groups(table(spark, []).limit(0), "instruction").collect() == []
    with pytest.raises(ValueError, match="two contents"):
        ns.split_near(table(spark, ["a", "a"]), 5)


def test_similar_sets_share_a_band_and_order_does_not_matter():
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        common, own = rng.integers(0, 2**62, 80), rng.integers(0, 2**62, (2, 10))
        sets = pa.array([rng.permutation(np.concatenate((common, o))).tolist() for o in own] + [[]], pa.list_(pa.int64()))
        a, b, none = ns.band_sketches(sets).to_pylist()
        missed += not any(x == y for x, y in zip(a, b))
        assert none == ns.band_sketches(pa.array([[0]], pa.list_(pa.int64()))).to_pylist()[0]
        assert a == ns.band_sketches(sets.slice(0, 1)).to_pylist()[0]
    assert missed == 0


def test_copies_in_a_batch_are_sketched_once(spark):
    texts = [t for t in prompts(20, 5) for _ in range(3)]
    rows = ns.contents(table(spark, texts).coalesce(1), "instruction", "input").collect()
    assert len(rows) == len({r.content for r in rows}) == len({t or "" for t in texts})


def test_runs_are_those_of_the_words():
    texts = ["a b c d e f", "A  B", "a b", "", " \t", "a b c d e", "b c d e f a b", "a", "a b c d e f"]
    found = ns.run_hashes(pa.array([t.lower() for t in texts])).to_pylist()
    names = {}
    for t, hashes in zip(texts, found):
        w = words(t)
        wanted = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        assert len(hashes) == len(wanted)
        assert all(names.setdefault(r, h) == h for r, h in zip(wanted, hashes))
    assert len(set(names.values())) == len(names)
    assert ns.run_hashes(pa.array(texts).slice(5, 2)).to_pylist() == found[5:7]


def test_several_splits_are_audited_on_one_table_of_contents(spark, monkeypatch):
    texts = prompts(20, 6)
    rng = random.Random(7)
    schema = "instruction string, input string, split string"
    sides = [[(t, "", rng.choice(["eval", "train"])) for t in texts] for _ in range(2)]
    splits = {name: spark.createDataFrame(rows, schema) for name, rows in zip(("one", "two"), sides)}
    splits["none"] = spark.createDataFrame([(t, "", "train") for t in texts], schema)
    made, kept = [], ns.materialise
    monkeypatch.setattr(ns, "materialise", lambda df, name: made.append(name) or kept(df, name))
    found = {r["by"]: r["n_near_overlap"] for r in ns.near_overlaps(splits, "instruction", "input").collect()}
    assert made.count("contents") == 1
    for name, rows in zip(("one", "two"), sides):
        both = {(t or "", s) for t, _, s in rows}
        assert found[name] == len({a for a, s in both if s == "eval" and any(x == "train" and (a == b or alike(a, b)) for b, x in both)})
    assert found["none"] == 0
