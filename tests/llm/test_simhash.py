import re

import llm_data
from xxhash import xxh64_intdigest

from evalspark.llm import graph, simhash


def slow_fingerprint(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= 3:
                root[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(prints):
        groups.setdefault(find(k), []).append(i)
    smallest = {g: min([i for i in v if i is not None], default=None) for g, v in groups.items()}
    return sorted(((i, f"{f:016x}", smallest[find(k)]) for k, (i, f) in enumerate(prints)), key=str)


def cases():
    base = llm_data.sentences(25, 3, (0, 200))
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        words = t.split()
        for k in range(4):  # near copies: one word changed
            if words:
                rows.append((1000 + 10 * i + k, " ".join([*words[: len(words) // 2], f"new{k}", *words[len(words) // 2 + 1 :]])))
    rows += [(50, None), (51, ""), (52, " \t\n"), (53, "one"), (54, "One two"), (55, "ONE TWO three É"), (53, "one"), (None, "one"), (56, "a" * 100_000)]
    return rows


def test_components_match_brute_force(spark):
    rows = cases()
    found = simhash.near_groups(llm_data.documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == brute(rows)


def test_links_are_all_close_pairs(spark):
    import random

    rng = random.Random(4)
    values = {0, 2**63, 2**64 - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        values.add(x)
        for _ in range(6):
            y = x
            for _ in range(rng.randint(1, 5)):
                y ^= 1 << rng.randrange(64)
            values.add(y)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    df = spark.createDataFrame([(signed(v),) for v in values], "_fp bigint")
    found = [tuple(sorted((r.a, r.b))) for r in simhash.links(df).collect()]
    want = {tuple(sorted((signed(a), signed(b)))) for a in values for b in values if a < b and bin(a ^ b).count("1") <= 3}
    assert len(found) == len(set(found)) and set(found) == want


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    found = graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots) == 41 + 30 + 2
    assert len({roots[i] for i in range(41)}) == 1 and len({roots[100 + k] for k in range(30)}) == 1
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_empty_table(spark):
    docs = llm_data.documents(spark, cases()).limit(0)
    assert simhash.near_groups(docs).collect() == [] and simhash.drop_near(docs).collect() == []


def test_the_stage_keeps_one_row_of_each_component(spark):
    """Rows are judged by id and text: null ids take part, and another text of a dropped id stays."""
    import corpus_pipeline

    rows = cases()
    copy = next(t for i, t in rows if i == 7)
    rows += [(None, copy), (None, copy + " "), (999, copy), (3, "of the same id " * 30), (None, "alone " * 40), (None, "ALONE " * 40)]
    keep = {}
    prints = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                root[find(a)] = find(b)
    for k, (i, _) in enumerate(rows):
        keep.setdefault(find(k), []).append(((i is None, i or 0), k))
    left = corpus_pipeline.near_stage(spark, llm_data.documents(spark, rows), "").collect()
    found = sorted((r.doc_id is None, r.doc_id or 0) for r in left)
    repeated = [min(v)[0] for v in keep.values()]
    repeated += [(False, 53)] * (rows.count((53, "one")) - 1) * ((False, 53) in repeated)  # rows that repeat id and text
    assert found == sorted(repeated)
    assert left and corpus_pipeline.near_stage(spark, llm_data.documents(spark, rows).limit(0), "").collect() == []
