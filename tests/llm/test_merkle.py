import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from evalspark.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, index int, `node` int, part int, n int"


def documents(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "t", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(parts)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return out


def siblings(tree, i):
    """By level: those before and those behind."""
    out = []
    for nodes in tree[:-1]:
        a = i - i % 3
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 3])))
        i //= 3
    return out


def brute(rows):
    key = lambda s: b"" if s is None else b"=" + s.encode()
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=key)
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]])
    over = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            way = siblings(trees[s], i) + siblings(over, k)
            other = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                other = (*r[:4], r[4].replace("\n", ""))
            node = leaf(other)
            for a, b in way:
                node = sha(a + node + b)
            root = over[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, sha("".join(a + b for a, b in way)), node, node == root))
    return sorted(out, key=str)


def found(docs, height):
    rows = merkle.verify(merkle.manifest(docs, merkle.without_line_feeds(), height))
    shown = [F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")]
    proof = merkle.proof(F.col("siblings"), F.col("source_siblings"))
    out = rows.select("doc_id", *shown, proof, F.lower(F.hex("folded_root")), "verified").collect()
    return sorted((tuple(r) for r in out), key=str)


def table(n, sources, seed=1):
    rng = random.Random(seed)
    # A third of the rows are of one source.
    pick = lambda: sources[0] if rng.random() < 0.34 else rng.choice(sources)
    return [(i, pick(), rng.choice(["en", None]), rng.choice([i, None]), rng.choice([f"t{i}\n", f"t{i}", "", None])) for i in range(n)]


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (-5, None, "é", -3, "a\nb\n"), (7, "", "", 0, ""),
    (7, "", "", 0, ""), (7, "", "", 1, ""), (8, "", "x", 2, "two\nlines"), (9, "zebra", "en", 3, "long\n" * 50_000),
    (10, "é", "en", 4, "\n"), (2**62, "Z", "en", 5, "x"),
]


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest_matches_brute_force_over_several_tiers(spark, height):
    rows = table(230, ["s", "a", None, "ä", "b"]) + ODD
    assert found(documents(spark, rows), height) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 27, 28])
def test_one_source_of_every_shape(spark, n):
    rows = [(i, "s", "en", i, "x\n") for i in range(n)]
    assert found(documents(spark, rows, 1), 1) == brute(rows)[:n] if n else found(documents(spark, rows), 1) == []


def test_many_sources(spark):
    rows = [(i, f"s{i % 40}", "en", i, f"t{i}\n") for i in range(90)]
    assert found(documents(spark, rows), 1) == brute(rows)


def test_appender_keeps_witnesses_up_to_date():
    for n in range(1, 60):
        tree = merkle.Appender()
        leaves = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
        for k, node in enumerate(leaves):
            tree.append(node)
        top = tree.finish()
        want = levels([x.hex() for x in leaves])
        assert top.hex() == want[-1][0]
        for k in range(n):
            assert bytes(tree.witness[k]).hex() == "".join(a + b for a, b in siblings(want, k))
            assert merkle.fold(leaves[k], bytes(tree.witness[k]), k, n) == (top, b"")


def test_changed_rows_and_witnesses_do_not_verify(spark):
    rows = merkle.manifest(documents(spark, table(40, ["a", "b"])), height=2)
    assert all(r.verified for r in merkle.verify(rows).collect())
    other = rows.withColumn("altered", F.unhex(F.sha2(F.hex("leaf"), 256)))
    assert not any(r.verified for r in merkle.verify(other).collect())
    short = rows.withColumn("siblings", F.expr("substring(siblings, 1, 10)"))
    with pytest.raises(Exception, match="too few siblings"):
        merkle.verify(short).collect()
    long = rows.withColumn("source_siblings", F.expr("concat(source_siblings, source_siblings)"))
    with pytest.raises(Exception, match="too many siblings"):
        merkle.verify(long).collect()


def test_the_manifest_holds_whatever_the_partitioning(spark):
    rows = table(150, ["a", "b"]) + ODD
    one, many = (found(documents(spark, rows, parts), 2) for parts in (1, 16))
    assert one == many
