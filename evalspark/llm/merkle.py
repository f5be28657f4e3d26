"""A Merkle manifest of a dataset, with a proof of membership for every row.

Leaves are appended in order to a tree whose open subtrees each remember their leaves. A new node
takes its earlier siblings into the partial witnesses of its own leaves and is itself added
to those of theirs; with FAN_OUT siblings the subtree closes and its parent is the next node
appended, one level up. A tree of any size is cut into blocks of FAN_OUT ** HEIGHT leaves that are
aligned with it, so a block is a subtree and a task appends it as a stream. The blocks' roots are the
leaves of the next tier's appends, and so on until a tree has one node. A leaf's witness is its own
block's part, then that of its block in the tier above, up to the root of its source and from there, in
a last tree over the sources, to the root of the dataset.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from evalspark.llm.common import materialise

FAN_OUT, HEIGHT = 3, 7
#: The columns that make up a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


def _parent(digests: list[bytes]) -> bytes:
    """H of the children, as hexadecimal text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


# --- one tree, one leaf after the other -----------------------------------------


class Appender:
    """A tree that grows by appends and keeps every leaf's witness up to date."""

    def __init__(self):
        self.open: list[list[tuple[bytes, int, int]]] = []  # by level: digest, first and last leaf + 1
        self.witness: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        at = len(self.witness)
        self.witness.append(bytearray())
        self._complete(0, (leaf, at, at + 1))

    def _complete(self, level: int, node: tuple[bytes, int, int]) -> None:
        """A node is known: it joins its siblings, and perhaps closes their subtree."""
        while True:
            if level == len(self.open):
                self.open.append([])
            run = self.open[level]
            digest, first, stop = node
            before = b"".join(d for d, _, _ in run)
            if run:
                for w in self.witness[run[0][1] : first]:
                    w += digest
                for w in self.witness[first:stop]:
                    w += before
            run.append(node)
            if len(run) < FAN_OUT:
                return
            node = self._close(level)
            level += 1

    def _close(self, level: int) -> tuple[bytes, int, int]:
        run, self.open[level] = self.open[level], []
        return _parent([d for d, _, _ in run]), run[0][1], run[-1][2]

    def finish(self, levels: int | None = None) -> bytes:
        """Close what is open, ``levels`` levels high or until one node is left; that node."""
        level = 0
        while True:
            run = self.open[level]
            alone = len(run) == 1 and not any(self.open[level + 1 :])
            if alone and (level == levels or levels is None):
                return run[0][0]
            if run:
                self._complete(level + 1, self._close(level))
            level += 1


def fold(node: bytes, siblings: bytes, index: int, n: int) -> tuple[bytes, bytes]:
    """Root of a tree of ``n`` leaves from leaf ``index`` and its witness; and the siblings not used."""
    while n > 1:
        place = index % FAN_OUT
        others = min(FAN_OUT, n - (index - place)) - 1
        own, siblings = siblings[: others * DIGEST], siblings[others * DIGEST :]
        if len(own) < others * DIGEST:
            raise ValueError("a witness has too few siblings")
        node = _parent([own[: place * DIGEST], node, own[place * DIGEST :]])
        index, n = index // FAN_OUT, -(-n // FAN_OUT)
    return node, siblings


# --- leaves ------------------------------------------------------------------


def _encoded(value: Column) -> Column:
    """A value's length in bytes, a colon and the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """Digest of a row's FIELDS, with another text if one is given."""
    parts = [text if name == "text" and text is not None else F.col(name) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*(_encoded(p) for p in parts)), 256))


def tree_of(source: Column) -> Column:
    """A source's key: in the order of sources, bytewise, with null first, and never null itself."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


# --- many trees ----------------------------------------------------------------


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their place in their tree and its number of rows: ``index`` and ``n``.

    Ranges of (tree, order) are sorted and numbered one by one; a range's numbers then go up by what the
    tree's earlier ranges hold. A tree's rows are in as many ranges as they fill.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    at = ranged.columns.index("tree")

    def number(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for tree in batch.column(at).to_pylist():
                count = count + 1 if tree == last else 0
                last = tree
                places.append(count)
            more = [pa.array([part] * len(batch), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "place"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in ranged.dtypes)
    placed = materialise(ranged.mapInArrow(number, f"{kinds}, part int, place bigint"), "places")
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")  # one row per range
    bases = (
        placed.groupBy("tree", "part")
        .agg(F.count("*").alias("_n"))
        .select(
            "tree",
            "part",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"),
            F.sum("_n").over(whole).alias("n"),
        )
    )
    return placed.join(bases, ["tree", "part"]).select(
        *rows.columns, (F.col("_base") + F.col("place")).alias("index"), "n"
    )


def _append_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Nodes with their siblings within their block, and the block's root as ``top``."""
    size = FAN_OUT**height
    block = F.floor(F.col("index") / F.lit(size)).cast("bigint")
    dealt = (
        nodes.withColumn("block", block)
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "index")
    )
    names = dealt.columns
    places = [names.index(c) for c in ("tree", "block", "n", "node")]

    def append(batches):
        key, block, held, total = None, Appender(), [], 0

        def close():
            # A tree of several blocks needs all their roots at one height.
            top = block.finish(height if total > size else None)
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            more = [pa.array([bytes(w) for w in block.witness], pa.binary()), pa.array([top] * len(table), pa.binary())]
            return pa.RecordBatch.from_arrays([*table.columns, *more], [*names, "siblings", "top"])

        for batch in batches:
            start = 0
            columns = [batch.column(p).to_pylist() for p in places]
            for k, (tree, number, n, node) in enumerate(zip(*columns)):
                if (tree, number) != key:
                    if k > start:
                        held.append(batch.slice(start, k - start))
                    if held:
                        yield close()
                    key, block, held, start = (tree, number), Appender(), [], k
                total = n
                block.append(node)
            if start < len(batch):
                held.append(batch.slice(start))
        if held:
            yield close()

    kinds = ", ".join(f"`{c}` {t}" for c, t in dealt.dtypes)
    return dealt.mapInArrow(append, f"{kinds}, siblings binary, top binary")


def _tiers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The appended blocks of every tier, leaves first; each tier's nodes are the roots below."""
    size, tiers = FAN_OUT**height, []
    while True:
        tiers.append(materialise(_append_blocks(nodes, height), "blocks"))
        nodes = tiers[-1].filter(F.col("index") % size == 0).filter(F.col("n") > size)
        nodes = nodes.select(
            "tree",
            F.col("block").alias("index"),
            F.ceil(F.col("n") / F.lit(size)).cast("bigint").alias("n"),
            F.col("top").alias("node"),
        )
        if nodes.isEmpty():
            return tiers


def _ended(tier: DataFrame, height: int) -> DataFrame:
    """(tree, top) of the trees whose root is in this tier."""
    return tier.filter((F.col("index") == 0) & (F.col("n") <= FAN_OUT**height)).select("tree", "top")


def _roots(tiers: list[DataFrame], height: int) -> DataFrame:
    found = _ended(tiers[0], height)
    for tier in tiers[1:]:
        found = found.unionByName(_ended(tier, height))
    return found


def _descend(tiers: list[DataFrame], ends: DataFrame, height: int) -> DataFrame:
    """The leaves with their whole witness and what ``ends`` says of their tree.

    A block's witness is handed down to its members, tier by tier, so at most a block's worth of rows
    meets one of another table, however many leaves a tree has.
    """
    more, above = [c for c in ends.columns if c != "tree"], None
    for tier in reversed(tiers):
        here = _ended(tier, height).select("tree").join(ends, "tree")
        here = here.select("tree", F.lit(0).cast("bigint").alias("block"), F.lit(b"").alias("_above"), *more)
        if above is not None:
            upper = above.select("tree", F.col("index").alias("block"), F.col("siblings").alias("_above"), *more)
            here = here.unionByName(upper)
        met = tier.join(here, ["tree", "block"])
        above = met.withColumn("siblings", F.concat("siblings", "_above")).drop("_above", "block", "top")
    return above


# --- the manifest ----------------------------------------------------------------


def manifest(docs: DataFrame, altered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """Every row's leaf, witness and roots.

    doc_id, leaf, altered, index, n, siblings, source_index, sources, source_siblings, subroot, root;
    digests and witnesses are binary. Input: FIELDS; other columns are not read. ``altered`` is a second
    digest to carry along, such as of a copy to be verified. Within a source, leaves ascend by doc_id, null
    ids first and equal ids by their digests, so that repeated rows are leaves of their own that may change
    places. An empty table gives no rows. Text is read once, to be hashed; what is shuffled and written is
    digests, at most (FAN_OUT - 1) * HEIGHT of them to a row.
    """
    rows = docs.select(
        "doc_id",
        tree_of(F.col("source")).alias("tree"),
        leaf().alias("node"),
        (F.lit(None).cast("binary") if altered is None else altered).alias("altered"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = materialise(rows, "leaves")
    tiers = _tiers(_numbered(leaves, "doc_id", "node", "row").drop("row"), height)
    # The sources' roots are the leaves of one more tree.
    subroots = _roots(tiers, height).select(F.col("tree").alias("of"), F.col("top").alias("node"))
    over = _tiers(_numbered(subroots.withColumn("tree", F.lit("all")), "of"), height)
    root = _roots(over, height).withColumnRenamed("top", "root")
    sources = _descend(over, root, height).select(
        F.col("of").alias("tree"),
        F.col("index").alias("source_index"),
        F.col("n").alias("sources"),
        F.col("siblings").alias("source_siblings"),
        F.col("node").alias("subroot"),
        "root",
    )
    found = _descend(tiers, materialise(sources, "sources"), height)
    return found.withColumnRenamed("node", "leaf").drop("tree")


def proof(siblings: Column, source_siblings: Column) -> Column:
    """Digest of a row's whole witness, as hexadecimal text."""
    return F.sha2(F.lower(F.hex(F.concat(siblings, source_siblings))), 256)


def verify(rows: DataFrame) -> DataFrame:
    """``rows`` of a manifest with ``folded_root``, from ``altered`` (else ``leaf``) and the witness.

    ``verified`` says that it is the root. A witness of the wrong length is an error.
    """
    names = ["altered", "leaf", "index", "n", "siblings", "source_index", "sources", "source_siblings"]
    places = [rows.columns.index(c) for c in names]

    def climb(batches):
        for batch in batches:
            roots = []
            for other, node, index, n, own, source, sources, above in zip(*(batch.column(p).to_pylist() for p in places)):
                subroot, rest = fold(node if other is None else other, own, index, n)
                folded, more = fold(subroot, above, source, sources)
                if rest or more:
                    raise ValueError("a witness has too many siblings")
                roots.append(folded)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(roots, pa.binary())], [*batch.schema.names, "folded_root"]
            )

    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    folded = rows.mapInArrow(climb, f"{kinds}, folded_root binary")
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_feeds() -> Column:
    """The digest of a row whose text lost its line feeds, for every second crc32 of its id; else null."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(chosen, leaf(F.replace("text", F.lit("\n"), F.lit(""))))


def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if f == "text" else f) for f in FIELDS) + ")"


_SQL_CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, b: list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END,
    xor(crc, b)), 4294967295), 4294967295)"""

MERKLE_SQL = f"""
WITH RECURSIVE
d AS (SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
             CASE WHEN {_SQL_CRC} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} END AS altered FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             row_number() OVER () AS r FROM d),
t(source, lvl, i, h) AS (
    SELECT source, 0, i, leaf FROM l
    UNION ALL
    SELECT source, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
    FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM t) WHERE n > 1 GROUP BY source, lvl, i // 3),
m AS (SELECT source, max(lvl) AS height FROM t GROUP BY source),
s AS (SELECT t.source, height, h AS subroot, row_number() OVER (ORDER BY t.source NULLS FIRST) - 1 AS i
      FROM t JOIN m ON t.source IS NOT DISTINCT FROM m.source AND t.lvl = height),
u(lvl, i, h) AS (
    SELECT 0, i, subroot FROM s
    UNION ALL
    SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
    FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY lvl, i // 3),
o AS (SELECT max(lvl) AS height FROM u),
root AS (SELECT h AS root FROM u JOIN o ON lvl = height),
own AS (
    SELECT l.r, t.lvl AS step,
           string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < l.i // (3 ** t.lvl)::BIGINT) AS pre,
           string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > l.i // (3 ** t.lvl)::BIGINT) AS post
    FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source
    JOIN t ON t.source IS NOT DISTINCT FROM l.source AND t.lvl < s.height
          AND t.i // 3 = l.i // (3 ** (t.lvl + 1))::BIGINT
    GROUP BY l.r, t.lvl),
above AS (
    SELECT s.source, s.height + u.lvl AS step,
           string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < s.i // (3 ** u.lvl)::BIGINT) AS pre,
           string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > s.i // (3 ** u.lvl)::BIGINT) AS post
    FROM s JOIN u ON u.lvl < (SELECT height FROM o) AND u.i // 3 = s.i // (3 ** (u.lvl + 1))::BIGINT
    GROUP BY s.source, s.height, u.lvl),
p AS (SELECT r, step, coalesce(pre, '') AS pre, coalesce(post, '') AS post FROM own
      UNION ALL
      SELECT l.r, step, coalesce(pre, ''), coalesce(post, '')
      FROM l JOIN above ON l.source IS NOT DISTINCT FROM above.source),
f(r, step, h) AS (
    SELECT r, 0, coalesce(altered, leaf) FROM l
    UNION ALL
    SELECT f.r, f.step + 1, sha256(pre || h || post) FROM f JOIN p ON p.r = f.r AND p.step = f.step),
g AS (SELECT r, arg_max(h, step) AS folded_root FROM f GROUP BY r),
q AS (SELECT r, string_agg(pre || post, '' ORDER BY step) AS siblings FROM p GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source CROSS JOIN root JOIN g USING (r) LEFT JOIN q USING (r)
"""
