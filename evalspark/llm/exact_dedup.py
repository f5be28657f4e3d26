"""Exact duplicates: sorted digest runs merged up a tree, in DataFrame operations only.

Every row gets a SHA-256 digest of its normalised text and falls into one of RUNS
leaf runs by a hash of its id. A run keeps, for each digest, its smallest id and its
number of rows, sorted by digest. In every round FAN_IN neighbouring runs are merged
into one, again with the smallest id and the sum; after the last round one run is
left. Entries only merge if the length and an independent 64-bit hash of the text
agree as well, so each level verifies what it keeps. The answer goes back down through
the leaves: rows meet it by (run, digest), never by digest alone, so that a text that
makes up a third of all rows is spread over all runs on the way up and on the way down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evalspark.llm.common import materialise, text_or_empty

RUNS, FAN_IN = 64, 8
SPACES = r"[\x20\x09-\x0D]+"
IDENTITY = ("_digest", "_length", "_check")
_LAST = 2**63 - 1


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space."""
    return F.regexp_replace(text, SPACES, " ")


def digest_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, _row, _run, digest columns, _raw) of every row, written once."""
    norm = F.col("_norm")
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("_row"),
        F.xxhash64(text_or_empty()).alias("_raw"),
        normalised(text_or_empty()).alias("_norm"),
    )
    return rows.select(
        "doc_id",
        "_row",
        "_raw",
        F.pmod(F.xxhash64("doc_id", "_row"), F.lit(RUNS)).cast("int").alias("_run"),
        F.unhex(F.sha2(norm, 256)).alias("_digest"),
        F.octet_length(norm).alias("_length"),
        F.xxhash64(norm).alias("_check"),
    )


def _merge(runs: DataFrame) -> DataFrame:
    """One sorted run of each number: smallest id, its row and the number of rows."""
    return (
        runs.groupBy("_run", *IDENTITY)
        .agg(
            F.min("_id").alias("_id"),
            F.min_by("_keeper", "_id").alias("_keeper"),
            F.sum("_n").alias("_n"),
        )
        .sortWithinPartitions("_run", "_digest")
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """Which row of each group of equal texts stays.

    Input: doc_id (integer), text; other columns are not read. One output row per
    input row: doc_id, keep_id, group_size, kept, text_sha256, and _raw (a hash of the
    text as it came). A null text is the empty text. Rows without doc_id come after
    all others; a group of such rows has keep_id null. Of rows that repeat one doc_id
    and text exactly one is kept. An empty table gives no rows.
    """
    rows = materialise(digest_rows(docs), "digests")
    leaves = _merge(
        rows.select(
            "_run",
            *IDENTITY,
            F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_id"),
            F.col("_row").alias("_keeper"),
            F.lit(1).cast("long").alias("_n"),
        )
    )
    runs, level = RUNS, leaves
    while runs > 1:
        level = _merge(level.withColumn("_run", F.floor(F.col("_run") / FAN_IN).cast("int")))
        runs = -(-runs // FAN_IN)
    top = level.select(*IDENTITY, "_id", "_keeper", F.col("_n").alias("group_size"))
    down = leaves.select("_run", *IDENTITY).join(top, list(IDENTITY))
    return rows.join(down, ["_run", *IDENTITY]).select(
        "doc_id",
        F.when(F.col("_id") != _LAST, F.col("_id")).alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_keeper")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
        "_raw",
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its own columns.

    The kept (doc_id, text hash) pairs meet the documents in one join. Where a table
    repeats a whole row, the repetitions meet there too and one of them is taken.
    """
    kept = exact_groups(docs).filter("kept")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("_raw").alias("_hash"))
    mine = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"),
        F.col("doc_id").alias("_key"),
        F.xxhash64(text_or_empty()).alias("_raw"),
    )
    same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_raw") == F.col("_hash"))
    first = Window.partitionBy("_id", "_hash").orderBy("_hash")
    stays = mine.join(kept, same).withColumn("_n", F.row_number().over(first))
    return stays.filter("_n = 1").select("_doc.*")


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
           FROM documents),
     g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256
FROM d JOIN g USING (h)
"""
