"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from evalspark.llm import (
    decontaminate,
    exact_dedup,
    fill_in_middle,
    language_model,
    merkle,
    packing,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
    training_order,
    url_filter,
    warc,
)
from evalspark.llm.common import ready, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(ready(spark), sf_dir.rstrip("/"))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


@query
def op1_toxicity(spark, sf_dir):
    """Toxicity of every document, by a classifier trained on ``labels``."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_decontamination(spark, sf_dir):
    """Documents that hold a passage of ``benchmark``, with the item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query
def op4_exact_dedup(spark, sf_dir):
    """Which document of each group of equal texts stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("_raw")


ORACLE["op4_exact_dedup"] = exact_dedup.EXACT_SQL


@query
def op5_suffix_dedup(spark, sf_dir):
    """Bytes of every document that repeat an earlier 100-byte string, removed."""
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


@query
def op6_url_filter(spark, sf_dir):
    """The verdict on every page's URL."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query
def op7_packing(spark, sf_dir):
    """Every piece of every document with its place in the packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_training_order(spark, sf_dir):
    """Slot, shard and byte offset of every sequence of the documents, shards written."""
    return training_order.training_order(table(spark, sf_dir, "documents"))[0]


@query
def op9_token_counts(spark, sf_dir):
    """Tokens of every document, counted in flat files by their separators."""
    return token_counts.document_tokens(table(spark, sf_dir, "documents"))


@query
def op10_language_model(spark, sf_dir):
    """Base score and language-model score of every document."""
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query
def op11_warc(spark, sf_dir):
    """Every page's record, as read back from the archives."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


ORACLE["op11_warc"] = warc.WARC_SQL


@query
def op12_fill_in_middle(spark, sf_dir):
    """Digests of every document rearranged, and of what comes back from its output."""
    out = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return fill_in_middle.restore(out.select(*columns, "output")).select(*columns, "restored_sha256")


ORACLE["op12_fill_in_middle"] = fill_in_middle.FILL_SQL


@query
def op13_merkle(spark, sf_dir):
    """Every document's leaf, proof and roots, with half of the documents checked as altered copies."""
    rows = merkle.verify(merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_line_feeds()))

    def shown(name):
        return F.lower(F.hex(name)).alias(name)

    return rows.select(
        "doc_id", shown("leaf"), shown("subroot"), shown("root"),
        merkle.proof(F.col("siblings"), F.col("source_siblings")).alias("proof_sha256"),
        shown("folded_root"), "verified",
    )


ORACLE["op13_merkle"] = merkle.MERKLE_SQL
