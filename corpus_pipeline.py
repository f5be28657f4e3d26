"""From documents to packed sequences: five stages, each one operator's decision.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
the rows the next stage works on. ``run`` writes each stage as Parquet to the shared
folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evalspark.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from evalspark.llm.common import materialise, ready, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier takes for toxic go."""
    return toxicity.drop_toxic(docs, table(ready(spark), sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    ready(spark)
    return exact_dedup.drop_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest id stays."""
    ready(spark)
    return simhash.drop_near(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    items = table(ready(spark), sf_dir, "benchmark")
    return decontaminate.drop_contaminated(docs, items, null_ids_stay=False)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
