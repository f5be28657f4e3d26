import collections
import os

import compare
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


def test_registered_queries_match_their_sql(spark):
    from evalspark.llm.queries import ORACLE, QUERIES

    con = compare.duck(SF_DIR)
    for name, sql in ORACLE.items():
        assert compare.spark_rows(QUERIES[name](spark, SF_DIR)) == compare.duck_rows(con, sql)


def test_stages_take_and_give_documents(spark):
    import corpus_pipeline
    from evalspark.llm.queries import QUERIES
    from evalspark.llm.common import materialise

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    groups = QUERIES["op4_exact_dedup"](spark, SF_DIR).filter("not kept").collect()
    assert not left["exact_dedup"] & {r.doc_id for r in groups if r.keep_id in left["toxicity"]}
    texts = collections.Counter(r.text for r in docs.select("text").collect())
    assert max(texts.values()) == 1
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in whole.select("doc_id").collect()} == left["benchmark_decontamination"]
