"""What grows with the tables goes over more tasks, and no task holds a whole share of them."""

import glob
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from evalspark.functions import jsonx
from evalspark.operators import incremental, textmetrics
from evalspark.session import prepare
from evalspark.sources import bucket_count
from evalspark.workload import queries


def test_files_of_a_store_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch", lambda spark, name: str(tmp_path / name))
    rows = spark.range(0, 300, 1, 5).selectExpr(
        "id", "'a' AS checkpoint", "'' AS instruction", "'' AS input", "'' AS task_type", "'{}' AS prediction", "'{}' AS reference"
    )
    store = queries.kept_up_to_date(spark, rows, incremental.JSON, "id")
    for part in range(3):
        assert len(glob.glob(f"{tmp_path}/incremental/files/part={part}/*.json")) > 1
    assert incremental.json_metrics(spark, store).first()["total"] == 300


def test_buckets_follow_the_number_of_prompts():
    assert bucket_count(100) == 8 and bucket_count(6_000_000) == 75
    assert bucket_count(12_000_000) == 2 * bucket_count(6_000_000)


def test_partitioned_files_are_written_without_a_sort(spark, tmp_path):
    prepare(spark)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 3
    spark.range(0, 300, 1, 1).selectExpr("id", "id % 3 AS pair").write.partitionBy("pair").json(str(tmp_path / "out"))
    assert [r["count"] for r in spark.read.json(str(tmp_path / "out")).groupBy("pair").count().collect()] == [100] * 3


def test_vectors_become_no_python_numbers():
    vectors = np.random.default_rng(1).normal(size=(40_000, 64))
    vectors[7] = 0
    flat = pa.ListArray.from_arrays(np.arange(0, vectors.size + 1, 64, dtype=np.int32), pa.array(vectors.ravel()))
    blocks = pa.ListArray.from_arrays(np.arange(0, 40_001, 5, dtype=np.int32), flat)
    tracemalloc.start()
    unit = textmetrics._unit.func(blocks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * vectors.nbytes
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    assert np.allclose(unit.flatten().flatten().to_numpy().reshape(-1, 64), vectors / np.where(norm == 0, 1, norm))
    best = textmetrics._best_matches.func(unit.slice(0, 2), unit.slice(2, 2))
    assert [len(x) for x in best.field("cand_best")] == [5, 5] and len(textmetrics._unit.func(blocks.slice(0, 0))) == 0


def test_whole_numbers_are_tagged_without_extracting_their_parts(spark):
    cases = ["0", "-0", "7", "-120", "100", "1.0", "1e2", "10e1", "1234567890123456789000", "-5.50", "0.0"]
    rows = spark.createDataFrame([(f'{{"a":[{x},"{x}"]}}',) for x in cases], "t string")
    found = [r[0] for r in rows.select(F.to_json(jsonx.comparable(F.col("t")))).collect()]
    wanted = ["n0", "n0", "n7e0", "n-12e1", "n1e2", "n1e0", "n1e2", "n1e2", "n123456789012345678" + "9e3", "n-55e-1", "n0"]
    assert found == [f'{{"sa":["{w}","s{x}"]}}' for w, x in zip(wanted, cases)]
    assert "WHEN t RLIKE r'^-?[1-9]" in jsonx._tagged_text(True)


def test_classes_are_taken_once_for_each_key(spark):
    rows = spark.range(1).select(F.parse_json(F.lit('{"a":[1],"b":2}')).alias("a"), F.parse_json(F.lit('{"a":["x"],"b":"2"}')).alias("b"))
    checked = rows.select(jsonx.schema_compliance(F.col("a"), F.col("b")).alias("s"))
    # Two for the values of a key, and two for the elements of lists.
    assert checked._jdf.queryExecution().analyzed().toString().lower().count("schema_of_variant") <= 4
    assert checked.first()["s"]["wrong"] == ["a", "b"]
