import glob
import json

import pytest
from pyspark.sql import functions as F

from evalspark import schemas, sources
from evalspark.operators import compare, forgetting
from evalspark.plans import datasets, reports


def test_jsonl_keeps_nulls_and_text(spark, tmp_path):
    path = str(tmp_path / "deep" / "rows.jsonl")
    df = spark.createDataFrame([("é\n“q”", None, "o")], schemas.INSTRUCTIONS)
    sources.write_jsonl(df, path)
    line = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{path}/*.json"))
    assert "é" in line and json.loads(line)["input"] is None
    assert sources.read_jsonl(spark, path, schemas.INSTRUCTIONS).collect() == df.collect()
    assert sources.read_instructions(spark, path).count() == 1


def test_missing_blank_and_malformed(spark, tmp_path):
    assert sources.read_jsonl(spark, str(tmp_path / "none.jsonl"), schemas.INSTRUCTIONS).count() == 0
    good = tmp_path / "good.jsonl"
    good.write_text('\n{"instruction":"a"}\n   \n{"instruction":"b","extra":1}\n\n')
    rows = sources.read_jsonl(spark, str(good), schemas.INSTRUCTIONS).collect()
    assert [tuple(r) for r in rows] == [("a", None, None), ("b", None, None)]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"instruction":"a"}\n{"instruction":\n')
    with pytest.raises(Exception):
        sources.read_jsonl(spark, str(bad), schemas.INSTRUCTIONS).collect()


def test_judgement_glob(spark, tmp_path):
    for name in ("a_vs_b", "b_vs_c"):
        (tmp_path / f"{name}.jsonl").write_text('{"winner":"A","checkpoint_a":"x","checkpoint_b":"y"}\n')
    (tmp_path / "other.jsonl").write_text("not read\n")
    rows = sources.read_judgements(spark, str(tmp_path / "*_vs_*.jsonl")).collect()
    assert sorted(r["source_file"] for r in rows) == ["a_vs_b.jsonl", "b_vs_c.jsonl"]
    assert sources.read_judgements(spark, str(tmp_path / "*_none_*.jsonl")).count() == 0


def test_tags():
    assert sources.tagged("out/table.csv") == "out/table.csv"
    assert sources.tagged("out/table.csv", " r2 ") == "out/table_r2.csv"
    assert sources.tagged("out.d/table", "r2") == "out.d/table_r2"


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.5, None)], "checkpoint string, x double, y double")
    path = sources.write_report(df, str(tmp_path / "t.csv"), ("y", "checkpoint", "x"), "v1")
    assert path.endswith("t_v1.csv")
    assert open(glob.glob(f"{path}/*.csv")[0]).read() == "y,checkpoint,x\n,a,0.5\n"
    empty = sources.write_key_value(df.filter("false"), str(tmp_path / "kv.csv"))
    assert open(glob.glob(f"{empty}/*.txt")[0]).read().startswith("no forgetting summary found")


def test_key_values_nest_json(spark):
    df = spark.createDataFrame([(1, 0.5)], "n int, r double").withColumn(
        "m", F.create_map(F.lit("k"), F.struct(F.lit(None).cast("int").alias("z")))
    )
    rows = {r["key"]: r["value"] for r in compare.to_key_value(df).collect()}
    assert rows == {"n": "1", "r": "0.5", "m": '{"k":{"z":null}}'}


def test_first_and_preferred(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 5, "y")], "k string, idx int, v string")
    first = {r["k"]: (r["idx"], r["v"]) for r in compare.first_document(df, ["k"]).collect()}
    assert first == {"a": (1, None), "b": (5, "y")}
    labelled, generic = df.filter("k = 'a' AND idx = 1"), df.filter("idx > 1")
    best = {r["k"]: r["idx"] for r in compare.prefer([labelled, generic], ["k"]).collect()}
    assert best == {"a": 1, "b": 5}
    assert compare.prefer([labelled.filter("false"), generic.filter("k = 'b'")]).first()["v"] == "y"
    assert compare.prefer([labelled.filter("false"), generic.filter("false")]).count() == 0


def test_evaluation_end_to_end(spark, tmp_path):
    labels = ("c0", "c1", "c2")
    text = spark.createDataFrame(
        [(i, c, "do", "", f"the answer number {i} of {c}", f"the answer number {i}") for i in range(4) for c in labels],
        "id bigint, checkpoint string, instruction string, input string, prediction string, reference string",
    )
    jsons = spark.createDataFrame(
        [(c, '{"a":1}', '{"a":1}') for c in labels], "checkpoint string, prediction string, reference string"
    )
    data = [(str(i), "c1", "c2", {"clarity": 3.0}, {}, "A", "", False) for i in range(4)]
    judged = spark.createDataFrame(data, schemas.PAIR_JUDGEMENTS).withColumn("idx", F.col("prompt_id").cast("bigint"))
    out = str(tmp_path / "eval")
    reports.write_evaluation(out, labels, text, jsons, judged, judged, "c1", "c2", run_tag="r")
    table = spark.read.option("header", True).csv(f"{out}/tables/comparison_r.csv").collect()
    assert [(r["checkpoint"], r["alpaca_judge_win_rate"], r["exact_match_rate"]) for r in table] == [
        ("c0", "0.0", "1.0"),
        ("c1", "1.0", "1.0"),
        ("c2", "0.0", "1.0"),
    ]
    summary = spark.read.option("header", True).option("escape", '"').csv(f"{out}/tables/forgetting_summary_r.csv")
    rows = {r["key"]: r["value"] for r in summary.collect()}
    assert rows["ckpt1_wins"] == "4" and json.loads(rows["category_breakdown"])["open_ended"]["total"] == 4
    # Another run is kept beside the first, and the two can be held against each other.
    turned = judged.withColumn("winner", F.lit("b"))
    reports.write_evaluation(out, labels, text, jsons, turned, turned, "c1", "c2", run_tag="q")
    runs = sources.read_runs(spark, f"{out}/metrics/judge_stats", "checkpoint STRING, win_rate DOUBLE", ("r", "q"))
    deltas = forgetting.run_deltas(runs, "r", "q", ["win_rate"]).collect()
    assert {r.checkpoint: r.delta_win_rate for r in deltas} == {"c0": 0.0, "c1": -1.0, "c2": 1.0}


def test_evaluation_without_judge_files(spark, tmp_path):
    labels = ("c0", "c1")
    text = spark.createDataFrame(
        [(1, c, "do", "", "the answer", "the answer") for c in labels],
        "id bigint, checkpoint string, instruction string, input string, prediction string, reference string",
    )
    jsons = spark.createDataFrame([("c0", "{}", "null")], "checkpoint string, prediction string, reference string")
    assert sources.find_judgements(spark, str(tmp_path / "*_vs_*.jsonl")) is None
    contested = spark.createDataFrame([], f"{schemas.PAIR_JUDGEMENTS}, idx BIGINT")
    out = str(tmp_path / "eval")
    reports.write_evaluation(out, labels, text, jsons, None, contested, "c0", "c1")
    table = spark.read.option("header", True).csv(f"{out}/tables/comparison.csv").collect()
    assert [(r["alpaca_judge_win_rate"], r["json_validity_rate"]) for r in table] == [(None, "0.0"), (None, "0.0")]


def test_paths_that_exist_are_read(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"{k}.jsonl").write_text('{"instruction":"%d"}\n' % k)
    paths = [str(tmp_path / name) for name in ("1.jsonl", "none.jsonl", "2.jsonl")]
    rows = sources.read_jsonl(spark, paths, schemas.INSTRUCTIONS).collect()
    assert sorted(r["instruction"] for r in rows) == ["1", "2"]
    assert sources.read_jsonl(spark, paths[1:2] * 2, schemas.INSTRUCTIONS).count() == 0


def test_json_dataset_end_to_end(spark):
    pool = spark.range(10).select(
        F.col("id").alias("idx"),
        F.concat(F.lit("p"), F.floor(F.col("id") / 2)).alias("instruction"),
        F.lit("").alias("input"),
        F.lit("t").alias("task_type"),
    )
    log = spark.range(10).select(
        F.col("id").alias("idx"),
        F.lit(0).alias("attempt"),
        F.lit("ok").alias("status"),
        F.when(F.col("id") == 9, "broken").otherwise('{"a":1}').alias("text"),
    )
    rows = datasets.json_dataset(pool, log, eval_size=2, train_cap=9).collect()
    assert len(rows) == 9
    sides = {}
    for r in rows:
        sides.setdefault(r["instruction"], set()).add(r["split"])
    assert all(len(s) == 1 for s in sides.values())
    assert sum(s == {"eval"} for s in sides.values()) == 2
