import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from evalspark.operators import forgetting, judge
from evalspark.sources import read_runs, write_bucketed, write_run, write_runs
from evalspark.workload import fixtures as fx, queries

SCHEMA = "checkpoint STRING, score DOUBLE"
SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def scores(spark, **values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def shown(df):
    return sorted(tuple(r) for r in df.collect())


def test_rewriting_a_run_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run in ("a", "b", "c"):
        write_run(scores(spark, x=1.0, y=2.0), path, run)
    before = files(path)
    write_run(scores(spark, x=5.0), path, "b")
    after = files(path)
    kept = {f for f in before if "run=b" not in str(f)}
    assert kept and all(before[f] == after.get(f) for f in kept)
    assert shown(read_runs(spark, path, SCHEMA, ["b"])) == [("x", 5.0, "b")]
    write_run(scores(spark, x=1.0).limit(0), path, "b")
    assert shown(read_runs(spark, path, SCHEMA, ["b", "none"])) == []
    assert len(shown(read_runs(spark, path, SCHEMA))) == 4
    with pytest.raises(ValueError, match="run tag"):
        write_run(scores(spark, x=1.0), path, "../a")


def test_several_runs_are_replaced_in_one_job(spark, tmp_path):
    path = str(tmp_path / "runs")
    three = spark.createDataFrame([("x", 1.0, r) for r in ("1", "2", "3")], f"{SCHEMA}, run STRING")
    write_runs(three, path)
    before = files(path)
    write_runs(three.filter("run <> '2'").withColumn("score", F.lit(9.0)), path)
    kept = [f for f in before if "run=2" in str(f)]
    assert kept and all(before[f] == files(path).get(f) for f in kept)
    assert shown(read_runs(spark, path, SCHEMA)) == [("x", 1.0, "2"), ("x", 9.0, "1"), ("x", 9.0, "3")]


def test_deltas_scan_two_partitions(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, x in (("a", 1.0), ("b", 4.0), ("c", 9.0), ("d", 16.0)):
        write_run(scores(spark, x=x, **{run: 2.0}), path, run)
    deltas = forgetting.run_deltas(read_runs(spark, path, SCHEMA), "b", "d", ["score"])
    assert shown(deltas) == [("b", 2.0, 0.0, -2.0), ("d", 0.0, 2.0, 2.0), ("x", 4.0, 16.0, 12.0)]
    assert re.search(r"PartitionFilters: \[.*run.* IN \(b,d\)", plan(deltas))
    read = read_runs(spark, path, SCHEMA, ("b", "d")).select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"run=(\w)", r.f)[1] for r in read} == {"b", "d"}


def bucketed(spark, df, key, tmp_path):
    name = f"{key}_{abs(hash(str(tmp_path)))}_{df._jdf.hashCode() & 0xFFFF}"
    return write_bucketed(df, name, key, 4, str(tmp_path / name))


@pytest.fixture
def shuffled_joins(spark):
    """Small tables are not broadcast, as large ones would not be."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_bucket_is_one_file(spark, tmp_path):
    bucketed(spark, spark.range(1000).withColumnRenamed("id", "k"), "k", tmp_path)
    assert len(files(tmp_path)) == 4


def test_the_plan_of_bucketed_predictions_needs_no_shuffle(spark, tmp_path, shuffled_joins):
    plain = fx.text_predictions(spark, SF_DIR)
    table = bucketed(spark, plain, "id", tmp_path)
    over = judge.comparison_plan(table, fx.CHECKPOINTS)
    assert "Exchange" not in plan(over) and "Exchange" in plan(judge.comparison_plan(plain, fx.CHECKPOINTS))
    assert shown(over) == shown(judge.comparison_plan(plain, fx.CHECKPOINTS))


def test_categories_over_buckets_shuffle_groups_only(spark, tmp_path, shuffled_joins):
    judged = bucketed(spark, queries.contested(spark, SF_DIR), "idx", tmp_path)
    preds = bucketed(spark, fx.judged_predictions(spark, SF_DIR), "id", tmp_path)
    found = plan(forgetting.category_breakdown(judged, preds, *fx.CHECKPOINTS[1:]))
    below = found[found.index("Join"):]
    assert found.count("Exchange") == 1 and "Exchange" not in below


def test_all_groupings_come_from_one_scan_and_one_shuffle(spark, tmp_path, shuffled_joins):
    judged = bucketed(spark, queries.planned(fx.pair_judgements(spark, SF_DIR)), "idx", tmp_path)
    preds = bucketed(spark, fx.judged_predictions(spark, SF_DIR), "id", tmp_path)
    report = forgetting.outcome_report(judged, preds, fx.CHECKPOINTS)
    found = plan(report)
    assert found.count("Exchange") == 1 and found.count("FileScan") == 2
    rows = {r.level: r for r in report.collect() if r["first"] in (None, fx.CHECKPOINTS[1])}
    one = forgetting.head_to_head(queries.contested(spark, SF_DIR), *fx.CHECKPOINTS[1:]).first()
    pair = rows["pair"]
    assert (pair.total, pair.wins_first, pair.wins_second, pair.ties) == tuple(one)[:4]
    assert rows["total"].total == judged.count()


def test_report_of_chosen_levels_and_double_outputs(spark):
    judged = spark.createDataFrame(
        [(1, "a", "b", "a", "b", "a", False), (2, "a", "b", "b", "a", "a", True), (3, "a", "c", "a", None, "tie", False)],
        "idx bigint, first string, second string, checkpoint_a string, checkpoint_b string, winner string, swapped boolean",
    )
    preds = spark.createDataFrame(
        [(1, "a", "Summarize"), (1, "b", "Summarize"), (2, "a", "x")], "id bigint, checkpoint string, instruction string"
    )
    found = forgetting.outcome_report(judged, preds, ("a", "b", "c"), ("total", "category"))
    assert sorted((r.level, r.category or "", r.total, r.wins_first, r.wins_second, r.ties, r.undecided, r.regression_idx, r.improvement_idx) for r in found.collect()) == [
        ("category", "open_ended", 2, 0, 1, 0, 1, None, None), ("category", "summarization", 1, 1, 0, 0, 0, 1, None),
        ("total", "", 3, 1, 1, 0, 1, 1, None),
    ]
    with pytest.raises(Exception, match="two outputs"):
        forgetting.outcome_report(judged, preds.union(preds), ("a", "b", "c")).collect()
