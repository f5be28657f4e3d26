import pytest
from pyspark.sql import functions as F

from evalspark.operators import prep


def test_normalise_keeps_instructions_of_spaces(spark):
    df = spark.createDataFrame(
        [(1, " a ", None, "o\n"), (2, "", "x", "y"), (3, "  ", "x", "y"), (4, None, "x", "y")],
        "id int, instruction string, input string, output string",
    )
    rows = prep.normalise_instructions(df).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("a", "", "o", 1), ("", "x", "y", 3)]


def test_pool_texts_and_doubling(spark):
    seeds = {
        "json_extraction": spark.createDataFrame(
            [("A", 'B"q', "C", "2024-01-01")], "first string, second string, location string, date string"
        ),
        "schema_generation": spark.createDataFrame([("N", 3, "C")], "name string, age int, city string"),
        "tool_call_args": spark.createDataFrame([("C", "today")], "city string, date string"),
    }
    rows = prep.build_pool(seeds, copies=2).collect()
    assert len(rows) == 6 and {r["copy_no"] for r in rows} == {0, 1}
    by_type = {r["task_type"]: r for r in rows}
    extraction = by_type["json_extraction"]
    assert extraction["input"] == 'A met B"q in C on 2024-01-01.'
    assert (
        extraction["json_example"]
        == '{"entities": ["A", "B\\"q"], "location": "C", "date": "2024-01-01"}'
    )
    assert by_type["schema_generation"]["json_example"] == '{"name": "N", "age": 3, "city": "C"}'
    assert (
        by_type["tool_call_args"]["json_example"]
        == '{"function": "weather", "arguments": {"city": "C", "date": "today"}}'
    )


def test_row_numbers_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select((5000 - F.col("id")).alias("k"))
    rows = prep.with_idx(df, "k").orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(5000))
    assert [r["k"] for r in rows] == list(range(1, 5001))


def test_shuffle_is_a_stable_permutation(spark):
    a = prep.shuffled(spark.range(3000).repartition(3), "id").orderBy("idx").collect()
    b = prep.shuffled(spark.range(3000).repartition(11), "id").orderBy("idx").collect()
    assert a == b and [r["idx"] for r in a] == list(range(3000))
    assert [r["id"] for r in a] != list(range(3000))
    assert prep.shuffled(spark.range(3000), "id", seed=7).orderBy("idx").collect() != a


@pytest.mark.parametrize("n, fraction, train", [(1000, 0.95, 950), (7, 0.5, 3), (1, 0.95, 0), (9, 1.0, 9), (0, 0.9, 0)])
def test_fraction_is_exact(spark, n, fraction, train):
    df = prep.split_fraction(spark.range(n), "id", fraction)
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {k: v for k, v in (("train", train), ("eval", n - train)) if v}
    # The train side is the head of the shuffled order.
    order = prep.shuffled(spark.range(n), "id")
    early = {r["id"] for r in order.filter(F.col("idx") < train).collect()}
    assert {r["id"] for r in df.filter(F.col("split") == "train").collect()} == early


def test_fraction_by_hash_is_close(spark):
    df = prep.split_fraction(spark.range(20000), "id", 0.9, exact=False)
    assert abs(df.filter(F.col("split") == "train").count() / 20000 - 0.9) < 0.01


@pytest.mark.parametrize("n, sides", [(300, (100, 80)), (150, (100, 50)), (60, (59, 1)), (0, (0, 0))])
def test_caps(spark, n, sides):
    df = spark.range(n).select("id", F.col("id").cast("string").alias("instruction"), F.lit("").alias("input"))
    for by in ("position", "content"):
        split = prep.split_capped(df, "id", 100, 80, by=by)
        counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
        assert (counts.get("eval", 0), counts.get("train", 0)) == sides


def test_without_a_cap_all_rows_stay_and_one_row_is_an_error(spark):
    df = spark.range(300).select("id", F.col("id").cast("string").alias("instruction"), F.lit("").alias("input"))
    for by in ("position", "content"):
        counts = {r["split"]: r["count"] for r in prep.split_capped(df, "id", 100, by=by).groupBy("split").count().collect()}
        assert counts == {"eval": 100, "train": 200}
        with pytest.raises(Exception, match="at least two rows"):
            prep.split_capped(df.filter("id = 1"), "id", 100, 80, by=by).collect()


def test_content_split_keeps_hot_copies_together(spark):
    """A third of all rows is one content; the split by content stays free of leaks."""
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(600).select("id", hot.alias("instruction"), F.lit("").alias("input"))
    leaky = prep.split_capped(df, "id", 200, 300, by="position")
    safe = prep.split_capped(df, "id", 200, 300, by="content")
    assert prep.split_overlap(leaky, "instruction", "input").first()["n_overlap"] > 0
    assert prep.split_overlap(safe, "instruction", "input").first()["n_overlap"] == 0
    contents = safe.groupBy("split").agg(F.count_distinct("instruction").alias("n")).collect()
    # 401 contents: the hot one and 400 others.
    assert {r["split"]: r["n"] for r in contents} == {"eval": 200, "train": 201}


def test_head_and_batches(spark):
    df = spark.range(40).withColumnRenamed("id", "idx")
    assert prep.head(df, 3).count() == 3 and prep.head(df, -1).count() == 0
    sizes = prep.with_batch_id(df, 16).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in sizes] == [16, 16, 8]


def test_swap_halves_and_can_be_off(spark):
    pairs = spark.range(4000).withColumnRenamed("id", "idx")
    on = prep.assign_swap(pairs).filter("swapped").count()
    assert abs(on / 4000 - 0.5) < 0.05
    assert prep.assign_swap(pairs, enabled=False).filter("swapped").count() == 0


def test_teacher_records_keep_key_order(spark):
    df = spark.createDataFrame(
        [('```json\n{"b":1,"a":[1,2,],"c":"x, y: z"}\n```',)], "text string"
    ).select(
        "text",
        F.lit("i").alias("instruction"),
        F.lit(None).cast("string").alias("input"),
        F.lit(None).cast("string").alias("task_type"),
    )
    row = prep.teacher_records(df).first()
    assert row["output"] == '{"b": 1, "a": [1, 2], "c": "x, y: z"}'
    assert row["task_type"] == "unknown" and row["input"] == ""


def test_pool_in_one_pass_equals_the_families(spark):
    seeds = spark.createDataFrame(
        [("json_extraction", "A", 'B"q', "C", "2024-01-01", None, None), ("tool_call_args", None, None, None, "today", None, "Oslo"),
         ("other", None, None, None, None, None, None)],
        "task_type string, first string, second string, location string, date string, name string, city string",
    )
    one = prep.pool_from(seeds, copies=1).drop("copy_no")
    each = prep.build_pool(
        {t: seeds.filter(F.col("task_type") == t).drop("task_type") for t in ("json_extraction", "tool_call_args")}, copies=1
    ).drop("copy_no")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, each.collect()))


def test_row_numbers_run_no_job_before_they_are_asked_for(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("x").alias("v"))
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup())
    numbered = prep.with_idx(df, "k")
    assert set(tracker.getJobIdsForGroup()) == before
    rows = sorted((r["k"], r["idx"]) for r in numbered.collect())
    assert [i for _, i in rows] == list(range(5000))
    assert prep.with_idx(df.filter("k < 0"), "k").collect() == []


def test_answers_nested_beyond_the_reader_stay_as_they_are(spark):
    deep = "[" * 200_000 + "]" * 200_000
    rows = [(0, "p", None, deep, "t"), (1, "p", None, '{"a":1,"a":{"b":"caf\\u00e9"}}', None)]
    df = spark.createDataFrame(rows, "idx int, instruction string, input string, text string, task_type string")
    found = {r["idx"]: r["output"] for r in prep.teacher_records(df).collect()}
    assert found == {0: deep, 1: '{"a": {"b": "café"}}'}
