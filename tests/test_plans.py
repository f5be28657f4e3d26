"""What the plans of the heavier jobs must not do."""

import re

import pytest

from evalspark.operators import attempts, compare
from evalspark.workload import fixtures as fx, queries

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_first_and_preferred_records_are_not_aggregated(spark):
    events = fx.table(spark, SF_DIR, "events").select("user_id", "event_id", "props")
    first = compare.first_document(events, ["user_id"], "event_id")
    other = compare.first_document(events.filter("event_id > 10"), ["user_id"], "event_id")
    for df in (first, compare.prefer([other, first], ["user_id"])):
        assert "SortAggregate" not in plan(df) and "ObjectHashAggregate" not in plan(df)


@pytest.mark.parametrize("accept", [attempts.accept_attempts, attempts.accept_judge_attempts])
def test_answers_are_shuffled_once_and_not_sorted(spark, accept):
    found = plan(accept(fx.attempt_log(spark, SF_DIR)))
    assert "SortAggregate" not in found and "ObjectHashAggregate" not in found
    assert "ShuffledHashJoin" in found and not re.search(r"\bSort \[", found)
    assert found.count("ReusedExchange") == 1


def test_the_summary_counts_once(spark):
    found = plan(queries.QUERIES["forgetting_summary"](spark, SF_DIR))
    assert found.count("FileScan") <= 9 and len(re.findall(r"\bExchange ", found)) <= 17
    assert "ReusedSubquery" in found and "CartesianProduct" not in found
