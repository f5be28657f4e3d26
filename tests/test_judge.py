import pytest
from pyspark.sql import functions as F

from evalspark import schemas
from evalspark.operators import compare, forgetting, judge, jsoneval

LABELS = ("c0", "c1", "c2")


def judgements(spark, rows):
    """Rows of (label a, label b, winner, scores a, scores b)."""
    data = [
        (str(i), a, b, sa, sb, w, "", False) for i, (a, b, w, sa, sb) in enumerate(rows)
    ]
    return spark.createDataFrame(data, schemas.PAIR_JUDGEMENTS).withColumn(
        "idx", F.col("prompt_id").cast("bigint")
    )


def votes(a, b, wins_a, wins_b, ties):
    return [(a, b, w, {}, {}) for w, n in (("A", wins_a), ("b", wins_b), ("Tie", ties)) for _ in range(n)]


# Published tallies: pair counts that add up to the totals per label, and their rates.
def test_published_rates(spark):
    # 0 against 1: 199 votes; 1 against 2: 200 votes.
    rows = votes("c0", "c1", 82, 47, 70) + votes("c1", "c2", 41, 41, 118)
    stats = judge.judge_stats(judgements(spark, rows), LABELS)
    found = {r["checkpoint"]: r for r in stats.collect()}
    tallies = {k: (r["total_compares"], r["ties"], r["wins"], r["losses"]) for k, r in found.items()}
    assert tallies == {
        "c0": (199, 70, 82, 47),
        "c1": (399, 188, 88, 123),
        "c2": (200, 118, 41, 41),
    }
    assert found["c0"]["win_rate"] == pytest.approx(0.6356589147286822)
    assert found["c0"]["tie_rate"] == pytest.approx(0.35175879396984927)
    assert found["c1"]["win_rate"] == pytest.approx(0.41706161137440756)
    assert found["c1"]["tie_rate"] == pytest.approx(0.47117794486215536)
    assert found["c2"]["win_rate"] == 0.5 and found["c2"]["tie_rate"] == pytest.approx(0.59)


def test_unknown_winners_and_labels(spark):
    rows = [
        ("c0", "c1", "A", {"clarity": 4.0}, {"clarity": None}),
        ("c0", "c1", "unclear", {"clarity": 2.0}, {}),
        ("c0", "other", "A", {"clarity": 5.0}, {}),
        (None, "c1", "b", {}, {}),
        ("", "c1", "b", {}, {}),
        ("c0", "c1", None, {}, {"clarity": 3.0}),
    ]
    found = {r["checkpoint"]: r for r in judge.judge_stats(judgements(spark, rows), LABELS).collect()}
    c0, c1, c2 = (found[k] for k in LABELS)
    assert (c0["wins"], c0["losses"], c0["ties"], c0["total_compares"]) == (1, 0, 0, 3)
    assert (c1["wins"], c1["losses"], c1["total_compares"]) == (0, 1, 3)
    assert c0["avg_clarity"] == 2.0 and c1["avg_clarity"] == 1.0
    assert (c2["total_compares"], c2["win_rate"], c2["avg_clarity"]) == (0, 0.0, 0.0)
    summary = judge.judge_summary(judge.judge_stats(judgements(spark, rows), LABELS)).collect()
    assert [r["checkpoint"] for r in summary] == list(LABELS)


def test_swapping_changes_no_tally(spark):
    rows = votes("c0", "c1", 5, 3, 2)
    turned = [(b, a, {"A": "b", "b": "A"}.get(w, w), sb, sa) for a, b, w, sa, sb in rows]
    plain = judge.judge_stats(judgements(spark, rows), LABELS).orderBy("position").collect()
    swapped = judge.judge_stats(judgements(spark, turned), LABELS).orderBy("position").collect()
    assert plain == swapped
    assert sum(r["wins"] for r in plain) == sum(r["losses"] for r in plain)


def test_plan_pairs_what_both_have(spark):
    preds = spark.createDataFrame(
        [(0, "c0", "i", "", "p0"), (0, "c1", "i", "", "p1"), (0, "c2", "i", "", "p2"),
         (1, "c0", "j", "", "q0"), (1, "c2", "j", "", "q2"), (2, "c1", "k", "", "r1")],
        "id bigint, checkpoint string, instruction string, input string, prediction string",
    )
    plan = judge.comparison_plan(preds, LABELS).collect()
    assert sorted((r["idx"], r["checkpoint_a"], r["checkpoint_b"], r["response_a"], r["response_b"]) for r in plan) == [
        (0, "c0", "c1", "p0", "p1"),
        (0, "c0", "c2", "p0", "p2"),
        (0, "c1", "c2", "p1", "p2"),
        (1, "c0", "c2", "q0", "q2"),
    ]
    swapped = judge.apply_swap(judge.comparison_plan(preds, LABELS).withColumn("swapped", F.lit(True)))
    first = swapped.filter("idx = 1").first()
    assert (first["checkpoint_a"], first["response_a"], first["response_b"]) == ("c2", "q2", "q0")


def predictions(spark, instructions, labels=("c1", "c2")):
    data = [
        (i, label, text, "", f"{label}:{i}") for i, text in enumerate(instructions) for label in labels
    ]
    return spark.createDataFrame(
        data, "id bigint, checkpoint string, instruction string, input string, prediction string"
    )


# Published category breakdown: first wins, second wins, ties, total.
BREAKDOWN = {
    "open_ended": ("x", 25, 46, 88),
    "rewriting": ("rewrite it", 3, 0, 7),
    "qa": ("a question", 6, 5, 13),
    "brainstorming": ("ideas", 1, 1, 2),
    "summarization": ("summary", 3, 0, 0),
}


def test_published_breakdown(spark):
    rows, instructions = [], []
    for text, wins1, wins2, ties in BREAKDOWN.values():
        rows += votes("c1", "c2", wins1, wins2, ties)
        instructions += [text] * (wins1 + wins2 + ties)
    judged, preds = judgements(spark, rows), predictions(spark, instructions)
    found = forgetting.category_breakdown(judged, preds, "c1", "c2").collect()
    assert {r["category"]: (r["ckpt1_wins"], r["ckpt2_wins"], r["ties"]) for r in found} == {
        k: v[1:] for k, v in BREAKDOWN.items()
    }
    assert sum(r["total"] for r in found) == 200
    overall = forgetting.head_to_head(judged, "c1", "c2").first()
    assert (overall["ckpt1_wins"], overall["ckpt2_wins"], overall["ties"]) == (38, 52, 110)
    assert overall["ckpt1_win_rate"] == pytest.approx(0.19)


def test_head_to_head_and_examples(spark):
    rows = [
        ("c1", "c2", "unclear", {}, {}),
        ("c2", "c1", "A", {}, {}),
        ("c1", None, "A", {}, {}),
        ("c1", "c2", "a", {}, {}),
        ("c1", "c2", "TIES", {}, {}),
        ("c9", "c2", "a", {}, {}),
    ]
    judged = judgements(spark, rows)
    preds = predictions(spark, ["do"] * 6).filter("NOT (id = 2 AND checkpoint = 'c2')")
    labelled = forgetting.head_to_head(judged, "c1", "c2").first()
    assert (labelled["total_pairs"], labelled["ckpt1_wins"], labelled["ckpt2_wins"], labelled["ties"]) == (6, 1, 1, 1)
    blind = forgetting.head_to_head(judged, "c1", "c2", positional=True).first()
    assert (blind["ckpt1_wins"], blind["ckpt2_wins"], blind["ties"]) == (4, 0, 2)
    # Here a win counts with one label missing, and all else is a tie.
    category = forgetting.category_breakdown(judged, preds, "c1", "c2").first()
    assert (category["ckpt1_wins"], category["ckpt2_wins"], category["ties"], category["total"]) == (2, 1, 3, 6)
    examples = {r["kind"]: r for r in forgetting.exemplars(judged, preds, "c1", "c2").collect()}
    assert examples["regression"]["idx"] == 3 and examples["improvement"]["idx"] == 1
    assert examples["improvement"]["prediction_ckpt1"] == "c1:1"

    metrics = spark.createDataFrame(
        [("c1", 0.25, 0.5), ("c2", 0.5, None)],
        "checkpoint string, rougeL_f1 double, bertscore_f1_avg double",
    )
    summary = forgetting.forgetting_summary(judged, preds, metrics, "c1", "c2", {"m": "p"}).first()
    assert (summary["total_pairs"], summary["ckpt1_wins"], summary["ties"]) == (6, 1, 1)
    assert summary["delta_rougeL_f1_ckpt2_minus_ckpt1"] == 0.25
    assert summary["delta_bertscore_f1_ckpt2_minus_ckpt1"] == -0.5
    assert summary["category_breakdown"]["open_ended"]["total"] == 6
    assert summary["representative_regression_example"]["idx"] == 3
    assert summary["available_metrics_files"] == {"m": "p"}


def test_no_judgements_still_make_a_summary(spark):
    empty = judgements(spark, [("c1", "c2", "a", {}, {})]).filter("false")
    metrics = spark.createDataFrame([], "checkpoint string, rougeL_f1 double, bertscore_f1_avg double")
    summary = forgetting.forgetting_summary(empty, predictions(spark, ["x"]), metrics, "c1", "c2").first()
    assert (summary["total_pairs"], summary["tie_rate"], summary["rougeL_f1_ckpt1"]) == (0, 0.0, 0.0)
    assert summary["representative_regression_example"] is None


def test_comparison_keeps_order_and_blanks(spark):
    labels = judge.label_frame(spark, ("z", "a"))
    stats = spark.createDataFrame([("a", 0.5)], "checkpoint string, win_rate double")
    texts = spark.createDataFrame([("z", 0.1, 0.2)], "checkpoint string, rougeL_f1 double, bertscore_f1_avg double")
    jsons = spark.createDataFrame(
        [("a", 1.0, 0.5, 0.25)],
        "checkpoint string, json_validity_rate double, schema_compliance_rate double, exact_match_rate double",
    )
    rows = compare.checkpoint_comparison(labels, stats, texts, jsons).collect()
    assert [tuple(r) for r in rows] == [
        ("z", None, 0.1, 0.2, None, None, None),
        ("a", 0.5, None, None, 1.0, 0.5, 0.25),
    ]


def test_published_json_rates(spark):
    """35 of 100 answers as asked, the others with another key."""
    good, bad = '{"name":"x"}', '{"title":"x"}'
    rows = [("c0", good if i < 35 else bad, good) for i in range(100)]
    rows += [("c1", "{", "not json"), ("c1", None, good)]
    preds = spark.createDataFrame(rows, "checkpoint string, prediction string, reference string")
    scored = jsoneval.score_json(preds)
    metrics = {r["checkpoint"]: r for r in jsoneval.json_metrics(scored).collect()}
    assert metrics["c0"]["json_validity_rate"] == 1.0
    assert metrics["c0"]["schema_compliance_rate"] == metrics["c0"]["exact_match_rate"] == 0.35
    assert metrics["c0"]["error_taxonomy_counts"] == {"key_mismatch": 65, "exact_mismatch": 65}
    # A bad reference stops its row but stays in the total.
    assert metrics["c1"]["total"] == 2 and metrics["c1"]["json_validity_rate"] == 0.0
    taxonomy = {(r["checkpoint"], r["category"]): r["count"] for r in jsoneval.error_taxonomy(scored).collect()}
    assert taxonomy == {
        ("c0", "key_mismatch"): 65,
        ("c0", "exact_mismatch"): 65,
        ("c1", "reference_parse_failed"): 1,
        ("c1", "invalid_json"): 1,
    }


def test_two_outputs_of_one_checkpoint_are_an_error(spark):
    rows = [(0, "c0", "i", "", "p"), (0, "c0", "i", "", "zzz"), (0, "c1", "i", "", "q")]
    preds = spark.createDataFrame(
        rows, "id bigint, checkpoint string, instruction string, input string, prediction string"
    )
    with pytest.raises(Exception, match="two outputs"):
        judge.comparison_plan(preds, LABELS).collect()
    judged = spark.createDataFrame([(0, "A", "c0", "c1")], "idx bigint, winner string, checkpoint_a string, checkpoint_b string")
    with pytest.raises(Exception, match="two outputs"):
        forgetting.exemplars(judged, preds, "c0", "c1").collect()


def test_a_swap_the_model_wrote_is_kept_apart(spark):
    verdicts = spark.createDataFrame(
        [(1, "c0", "c1", None, None, None, True), (2, "c0", "c1", "own", "x", "y", None)],
        "idx bigint, first string, second string, prompt_id string, checkpoint_a string, checkpoint_b string, swapped boolean",
    )
    plan = spark.createDataFrame([(1, "c0", "c1", False), (2, "c0", "c1", True)], "idx bigint, first string, second string, swapped boolean")
    for trust, want in ((False, {1: False, 2: True}), (True, {1: True, 2: True})):
        done = judge.complete_judgements(verdicts, plan, trust_model_labels=trust)
        assert {r["idx"]: r["swapped"] for r in done.collect()} == want
        assert done.columns.count("swapped") == 1 and "raw_swapped" in done.columns


def test_statistics_without_judge_files_are_blank(spark):
    rows = judge.absent_stats(spark, LABELS).collect()
    assert len(rows) == len(LABELS) and all(r["win_rate"] is None and r["wins"] == 0 for r in rows)


def test_metrics_of_labels_without_rows_are_zero(spark):
    preds = spark.createDataFrame(
        [("c0", '{"a":1}', "null"), ("c0", "null", '{"a":1}'), ("c9", "{}", "{}")],
        "checkpoint string, prediction string, reference string",
    )
    scored = jsoneval.score_json(preds)
    found = {r["checkpoint"]: r for r in jsoneval.json_metrics(scored, ("c0", "c1")).collect()}
    assert set(found) == {"c0", "c1"}
    assert found["c0"]["error_taxonomy_counts"] == {"reference_parse_failed": 1, "not_object": 1}
    assert (found["c1"]["total"], found["c1"]["json_validity_rate"], found["c1"]["error_taxonomy_counts"]) == (0, 0.0, {})
