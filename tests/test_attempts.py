from evalspark import schemas
from evalspark.operators import attempts

OK, BAD, LIST = '{"a":1}', "no json", "[1,2]"
API, ERR = ("api_error", None), ("error", None)


def log(spark, cases):
    rows = [
        (idx, n, call[0], call[1]) if isinstance(call, tuple) else (idx, n, "ok", call)
        for idx, calls in enumerate(cases)
        for n, call in enumerate(calls)
    ]
    return spark.createDataFrame(rows, schemas.ATTEMPT_LOG)


# Calls of a prompt, and the attempt that is accepted.
TEACHER = [
    ([OK], 0),
    ([API, API, OK], 2),
    ([API] * 4 + [OK], 4),
    ([API] * 5 + [OK], None),
    ([BAD, OK], 1),
    ([BAD, BAD, OK], None),
    ([BAD, API, OK], None),
    ([BAD, ERR, OK], None),
    ([ERR, OK], None),
    ([API, ERR, OK], None),
    ([API] * 4 + [BAD, OK], 5),
    ([API, BAD, LIST], 2),
    ([BAD], None),
    ([API], None),
]


def test_teacher_budgets(spark):
    found = attempts.accept_attempts(log(spark, [c for c, _ in TEACHER])).collect()
    assert {r["idx"]: r["attempt"] for r in found} == {
        i: a for i, (_, a) in enumerate(TEACHER) if a is not None
    }
    assert all(r["text"] in (OK, LIST) for r in found)


def test_more_invalid_retries(spark):
    found = attempts.accept_attempts(log(spark, [[BAD, BAD, OK], [BAD] * 4 + [OK]]), 4, 2).collect()
    assert [(r["idx"], r["attempt"]) for r in found] == [(0, 2)]


JUDGE = [
    ([OK], 0),
    ([LIST, "", BAD, OK], 3),
    ([BAD] * 4 + [OK], None),
    ([API, API, API, OK], 3),
    ([BAD, ERR, OK], None),
    ([OK, ERR], 0),
    (['[{"a":1}]'], 0),
    ([API], None),
]


def test_judge_budget(spark):
    found = attempts.accept_judge_attempts(log(spark, [c for c, _ in JUDGE])).collect()
    assert {r["idx"]: r["attempt"] for r in found} == {
        i: a for i, (_, a) in enumerate(JUDGE) if a is not None
    }


def test_pending(spark):
    accepted = attempts.accept_attempts(log(spark, [c for c, _ in TEACHER]))
    prompts = spark.range(len(TEACHER)).withColumnRenamed("id", "idx")
    found = {r["idx"] for r in attempts.pending(prompts, accepted).collect()}
    assert found == {i for i, (_, a) in enumerate(TEACHER) if a is None}


def test_assembly_fills_missing_output(spark):
    rows = spark.createDataFrame([(0, "i", "x", "o"), (1, "j", None, "p")], "idx bigint, instruction string, input string, output string")
    preds = spark.createDataFrame([(0, "answer")], "idx bigint, prediction string")
    found = attempts.assemble_predictions(rows, preds, "c0").orderBy("id").collect()
    assert [tuple(r) for r in found] == [
        (0, "c0", "i", "x", "", "answer", "o"),
        (1, "c0", "j", "", "", "", "p"),
    ]
