from pyspark.sql import functions as F

from evalspark.functions import text


def test_strip_removes_unicode_space(column):
    texts = ["  a b ", " 　x\x1f\n", "​ x", "", None]
    assert column(texts, text.strip) == ["a b", "x", "​ x", "", None]


def test_prompts(spark):
    row = spark.createDataFrame([("do", None, "out")], "i string, x string, o string")
    i, x, o = F.col("i"), F.col("x"), F.col("o")
    found = row.select(
        text.training_text(i, F.lit("in"), o).alias("train"),
        text.generation_prompt(i, x).alias("plain"),
        text.chat_prompt(F.lit("  do "), F.lit(" it\n"), ("<u>", "</u>")).alias("chat"),
        text.chat_prompt(F.lit("do"), x, ("<u>", "</u>")).alias("short"),
    ).first()
    assert found["train"] == "Instruction: do\nInput: in\nResponse: out"
    assert found["plain"] == "Instruction: do\nInput: \nResponse: "
    assert found["chat"] == "<u>do\nit</u>"
    assert found["short"] == "<u>do</u>"


def test_fill_is_sequential_and_literal(spark):
    values = {"a": F.lit("$1 \\ __B__"), "b": F.lit("two")}
    found = spark.range(1).select(text.fill("__A__ and __B__", values).alias("t")).first()["t"]
    assert found == "$1 \\ two and two"
    backwards = dict(reversed(values.items()))
    found = spark.range(1).select(text.fill("__A__ and __B__", backwards).alias("t")).first()["t"]
    assert found == "$1 \\ __B__ and two"


def test_token_budget(column):
    found = column(["a b  c", "a", "", None], lambda c: text.token_budget(c, 2))
    assert [tuple(r) for r in found] == [
        (["a", "b"], 2, True),
        (["a"], 1, False),
        ([], 0, False),
        ([], 0, False),
    ]


def test_task_completed(column):
    long = "this answer is long enough"
    texts = [long, " " * 30 + "short", long + " SORRY", long + " {}", long + " I'm an AI", None, ""]
    assert column(texts, text.task_completed) == [True] + [False] * 6
    assert column(["abc"], lambda c: text.task_completed(c, 3)) == [True]


def test_categories(column):
    texts = [
        "Summarize and rewrite",
        "Please reword this",
        "Give ideas to answer",
        "Tell me what is wrong",
        "What is the mechanism of photosynthesis?",
        "questionable",
        None,
    ]
    assert column(texts, text.instruction_category) == [
        "summarization",
        "rewriting",
        "brainstorming",
        "qa",
        "open_ended",
        "qa",
        "open_ended",
    ]
