import bisect
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.functions import tokens as tok
from evalspark.functions.stem import porter_stem
from evalspark.operators import textmetrics

# Examples of the algorithm's published description, and of its extensions.
STEMS = """caresses caress ponies poni ties tie cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop
tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit
conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac
adjustment adjust dependent depend adoption adopt homologou homolog communism commun
activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll
skies sky dying die dies die cried cri died die flies fli enjoy enjoy news news
succeed succeed""".split()


def test_stems():
    for word, stem in zip(STEMS[::2], STEMS[1::2]):
        assert porter_stem(word) == stem, word


TEXTS = [
    ("The cats were running, running fast!", "a cat ran; the cats are running"),
    ("same words here", "same words here"),
    ("a b c a b c a", "a a a b"),
    ("", "nothing"),
    ("été à la plage", "l'été à la plage"),
    (None, None),
    ("x " * 300, "x y " * 200),
]


def _tokens(t, stem):
    words = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in (t or "").lower())
    return [porter_stem(w) if stem and len(w) > 3 else w for w in words.split()]


def _f(overlap, c, r):
    p, q = (overlap / c if c else 0.0), (overlap / r if r else 0.0)
    return 2 * p * q / (p + q) if p + q else 0.0


def _ngram_f(c, r, n):
    grams = [Counter(zip(*(x[i:] for i in range(n)))) for x in (c, r)]
    return _f(sum((grams[0] & grams[1]).values()), sum(grams[0].values()), sum(grams[1].values()))


def _lcs(c, r):
    row = [0] * (len(r) + 1)
    for x in c:
        new = [0]
        for j, y in enumerate(r):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("stem", [True, False])
def test_rouge_against_counting(spark, stem):
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(TEXTS)], "i int, prediction string, reference string"
    ).repartition(2)
    found = {r["i"]: r for r in textmetrics.rouge(df, use_stemmer=stem).collect()}
    for i, (a, b) in enumerate(TEXTS):
        c, r = _tokens(a, stem), _tokens(b, stem)
        assert found[i]["rouge1_f1"] == pytest.approx(_ngram_f(c, r, 1))
        assert found[i]["rouge2_f1"] == pytest.approx(_ngram_f(c, r, 2))
        assert found[i]["rougeL_f1"] == pytest.approx(_f(_lcs(c, r), len(c), len(r)))
    one = {r["i"]: r for r in textmetrics.rouge_n(df, 2, stem).collect()}
    long = {r["i"]: r for r in textmetrics.rouge_l(df, stem).collect()}
    for i in found:
        assert one[i]["rouge2_f1"] == found[i]["rouge2_f1"]
        assert long[i]["rougeL_f1"] == found[i]["rougeL_f1"]


def test_lcs_as_fold(spark):
    """The bit-parallel length equals a fold of the usual recurrence in SQL."""
    rng = np.random.default_rng(7)
    rows = [
        (i, [str(x) for x in rng.integers(0, 4, rng.integers(0, 30))],
         [str(x) for x in rng.integers(0, 4, rng.integers(0, 30))])
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "i int, c array<string>, r array<string>")

    def row_step(row, x):
        def cell(new, y_place):
            y, j = y_place["y"], y_place["j"]
            best = F.when(x == y, F.get(row, j) + 1).otherwise(
                F.greatest(F.get(row, j + 1), F.element_at(new, -1))
            )
            return F.concat(new, F.array(best))

        places = F.transform("r", lambda y, j: F.struct(y.alias("y"), j.alias("j")))
        return F.aggregate(places, F.array(F.lit(0)), cell)

    zeros = F.array_repeat(F.lit(0), F.size("r") + 1)
    fold = F.element_at(F.aggregate("c", zeros, row_step), -1)
    found = df.select(fold.alias("a"), tok.lcs_length(F.col("c"), F.col("r")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in found)


@pytest.mark.parametrize("block", [1, 3, 512])
def test_embedding_match_in_any_blocks(spark, block):
    rng = np.random.default_rng(3)
    rows, expected = [], {}
    for row_id, (m, n) in enumerate([(4, 7), (1, 1), (9, 2)]):
        c, r = rng.normal(size=(m, 5)), rng.normal(size=(n, 5))
        rows += [("k", row_id, "candidate", i, [float(x) for x in v]) for i, v in enumerate(c)]
        rows += [("k", row_id, "reference", i, [float(x) for x in v]) for i, v in enumerate(r)]
        unit = [x.astype("float32").astype("float64") for x in (c, r)]
        s = np.array([[a @ b / np.linalg.norm(a) / np.linalg.norm(b) for b in unit[1]] for a in unit[0]])
        p, q = s.max(axis=1).mean(), s.max(axis=0).mean()
        expected[row_id] = (p, q, 2 * p * q / (p + q))
    rows.append(("k", 9, "candidate", 0, [1.0] * 5))
    expected[9] = (0.0, 0.0, 0.0)
    df = spark.createDataFrame(
        rows, "checkpoint string, row_id bigint, side string, pos int, vector array<float>"
    )
    found = {r["row_id"]: r for r in textmetrics.embedding_f1(df, block).collect()}
    assert set(found) == set(expected)
    for row_id, values in expected.items():
        got = found[row_id]
        assert (got["precision"], got["recall"], got["f1"]) == pytest.approx(values)


def test_text_metrics_skip_absent_checkpoints(spark):
    df = spark.createDataFrame(
        [("c0", "one two three four five six", "one two"), ("c0", "", "x")],
        "checkpoint string, prediction string, reference string",
    )
    rows = textmetrics.text_metrics(df).collect()
    assert [(r["checkpoint"], r["samples"], r["avg_output_tokens"]) for r in rows] == [("c0", 2, 3.0)]
    assert rows[0]["task_completion_rate"] == 0.5 and rows[0]["bertscore_f1_avg"] is None


def test_long_rows_are_matched_in_several_tasks(spark):
    """A row of 2,400 tokens in blocks of 64 meets its other side under 16 keys, without an outer join."""
    rng = np.random.default_rng(2)
    sides = {"candidate": rng.normal(size=(2400, 4)), "reference": rng.normal(size=(300, 4))}
    rows = [("c", 1, s, i, [float(x) for x in v]) for s, m in sides.items() for i, v in enumerate(m)]
    rows.append(("c", 2, "candidate", 0, [1.0, 0.0, 0.0, 0.0]))
    df = spark.createDataFrame(rows, "checkpoint string, row_id bigint, side string, pos int, vector array<float>")
    scored = textmetrics.embedding_f1(df, block=64)
    plan = scored._jdf.queryExecution().toString()
    assert "FullOuter" not in plan
    found = {r["row_id"]: r for r in scored.collect()}
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (sides["candidate"].astype("f4").astype(float), sides["reference"].astype("f4").astype(float))]
    cosines = unit[0] @ unit[1].T
    assert abs(found[1]["precision"] - cosines.max(axis=1).mean()) < 1e-6
    assert abs(found[1]["recall"] - cosines.max(axis=0).mean()) < 1e-6
    assert (found[2]["precision"], found[2]["f1"]) == (0.0, 0.0)


def test_lcs_blocks_do_not_change_the_length():
    rng = random.Random(6)
    for _ in range(300):
        letters = range(rng.choice([2, 5, 30]))
        a, b = (rng.choices(letters, k=rng.randrange(60)) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            left = 0
            for j, y in enumerate(b, 1):
                left, row[j] = row[j], left + 1 if x == y else max(row[j], row[j - 1])
        assert {tok._lcs(a, b, block) for block in (1, 7, 4096)} == {row[-1]}


def test_lcs_of_long_texts_in_little_memory():
    rng = random.Random(7)
    a = list(range(30_000))
    b = rng.sample(a, len(a))
    tracemalloc.start()
    found = tok._lcs(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15e6
    piles = []  # patience: the longest increasing run
    for x in b:
        k = bisect.bisect_left(piles, x)
        piles[k : k + 1] = [x]
    assert found == len(piles)
