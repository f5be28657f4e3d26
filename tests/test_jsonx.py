import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from evalspark.functions import jsonx

# text, the part read as JSON, its value (None: not JSON)
PARSED = [
    ('{"a":1}', '{"a":1}', '{"a":1}'),
    ('  {"a":1}\n', '{"a":1}', '{"a":1}'),
    ('{"a":1} {"b":2}', '{"b":2}', '{"b":2}'),
    ('[{"a":1},{"b":2}]', '{"b":2}', '{"b":2}'),
    ('{"a":"}{}"}', "{}", "{}"),
    ('{ foo {"a":1}', '{ foo {"a":1}', None),
    ('```json\n{"a":1,}\n```\n', '{"a":1}', '{"a":1}'),
    ('```\n[1, 2]\n```', "[1, 2]", "[1,2]"),
    ('<think>{"x":1}</think> {"y":2}', '{"y":2}', '{"y":2}'),
    ('<think> {"x":1} {"y":2', '{"x":1}', '{"x":1}'),
    ("reasons</THINK>  [1,2,]", "[1,2]", "[1,2]"),
    ("< thinking >a</ thinking >b< redacted_reasoning >c</redacted_reasoning> 7", "b 7", None),
    ("<<think>think> a {\"q\":1}", '{"q":1}', '{"q":1}'),
    ('{"a":["x","y"],"b":', '["x","y"]', '["x","y"]'),
    ("Sure: [1, 2] done", "[1, 2]", "[1,2]"),
    ('text {"k":[1,2,],} text', '{"k":[1,2]}', '{"k":[1,2]}'),
    ('{"a":1} x } {"d":4} {', '{"d":4}', '{"d":4}'),
    ('{"a":"{"} }', '{"a":"{"} }', None),
    ('{"bad": } {"a":1} {bad}', '{"a":1}', '{"a":1}'),
    ("12", "12", "12"),
    ("12 apples", "12 apples", None),
    ("[1] [2]", "[1] [2]", None),
    ("1] [2", "1] [2", None),
    ('"x" "y"', '"x" "y"', None),
    ("1,2", "1,2", None),
    ("null", "null", "null"),
    ("true", "true", "true"),
    ("", "", None),
    (None, "", None),
    ("{'a':1}", "{'a':1}", None),
    ('{"a":1,"a":2}', '{"a":1,"a":2}', '{"a":2}'),
    ("  {\"a\":1}\x1c", '{"a":1}', '{"a":1}'),
]


def test_json_text_and_value(column):
    texts = [t for t, _, _ in PARSED]
    assert column(texts, jsonx.json_text) == [x for _, x, _ in PARSED]
    assert column(texts, lambda c: F.to_json(jsonx.parse_json(c))) == [x for _, _, x in PARSED]
    assert column(texts, jsonx.is_valid) == [x is not None for _, _, x in PARSED]


def test_number_words_and_wide_numbers_are_json(column):
    texts = ['{"a":NaN}', '{"a":-Infinity}', "1e400", "1" * 60, '{"a":01}', '{"a":+1}', '{"a":.5}']
    assert column(texts, jsonx.is_valid) == [True, True, True, True, False, False, False]


def test_long_texts_need_no_stack(column):
    deep = "{" * 300 + "}" * 300
    wide = "x{}" * 3000
    quoted = json.dumps({"a": 'say \\ "hi" ' * 20000})
    spans = column([deep, wide], lambda c: F.size(jsonx.object_spans(c)))
    assert spans == [1, 3000]
    assert column([quoted], lambda c: F.to_json(jsonx.parse_strict(c))) == [json.dumps(json.loads(quoted), separators=(",", ":"))]


def _spans(text):
    """Character by character: where depth returns to zero, a span ends."""
    found, depth, start = [], 0, 0
    for i, c in enumerate(text):
        if c == "{":
            start = i if depth == 0 else start
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                found.append(text[start : i + 1])
    return found


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet='{}"[],:a1 \\\né', max_size=40), min_size=30, max_size=60))
def test_spans_equal_character_scan(column, texts):
    assert column(texts, jsonx.object_spans) == [_spans(t) for t in texts]


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.dictionaries(
            st.text(alphabet="abc\"\\ é", max_size=4),
            st.recursive(
                st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet="xy\"\\é", max_size=5),
                lambda x: st.lists(x, max_size=3)
                | st.dictionaries(st.text(alphabet="kl", max_size=2), x, max_size=2),
                max_leaves=6,
            ),
            max_size=4,
        ),
        min_size=20,
        max_size=40,
    )
)
def test_valid_objects_survive(column, values):
    texts = [json.dumps(v, ensure_ascii=False) for v in values]
    shown = column(texts, lambda c: F.to_json(jsonx.parse_strict(c)))
    assert [json.loads(x) for x in shown] == values
    fenced = [f"```json\n{t}\n```" for t in texts]
    assert column(fenced, lambda c: jsonx.strip_fences(c)) == texts


def _pairs(spark, pairs, build):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    parsed = df.repartition(1).select(
        "i", jsonx.parse_strict(F.col("a")).alias("a"), jsonx.parse_strict(F.col("b")).alias("b")
    )
    rows = parsed.select("i", build(F.col("a"), F.col("b")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


# candidate, reference, reason, missing, extra, wrong
COMPLIANCE = [
    ('{"a":1}', '{"a":2.5}', None, [], [], []),
    ('{"a":true}', '{"a":1}', "wrong_types", [], [], ["a"]),
    ('{"a":null}', '{"a":null}', None, [], [], []),
    ('{"a":null}', '{"a":"x"}', "wrong_types", [], [], ["a"]),
    ('{"a":[1,2]}', '{"a":["x"]}', "wrong_types", [], [], ["a"]),
    ('{"a":[1,"x"]}', '{"a":["x"]}', None, [], [], []),
    ('{"a":[]}', '{"a":["x"]}', None, [], [], []),
    ('{"a":["x"]}', '{"a":[]}', None, [], [], []),
    ('{"a":"x"}', '{"a":[]}', "wrong_types", [], [], ["a"]),
    ('{"a":[true]}', '{"a":[1.5]}', None, [], [], []),
    ('{"a":[null]}', '{"a":[1.5]}', "wrong_types", [], [], ["a"]),
    ('{"a":{"y":1}}', '{"a":{"x":[]}}', None, [], [], []),
    ('{"c":1,"b":1}', '{"a":1,"b":1,"0":1}', "key_mismatch", ["0", "a"], ["c"], []),
    ('{"b":"1","a":"1"}', '{"a":1,"b":1}', "wrong_types", [], [], ["a", "b"]),
    ("[1]", '{"a":1}', "non_object", [], [], []),
    ('{"a":1}', "[1]", "non_object", [], [], []),
    ("{}", "{}", None, [], [], []),
]


def test_schema_compliance(spark):
    found = _pairs(spark, [(a, b) for a, b, *_ in COMPLIANCE], jsonx.schema_compliance)
    expected = [(r is None, r, m, e, w) for _, _, r, m, e, w in COMPLIANCE]
    assert [tuple(f) for f in found] == expected


# candidate, reference, equal as Python sees it, equal with booleans apart
EQUAL = [
    ('{"a":1,"b":2}', '{"b":2.0,"a":1}', True, True),
    ('{"a":[1,2]}', '{"a":[2,1]}', False, False),
    ('{"a":true}', '{"a":1}', True, False),
    ('{"a":false}', '{"a":0.0}', True, False),
    ('{"a":10000000}', '{"a":1e7}', True, True),
    ('{"a":0.1}', '{"a":1e-1}', True, True),
    ('{"a":-0}', '{"a":0}', True, True),
    ('{"a":"1"}', '{"a":1}', False, False),
    ('{"a":"1.0 true"}', '{"a":"1 true"}', False, False),
    ('{"a":{"x":[1,{"y":2.50}]}}', '{"a":{"x":[1.0,{"y":2.5}]}}', True, True),
    ('{"a":null}', '{"a":null}', True, True),
    ('{"a":null}', "{}", False, False),
    ('{"a":9007199254740993}', '{"a":9007199254740992}', False, False),
    ('{"a":"x\\ny"}', '{"a":"x\\u000ay"}', True, True),
    ('{"a":1e22}', '{"a":10000000000000000000000}', True, True),
    ('{"a":%s1}' % ("1" * 41), '{"a":%s2}' % ("1" * 41), False, False),
    ('{"a":NaN}', '{"a":"NaN"}', False, False),
    ('{"a":-1.50e-3,"n1":2}', '{"n1":2.0,"a":-0.0015}', True, True),
    ('{"a":"n1e0"}', '{"a":1}', False, False),
    ('{"a":1,"a":2}', '{"a":2.0}', True, True),
]


def test_deep_equality(spark):
    pairs = [(a, b) for a, b, _, _ in EQUAL]
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, a string, b string").repartition(1)
    a, b = F.col("a"), F.col("b")
    found = df.select(
        "i",
        jsonx.json_equal(a, b).alias("equal"),
        jsonx.json_equal(a, b, python_equality=False).alias("strict"),
    ).orderBy("i")
    assert [(r.equal, r.strict) for r in found.collect()] == [(x, y) for *_, x, y in EQUAL]


# candidate, reference, F1 per reference key
FIELDS = [
    ('{"a":"x","b":[1]}', '{"a":"x","b":[1]}', {"a": 1.0, "b": 1.0}),
    ('{"a":["x","y","y"]}', '{"a":["y","z"]}', {"a": 0.5}),
    ('{"a":["x","y","z"]}', '{"a":["x"]}', {"a": 0.5}),
    ('{"b":1}', '{"a":[]}', {"a": 1.0}),
    ('{"a":"x"}', '{"a":[]}', {"a": 1.0}),
    ('{"a":[]}', '{"a":[1]}', {"a": 0.0}),
    ('{"a":null}', '{"a":null}', {"a": 0.0}),
    ('{"a":[{"k":1,"j":2}]}', '{"a":[{"j":2,"k":1}]}', {"a": 1.0}),
    ('{"a":[null,1]}', '{"a":[null]}', {"a": 2 / 3}),
    ('{"a":1,"zz":0}', '{"a":1,"b":2}', {"a": 1.0, "b": 0.0}),
    ('{"a":1}', "{}", {}),
]


def test_field_f1(spark):
    found = _pairs(spark, [(a, b) for a, b, _ in FIELDS], jsonx.field_f1)
    for row, (_, _, expected) in zip(found, FIELDS):
        assert {k: round(v, 9) for k, v in row["per_field"].items()} == {
            k: round(v, 9) for k, v in expected.items()
        }
        mean = sum(expected.values()) / len(expected) if expected else 0.0
        assert abs(row["macro"] - mean) < 1e-9


def test_value_classes(column):
    texts = ["1", "1.0", "1e2", "12345678901234567890", '"x"', "true", "null", "[1]", '{"a":1}', "x"]
    classes = column(texts, lambda c: jsonx.value_class(jsonx.parse_strict(c)))
    assert classes == ["int", "float", "float", "int", "str", "bool", "null", "list", "dict", None]


def test_required_keys(column):
    texts = ['{"a":1,"b":"x"}', '{"a":true,"b":"x"}', '{"a":1.5,"b":"x"}', '{"b":"x"}', "[1]"]
    found = column(texts, lambda c: jsonx.has_keys(jsonx.parse_strict(c), {"a": "int", "b": "str"}))
    assert found == [True, True, False, False, False]


def test_extraction(column):
    texts = ['{"entities":1}', '{"location":1,"date":2}', '{"location":1}', "[1]", "x"]
    found = column(texts, lambda c: jsonx.is_extraction(jsonx.parse_strict(c)))
    assert found == [True, True, False, False, False]


def test_parse_object(column):
    texts = ['x {"a":1}', "[1,2]", '[ [] ]', "nothing", None]
    found = column(texts, jsonx.parse_object)
    assert [r["value"] is not None for r in found] == [True, False, False, False, False]
    assert found[1]["error"].startswith("expected JSON object, ok=true parsed_type=list preview=[1,2]")
    assert "parsed_type=n/a" in found[3]["error"]


def test_response_text(column):
    message = '{"choices":[{"message":%s}]}'
    texts = [
        message % '{"content":" hi "}',
        message % '{"content":[{"type":"text","text":"a "},{"type":"image"},"b",{"type":"text"}]}',
        message % '{"content":"  ","reasoning_content":" why "}',
        message % '{"content":null,"reasoning_content":"","refusal":"no"}',
        message % '{"content":[],"refusal":"no"}',
        message % "{}",
        '{"choices":[]}',
        "not json",
    ]
    assert column(texts, jsonx.response_text) == ["hi", "a b", "why", "no", "no", "", "", ""]


def test_many_objects_cost_as_much_each_as_few(spark):
    import time

    def seconds(n):
        df = spark.range(1).select(F.expr(f"repeat(' {{\"a\":1}}', {n})").alias("t"))
        start = time.perf_counter()
        row = df.select(jsonx.object_spans(F.col("t")).alias("s"), jsonx.json_text(F.col("t")).alias("j")).select(
            F.size("s").alias("n"), F.element_at("s", -1).alias("last"), "j"
        ).first()
        assert tuple(row) == (n, '{"a":1}', '{"a":1}')
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(100_000) / 100_000 < 2 * seconds(1000) / 1000
