"""JSON found in free-form model output: extraction, comparison and scoring.

Texts are Columns of STRING, parsed values Columns of VARIANT. An invalid text
parses to NULL; the JSON literal ``null`` parses to a VARIANT that is not NULL.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions.text import or_empty, strip

# --- fixed values ---------------------------------------------------------
# Tag names whose content is reasoning, not answer.
REASONING_NAME = "(?:think|thinking|redacted_reasoning)"
# Fields read, in this order, when a chat message has no usable content.
MESSAGE_FALLBACK_FIELDS = ("reasoning_content", "refusal")
# --------------------------------------------------------------------------

# Whitespace as the text side knows it: Unicode spaces and the four separators.
_WS = r"[\s\x1c-\x1f]"
_OPEN = rf"<{_WS}*{REASONING_NAME}{_WS}*>"
_CLOSE = rf"<{_WS}*/{_WS}*{REASONING_NAME}{_WS}*>"

# A JSON string or any other token; possessive, so that long strings need no stack.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[^\s{}\[\],:"]++'

# Strict JSON, but for the three number words that Python's reader takes too.
_PARSE = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}
_END = "--end of text--"

# The value in front of the end marker, when the marker is in second place.
_WHOLE = f"""d -> CASE WHEN try_variant_get(d, '$[1]', 'string') = '{_END}'
    THEN try_variant_get(d, '$[0]', 'variant') END"""

# Type names of VARIANT values as value classes; all others are decimals.
_CLASS = r"""s -> coalesce(
    try_element_at(map('OBJECT', 'dict', 'ARRAY', 'list', 'STRING', 'str',
                       'BOOLEAN', 'bool', 'VOID', 'null', 'BIGINT', 'int'),
                   substring_index(s, '<', 1)),
    CASE WHEN s RLIKE r'^DECIMAL\((?:19|[23]\d),0\)$' THEN 'int'
         WHEN s IS NOT NULL THEN 'float' END)"""

# A text with one opening brace has its span end at the next closing one. Otherwise a
# fold over the pieces of the text cut after each brace: a piece that opens at depth 0
# starts a span, one that closes back to depth 0 ends it. A fold copies its state at every step, so no
# list grows along the text: pieces go in groups, a first fold finds the depth at which each
# group begins, and then every group lists its own spans, as places and numbers of pieces.
_GROUP = 64
_DEPTH = """CASE WHEN endswith(p, '{') THEN c.depth + 1
    WHEN endswith(p, '}') AND c.depth > 0 THEN c.depth - 1 ELSE c.depth END"""
_FIRST = "CASE WHEN endswith(p, '{') AND c.depth = 0 THEN c.at + 1 ELSE c.first END"
_PIECES = f"slice(pieces, int(g * {_GROUP} + 1), {_GROUP})"
_NO_STARTS = "cast(array() AS array<struct<depth: int, first: int>>)"
_NO_RUNS = "cast(array() AS array<struct<first: int, n: int>>)"
_STARTS = f"""aggregate(sequence(0, (size(pieces) - 1) div {_GROUP}),
    named_struct('depth', 0, 'first', 0, 'starts', {_NO_STARTS}),
    (s, g) -> aggregate({_PIECES},
        named_struct('at', int(g * {_GROUP}), 'depth', s.depth, 'first', s.first),
        (c, p) -> named_struct('at', c.at + 1, 'depth', {_DEPTH}, 'first', {_FIRST}),
        c -> named_struct('depth', c.depth, 'first', c.first, 'starts',
            concat(s.starts, array(named_struct('depth', s.depth, 'first', s.first))))),
    s -> s.starts)"""
_RUNS = f"""flatten(transform({_STARTS}, (start, g) -> aggregate({_PIECES},
    named_struct('at', int(g * {_GROUP}), 'depth', start.depth, 'first', start.first, 'runs', {_NO_RUNS}),
    (c, p) -> named_struct('at', c.at + 1, 'depth', {_DEPTH}, 'first', {_FIRST},
        'runs', CASE WHEN endswith(p, '}}') AND c.depth = 1
            THEN concat(c.runs, array(named_struct('first', c.first, 'n', c.at + 1 - c.first))) ELSE c.runs END),
    c -> c.runs)))"""
_SPANS = f"""t -> CASE
    WHEN locate('}}', t, instr(t, '{{') + 1) = 0 OR NOT contains(t, '{{')
        THEN cast(array() AS array<string>)
    WHEN locate('{{', t, instr(t, '{{') + 1) = 0
        THEN array(substr(t, instr(t, '{{'), locate('}}', t, instr(t, '{{')) - instr(t, '{{') + 1))
    ELSE transform(array(split(t, r'(?<=[{{}}])', -1)), pieces -> transform({_RUNS},
        x -> concat('{{', array_join(slice(pieces, x.first + 1, x.n), ''))))[0] END"""


# Texts with numbers that VARIANT does not keep as written: fractions, exponents, numbers
# past BIGINT, and the number words.
_EXACT_NUMBERS = r"\d[.eE]|\d{19}|NaN|Infinity"

# Sign, whole digits, fraction and exponent of a number token.
_NUMBER = r"^(-?)(\d+)(?:\.(\d+))?(?:[eE]([+-]?\d+))?$"
# Most numbers: their digits are the token itself, so nothing has to be extracted.
_WHOLE_NUMBER = r"^-?[1-9]\d*$"


def _plain_text(python_equality: bool) -> str:
    """SQL lambda over JSON text without exact numbers: booleans as numbers, no -0."""
    booleans = "WHEN 'true' THEN '1' WHEN 'false' THEN '0'" if python_equality else ""
    has_booleans = "OR contains(j, 'true') OR contains(j, 'false')" if python_equality else ""
    return rf"""j -> CASE WHEN contains(j, '-0') {has_booleans} THEN array_join(transform(
        regexp_extract_all(j, r'{_TOKEN}', 0),
        t -> CASE t {booleans} WHEN '-0' THEN '0' ELSE t END), '') ELSE j END"""


def _tagged_text(python_equality: bool) -> str:
    """SQL lambda over JSON text: numbers as texts of their sign, digits and exponent.

    Texts get an s in front and numbers an n, so no number equals a text.
    """
    digits = f"concat(regexp_extract(t, r'{_NUMBER}', 2), regexp_extract(t, r'{_NUMBER}', 3))"
    trimmed = f"rtrim('0', {digits})"
    exponent = (
        f"coalesce(try_cast(regexp_extract(t, r'{_NUMBER}', 4) AS bigint), 0)"
        f" - length(regexp_extract(t, r'{_NUMBER}', 3)) + length({digits}) - length({trimmed})"
    )
    booleans = """WHEN t = 'true' THEN '"n1e0"' WHEN t = 'false' THEN '"n0"'""" if python_equality else ""
    return rf"""j -> array_join(transform(regexp_extract_all(j, r'{_TOKEN}', 0),
        t -> CASE WHEN startswith(t, '"') THEN concat('"s', substr(t, 2))
            WHEN t IN ('{{', '}}', '[', ']', ',', ':') THEN t
            WHEN t RLIKE r'{_WHOLE_NUMBER}' THEN
                concat('"n', rtrim('0', t), 'e', length(t) - length(rtrim('0', t)), '"')
            WHEN t RLIKE r'{_NUMBER}' THEN CASE WHEN {trimmed} = '' THEN '"n0"'
                ELSE concat('"n', regexp_extract(t, r'{_NUMBER}', 1), ltrim('0', {trimmed}),
                            'e', {exponent}, '"') END
            WHEN t IN ('NaN', 'Infinity', '-Infinity') THEN concat('"n', t, '"')
            {booleans} ELSE t END), '')"""


# JSON text with every number replaced by one of its kind: whole or not.
_SHAPED = rf"""j -> array_join(transform(regexp_extract_all(j, r'{_TOKEN}', 0),
    t -> CASE WHEN t RLIKE r'^-?\d+$' THEN '1'
        WHEN t RLIKE r'{_NUMBER}' OR t IN ('NaN', 'Infinity', '-Infinity') THEN '1.5'
        ELSE t END), '')"""


def let(value: Column, body: Callable[[Column], Column] | str) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    ``body`` is a Python function of the Column or a SQL lambda such as ``x -> x + x``,
    which is built in one call however long it is.
    """
    if isinstance(body, str):
        results = F.call_function("transform", F.array(value), F.expr(body))
    else:
        results = F.transform(F.array(value), body)
    return F.get(results, F.lit(0))


# --- text to JSON text ----------------------------------------------------


def strip_reasoning(c: Column) -> Column:
    """Drop reasoning blocks, then everything up to the last closing tag, then stray tags."""
    paired = F.regexp_replace(c, rf"(?isU){_OPEN}.*?{_CLOSE}", "")

    def after_last_close(chunks: Column) -> Column:
        last = F.element_at(chunks, -1)
        return F.when(F.size(chunks) > 1, strip(last)).otherwise(last)

    tail = let(F.split(paired, rf"(?iU){_CLOSE}{_WS}*", -1), after_last_close)
    bare = F.regexp_replace(tail, rf"(?iU)</?{_WS}*{REASONING_NAME}{_WS}*>", "")

    # Removing a tag can join its neighbours into a new opening tag.
    def from_first_brace(t: Column) -> Column:
        reopened = t.rlike(rf"(?iU)^{_OPEN}") & t.contains("{")
        return F.when(reopened, F.substr(t, F.instr(t, "{"))).otherwise(t)

    return let(bare, from_first_brace)


def strip_fences(c: Column) -> Column:
    """Drop a code fence that opens the text and one that closes it."""
    opened = F.regexp_replace(c, rf"(?iU)^```(?:json)?{_WS}*", "")
    return F.regexp_replace(opened, rf"(?dU)(?<!{_WS}){_WS}*```$", "")


def repair_commas(c: Column) -> Column:
    """Drop commas that stand right before a closing bracket or brace."""
    pattern = rf"(?U),{_WS}*([}}\]])"
    return F.when(c.contains(","), F.regexp_replace(c, pattern, "$1")).otherwise(c)


def object_spans(c: Column) -> Column:
    """Top-level ``{...}`` spans from left to right; quoting is not looked at.

    The text is cut after every brace, so the fold takes one step per brace and
    not one per character, and its cost grows with the number of braces alone.
    """

    return let(c, _SPANS)


def parse_strict(c: Column) -> Column:
    """VARIANT of a text that is one JSON document and nothing else, else NULL.

    The built-in parser stops after the first value. With an end marker behind
    the text, both in one array, the marker is only in second place when the
    value reached the end of the text. NaN and Infinity count as numbers.
    """
    document = F.from_json(F.concat(F.lit("["), c, F.lit(f',"{_END}"]')), "variant", _PARSE)
    return let(document, _WHOLE)


def last_object(c: Column) -> Column:
    """VARIANT of the last span that parses, after repair; NULL when none does.

    A span starts with a brace, so one that parses is an object. Spans before
    the one that is taken are not parsed.
    """
    return F.aggregate(
        F.reverse(object_spans(c)),
        F.lit(None).cast("variant"),
        lambda found, span: F.coalesce(found, parse_strict(repair_commas(span))),
    )


def _slice(c: Column, first: str, last: str) -> Column:
    """From the first ``first`` to the last ``last``; NULL when not in that order."""
    start = F.instr(c, first)
    back = F.instr(F.reverse(c), last)
    end = F.length(c) - back + 1
    return F.when((start > 0) & (back > 0) & (end > start), F.substr(c, start, end - start + 1))


def fallback_slice(c: Column) -> Column:
    """First brace to last, else first bracket to last, repaired; else the text itself."""
    return F.coalesce(
        repair_commas(_slice(c, "{", "}")), repair_commas(_slice(c, "[", "]")), c
    )


def cleaned(c: Column) -> Column:
    """The text without surrounding space, reasoning and fences."""
    stripped = strip(or_empty(c))
    answer = let(
        stripped, lambda t: F.when(t.contains("<"), strip_reasoning(t)).otherwise(t)
    )
    return let(answer, lambda t: F.when(t.contains("```"), strip_fences(t)).otherwise(t))


def parse_json(c: Column) -> Column:
    """Tolerant parse of a model output: VARIANT, or NULL when it is not JSON."""
    return let(
        cleaned(c), lambda t: F.coalesce(last_object(t), parse_strict(fallback_slice(t)))
    )


def json_text(c: Column) -> Column:
    """The part of a model output that is read as JSON, repaired but not checked."""

    def chosen(t: Column) -> Column:
        # Once a span is found, those before it are not looked at.
        def last_parsable(found: Column, span: Column) -> Column:
            repaired = let(repair_commas(span), lambda r: F.when(parse_strict(r).isNotNull(), r))
            return F.coalesce(found, repaired)

        last = F.aggregate(F.reverse(object_spans(t)), F.lit(None).cast("string"), last_parsable)
        return F.coalesce(last, fallback_slice(t))

    return let(cleaned(c), chosen)


def is_valid(c: Column) -> Column:
    return parse_json(c).isNotNull()


def _rewritten(text: str | None) -> str | None:
    """A text's value written out again; the text itself where it is none or nested too deep to read."""
    try:
        return None if text is None else json.dumps(json.loads(text), ensure_ascii=False)
    except (ValueError, RecursionError):
        return text


def rewrite_json(df: DataFrame, column: str) -> DataFrame:
    """``df`` with JSON texts written out again from their values, characters unescaped.

    A repeated key keeps its first place and its last value at every depth, which no
    built-in function does while keeping the order of keys. Other texts stay as they are, and so do
    texts nested deeper than the reader goes (some thousand levels).
    """
    place, schema = df.columns.index(column), df.schema

    def scan(batches):
        for batch in batches:
            texts = [_rewritten(t) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, pa.string()))

    return df.mapInArrow(scan, schema)


# --- value classes --------------------------------------------------------


def value_class(v: Column) -> Column:
    """int, float, str, bool, null, list or dict; NULL for no value.

    Whole decimals of 19 digits and more are integers too wide for BIGINT.
    """
    return let(F.schema_of_variant(v), _CLASS)


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def as_map(v: Column) -> Column:
    """Members of an object; NULL for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def as_list(v: Column) -> Column:
    """Elements of a list; NULL for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_null_literal(v: Column) -> Column:
    return v.isNull() | (F.to_json(v) == "null")


def parse_object(c: Column, preview: int = 500) -> Column:
    """Object, or the single object of a one-element list, as STRUCT<value, error>.

    ``preview`` is how much of the text an error message quotes.
    """

    def pick(v: Column) -> Column:
        only = F.when(F.size(as_list(v)) == 1, F.get(as_list(v), F.lit(0)))
        value = F.when(is_object(v), v).when(is_object(only), only)
        error = F.concat(
            F.lit("expected JSON object, ok="),
            v.isNotNull().cast("string"),
            F.lit(" parsed_type="),
            F.coalesce(value_class(v), F.lit("n/a")),
            F.lit(" preview="),
            F.substring(or_empty(c), 1, preview),
        )
        return F.struct(
            value.alias("value"), F.when(value.isNull(), error).alias("error")
        )

    return let(parse_json(c), pick)


def has_keys(v: Column, required: Mapping[str, str]) -> Column:
    """Every required key is there with its value class (a bool passes as an int)."""

    def check(members: Column) -> Column:
        passed = members.isNotNull()
        for key, kind in required.items():
            found = value_class(F.try_element_at(members, F.lit(key)))
            allowed = ("int", "bool") if kind == "int" else (kind,)
            passed = passed & F.coalesce(found.isin(*allowed), F.lit(False))
        return passed

    return let(as_map(v), check)


def response_text(c: Column) -> Column:
    """Answer text of a stored chat response, from the first field that has any."""

    def field(v: Column, path: str) -> Column:
        found = F.try_variant_get(v, path, "variant")
        text = strip(F.try_variant_get(found, "$", "string"))
        return F.when((value_class(found) == "str") & (text != ""), text)

    def part_text(part: Column) -> Column:
        own = F.try_variant_get(part, "$", "string")
        typed = F.try_variant_get(part, "$.type", "string") == "text"
        return (
            F.when(value_class(part) == "str", own)
            .when(typed, or_empty(F.try_variant_get(part, "$.text", "string")))
            .otherwise(F.lit(""))
        )

    def read(v: Column) -> Column:
        message = "$.choices[0].message"
        parts = F.try_variant_get(v, f"{message}.content", "array<variant>")
        joined = strip(F.array_join(F.transform(parts, part_text), ""))
        return F.coalesce(
            F.when(joined != "", joined),
            field(v, f"{message}.content"),
            *(field(v, f"{message}.{name}") for name in MESSAGE_FALLBACK_FIELDS),
            F.lit(""),
        )

    return let(parse_strict(c), read)


# --- comparison -----------------------------------------------------------


def has_exact_numbers(c: Column) -> Column:
    """Whether a text holds numbers that must be compared as they are written."""
    return F.coalesce(c.rlike(_EXACT_NUMBERS), F.lit(False))


def shape(text: Column) -> Column:
    """VARIANT of a JSON text with the value classes of its numbers, not their values."""
    return parse_strict(let(text, _SHAPED))


def comparable(text: Column, python_equality: bool = True) -> Column:
    """VARIANT of a JSON text that is equal to another's exactly when their values are.

    Numbers compare by written value: 1, 1.0 and 1e0 are equal, and so are 1e22 and its 23
    digits; no digit is lost. Keys and texts have an s in front. With
    ``python_equality`` true and false also equal 1 and 0.
    """
    return parse_strict(let(text, _tagged_text(python_equality)))


def plain_equal(a: Column, b: Column, python_equality: bool = True) -> Column:
    """Deep equality of two values without exact numbers, by their ``to_json`` texts."""
    form = _plain_text(python_equality)
    return let(a, form) == let(b, form)


def json_equal(a: Column, b: Column, python_equality: bool = True) -> Column:
    """Deep equality of two JSON texts: sorted keys, ordered lists, numbers by value."""
    left, right = comparable(a, python_equality), comparable(b, python_equality)
    return F.to_json(left) == F.to_json(right)


def _classes_compatible(x: Column, y: Column) -> Column:
    numeric = ("int", "float")
    return (x == y) | (x.isin(*numeric) & y.isin(*numeric))


def type_compatible(a: Column, b: Column) -> Column:
    """Same class, where int and float pass for each other and bool only for bool."""
    return let(value_class(a), lambda x: let(value_class(b), lambda y: _classes_compatible(x, y)))


def _list_compatible(candidate: Column, reference: Column) -> Column:
    """Element classes of two lists overlap, or both lists are all numeric."""
    numeric = ("int", "float", "bool")

    def all_numeric(classes: Column) -> Column:
        return F.forall(classes, lambda k: k.isin(*numeric))

    return let(
        F.transform(candidate, value_class),
        lambda x: let(
            F.transform(reference, value_class),
            lambda y: (F.size(x) == 0)
            | (F.size(y) == 0)
            | F.arrays_overlap(x, y)
            | (all_numeric(x) & all_numeric(y)),
        ),
    )


def _compliance(reason: Column, missing: Column, extra: Column, wrong: Column) -> Column:
    return F.struct(
        reason.isNull().alias("ok"),
        reason.alias("reason"),
        missing.alias("missing"),
        extra.alias("extra"),
        wrong.alias("wrong"),
    )


def full_compliance() -> Column:
    """The outcome of ``schema_compliance`` for a candidate without faults."""
    none = F.array().cast("array<string>")
    return _compliance(F.lit(None).cast("string"), none, none, none)


def schema_compliance(a: Column, b: Column) -> Column:
    """Does candidate ``a`` have the keys and value classes of reference ``b``?

    Returns STRUCT<ok, reason, missing, extra, wrong>; ``reason`` is non_object,
    key_mismatch or wrong_types.
    """

    def wrong_keys(cand: Column, ref: Column) -> Column:
        def fails(key: Column) -> Column:
            cv, rv = F.try_element_at(cand, key), F.try_element_at(ref, key)

            def agree(x: Column, y: Column) -> Column:
                lists = (x == "list") & _list_compatible(as_list(cv), as_list(rv))
                return F.when(y == "list", lists).otherwise(_classes_compatible(x, y))

            return ~let(value_class(cv), lambda x: let(value_class(rv), lambda y: agree(x, y)))

        return F.array_sort(F.filter(F.map_keys(ref), fails))

    def details(cand: Column, ref: Column) -> Column:
        objects = cand.isNotNull() & ref.isNotNull()
        none = F.array().cast("array<string>")
        # Keys mostly come out alike and in one order, which costs no sets.
        alike = F.map_keys(cand) == F.map_keys(ref)
        missing = F.when(~alike, F.array_sort(F.array_except(F.map_keys(ref), F.map_keys(cand))))
        extra = F.when(~alike, F.array_sort(F.array_except(F.map_keys(cand), F.map_keys(ref))))

        def verdict(keys: Column) -> Column:
            same_keys = (F.size(keys["missing"]) == 0) & (F.size(keys["extra"]) == 0)
            return let(
                F.when(objects & same_keys, wrong_keys(cand, ref)).otherwise(none),
                lambda wrong: let(
                    F.when(~objects, "non_object")
                    .when(~same_keys, "key_mismatch")
                    .when(F.size(wrong) > 0, "wrong_types"),
                    lambda reason: _compliance(reason, keys["missing"], keys["extra"], wrong),
                ),
            )

        return let(
            F.struct(
                F.coalesce(missing, none).alias("missing"), F.coalesce(extra, none).alias("extra")
            ),
            verdict,
        )

    return let(as_map(a), lambda cand: let(as_map(b), lambda ref: details(cand, ref)))


def field_f1(a: Column, b: Column) -> Column:
    """Per-field F1 of candidate ``a`` over the keys of reference ``b`` and its mean.

    Lists compare as sets, anything else by equality; STRUCT<macro, per_field>. Both values
    are parsed texts without exact numbers, or both are ``comparable``; the latter's keys keep
    their s.
    """
    form = _plain_text(True)

    def canonical(v: Column) -> Column:
        return let(F.to_json(v), form)

    def elements(v: Column) -> Column:
        found = F.transform(as_list(v), lambda x: F.coalesce(canonical(x), F.lit("null")))
        return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))

    def list_score(cv: Column, rv: Column) -> Column:
        def f1(c: Column, r: Column) -> Column:
            both = F.size(F.array_intersect(c, r)).cast("double")
            return (
                F.when((F.size(c) == 0) & (F.size(r) == 0), 1.0)
                .when(both == 0, 0.0)
                # 2pr / (p + r) with p = both/|c| and r = both/|r|
                .otherwise(2 * both / (F.size(c) + F.size(r)))
            )

        return let(elements(cv), lambda c: let(elements(rv), lambda r: f1(c, r)))

    def field(cand: Column, ref: Column, key: Column) -> Column:
        cv, rv = F.try_element_at(cand, key), F.try_element_at(ref, key)
        equal = ~is_null_literal(cv) & (canonical(cv) == canonical(rv))
        return F.when(value_class(rv) == "list", list_score(cv, rv)).otherwise(
            F.coalesce(equal, F.lit(False)).cast("double")
        )

    def score(cand: Column, ref: Column) -> Column:
        keys = F.map_keys(ref)

        def result(values: Column) -> Column:
            total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
            macro = F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0)
            return F.struct(
                macro.alias("macro"), F.map_from_arrays(keys, values).alias("per_field")
            )

        return let(F.transform(keys, lambda k: field(cand, ref, k)), result)

    return let(as_map(a), lambda cand: let(as_map(b), lambda ref: score(cand, ref)))


def is_extraction(v: Column) -> Column:
    """The reference looks like an extraction: entities, or location and date."""

    def has(members: Column, key: str) -> Column:
        return F.array_contains(F.map_keys(members), key)

    return let(
        as_map(v),
        lambda m: F.coalesce(
            has(m, "entities") | (has(m, "location") & has(m, "date")), F.lit(False)
        ),
    )
