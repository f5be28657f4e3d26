"""The registered queries in SQL, for DuckDB on the same parquet tables.

Outcomes of damaged JSON are stated by damage class and do not parse anything,
so they are independent of the code they check.
"""

from __future__ import annotations

from evalspark.workload.fixtures import CHECKPOINTS, PAIRS, VOCABULARY

# --- fixed values, stated here again so that a wrong list in the library shows ---
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
FAILURE_MARKERS = (
    "i can't", "i cannot", "unable to", "as an ai", "i'm an ai", "sorry", "{}", "null", "[]"
)
CATEGORY_KEYWORDS = (
    ("summarization", ("summar",)),
    ("rewriting", ("rewrite", "rephrase", "reword")),
    ("brainstorming", ("brainstorm", "ideas")),
    ("qa", ("question", "answer", " who ", " what ", " when ", " where ", " why ", " how ")),
)
POOL_INSTRUCTIONS = {
    "json_extraction": "Extract entities and dates into JSON.",
    "schema_generation": "You are given a JSON schema. Generate a profile object that matches the "
    "schema exactly. Return only valid JSON.",
    "exact_label_classification": "Classify the sentiment into exactly one label from "
    "[positive, neutral, negative]. Return JSON in the required shape only.",
    "json_repair": "Repair malformed JSON. Return ONLY valid JSON (no explanations).",
    "tool_call_args": "Create JSON arguments for a function call. Return ONLY the JSON argument object.",
}
PROFILE_SCHEMA, TOOL_FUNCTION = '{"required": ["name", "age", "city"]}', "weather"
TASK_TYPES = tuple(POOL_INSTRUCTIONS)
DIMENSIONS = (
    "instruction_following",
    "correctness",
    "clarity",
    "completeness",
    "structured_output_validity",
    "hallucination_risk",
)
# ---------------------------------------------------------------------------------

C0, C1, C2 = CHECKPOINTS


def q(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def h(expression: str) -> str:
    return f"('0x' || substr(md5({expression}), 1, 8))::BIGINT"


def ratio(part: str, whole: str) -> str:
    return f"coalesce(({part})::DOUBLE / nullif(({whole})::DOUBLE, 0), 0.0)"


def r(expression: str) -> str:
    return f"round({expression}, 6)"


def strip(expression: str) -> str:
    return f"trim({expression}, {q(WHITESPACE)})"


# --- shared tables ---------------------------------------------------------------

TURNS = """
turns AS (
  SELECT u.conv_id, u.turn, u.conv_id * 1000 + u.turn AS idx,
         u.text AS instruction, a.text AS reference
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""

PREDS = TURNS + f""",
preds AS (
  SELECT idx AS id, '{C0}' AS checkpoint, instruction, reference, reference AS prediction FROM turns
  UNION ALL
  SELECT idx, '{C1}', instruction, reference,
         array_to_string(string_split(reference, ' ')[1:len(string_split(reference, ' ')):2], ' ')
  FROM turns
  UNION ALL
  SELECT t.idx, '{C2}', t.instruction, t.reference, coalesce(o.reference, '')
  FROM turns t LEFT JOIN turns o ON o.conv_id = t.conv_id + 1 AND o.turn = t.turn)"""

JSON_PARTS = """
parts AS (
  SELECT event_id, event_id % 5 AS fam, event_id // 5 AS m, event_type AS et,
         '"user' || user_id || '"' AS u, '"city' || (user_id % 50) || '"' AS c,
         '"' || strftime(ts, '%Y-%m-%d') || '"' AS d, (18 + user_id % 60)::VARCHAR AS age,
         CASE user_id % 3 WHEN 0 THEN '"positive"' WHEN 1 THEN '"neutral"' ELSE '"negative"' END AS lab
  FROM events),
members AS (
  SELECT event_id, fam, m, u, et,
    CASE fam
      WHEN 0 THEN ['"entities":[' || u || ',"' || et || '"]', '"location":' || c, '"date":' || d]
      WHEN 1 THEN ['"name":' || u, '"age":' || age, '"city":' || c]
      WHEN 2 THEN ['"label":' || lab]
      WHEN 3 THEN ['"name":' || u, '"age":' || age]
      ELSE ['"function":"weather"', '"arguments":{"city":' || c || ',"date":' || d || '}']
    END AS mem,
    ['entities', 'name', 'label', 'name', 'function'][fam + 1] AS first_key
  FROM parts),
refs AS (
  SELECT *, '{' || array_to_string(mem, ',') || '}' AS reference FROM members)"""

JSON_PREDS = JSON_PARTS + f""",
kinds AS (
  SELECT refs.*, k.checkpoint, m % k.n AS kind
  FROM refs, (VALUES ('{C0}', 12), ('{C1}', 7), ('{C2}', 9)) k(checkpoint, n)),
jpreds AS (
  SELECT *, event_id AS id, {[*TASK_TYPES]!r}[fam + 1] AS task_type,
    CASE kind
      WHEN 0 THEN reference
      WHEN 1 THEN '{{' || array_to_string(list_reverse(mem), ',') || '}}'
      WHEN 2 THEN '```json' || chr(10) || reference || chr(10) || '```'
      WHEN 3 THEN '<think>{{"x":1}}</think>' || chr(10) || reference
      WHEN 4 THEN 'Here it is: ' || reference || ' Hope it helps.'
      WHEN 5 THEN left(reference, length(reference) - 1) || ',}}'
      WHEN 6 THEN left(reference, instr(reference, '}}') - 1)
      WHEN 7 THEN 'I could not find any data.'
      WHEN 8 THEN '{{' || array_to_string(mem[2:], ',') || '}}'
      WHEN 9 THEN left(reference, length(reference) - 1) || ',"zz":0}}'
      WHEN 10 THEN '{{' || array_to_string(list_concat(['"' || first_key || '":7'], mem[2:]), ',') || '}}'
      ELSE '[1,2,3]'
    END AS prediction,
    kind NOT IN (6, 7) OR (kind = 6 AND fam = 0) AS valid,
    kind NOT IN (6, 7, 11) AS is_object,
    kind <= 5 AS perfect
  FROM kinds),
outcome AS (
  SELECT *,
    CASE WHEN fam = 0 AND is_object
         THEN CASE WHEN kind IN (8, 10) THEN 2.0 / 3 ELSE 1.0 END END::DOUBLE AS f1,
    CASE WHEN kind = 6 AND fam <> 0 THEN ['truncated_output']
         WHEN kind = 7 THEN ['invalid_json']
         WHEN kind IN (6, 11) THEN ['not_object']
         WHEN kind IN (8, 9) THEN ['key_mismatch', 'exact_mismatch']
         WHEN kind = 10 THEN ['wrong_types', 'exact_mismatch']
         ELSE []::VARCHAR[] END AS labels
  FROM jpreds)"""

JSON_METRICS = JSON_PREDS + f""",
jmetrics AS (
  SELECT checkpoint, count(*) AS total,
    {ratio('count(*) FILTER (valid)', 'count(*)')} AS json_validity_rate,
    {ratio('count(*) FILTER (perfect)', 'count(*) FILTER (valid)')} AS schema_compliance_rate,
    {ratio('count(*) FILTER (perfect)', 'count(*)')} AS exact_match_rate,
    coalesce(avg(f1), 0.0) AS extraction_field_level_f1_avg,
    count(f1) AS extraction_prompts
  FROM outcome GROUP BY checkpoint)"""

TAXONOMY = JSON_PREDS + """,
taxonomy AS (
  SELECT checkpoint, category, count(*) AS count
  FROM (SELECT checkpoint, unnest(labels) AS category FROM outcome) GROUP BY ALL)"""


# The outcome of each hard case, by hand: reference_ok, valid, is_object, compliant, exact, F1, labels.
HARD = f"""
hard AS (
  SELECT event_id AS id, user_id AS n, ['{C0}', '{C1}', '{C2}'][user_id % 3 + 1] AS checkpoint, o.*
  FROM events JOIN (VALUES
    (0, false, false, false, false, false, NULL, 'reference_parse_failed'),
    (1, false, false, false, false, false, NULL, 'reference_parse_failed'),
    (2, true, true, true, true, true, NULL, ''),
    (3, true, true, true, true, true, NULL, ''),
    (4, true, true, true, true, true, NULL, ''),
    (5, true, true, true, true, false, NULL, 'exact_mismatch'),
    (6, true, true, true, true, false, NULL, 'exact_mismatch'),
    (7, true, true, true, true, true, NULL, ''),
    (8, true, true, true, true, true, NULL, ''),
    (9, true, true, true, false, false, NULL, 'wrong_types,exact_mismatch'),
    (10, true, true, true, false, false, NULL, 'wrong_types,exact_mismatch'),
    (11, true, true, true, true, false, 0.4, 'exact_mismatch'),
    (12, true, true, true, true, true, NULL, ''),
    (13, true, true, true, false, true, NULL, 'wrong_types'),
    (14, true, true, false, false, false, NULL, 'not_object'),
    (15, true, false, false, false, false, NULL, 'truncated_output')
  ) o(kind, reference_ok, valid, is_object, compliant, exact, f1, labels) ON event_id % 16 = o.kind)"""

HARD_METRICS = HARD + f""",
counted AS (
  SELECT checkpoint, category || '=' || count(*) AS shown FROM
    (SELECT checkpoint, unnest(string_split(labels, ',')) AS category FROM hard WHERE labels <> '')
  GROUP BY checkpoint, category),
hmetrics AS (
  SELECT l.checkpoint, count(id) AS total,
    {ratio('count(*) FILTER (valid)', 'count(id)')} AS json_validity_rate,
    {ratio('count(*) FILTER (compliant)', 'count(*) FILTER (valid)')} AS schema_compliance_rate,
    {ratio('count(*) FILTER (exact)', 'count(id)')} AS exact_match_rate,
    coalesce(avg(f1), 0.0)::DOUBLE AS extraction_field_level_f1_avg, count(f1) AS extraction_prompts,
    coalesce((SELECT string_agg(shown, ',' ORDER BY shown) FROM counted c
      WHERE c.checkpoint = l.checkpoint), '') AS error_taxonomy_counts
  FROM (VALUES ('{C0}'), ('{C1}'), ('{C2}'), ('ckpt9_absent')) l(checkpoint)
    LEFT JOIN hard USING (checkpoint) GROUP BY l.checkpoint)"""


def _scores(side: str) -> str:
    parts = ", ".join(
        f"'{d}': "
        + (
            f"CASE WHEN k % 11 = 0 THEN NULL ELSE 1 + {h(f'''{q(f'{side}|{d}|')} || k''')} % 5 END"
            if d == "clarity"
            else f"1 + {h(f'''{q(f'{side}|{d}|')} || k''')} % 5"
        )
        for d in DIMENSIONS
    )
    return "{" + parts + "}"


_PAIRS = ", ".join(f"('{a}v{b}', '{CHECKPOINTS[a]}', '{CHECKPOINTS[b]}')" for a, b in PAIRS)

JUDGED = f"""
keyed AS (
  SELECT event_id AS idx, p.*, {h("p.pair || '|' || event_id")} AS k
  FROM events, (VALUES {_PAIRS}) p(pair, first, second)),
labelled AS (
  SELECT *, CASE WHEN k % 89 = 0 THEN NULL WHEN k % 97 = 0 THEN 'other' ELSE first END AS label_a,
         k % 2 = 1 AS swapped, {_scores('a')} AS sa, {_scores('b')} AS sb
  FROM keyed),
judged AS (
  SELECT idx, pair, first, second, swapped,
    CASE WHEN swapped THEN second ELSE label_a END AS ca,
    CASE WHEN swapped THEN label_a ELSE second END AS cb,
    CASE WHEN swapped THEN sb ELSE sa END AS ra,
    CASE WHEN swapped THEN sa ELSE sb END AS rb,
    CASE WHEN k % 20 <= 7 THEN 'a' WHEN k % 20 <= 12 THEN 'b'
         WHEN k % 20 <= 18 THEN 'tie' ELSE 'unclear' END AS w
  FROM labelled)"""

_IN = ", ".join(q(c) for c in CHECKPOINTS)

STATS = JUDGED + f""",
sides AS (
  SELECT ca AS checkpoint, ra AS s, w = 'a' AS won, w = 'b' AS lost, w = 'tie' AS tied
  FROM judged WHERE ca IN ({_IN}) AND cb IN ({_IN})
  UNION ALL
  SELECT cb, rb, w = 'b', w = 'a', w = 'tie' FROM judged WHERE ca IN ({_IN}) AND cb IN ({_IN})),
stats AS (
  SELECT checkpoint, count(*) FILTER (won) AS wins, count(*) FILTER (lost) AS losses,
    count(*) FILTER (tied) AS ties, count(*) AS total_compares,
    {ratio('count(*) FILTER (won)', 'count(*) FILTER (won OR lost)')} AS win_rate,
    {ratio('count(*) FILTER (tied)', 'count(*)')} AS tie_rate,
    {ratio('count(*) FILTER (lost)', 'count(*)')} AS loss_rate,
    {", ".join(f"{ratio(f'sum(s.{d})', 'count(*)')} AS avg_{d}" for d in DIMENSIONS)}
  FROM sides GROUP BY checkpoint)"""

H2H = JUDGED + f""",
pair12 AS (SELECT * FROM judged WHERE pair = '1v2'),
named AS (
  SELECT idx, w, ca, cb, ca IS NOT NULL AND cb IS NOT NULL AS named,
    coalesce(CASE w WHEN 'a' THEN ca WHEN 'b' THEN cb END, '') AS winner FROM pair12),
h2h AS (
  SELECT count(*) AS total_pairs,
    count(*) FILTER (named AND winner = '{C1}') AS ckpt1_wins,
    count(*) FILTER (named AND winner = '{C2}') AS ckpt2_wins,
    count(*) FILTER (named AND w = 'tie') AS ties FROM named),
prompts AS (
  SELECT event_id AS idx, user_id, CASE event_type
      WHEN 'click' THEN 'Summarize this' WHEN 'view' THEN 'Please rephrase it'
      WHEN 'signup' THEN 'Give me ideas' WHEN 'error' THEN 'Tell me what is wrong'
      ELSE 'What is this?' END AS instruction,
    CASE event_type WHEN 'click' THEN 'summarization' WHEN 'view' THEN 'rewriting'
      WHEN 'signup' THEN 'brainstorming' WHEN 'error' THEN 'qa' ELSE 'open_ended' END AS category
  FROM events),
outcomes AS (
  SELECT n.*, p.user_id, p.instruction, p.category FROM named n JOIN prompts p USING (idx)),
breakdown AS (
  SELECT category, count(*) FILTER (winner = '{C1}') AS ckpt1_wins,
    count(*) FILTER (winner = '{C2}') AS ckpt2_wins,
    count(*) FILTER (winner NOT IN ('{C1}', '{C2}')) AS ties, count(*) AS total
  FROM outcomes GROUP BY category),
examples AS (
  SELECT CASE winner WHEN '{C1}' THEN 'regression' ELSE 'improvement' END AS kind, idx, category,
    instruction, '' AS input, '{C1} says ' || user_id AS prediction_ckpt1,
    '{C2} says ' || user_id AS prediction_ckpt2, winner
  FROM outcomes WHERE winner IN ('{C1}', '{C2}')
  QUALIFY row_number() OVER (PARTITION BY winner ORDER BY idx) = 1)"""

VECTORS = f"""
vectors AS (
  SELECT (['{C0}', '{C1}', '{C2}'])[(vec_id // 10) % 3 + 1] AS checkpoint, vec_id // 10 AS row_id,
         vec_id % 10 < 5 AS cand, vec_id % 5 AS pos,
         list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
cosines AS (
  SELECT c.checkpoint, c.row_id, c.pos AS cpos, r.pos AS rpos,
    list_dot_product(c.v, r.v) / sqrt(list_dot_product(c.v, c.v) * list_dot_product(r.v, r.v)) AS s
  FROM vectors c JOIN vectors r ON c.row_id = r.row_id AND c.cand AND NOT r.cand),
matched AS (
  SELECT * FROM
    (SELECT checkpoint, row_id, avg(best) AS precision FROM
       (SELECT checkpoint, row_id, cpos, max(s) AS best FROM cosines GROUP BY ALL) GROUP BY ALL)
    JOIN
    (SELECT row_id, avg(best) AS recall FROM
       (SELECT row_id, rpos, max(s) AS best FROM cosines GROUP BY ALL) GROUP BY ALL)
    USING (row_id)),
ematch AS (
  SELECT checkpoint, row_id, precision, recall,
    2 * precision * recall / (precision + recall) AS f1 FROM matched)"""

TOKENS = PREDS + """,
toks AS (
  SELECT id, checkpoint, prediction, reference,
    regexp_extract_all(lower(prediction), '[a-z0-9]+') AS ct,
    regexp_extract_all(lower(reference), '[a-z0-9]+') AS rt FROM preds)"""

# --- fixed values: the stemmer's suffixes and exceptions, as published -------------
_STEM_2 = """ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e
ousli>ous ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al
iviti>ive biliti>ble fulli>ful"""
_STEM_3 = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
_STEM_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
_STEM_WHOLE = """sky>sky skies>sky dying>die lying>lie tying>tie news>news innings>inning
inning>inning outings>outing outing>outing cannings>canning canning>canning howe>howe
proceed>proceed exceed>exceed succeed>succeed"""
# -----------------------------------------------------------------------------------


def _cut(n: int, word: str = "w") -> str:
    return f"left({word}, length({word}) - {n})"


def _m(n: int) -> str:
    """Vowel-to-consonant changes of the word without its last n letters, from its shape."""
    return f"len(regexp_extract_all({_cut(n, 'sh')}, 'vc'))"


def _short(n: int) -> str:
    sh, word = _cut(n, "sh"), _cut(n)
    return f"({sh} = 'vc' OR (right({sh}, 3) = 'cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y')))"


def _ends(suffix: str) -> str:
    return f"ends_with(w, '{suffix}')"


def _stem_rules(text: str) -> str:
    rules = [r.split(">") for r in text.split()]
    return " ".join(
        f"WHEN {_ends(x)} THEN CASE WHEN {_m(len(x))} > 0 THEN {_cut(len(x))} || '{y}' ELSE w END"
        for x, y in rules
    )


def _stem_step(number: int, expression: str) -> str:
    """One step: the word, and its shape of vowels (v) and consonants (c) for the next step."""
    shape = """list_reduce(string_split(w, ''), lambda a, x: a || CASE WHEN x IN ('a','e','i','o','u')
      OR (x = 'y' AND right(a, 1) = 'c') THEN 'v' ELSE 'c' END, '')"""
    return f""",
stem{number} AS (SELECT word, w, {shape} AS sh FROM
  (SELECT word, {expression} AS w FROM stem{number - 1}))"""


def _last_two_equal(n: int) -> str:
    word, sh = _cut(n), _cut(n, "sh")
    return (
        f"(length({word}) > 1 AND right({word}, 1) = left(right({word}, 2), 1) AND right({sh}, 1) = 'c')"
    )


def _gerund(n: int) -> str:
    stem = _cut(n)
    return f"""CASE WHEN NOT contains({_cut(n, 'sh')}, 'v') THEN w
      WHEN right({stem}, 2) IN ('at', 'bl', 'iz') THEN {stem} || 'e'
      WHEN {_last_two_equal(n)} THEN CASE WHEN right({stem}, 1) IN ('l', 's', 'z') THEN {stem}
        ELSE {_cut(n + 1)} END
      WHEN {_m(n)} = 1 AND {_short(n)} THEN {stem} || 'e' ELSE {stem} END"""


STEMS = (
    """,
stem0 AS (SELECT word, word AS w FROM (SELECT DISTINCT unnest(list_concat(ct, rt)) AS word FROM plain)
  WHERE length(word) > 3)"""
    + _stem_step(
        1,
        f"""CASE WHEN {_ends('ies')} THEN CASE WHEN length(w) = 4 THEN {_cut(1)} ELSE {_cut(2)} END
          WHEN {_ends('sses')} THEN {_cut(2)} WHEN {_ends('s')} AND NOT {_ends('ss')} THEN {_cut(1)}
          ELSE w END""",
    )
    + _stem_step(
        2,
        f"""CASE WHEN {_ends('ied')} THEN CASE WHEN length(w) = 4 THEN {_cut(1)} ELSE {_cut(2)} END
          WHEN {_ends('eed')} THEN CASE WHEN {_m(3)} > 0 THEN {_cut(1)} ELSE w END
          WHEN {_ends('ed')} THEN {_gerund(2)} WHEN {_ends('ing')} THEN {_gerund(3)} ELSE w END""",
    )
    + _stem_step(
        3,
        f"""CASE WHEN {_ends('y')} AND length(w) > 2 AND right({_cut(1, 'sh')}, 1) = 'c'
          THEN {_cut(1)} || 'i' ELSE w END""",
    )
    + _stem_step(4, f"CASE WHEN {_ends('alli')} AND {_m(4)} > 0 THEN {_cut(2)} ELSE w END")
    + _stem_step(
        5,
        f"""CASE WHEN {_ends('logi')} AND {_m(3)} > 0 THEN {_cut(1)} {_stem_rules(_STEM_2)}
          ELSE w END""",
    )
    + _stem_step(6, f"CASE {_stem_rules(_STEM_3)} ELSE w END")
    + _stem_step(
        7,
        "CASE "
        + " ".join(
            f"WHEN {_ends(x)} THEN CASE WHEN {_m(len(x))} > 1"
            + (f" AND right({_cut(3)}, 1) IN ('s', 't')" if x == "ion" else "")
            + f" THEN {_cut(len(x))} ELSE w END"
            for x in _STEM_4.split()
        )
        + " ELSE w END",
    )
    + _stem_step(
        8,
        f"""CASE WHEN {_ends('e')} AND ({_m(1)} > 1 OR ({_m(1)} = 1 AND NOT {_short(1)}))
          THEN {_cut(1)} ELSE w END""",
    )
    + _stem_step(9, f"CASE WHEN {_ends('ll')} AND {_m(1)} > 1 THEN {_cut(1)} ELSE w END")
    + f""",
stems AS (
  SELECT word, coalesce(o.whole, w) AS stem FROM stem9 LEFT JOIN (VALUES
    {", ".join("('{}', '{}')".format(*r.split(">")) for r in _STEM_WHOLE.split())}) o(known, whole)
  ON known = word),
stemmed AS (
  SELECT id, checkpoint, side, list(coalesce(stem, t) ORDER BY i) AS tokens FROM
    (SELECT id, checkpoint, 'c' AS side, unnest(ct) AS t, generate_subscripts(ct, 1) AS i FROM plain
     UNION ALL SELECT id, checkpoint, 'r', unnest(rt), generate_subscripts(rt, 1) FROM plain)
    LEFT JOIN stems ON word = t GROUP BY ALL)"""
)

STEMMED = TOKENS.replace("toks AS (", "plain AS (") + STEMS + """,
toks AS (
  SELECT p.id, p.checkpoint, prediction, reference,
    coalesce(c.tokens, []::VARCHAR[]) AS ct, coalesce(r.tokens, []::VARCHAR[]) AS rt
  FROM plain p
    LEFT JOIN stemmed c ON c.id = p.id AND c.checkpoint = p.checkpoint AND c.side = 'c'
    LEFT JOIN stemmed r ON r.id = p.id AND r.checkpoint = p.checkpoint AND r.side = 'r')"""


def _rouge(n: int) -> str:
    """F-measures of n-grams per row, as table rouge{n}."""
    gram = " || ' ' || ".join(f"t[i + {k}]" for k in range(n))

    def counts(side: str) -> str:
        return f"""(SELECT id, checkpoint, {gram} AS g, count(*) AS n
          FROM (SELECT id, checkpoint, {side} AS t, unnest(range(1, len({side}) - {n} + 2)) AS i
                FROM toks) GROUP BY ALL)"""

    return f""",
over{n} AS (
  SELECT id, checkpoint, sum(least(c.n, r.n)) AS o
  FROM {counts('ct')} c JOIN {counts('rt')} r USING (id, checkpoint, g) GROUP BY ALL),
rouge{n} AS (
  SELECT id, checkpoint,
    coalesce(2.0 * o / (greatest(len(ct) - {n - 1}, 0) + greatest(len(rt) - {n - 1}, 0)), 0.0)::DOUBLE
      AS rouge{n}_f1
  FROM toks LEFT JOIN over{n} USING (id, checkpoint))"""


# Longest common subsequence: one step per candidate token, all rows at a time.
LCS = """,
ids AS (SELECT row_number() OVER () AS rid, * FROM toks),
cells AS (SELECT rid, unnest(range(1, len(rt) + 1)) AS j, unnest(rt) AS tok FROM ids),
cand AS (SELECT rid, unnest(range(1, len(ct) + 1)) AS i, unnest(ct) AS tok FROM ids),
dp(rid, i, j, v) AS (
  SELECT rid, 0, j, 0 FROM cells
  UNION ALL
  SELECT rid, i + 1, j, max(greatest(v, diag)) OVER (PARTITION BY rid ORDER BY j)
  FROM (SELECT d.rid, d.i, d.j, d.v,
          CASE WHEN c.tok = x.tok
               THEN 1 + lag(d.v, 1, 0) OVER (PARTITION BY d.rid ORDER BY d.j) ELSE 0 END AS diag
        FROM dp d JOIN cand x ON x.rid = d.rid AND x.i = d.i + 1
        JOIN cells c ON c.rid = d.rid AND c.j = d.j)),
rougeL AS (
  SELECT id, checkpoint, coalesce(2.0 * v / (len(ct) + len(rt)), 0.0)::DOUBLE AS rougeL_f1
  FROM ids LEFT JOIN dp ON dp.rid = ids.rid AND dp.i = len(ct) AND dp.j = len(rt))"""

COMPLETED = "length({t}) >= 20 AND NOT (" + " OR ".join(
    f"contains(lower({{t}}), {q(m)})" for m in FAILURE_MARKERS if m != "{}"
) + " OR contains({t}, '{{}}'))"

TEXT_METRICS = STEMMED + _rouge(1) + _rouge(2) + LCS + "," + VECTORS + f""",
tmetrics AS (
  SELECT checkpoint, count(*) AS samples,
    avg(len(regexp_extract_all(prediction, '\\S+'))) AS avg_output_tokens,
    avg(CASE WHEN {COMPLETED.format(t=strip('prediction'))} THEN 1.0 ELSE 0.0 END)
      AS task_completion_rate,
    avg(rouge1_f1) AS rouge1_f1, avg(rouge2_f1) AS rouge2_f1, avg(rougeL_f1) AS rougeL_f1
  FROM toks JOIN rouge1 USING (id, checkpoint) JOIN rouge2 USING (id, checkpoint)
    JOIN rougeL USING (id, checkpoint) GROUP BY checkpoint),
tfull AS (
  SELECT t.*, e.bertscore_f1_avg FROM tmetrics t LEFT JOIN
    (SELECT checkpoint, avg(f1) AS bertscore_f1_avg FROM ematch GROUP BY checkpoint) e
    USING (checkpoint)),
deltas AS (
  SELECT a.rougeL_f1 AS rougeL_f1_ckpt1, b.rougeL_f1 AS rougeL_f1_ckpt2,
    b.rougeL_f1 - a.rougeL_f1 AS delta_rougeL_f1_ckpt2_minus_ckpt1,
    a.bertscore_f1_avg AS bertscore_f1_ckpt1, b.bertscore_f1_avg AS bertscore_f1_ckpt2,
    b.bertscore_f1_avg - a.bertscore_f1_avg AS delta_bertscore_f1_ckpt2_minus_ckpt1
  FROM tfull a, tfull b WHERE a.checkpoint = '{C1}' AND b.checkpoint = '{C2}')"""

PLAN = PREDS + f""",
pairs AS (
  SELECT a.id AS idx, a.instruction, a.checkpoint AS first, b.checkpoint AS second,
    a.prediction AS pa, b.prediction AS pb,
    {h("'42|' || a.checkpoint || '|' || b.checkpoint || '|' || a.id")} % 2 = 1 AS swapped
  FROM preds a JOIN preds b ON a.id = b.id AND a.checkpoint < b.checkpoint),
plan AS (
  SELECT idx, instruction, swapped,
    CASE WHEN swapped THEN second ELSE first END AS checkpoint_a,
    CASE WHEN swapped THEN first ELSE second END AS checkpoint_b,
    CASE WHEN swapped THEN pb ELSE pa END AS response_a,
    CASE WHEN swapped THEN pa ELSE pb END AS response_b FROM pairs)"""

LOG = JSON_PREDS + f""",
attempts AS (
  SELECT event_id // 5 AS idx, event_id % 5 AS attempt, kind, fam, prediction, valid, is_object,
    {h("'s|' || event_id")} % 16 AS draw
  FROM jpreds WHERE checkpoint = '{C0}'),
log AS (
  SELECT *, CASE WHEN draw < 4 THEN 'api_error' WHEN draw = 4 THEN 'error' ELSE 'ok' END AS status
  FROM attempts),
heads AS (
  SELECT idx, min(attempt) FILTER (status <> 'api_error') AS p,
    min(attempt) FILTER (status = 'ok' AND valid) AS v FROM log GROUP BY idx),
accepted AS (
  SELECT l.idx, l.attempt::INTEGER AS attempt, l.prediction AS text, l.kind, l.fam
  FROM heads JOIN log l ON l.idx = heads.idx AND l.attempt = v
  WHERE v <= p + 1 AND NOT EXISTS (
    SELECT 1 FROM log b WHERE b.idx = heads.idx AND b.status <> 'ok'
      AND b.attempt >= p AND b.attempt < v)),
verdicts AS (
  SELECT l.idx, l.attempt::INTEGER AS attempt, l.prediction AS text FROM
    (SELECT idx, min(attempt) FILTER (status = 'ok' AND is_object AND attempt <= 3) AS v,
       min(attempt) FILTER (status = 'error') AS s FROM log GROUP BY idx) f
    JOIN log l ON l.idx = f.idx AND l.attempt = v
  WHERE v < coalesce(s, 99))"""

POOL = f"""
rows5 AS (
  SELECT event_id, event_id % 5 AS fam, 'user' || user_id AS name, (18 + user_id % 60) AS age,
    'city' || (user_id % 50) AS city, strftime(ts, '%Y-%m-%d') AS date, event_type, props
  FROM events),
base AS (
  SELECT event_id, {[*TASK_TYPES]!r}[fam + 1] AS task_type,
    CASE fam {" ".join(f"WHEN {i} THEN {q(POOL_INSTRUCTIONS[t])}" for i, t in enumerate(TASK_TYPES))}
    END AS instruction,
    CASE fam
      WHEN 0 THEN name || ' met ' || event_type || ' in ' || city || ' on ' || date || '.'
      WHEN 1 THEN 'Schema: ' || {q(PROFILE_SCHEMA)} || chr(10)
        || 'User preference: generate a profile for ' || name || ' aged ' || age || ' living in '
        || city || '.'
      WHEN 2 THEN props
      WHEN 3 THEN '{{"name":"' || name || '","age": ' || age || ',}}'
      ELSE 'Get {TOOL_FUNCTION} for ' || city || ' ' || date || '.' END AS input,
    CASE fam
      WHEN 0 THEN '{{"entities": ["' || name || '", "' || event_type || '"], "location": "' || city
        || '", "date": "' || date || '"}}'
      WHEN 1 THEN '{{"name": "' || name || '", "age": ' || age || ', "city": "' || city || '"}}'
      WHEN 2 THEN '{{"label": "' || event_type || '"}}'
      WHEN 3 THEN '{{"name": "' || name || '", "age": ' || age || '}}'
      ELSE '{{"function": "{TOOL_FUNCTION}", "arguments": {{"city": "' || city || '", "date": "'
        || date || '"}}}}' END AS json_example
  FROM rows5),
pool AS (SELECT base.*, copy_no::INTEGER AS copy_no FROM base, (VALUES (0), (1)) c(copy_no))"""

_ORDER = "md5('42|' || {key}) || '|' || {key}"

LEAKY = """
leaky AS (
  SELECT doc_id, copy_no::INTEGER AS copy_no, text, doc_id || '-' || copy_no AS k,
    sha256(text || chr(31)) AS ck
  FROM documents, (VALUES (0), (1)) c(copy_no)),
by_position AS (
  SELECT *, row_number() OVER (ORDER BY md5('42|' || k) || '|' || k) AS pos,
    count(*) OVER () AS n FROM leaky),
contents AS (
  SELECT ck, row_number() OVER (ORDER BY md5('42|' || ck) || '|' || ck) AS pos,
    count(*) OVER () AS n FROM (SELECT DISTINCT ck FROM leaky)),
split_p AS (
  SELECT doc_id, copy_no, ck, pos, n,
    CASE WHEN pos <= least(100, n - 1) THEN 'eval' ELSE 'train' END AS split FROM by_position),
split_c AS (
  SELECT doc_id, copy_no, leaky.ck,
    CASE WHEN pos <= least(100, n - 1) THEN 'eval' ELSE 'train' END AS split
  FROM leaky JOIN contents USING (ck))"""


def _category(column: str) -> str:
    rules = " ".join(
        "WHEN "
        + " OR ".join(f"contains(lower({column}), {q(k)})" for k in keywords)
        + f" THEN '{category}'"
        for category, keywords in CATEGORY_KEYWORDS
    )
    return f"CASE {rules} ELSE 'open_ended' END"


def _with(tables: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{tables.lstrip(',')}\n{select}"


_H2H_RATES = ", ".join(
    f"{r(ratio(c, 'total_pairs'))} AS {name}"
    for c, name in (
        ("ckpt1_wins", "ckpt1_win_rate"),
        ("ckpt2_wins", "ckpt2_win_rate"),
        ("ties", "tie_rate"),
    )
)
_COMPACT = "replace(replace({t}, ',', ', '), ':', ': ')"
_TRIMMED = strip("{t}")


def _example_json(kind: str) -> str:
    keys = (
        "idx",
        "category",
        "instruction",
        "input",
        "prediction_ckpt1",
        "prediction_ckpt2",
        "winner",
    )
    body = " || ',' || ".join(
        f"'\"{k}\":' || idx" if k == "idx" else f"'\"{k}\":\"' || {k} || '\"'" for k in keys
    )
    return f"(SELECT '{{' || {body} || '}}' FROM examples WHERE kind = '{kind}')"


def _fixed(expression: str) -> str:
    return f"printf('%.6f', {expression})"


_SUMMARY_ROWS = [
    ("ckpt1", q(C1)),
    ("ckpt2", q(C2)),
    *((c, f"(SELECT {c}::VARCHAR FROM h2h)") for c in ("total_pairs", "ckpt1_wins", "ckpt2_wins", "ties")),
    *(
        (name, f"(SELECT {_fixed(ratio(c, 'total_pairs'))} FROM h2h)")
        for c, name in (
            ("ckpt1_wins", "ckpt1_win_rate"),
            ("ckpt2_wins", "ckpt2_win_rate"),
            ("ties", "tie_rate"),
        )
    ),
    (
        "delta_win_rate_ckpt2_minus_ckpt1",
        "(SELECT "
        + _fixed(f"{ratio('ckpt2_wins', 'total_pairs')} - {ratio('ckpt1_wins', 'total_pairs')}")
        + " FROM h2h)",
    ),
    *(
        (c, f"(SELECT {_fixed(c)} FROM deltas)")
        for c in (
            "rougeL_f1_ckpt1",
            "rougeL_f1_ckpt2",
            "bertscore_f1_ckpt1",
            "bertscore_f1_ckpt2",
            "delta_rougeL_f1_ckpt2_minus_ckpt1",
            "delta_bertscore_f1_ckpt2_minus_ckpt1",
        )
    ),
    (
        "category_breakdown",
        "(SELECT '{' || string_agg('\"' || category || '\":{\"ckpt1_wins\":' || ckpt1_wins "
        "|| ',\"ckpt2_wins\":' || ckpt2_wins || ',\"ties\":' || ties || ',\"total\":' || total "
        "|| '}', ',' ORDER BY category) || '}' FROM breakdown)",
    ),
    ("representative_regression_example", _example_json("regression")),
    ("representative_improvement_example", _example_json("improvement")),
]

ANSWERS = LOG + """,
answers AS (
  SELECT idx, CASE WHEN a.kind IN (2, 3, 4, 5) THEN refs.reference
    WHEN a.kind = 6 THEN '[' || refs.u || ',"' || refs.et || '"]' ELSE a.text END AS t
  FROM accepted a JOIN refs ON refs.event_id = a.idx * 5 + a.attempt)"""

ORACLE: dict[str, str] = {
    "json_metrics": _with(
        JSON_METRICS,
        f"""SELECT checkpoint, total, {r('json_validity_rate')} AS json_validity_rate,
          {r('schema_compliance_rate')} AS schema_compliance_rate,
          {r('exact_match_rate')} AS exact_match_rate,
          {r('extraction_field_level_f1_avg')} AS extraction_field_level_f1_avg,
          extraction_prompts FROM jmetrics""",
    ),
    "json_metrics_document": _with(
        TAXONOMY,
        """SELECT t.checkpoint, (SELECT count(*) FROM outcome o WHERE o.checkpoint = t.checkpoint) AS total,
          string_agg(category || '=' || count, ',' ORDER BY category) AS error_taxonomy_counts
        FROM taxonomy t GROUP BY t.checkpoint""",
    ),
    "json_error_taxonomy": _with(TAXONOMY, "SELECT checkpoint, category, count FROM taxonomy"),
    "json_scores": _with(
        JSON_PREDS,
        f"""SELECT id, checkpoint, true AS reference_ok, valid, is_object, perfect AS compliant,
          perfect AS exact, f1 IS NOT NULL AS extraction, {r('f1')} AS extraction_f1,
          array_to_string(labels, ',') AS labels FROM outcome""",
    ),
    "json_valid_rows": _with(
        JSON_PREDS, "SELECT id, checkpoint, prediction FROM jpreds WHERE valid"
    ),
    "json_validity_counts": _with(
        JSON_PREDS,
        "SELECT checkpoint, count(*) FILTER (valid) AS kept, count(*) AS total FROM jpreds GROUP BY 1",
    ),
    "json_text": _with(
        JSON_PREDS,
        """SELECT id, checkpoint, CASE WHEN kind IN (2, 3, 4, 5) THEN reference
          WHEN kind = 6 AND fam = 0 THEN '[' || u || ',"' || et || '"]'
          ELSE prediction END AS json_text FROM jpreds""",
    ),
    "json_spans": _with(
        JSON_PREDS,
        """SELECT id, checkpoint,
          CASE WHEN kind = 3 THEN 2 WHEN kind IN (6, 7, 11) THEN 0 ELSE 1 END::INTEGER AS n_spans,
          CASE WHEN kind IN (6, 7, 11) THEN NULL WHEN kind IN (2, 3, 4) THEN reference
            ELSE prediction END AS last_span FROM jpreds""",
    ),
    "json_stripped": _with(
        JSON_PREDS,
        """SELECT id, checkpoint,
          CASE WHEN kind = 3 THEN chr(10) || reference ELSE prediction END AS no_reasoning,
          CASE WHEN kind = 2 THEN reference ELSE prediction END AS no_fences,
          CASE WHEN kind = 5 THEN reference ELSE prediction END AS repaired FROM jpreds""",
    ),
    "json_object_parse": _with(
        JSON_PREDS,
        """SELECT id, checkpoint, is_object AS has_value,
          CASE WHEN NOT is_object THEN 'expected JSON object, ok=' || valid || ' parsed_type='
            || CASE WHEN valid THEN 'list' ELSE 'n/a' END || ' preview=' || prediction END AS error
        FROM jpreds""",
    ),
    "json_required_keys": _with(
        JSON_PREDS,
        "SELECT id, checkpoint, fam IN (1, 3) AND (kind <= 5 OR kind = 9) AS has_keys FROM jpreds",
    ),
    "schema_compliance": _with(
        JSON_PREDS,
        """SELECT id, checkpoint, perfect AS ok,
          CASE WHEN kind IN (6, 7, 11) THEN 'non_object' WHEN kind IN (8, 9) THEN 'key_mismatch'
            WHEN kind = 10 THEN 'wrong_types' END AS reason,
          CASE WHEN kind = 8 THEN first_key ELSE '' END AS missing,
          CASE WHEN kind = 9 THEN 'zz' ELSE '' END AS extra,
          CASE WHEN kind = 10 THEN first_key ELSE '' END AS wrong FROM jpreds""",
    ),
    "field_f1": _with(
        JSON_PREDS,
        f"""SELECT id, checkpoint, {r('f1')} AS macro,
          CASE WHEN kind IN (8, 10) THEN 0.0 ELSE 1.0 END::DOUBLE AS entities,
          1.0::DOUBLE AS location, 1.0::DOUBLE AS date FROM outcome WHERE f1 IS NOT NULL""",
    ),
    "json_equality": """SELECT event_id,
        event_id % 5 IN (0, 2, 4) OR (event_id % 5 = 1 AND user_id = 1) AS equal,
        event_id % 5 IN (0, 4) OR (event_id % 5 = 1 AND user_id = 1) AS strictly_equal FROM events""",
    "json_type_compatibility": _with(
        JSON_PREDS,
        """SELECT *, class_a = class_b AS compatible FROM (
          SELECT id, checkpoint, CASE fam WHEN 0 THEN 'list' ELSE 'str' END AS class_a,
            CASE WHEN kind IN (6, 7, 8, 11) THEN NULL WHEN kind = 10 THEN 'int'
              WHEN fam = 0 THEN 'list' ELSE 'str' END AS class_b FROM jpreds)""",
    ),
    "json_hard_scores": _with(
        HARD,
        f"""SELECT id, reference_ok, valid, is_object, compliant, exact, f1 IS NOT NULL AS extraction,
          {r('f1::DOUBLE')} AS extraction_f1, labels FROM hard""",
    ),
    "json_hard_metrics": _with(
        HARD_METRICS,
        f"""SELECT checkpoint, total, {", ".join(f"{r(c)} AS {c}" for c in (
            "json_validity_rate", "schema_compliance_rate", "exact_match_rate",
            "extraction_field_level_f1_avg"))}, extraction_prompts, error_taxonomy_counts
        FROM hmetrics""",
    ),
    "teacher_records_hard": _with(
        HARD,
        """SELECT id, replace(CASE kind
          WHEN 0 THEN 'null' WHEN 2 THEN '{"a": %s}' WHEN 3 THEN '{"a": %s, "b": [1, 2.5]}'
          WHEN 4 THEN '{"a": 1e+22, "n": %s}'
          WHEN 5 THEN '{"a": 1%s0000000000000000000000000000000000000001}'
          WHEN 6 THEN '{"a": {"x": [1, {"y": %s}]}}' WHEN 7 THEN '{"a": "last"}'
          WHEN 8 THEN '{"a": "café %s"}' WHEN 10 THEN '{"a": 1.5, "b": "%s"}'
          WHEN 11 THEN '{"entities": ["u%s", 1.0, "x"], "location": null}'
          WHEN 12 THEN '{"a": 1.2345678901234568e+18, "b": %s}'
          WHEN 13 THEN '{"a": %s, "b": true}' ELSE '{"a": %s}' END, '%s', n::VARCHAR) AS output
        FROM hard WHERE kind <> 1""",
    ),
    "response_text": """SELECT event_id, CASE event_id % 7
        WHEN 0 THEN 'hi ' || event_type WHEN 1 THEN event_type || ' end'
        WHEN 2 THEN 'because ' || event_type WHEN 3 THEN 'no ' || event_type
        WHEN 5 THEN event_type ELSE '' END AS answer FROM events""",
    "instruction_normalise": f"""SELECT doc_id,
        CASE WHEN doc_id % 4 IN (0, 1) THEN {strip('text')} ELSE '' END AS instruction,
        CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE '' END AS input, {strip('text')} AS output
      FROM documents WHERE doc_id % 4 <> 2 AND (doc_id % 4 <> 1 OR length(text) > 0)""",
    "instruction_dataset": f"""WITH n AS (
        SELECT doc_id, CASE WHEN doc_id % 4 IN (0, 1) THEN {strip('text')} ELSE '' END AS instruction
        FROM documents WHERE doc_id % 4 <> 2 AND (doc_id % 4 <> 1 OR length(text) > 0))
      SELECT *, CASE WHEN row_number() OVER (ORDER BY {_ORDER.format(key='doc_id')})
          <= floor((count(*) OVER ())::DOUBLE * 0.95::DOUBLE) THEN 'train' ELSE 'eval' END AS split
      FROM n""",
    "train_text": _with(
        TURNS,
        """SELECT idx, 'Instruction: ' || instruction || chr(10) || 'Input: ' || chr(10)
          || 'Response: ' || reference AS text FROM turns""",
    ),
    "generation_prompt": _with(
        """
p AS (SELECT conv_id * 1000 + turn AS idx, text AS instruction,
  CASE WHEN (conv_id * 1000 + turn) % 2 = 0 THEN ' with spaces ' ELSE '' END AS i
  FROM conversations WHERE role = 'user'),
g AS (SELECT *, 'Instruction: ' || instruction || chr(10) || 'Input: ' || i || chr(10) || 'Response: ' AS plain FROM p)""",
        f"""SELECT idx, plain, plain AS untemplated, '<|user|>' || chr(10) ||
          {strip(strip('instruction') + " || chr(10) || " + strip('i'))}
          || '<|end|>' || chr(10) || '<|assistant|>' || chr(10) AS chat FROM g""",
    ),
    "prompt_pool": _with(
        POOL, "SELECT event_id, copy_no, task_type, instruction, input, json_example FROM pool"
    ),
    "teacher_prompt": _with(
        POOL,
        """SELECT event_id, copy_no, 'Shape: ' || json_example || chr(10) || 'Do: ' || instruction
          || chr(10) || 'With: ' || input AS prompt FROM pool""",
    ),
    "pairwise_prompt": _with(
        PLAN,
        """SELECT idx, checkpoint_a, checkpoint_b, instruction || '||' || checkpoint_a || '|' ||
          response_a || '|' || checkpoint_b || '|' || response_b AS prompt FROM plan""",
    ),
    "json_judge_prompt": _with(
        JSON_PREDS,
        """SELECT id, checkpoint, 'Answer event ' || id || '||' || checkpoint || '|' || prediction
          || '|' || reference AS prompt FROM jpreds""",
    ),
    "token_budget": _with(
        PREDS + ",\ncut AS (SELECT id, checkpoint, regexp_extract_all(prediction, '\\S+') AS t FROM preds)",
        """SELECT id, checkpoint, array_to_string(t[1:64], ' ') AS kept,
          least(len(t), 64)::INTEGER AS n_tokens, len(t) > 64 AS truncated FROM cut""",
    ),
    "task_completion": f"""WITH a AS (SELECT doc_id, {strip('''CASE doc_id % 6
          WHEN 0 THEN 'SORRY, ' || text WHEN 1 THEN text || ' {}'
          WHEN 2 THEN '          too short          ' WHEN 3 THEN '' ELSE text END''')} AS t
        FROM documents)
      SELECT doc_id, {COMPLETED.format(t='t')} AS completed FROM a""",
    "instruction_category": _with(
        H2H,
        f"""SELECT 'documents' AS origin, doc_id AS id, {_category('text')} AS category FROM documents
        UNION ALL SELECT 'events', idx, category FROM prompts""",
    ),
    "teacher_records": _with(
        ANSWERS,
        f"""SELECT idx, 'Prompt ' || idx AS instruction, '' AS input,
          {_COMPACT.format(t='t')} AS output, 'unknown' AS task_type FROM answers""",
    ),
    "json_dataset": _with(
        ANSWERS + """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42|' || ck) || '|' || ck) AS pos, count(*) OVER () AS n
  FROM (SELECT *, sha256('Prompt ' || idx || chr(31)) AS ck FROM answers))""",
        f"""SELECT idx, {_COMPACT.format(t='t')} AS output, 't' AS task_type,
          CASE WHEN pos <= least(50, n - 1) THEN 'eval' ELSE 'train' END AS split FROM ranked""",
    ),
    "shuffled_order": f"""SELECT doc_id,
        row_number() OVER (ORDER BY {_ORDER.format(key='doc_id')}) - 1 AS idx FROM documents""",
    "head_limit": f"""SELECT doc_id,
        row_number() OVER (ORDER BY {_ORDER.format(key='doc_id')}) - 1 AS idx FROM documents
      QUALIFY idx < 25""",
    "positional_ids": """WITH n AS (SELECT conv_id, turn,
          row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM conversations)
      SELECT *, idx // 16 AS batch_id FROM n""",
    "split_fraction": f"""SELECT doc_id, CASE WHEN
          row_number() OVER (ORDER BY {_ORDER.format(key='doc_id')})
            <= floor((count(*) OVER ())::DOUBLE * 0.95::DOUBLE)
        THEN 'train' ELSE 'eval' END AS split FROM documents""",
    "split_fraction_by_hash": f"""SELECT doc_id,
        CASE WHEN {h("'42|' || doc_id")} < 0.95::DOUBLE * 4294967296 THEN 'train' ELSE 'eval' END
          AS split FROM documents""",
    "split_capped": _with(
        LEAKY, "SELECT doc_id, copy_no, split FROM split_p WHERE pos <= least(100, n - 1) + 80"
    ),
    "split_uncapped": _with(LEAKY, "SELECT doc_id, copy_no, split FROM split_p"),
    "split_leakfree": _with(LEAKY, "SELECT doc_id, copy_no, split FROM split_c"),
    "split_overlap": _with(
        LEAKY,
        """SELECT 'position' AS by, count(*) AS n_overlap FROM
          (SELECT ck FROM split_p GROUP BY ck HAVING count(DISTINCT split) = 2)
        UNION ALL SELECT 'content', count(*) FROM
          (SELECT ck FROM split_c GROUP BY ck HAVING count(DISTINCT split) = 2)""",
    ),
    "rouge1": _with(
        TOKENS + _rouge(1), f"SELECT id, checkpoint, {r('rouge1_f1')} AS rouge1_f1 FROM rouge1"
    ),
    "rouge2": _with(
        TOKENS + _rouge(2), f"SELECT id, checkpoint, {r('rouge2_f1')} AS rouge2_f1 FROM rouge2"
    ),
    "rougeL": _with(
        TOKENS + LCS,
        f'SELECT id, checkpoint, {r("rougeL_f1")} AS "rougeL_f1" FROM rougeL',
        recursive=True,
    ),
    "rouge_stemmed": _with(
        STEMMED + _rouge(1) + _rouge(2) + LCS,
        f"""SELECT id, checkpoint, {r('rouge1_f1')} AS rouge1_f1, {r('rouge2_f1')} AS rouge2_f1,
          {r("rougeL_f1")} AS "rougeL_f1"
        FROM rouge1 JOIN rouge2 USING (id, checkpoint) JOIN rougeL USING (id, checkpoint)""",
        recursive=True,
    ),
    "output_length": _with(
        PREDS,
        f"""SELECT checkpoint, {r("avg(len(regexp_extract_all(prediction, '\\S+')))")}
          AS avg_output_tokens FROM preds GROUP BY checkpoint""",
    ),
    "completion_rate": _with(
        PREDS,
        f"""SELECT checkpoint, {r(f"avg(CASE WHEN {COMPLETED.format(t=strip('prediction'))} THEN 1.0 ELSE 0.0 END)")}
          AS task_completion_rate FROM preds GROUP BY checkpoint""",
    ),
    "embedding_f1": _with(
        VECTORS,
        f"""SELECT checkpoint, row_id, {r('precision')} AS precision, {r('recall')} AS recall,
          {r('f1')} AS f1 FROM ematch""",
    ),
    "text_metrics": _with(
        TEXT_METRICS,
        f"""SELECT checkpoint, samples, {", ".join(f'{r(c)} AS "{c}"' for c in (
            "avg_output_tokens", "task_completion_rate", "rouge1_f1", "rouge2_f1", "rougeL_f1",
            "bertscore_f1_avg"))} FROM tfull""",
        recursive=True,
    ),
    "predictions": f"""SELECT c.conv_id * 1000 + c.turn AS id, '{C0}' AS checkpoint,
        c.text AS instruction, '' AS input, '' AS task_type, coalesce(a.text, '') AS prediction,
        '' AS reference
      FROM conversations c LEFT JOIN conversations a
        ON a.conv_id = c.conv_id AND a.turn = c.turn + 1 AND a.role = 'assistant'""",
    "pair_plan": _with(
        PLAN,
        "SELECT idx, checkpoint_a, checkpoint_b, swapped, response_a, response_b FROM plan",
    ),
    "completed_judgements": _with(
        JUDGED,
        """SELECT idx, pair, printf('alpaca_eval_%05d', idx) AS prompt_id,
          CASE WHEN swapped THEN second ELSE first END AS checkpoint_a,
          CASE WHEN swapped THEN first ELSE second END AS checkpoint_b, swapped FROM judged""",
    ),
    "completed_judgements_trusting": _with(
        JUDGED,
        """SELECT idx, pair, printf('alpaca_eval_%05d', idx) AS prompt_id,
          coalesce(ca, first) AS checkpoint_a, coalesce(cb, second) AS checkpoint_b,
          CASE WHEN idx % 5 = 0 THEN NOT swapped ELSE swapped END AS swapped FROM judged""",
    ),
    "completed_json_judgements": _with(
        JSON_PREDS,
        """SELECT id AS idx, checkpoint AS asked_checkpoint,
          CASE WHEN fam = 3 THEN 'given' ELSE printf('json_eval_%05d', id) END AS prompt_id,
          CASE WHEN fam = 4 THEN 'other' ELSE checkpoint END AS checkpoint FROM jpreds""",
    ),
    "allowed_judgements": _with(
        JUDGED,
        f"""SELECT pair, count(*) AS n, sum(idx)::BIGINT AS sum_idx FROM judged
        WHERE ca IN ({_IN}) AND cb IN ({_IN}) GROUP BY pair""",
    ),
    "win_tally": _with(
        STATS,
        f"""SELECT checkpoint, wins, losses, ties, total_compares, {r('win_rate')} AS win_rate,
          {r('tie_rate')} AS tie_rate, {r('loss_rate')} AS loss_rate FROM stats""",
    ),
    "judge_summary": _with(
        STATS,
        f"""SELECT checkpoint, {r('win_rate')} AS win_rate, {r('tie_rate')} AS tie_rate,
          {", ".join(f"{r(f'avg_{d}')} AS avg_{d}" for d in DIMENSIONS)} FROM stats""",
    ),
    "head_to_head": _with(
        H2H, f"SELECT total_pairs, ckpt1_wins, ckpt2_wins, ties, {_H2H_RATES} FROM h2h"
    ),
    "head_to_head_positional": _with(
        JUDGED
        + """,
h2h AS (SELECT count(*) AS total_pairs, count(*) FILTER (w = 'a') AS ckpt1_wins,
  count(*) FILTER (w = 'b') AS ckpt2_wins, count(*) FILTER (w NOT IN ('a', 'b')) AS ties
  FROM judged WHERE pair = '1v2')""",
        f"SELECT total_pairs, ckpt1_wins, ckpt2_wins, ties, {_H2H_RATES} FROM h2h",
    ),
    "category_breakdown": _with(
        H2H, "SELECT category, ckpt1_wins, ckpt2_wins, ties, total FROM breakdown"
    ),
    "exemplars": _with(
        H2H,
        """SELECT kind, idx, category, instruction, input, prediction_ckpt1, prediction_ckpt2, winner
        FROM examples""",
    ),
    "metric_deltas": _with(
        TEXT_METRICS,
        "SELECT "
        + ", ".join(
            f'{r(c)} AS "{c}"'
            for c in (
                "rougeL_f1_ckpt1",
                "rougeL_f1_ckpt2",
                "bertscore_f1_ckpt1",
                "bertscore_f1_ckpt2",
                "delta_rougeL_f1_ckpt2_minus_ckpt1",
                "delta_bertscore_f1_ckpt2_minus_ckpt1",
            )
        )
        + " FROM deltas",
        recursive=True,
    ),
    "forgetting_summary": _with(
        TEXT_METRICS + "," + H2H,
        " UNION ALL ".join(f"SELECT {q(k)} AS key, {v} AS value" for k, v in _SUMMARY_ROWS),
        recursive=True,
    ),
    "checkpoint_comparison": _with(
        TEXT_METRICS + "," + STATS + "," + JSON_METRICS,
        f"""SELECT s.checkpoint, {r('s.win_rate')} AS alpaca_judge_win_rate,
          {r('t.rougeL_f1')} AS "rougeL_f1", {r('t.bertscore_f1_avg')} AS bertscore_f1_avg,
          {r('j.json_validity_rate')} AS json_validity_rate,
          {r('j.schema_compliance_rate')} AS schema_compliance_rate,
          {r('j.exact_match_rate')} AS exact_match_rate
        FROM stats s LEFT JOIN tfull t USING (checkpoint) LEFT JOIN jmetrics j USING (checkpoint)""",
        recursive=True,
    ),
    "evaluation_report": _with(
        TEXT_METRICS + "," + STATS + "," + JSON_METRICS,
        f"""SELECT s.checkpoint, {r('s.win_rate')} AS alpaca_judge_win_rate,
          {r('t.rougeL_f1')} AS "rougeL_f1", {r('t.bertscore_f1_avg')} AS bertscore_f1_avg,
          {r('j.json_validity_rate')} AS json_validity_rate,
          {r('j.schema_compliance_rate')} AS schema_compliance_rate,
          {r('j.exact_match_rate')} AS exact_match_rate
        FROM stats s LEFT JOIN tfull t USING (checkpoint) LEFT JOIN jmetrics j USING (checkpoint)""",
        recursive=True,
    ),
    "comparison_without_judgements": _with(
        TEXT_METRICS + "," + JSON_METRICS,
        f"""SELECT l.checkpoint, NULL::DOUBLE AS alpaca_judge_win_rate,
          {r('t.rougeL_f1')} AS "rougeL_f1", {r('t.bertscore_f1_avg')} AS bertscore_f1_avg,
          {r('coalesce(j.json_validity_rate, 0.0)')} AS json_validity_rate,
          {r('coalesce(j.schema_compliance_rate, 0.0)')} AS schema_compliance_rate,
          {r('coalesce(j.exact_match_rate, 0.0)')} AS exact_match_rate
        FROM (VALUES ('{C0}'), ('{C1}'), ('{C2}'), ('ckpt9_absent')) l(checkpoint)
          LEFT JOIN tfull t USING (checkpoint) LEFT JOIN jmetrics j USING (checkpoint)""",
        recursive=True,
    ),
    "missing_paths": _with(
        TURNS, "SELECT instruction, '' AS input, reference AS output FROM turns"
    ),
    "instruction_source": """SELECT kind, text AS instruction, lang AS input, source AS output
      FROM documents, (VALUES ('parquet'), ('jsonl')) k(kind)""",
    "accepted_attempts": _with(LOG, "SELECT idx, attempt, text FROM accepted"),
    "accepted_judge_attempts": _with(LOG, "SELECT idx, attempt, text FROM verdicts"),
    "pending_prompts": _with(
        LOG,
        "SELECT DISTINCT event_id // 5 AS idx FROM events WHERE idx NOT IN (SELECT idx FROM accepted)",
    ),
    "jsonl_roundtrip": _with(
        TURNS,
        "SELECT instruction, NULL::VARCHAR AS input, reference AS output FROM turns",
    ),
    "judgement_files": _with(
        STATS,
        f"""SELECT checkpoint, wins, losses, ties, total_compares,
          {r('avg_clarity')} AS avg_clarity FROM stats""",
    ),
    "report_csv": _with(
        STATS,
        f"SELECT checkpoint, {r('win_rate')} AS win_rate, {r('tie_rate')} AS tie_rate FROM stats",
    ),
    "first_documents": """SELECT user_id, event_id, event_type, props FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "preferred_source": """SELECT user_id, event_id, event_type FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id
        ORDER BY CASE event_type WHEN 'purchase' THEN 0 ELSE 1 END, event_id) = 1""",
    "key_value_report": _with(
        H2H,
        " UNION ALL ".join(
            f"SELECT '{c}' AS key, {c}::VARCHAR AS value FROM h2h"
            for c in ("total_pairs", "ckpt1_wins", "ckpt2_wins", "ties")
        ),
    ),
}

# --- the same results by other ways -------------------------------------------

for _name, _twin in {
    "streamed_attempts": "accepted_attempts",
    "streamed_judge_attempts": "accepted_judge_attempts",
    "streamed_pending": "pending_prompts",
    "incremental_json_metrics": "json_metrics",
    "incremental_error_taxonomy": "json_error_taxonomy",
    "incremental_judge_stats": "win_tally",
    "bucketed_pair_plan": "pair_plan",
    "bucketed_category_breakdown": "category_breakdown",
}.items():
    ORACLE[_name] = ORACLE[_twin]

ORACLE["incremental_text_metrics"] = "SELECT * EXCLUDE (bertscore_f1_avg) FROM (" + ORACLE["text_metrics"] + ")"

_RUN_STATS = ("win_rate", "tie_rate", "avg_clarity")


def _run(name: str, condition: str) -> str:
    """Statistics of the judgements that meet a condition, as CTEs of a run."""
    chosen = STATS[len(JUDGED):].replace("FROM judged WHERE", f"FROM judged WHERE {condition} AND")
    return chosen.replace("sides", f"sides_{name}").replace("stats AS", f"stats_{name} AS")


ORACLE["run_deltas"] = _with(
    JUDGED + _run("base", "true") + _run("ablation", "idx % 2 = 1"),
    "SELECT checkpoint, "
    + ", ".join(
        f"{r(f'coalesce(a.{c}, 0)')} AS {c}_run1, {r(f'coalesce(b.{c}, 0)')} AS {c}_run2, "
        f"{r(f'coalesce(b.{c}, 0) - coalesce(a.{c}, 0)')} AS delta_{c}"
        for c in _RUN_STATS
    )
    + " FROM stats_base a FULL JOIN stats_ablation b USING (checkpoint)",
)

_LEVELS = {
    "total": "()", "pair": "(first, second)", "category": "(category)", "swapped": "(swapped)",
    "pair, category": "(first, second, category)", "pair, swapped": "(first, second, swapped)",
}
ORACLE["outcome_report"] = _with(
    H2H
    + """,
everyone AS (
  SELECT j.*, category, ca IS NOT NULL AND cb IS NOT NULL AS named,
    coalesce(CASE w WHEN 'a' THEN ca WHEN 'b' THEN cb END, '') AS winner
  FROM judged j JOIN prompts USING (idx)),
grouped AS (
  SELECT first, second, category, swapped,
    grouping(first, second, category, swapped) AS gid, count(*) AS total,
    count(*) FILTER (named AND winner = first) AS wins_first,
    count(*) FILTER (named AND winner = second) AS wins_second,
    count(*) FILTER (named AND w = 'tie') AS ties,
    count(*) FILTER (winner NOT IN (first, second)) AS undecided,
    min(idx) FILTER (winner = first) AS regression_idx, min(idx) FILTER (winner = second) AS improvement_idx
  FROM everyone GROUP BY GROUPING SETS (""" + ", ".join(_LEVELS.values()) + "))",
    f"""SELECT CASE gid WHEN 15 THEN 'total' WHEN 3 THEN 'pair' WHEN 13 THEN 'category' WHEN 14 THEN 'swapped'
      WHEN 1 THEN 'pair, category' WHEN 2 THEN 'pair, swapped' END AS level,
      first, second, category, swapped, total, wins_first, wins_second, ties, undecided,
      {r('wins_first / total')} AS wins_first_rate, {r('wins_second / total')} AS wins_second_rate,
      {r('ties / total')} AS ties_rate, regression_idx, improvement_idx FROM grouped""",
)
ORACLE["bucketed_outcome_report"] = ORACLE["outcome_report"]

# Alternatives are tried in their order: longer pieces come first.
_SEGMENTS = "(?s)" + "|".join(p.replace(".", "[.]") for p in sorted(VOCABULARY, key=len, reverse=True)) + "|."
ORACLE["token_budget_segmented"] = (
    ORACLE["token_budget"].replace("'\\S+'", q(_SEGMENTS)).replace("array_to_string(t[1:64], ' ')", "array_to_string(t[1:64], '|')")
)
ORACLE["output_length_segmented"] = ORACLE["output_length"].replace("'\\S+'", q(_SEGMENTS))

_NEAR = LEAKY + r""",
texts AS (SELECT ck, any_value(text) AS text FROM leaky GROUP BY ck),
worded AS (SELECT ck, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM texts),
sets AS (
  SELECT ck, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded),
elements AS (SELECT ck, len(s) AS size, unnest(s) AS e FROM sets),
near AS (
  SELECT a.ck AS x, b.ck AS y FROM elements a JOIN elements b ON a.e = b.e AND a.ck <> b.ck
  GROUP BY a.ck, b.ck HAVING 9 * count(*) >= 4 * (any_value(a.size) + any_value(b.size))
  UNION ALL
  SELECT a.ck, b.ck FROM sets a JOIN sets b ON len(a.s) = 0 AND len(b.s) = 0 AND a.ck <> b.ck),
reach(ck, other) AS (
  SELECT x, x FROM near
  UNION
  SELECT reach.ck, near.y FROM reach JOIN near ON near.x = reach.other),
grouped AS (SELECT ck, min(other) AS grp, count(*) AS size FROM reach GROUP BY ck),
numbers AS (SELECT count(*) AS n, least(100, count(*) - 1) AS target, (SELECT count(*) FROM grouped) AS m FROM texts),
ordered AS (
  SELECT grp, sum(size) OVER (ORDER BY md5('42|' || grp) || '|' || grp) AS stop
  FROM (SELECT DISTINCT grp, size FROM grouped)),
taken AS (
  SELECT ck FROM grouped JOIN ordered USING (grp) CROSS JOIN numbers WHERE stop <= target * m // n),
singles AS (
  SELECT ck, row_number() OVER (ORDER BY md5('42|' || ck) || '|' || ck) AS pos
  FROM texts WHERE ck NOT IN (SELECT ck FROM grouped)),
evals AS (
  SELECT ck FROM taken UNION ALL
  SELECT ck FROM singles CROSS JOIN numbers WHERE pos <= target - (SELECT count(*) FROM taken)),
split_n AS (
  SELECT doc_id, copy_no, ck, CASE WHEN ck IN (SELECT ck FROM evals) THEN 'eval' ELSE 'train' END AS split FROM leaky)"""


def _near_overlap(table: str) -> str:
    return f"""(SELECT count(DISTINCT e.ck) FROM {table} e JOIN (
        SELECT x, y FROM near UNION ALL SELECT ck, ck FROM texts) ON e.ck = x
      JOIN {table} t ON t.ck = y AND t.split = 'train' WHERE e.split = 'eval')"""


ORACLE["split_near_copies"] = _with(_NEAR, "SELECT doc_id, copy_no, split FROM split_n", recursive=True)
ORACLE["near_copy_overlap"] = _with(
    _NEAR,
    f"""SELECT 'position' AS by, {_near_overlap('split_p')} AS n_near_overlap
    UNION ALL SELECT 'content', {_near_overlap('split_c')} UNION ALL SELECT 'near copies', 0""",
    recursive=True,
)
