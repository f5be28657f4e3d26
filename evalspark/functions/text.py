"""Text expressions: clean-up, prompt texts, token budgets and keyword rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

# --- fixed values ---------------------------------------------------------
# Characters that Unicode-aware stripping removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# An answer holding one of these (lower-cased) did not complete its task.
FAILURE_MARKERS = (
    "i can't",
    "i cannot",
    "unable to",
    "as an ai",
    "i'm an ai",
    "sorry",
    "{}",
    "null",
    "[]",
)

# Instruction categories in order of precedence; the first rule that hits wins.
CATEGORY_KEYWORDS = (
    ("summarization", ("summar",)),
    ("rewriting", ("rewrite", "rephrase", "reword")),
    ("brainstorming", ("brainstorm", "ideas")),
    (
        "qa",
        (
            "question",
            "answer",
            " who ",
            " what ",
            " when ",
            " where ",
            " why ",
            " how ",
        ),
    ),
)
DEFAULT_CATEGORY = "open_ended"
# --------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode spaces included."""
    return F.btrim(c, F.lit(WHITESPACE))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def contains_any(c: Column, needles) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | c.contains(needle)
    return found


def training_text(instruction: Column, input_: Column, output: Column) -> Column:
    """The text a model is trained on: instruction, input and response."""
    return F.concat(
        F.lit("Instruction: "), instruction, F.lit("\nInput: "), input_, F.lit("\nResponse: "), output
    )


def generation_prompt(instruction: Column, input_: Column) -> Column:
    """The training text up to the response, with nulls as empty strings."""
    return training_text(or_empty(instruction), or_empty(input_), F.lit(""))


def chat_prompt(
    instruction: Column, input_: Column, template: tuple[str, str] | None = None
) -> Column:
    """One user turn between the markers of a chat template.

    ``template`` is the text before and after the turn; without a template the
    plain generation prompt is used.
    """
    if template is None:
        return generation_prompt(instruction, input_)
    turn = strip(F.concat(strip(or_empty(instruction)), F.lit("\n"), strip(or_empty(input_))))
    before, after = template
    return F.concat(F.lit(before), turn, F.lit(after))


def fill(template: str, mapping: Mapping[str, Column]) -> Column:
    """Replace ``__NAME__`` by each value in mapping order.

    Replacement is sequential: a value that itself holds a later placeholder is
    expanded too.
    """
    text = F.lit(template)
    for name, value in mapping.items():
        text = F.replace(text, F.lit(f"__{name.upper()}__"), or_empty(value))
    return text


def tokens(c: Column, tokenizer: str | Callable[[Column], Column] = r"\S+") -> Column:
    """Tokens of a text: the matches of a pattern, or what a function of the text makes of it."""
    if callable(tokenizer):
        return tokenizer(c)
    return F.regexp_extract_all(or_empty(c), F.lit(tokenizer), F.lit(0))


def token_budget(
    c: Column, max_tokens: int, tokenizer: str | Callable[[Column], Column] = r"\S+"
) -> Column:
    """Keep the first ``max_tokens`` tokens; returns tokens, n_tokens, truncated.

    ``tokenizer`` is a pattern or a function from a text to its list of tokens, such as
    ``segment.longest_match`` of a vocabulary.
    """
    found = F.transform(
        F.array(tokens(c, tokenizer)),
        lambda t: F.struct(
            F.slice(t, 1, max_tokens).alias("tokens"),
            F.least(F.size(t), F.lit(max_tokens)).alias("n_tokens"),
            (F.size(t) > max_tokens).alias("truncated"),
        ),
    )
    return F.get(found, F.lit(0))


def task_completed(c: Column, min_chars: int = 20) -> Column:
    """Long enough after stripping, and free of every failure marker."""
    t = strip(or_empty(c))
    return (
        (F.length(t) > 0)
        & (F.length(t) >= min_chars)
        & ~contains_any(F.lower(t), FAILURE_MARKERS)
    )


def instruction_category(c: Column) -> Column:
    """First matching category of ``CATEGORY_KEYWORDS``, else open_ended."""
    s = F.lower(or_empty(c))
    rule = None
    for category, keywords in CATEGORY_KEYWORDS:
        hit = contains_any(s, keywords)
        rule = F.when(hit, category) if rule is None else rule.when(hit, category)
    return rule.otherwise(F.lit(DEFAULT_CATEGORY))


def hash32(c: Column) -> Column:
    """First 32 bits of md5 as a non-negative BIGINT; the same in every SQL engine."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")
