"""Word tokens, their stems, n-grams and overlaps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from evalspark.functions.stem import porter_stem
from evalspark.functions.text import or_empty

# --- fixed values ---------------------------------------------------------
# A scored token is a run of these; words of up to three letters keep their form.
WORD = "[a-z0-9]+"
LONGEST_UNSTEMMED = 3
# --------------------------------------------------------------------------


def word_tokens(c: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(or_empty(c)), F.lit(WORD), F.lit(0))


# Stems a task has met. A plain dict goes to the workers by value, as the functions here do; an
# object that wraps a function would be looked up in this package, which workers need not have.
_STEMS: dict[str, str] = {}
_STEMS_KEPT = 200_000


def _stem(word: str) -> str:
    if len(word) <= LONGEST_UNSTEMMED:
        return word
    stem = _STEMS.get(word)
    if stem is None:
        if len(_STEMS) == _STEMS_KEPT:
            _STEMS.clear()
        stem = _STEMS[word] = porter_stem(word)
    return stem


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stems of token lists; the work per batch is one stem per distinct token."""
    encoded = tokens.flatten().dictionary_encode()
    stems = pa.array([_stem(w) for w in encoded.dictionary.to_pylist()], pa.string())
    # Offsets of a sliced batch do not start at 0, those of its flat values do.
    starts = pc.subtract(tokens.offsets, tokens.offsets[0])
    return pa.ListArray.from_arrays(starts, stems.take(encoded.indices))


# Reference tokens of one block of the LCS: the bits of one integer.
LCS_BLOCK = 4096


def _lcs(candidate: list[int], reference: list[int], block: int = LCS_BLOCK) -> int:
    """Length of the longest common subsequence, one bit per reference token.

    Common ends are counted at once; between them runs the bit-parallel recurrence of
    Hyyro (2004), where unset bits mark row growth. The reference is taken in blocks, one
    after the other: all that a block hands on is, for each candidate token, the carry of its sum.
    So memory holds the places of one block's tokens and a byte per candidate token.
    """
    shorter, ends = min(len(candidate), len(reference)), 0
    while ends < shorter and candidate[ends] == reference[ends]:
        ends += 1
    behind = 0
    while behind < shorter - ends and candidate[-1 - behind] == reference[-1 - behind]:
        behind += 1
    candidate = candidate[ends : len(candidate) - behind]
    reference = reference[ends : len(reference) - behind]
    common = set(reference).intersection(candidate)
    candidate = [code for code in candidate if code in common]
    reference = [code for code in reference if code in common]
    length, carries = ends + behind, bytearray(len(candidate))
    for at in range(0, len(reference), block):
        places: dict[int, int] = {}
        part = reference[at : at + block]
        for i, code in enumerate(part):
            places[code] = places.get(code, 0) | (1 << i)
        width = len(part)
        full = (1 << width) - 1
        row = full
        for k, code in enumerate(candidate):
            hits = row & places.get(code, 0)
            carry = carries[k]
            if hits or carry:
                total = row + hits + carry
                carries[k] = total >> width
                row = ((total & full) | (row - hits))
        length += width - row.bit_count()
    return length


@F.arrow_udf(T.LongType())
def lcs_length(candidate: pa.Array, reference: pa.Array) -> pa.Array:
    """Longest common subsequence of two token lists."""
    left, right = candidate.flatten(), reference.flatten()
    codes = pa.concat_arrays([left, right]).dictionary_encode().indices

    def lists(tokens: pa.Array, shift: int) -> Iterator[list[int]]:
        ends = pc.add(pc.subtract(tokens.offsets, tokens.offsets[0]), shift).to_pylist()
        return (codes.slice(a, b - a).to_pylist() for a, b in zip(ends, ends[1:]))

    pairs = zip(lists(candidate, 0), lists(reference, len(left)))
    return pa.array([_lcs(c, r) for c, r in pairs], pa.int64())


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens as texts; tokens hold no space, so this is unambiguous."""
    if n == 1:
        return tokens
    places = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    grams = F.transform(places, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def clipped_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two lists of texts.

    Sorts both together and walks over runs of equal texts, so the cost is that of
    the sort and no row leaves its task.
    """
    tagged = F.sort_array(
        F.concat(
            F.transform(a, lambda x: F.struct(x.alias("gram"), F.lit(0).alias("side"))),
            F.transform(b, lambda x: F.struct(x.alias("gram"), F.lit(1).alias("side"))),
        )
    )
    start = F.struct(
        F.lit("").alias("gram"), F.lit(0).alias("open"), F.lit(0).cast("bigint").alias("both")
    )

    # Within a run the a-side comes first: it opens places that the b-side takes.
    def step(state: Column, x: Column) -> Column:
        left = F.when(state["gram"] == x["gram"], state["open"]).otherwise(0)
        taken = (x["side"] == 1) & (left > 0)
        return F.struct(
            x["gram"].alias("gram"),
            F.when(x["side"] == 0, left + 1).when(taken, left - 1).otherwise(left).alias("open"),
            (state["both"] + taken.cast("bigint")).alias("both"),
        )

    return F.aggregate(tagged, start, step)["both"]
