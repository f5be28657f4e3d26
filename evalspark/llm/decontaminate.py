"""Benchmark passages in documents by spaced seeds, in DataFrame operations only.

Every run of SPAN words is hashed once per mask; a mask looks at WEIGHT of the SPAN words
and ignores the others, so a substituted word only spoils the seeds that look at it.
Seeds of benchmark items and of documents are joined on their hash. Around a hit, WINDOW
words of both sides are compared position by position: the hit counts if at least
MIN_SHARE of them agree in one window that holds the seed.

Items below SHORT words have masks of their own length. They may differ in so few words that
dealing the positions over one mask more than that leaves one mask whole: nothing that the comparison
would accept is missed. From SHORT words on the fixed masks leave none out either. Documents unroll the
short masks only of lengths that the benchmark has.

Documents are never shuffled for this: positions are unrolled within the scan and meet
the benchmark's seeds there while these number at most BROADCAST_SEEDS (counted first). A
larger benchmark makes a filter of SEED_BITS bits for each seed, FILTER_BITS at most, that the scan looks
seeds up in: the few that pass are joined by hash of the seeds, along with the words around them; both
ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.llm.common import text_or_empty

SPAN = 9
#: Positions looked at; six of nine words each.
MASKS = ((0, 1, 3, 5, 7, 8), (0, 1, 2, 5, 6, 8), (0, 2, 3, 4, 7, 8), (0, 3, 4, 6, 7, 8))
WINDOW = 13
MIN_SHARE = 0.8
BROADCAST_SEEDS = 200_000
SHORT = 12
#: Bits of the filter for each seed, all of them at most, and numbers of the filter put together at once.
SEED_BITS, FILTER_BITS, FILTER_BLOCK = 16, 1 << 27, 4096
_LEAD = WINDOW - SPAN  # words of the first window before the seed
_WIDE = _LEAD + WINDOW  # words from the first to the last window that holds a seed


def word_hashes(text: Column) -> Column:
    """Hashes of the words, case and punctuation aside."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _around(words: Column, at: Column) -> Column:
    """The words from WINDOW-SPAN before ``at`` on, _WIDE of them, without those outside the text."""
    return F.slice(words, F.greatest(at - _LEAD, F.lit(0)) + 1, F.least(at, F.lit(_LEAD)) + WINDOW)


def _nth(around: Column, at: Column, k: int) -> Column:
    """Word ``k`` of the _WIDE ones around ``at``; null outside the text."""
    return F.get(around, F.least(at - _LEAD, F.lit(0)) + k)


def short_masks(length: int) -> list[tuple[int, ...]]:
    """Positions dealt over one mask more than an item of ``length`` words may have substitutions."""
    spare = length - math.ceil(length * MIN_SHARE)
    return [tuple(range(k, length, spare + 1)) for k in range(spare + 1)]


def _spot_seeds(words: Column, at: Column, masks, family: int) -> Column:
    """The seeds of one place; null where a mask looks beyond the text."""

    def seed(i: int, mask: tuple[int, ...]) -> Column:
        hashed = F.xxhash64(F.lit(family), F.lit(i), *(F.get(words, at + o) for o in mask))
        return F.when((at + mask[0] >= 0) & (at + mask[-1] < F.size(words)), hashed)

    return F.array(*(seed(i, mask) for i, mask in enumerate(masks)))


def _seeds(df: DataFrame, key: str, lengths: Sequence[int] = (), whole: bool = True, may: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, _words, _at, _seed): each position's seeds, one per mask.

    ``whole``: the seeds of MASKS; ``lengths``: of short items, whose places may reach beyond the text by
    as many words as may differ. ``may`` tells of a seed whether to keep it.

    Places are unrolled in generated code, which keeps a text's rows until all of them are made. What is added
    to a place must be generated code too: else each of its rows would be a copy of all the words.
    """
    places, n = [], F.size("_words")
    if whole:
        # The outer form keeps Spark from adding a filter that would hash all words twice.
        places.append((F.when(n >= SPAN, F.sequence(F.lit(0), n - SPAN)), MASKS, 0))
    for length in lengths:
        masks = short_masks(length)
        spare = len(masks) - 1
        reach = F.when((n > 0) & (n >= length - spare), F.sequence(F.lit(-spare), n - length + spare))
        places.append((reach, masks, length))
    out = None
    for spots, masks, family in places:
        each = df.select(key, "_words", F.explode_outer(spots).alias("_at")).filter("_at IS NOT NULL")
        if family:
            seeds = _spot_seeds(F.col("_words"), F.col("_at"), masks, family)
        else:
            hashed = [
                F.xxhash64(F.lit(i), *(F.col("_words")[F.col("_at") + o] for o in mask))
                for i, mask in enumerate(masks)
            ]
            seeds = F.array(*hashed)
        part = each.select(key, "_words", "_at", F.explode(seeds).alias("_seed"))
        if family:
            part = part.filter("_seed IS NOT NULL")
        if may is not None:
            part = part.filter(may(F.col("_seed")))
        out = part if out is None else out.unionByName(part)
    return out


def filter_bits(seeds: int) -> int:
    """The bits of a filter for so many seeds: a power of two, FILTER_BITS at most."""
    wanted = 1 << max(12, (max(1, seeds) * SEED_BITS - 1).bit_length())
    return min(FILTER_BITS, wanted)


def _marks(seed: Column) -> Column:
    """A number with the four bits that a seed has in its word of the filter."""
    one, marks = F.lit(1).cast("bigint"), None
    for k in range(4):
        place = F.shiftrightunsigned(seed, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", one, place)
        marks = bit if marks is None else marks.bitwiseOR(bit)
    return marks


def _word(seed: Column, bits: int) -> Column:
    """Which number of a filter of ``bits`` bits, a power of two, has a seed's bits."""
    return F.shiftrightunsigned(seed, 32).bitwiseAND(F.lit(bits // 64 - 1).cast("bigint")).cast("int")


def seed_filter(seeds: DataFrame, bits: int) -> Column:
    """``bits`` bits as one array of numbers, with four bits set for each seed, all in one number."""
    size = bits // 64
    block = min(size, FILTER_BLOCK)
    marked = seeds.select(_word(F.col("_seed"), bits).alias("_word"), _marks(F.col("_seed")).alias("_bits"))
    every = seeds.sparkSession.range(size).select(F.col("id").cast("int").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    words = marked.unionByName(every).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))

    def listed(df: DataFrame, number: str, value: str, *by: str) -> DataFrame:
        rows = F.sort_array(F.collect_list(F.struct(number, value)))
        return df.groupBy(*by).agg(F.transform(rows, lambda r: r[value]).alias("_bits"))

    # A number of words that does not grow past FILTER_BITS / 64, put together block by block.
    blocks = listed(words.withColumn("_block", F.floor(F.col("_word") / block)), "_word", "_bits", "_block")
    return listed(blocks, "_block", "_bits").select(F.flatten("_bits")).scalar()


def may_hold(words: Column, bits: int, seed: Column) -> Column:
    """Whether a filter has all of a seed's bits. It is read in one place, as tasks are sent it once per place."""
    return F.bitwise_not(F.get(words, _word(seed, bits))).bitwiseAND(_marks(seed)) == 0


def _agreeing(equal: Sequence[Column], need: Column, width: Column) -> Column:
    """Whether some window of ``width`` words holding the seed has ``need`` equal words.

    ``equal``: of each of the _WIDE words whether it is. In bits of one number, as this stays in generated code.
    """
    same = None
    for k, x in enumerate(equal):
        bit = F.when(x, F.lit(1 << k)).otherwise(F.lit(0))
        same = bit if same is None else same.bitwiseOR(bit)
    wide = F.call_function("shiftleft", F.lit(1), width) - 1
    found = None
    for s in range(WINDOW - SPAN + 1):
        enough = F.bit_count(F.shiftright(same, s).bitwiseAND(wide)) >= need
        found = enough if found is None else found | enough
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_items, hits): documents that hold a benchmark passage.

    Items of equal words count as one: item_id is the smallest of them, n_items their
    number. ``hits`` counts verified seed positions. A null text has no words, and an item without
    words matches nothing; an item of fewer than WINDOW words must agree in MIN_SHARE of its own length,
    so one of a few words matches wherever these stand. Rows that repeat a doc_id add up
    their hits. Empty tables give no rows; other columns are not read.
    """
    items = (
        benchmark.select(word_hashes(text_or_empty()).alias("_words"), "item_id")
        .groupBy("_words")
        .agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
        .withColumn("_length", F.size("_words"))
    )
    short = items.filter(F.col("_length").between(1, SHORT - 1))
    kinds = items.filter("_length > 0").groupBy(F.when(F.col("_length") < SHORT, F.col("_length")).alias("_short"))
    # SHORT rows at most: how many items, and how many places of spans in them.
    kinds = kinds.agg(F.count("*").alias("n"), F.sum(F.col("_length") - SPAN + 1).alias("places")).collect()
    lengths = sorted(r["_short"] for r in kinds if r["_short"] is not None)
    n_seeds = sum(r["n"] * len(short_masks(r["_short"])) if r["_short"] is not None else r["places"] * len(MASKS) for r in kinds)
    named = F.struct("item_id", "n_items", "_length").alias("_item")
    sides = _seeds(items.filter(F.col("_length") >= SHORT).select(named, "_words"), "_item")
    for length in lengths:
        own = short.filter(F.col("_length") == length).select(named, "_words", F.lit(0).alias("_at"))
        masks = _spot_seeds(F.col("_words"), F.col("_at"), short_masks(length), length)
        sides = sides.unionByName(own.withColumn("_seed", F.explode(masks)))
    theirs = _around(F.col("_words"), F.col("_at")).alias("_theirs")
    seeds = sides.select("_seed", "_item", F.col("_at").alias("_from"), theirs)
    mine, at = docs.select("doc_id", word_hashes(text_or_empty()).alias("_words")), F.col("_at")
    if n_seeds <= BROADCAST_SEEDS:
        hits = _seeds(mine, "doc_id", lengths).join(F.broadcast(seeds), "_seed")
        own = [F.get("_words", at + (k - _LEAD)) for k in range(_WIDE)]
    else:
        bits = filter_bits(n_seeds)
        words = seed_filter(sides, bits)
        found = _seeds(mine, "doc_id", lengths, may=lambda seed: may_hold(words, bits, seed))
        # What passes takes along the words it is compared by, so documents need not be met again.
        found = found.select("doc_id", "_at", "_seed", _around(F.col("_words"), at).alias("_mine"))
        hits = found.join(seeds, "_seed")
        own = [_nth(F.col("_mine"), at, k) for k in range(_WIDE)]
    equal = [x == _nth(F.col("_theirs"), F.col("_from"), k) for k, x in enumerate(own)]
    width = F.least(F.lit(WINDOW), F.col("_item._length"))
    need = F.ceil(width * F.lit(MIN_SHARE)).cast("int")
    agrees = _agreeing(equal, need, width)
    # Verified in the aggregate, not by a filter: a filter would become part of the join's
    # condition, take the join out of generated code and build every unrolled row in full.
    return (
        hits.groupBy("doc_id", F.col("_item.item_id").alias("item_id"))
        .agg(F.max("_item.n_items").alias("n_items"), F.sum(agrees.cast("long")).alias("hits"))
        .filter("hits > 0")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, null_ids_stay: bool = True) -> DataFrame:
    """The documents without a benchmark passage, all their columns.

    Rows are told apart by id and text. Null ids stay, unless ``null_ids_stay`` is false.
    """
    key = F.struct("doc_id", F.xxhash64(text_or_empty()).alias("_text"))
    leaks = contaminated(docs.select(key.alias("doc_id"), "text"), benchmark).select("doc_id.*").distinct()
    leaks = leaks.select(F.col("doc_id").alias("_id"), "_text")
    if null_ids_stay:
        leaks = leaks.filter("_id IS NOT NULL")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_or_empty()) == F.col("_text"))
    return docs.join(leaks, same, "left_anti").select(*(f"`{c}`" for c in docs.columns))
