"""Toxicity by a small convolutional text classifier, trained and applied in numpy.

A word is the sum of two hashed embeddings, one of the word and one of its first letters.
Filters of one, two and three words slide over the whole text, each keeps its largest
response (never below zero), and a logistic layer weighs these maxima. Embeddings start
from smoothed log-odds of the training texts and are trained further with the
filters by stochastic gradients; a maximum passes its gradient to the words it came from.
Scores are scaled on texts left out of training, and each language gets the threshold
with the best F1 there. Language, source, id and label never enter a score.

The classifier learns from all labelled documents. Only their texts move, once, to shards of about SHARD_BYTES that a hash
of the id deals them to; a shard is written as rows of coded words that every round reads in place. In each of EPOCHS rounds every shard trains on from the same model in a task of its own, and the models they
come to are averaged, each embedding over the shards that moved it. The fitted arrays have a fixed size and are broadcast;
scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from evalspark.llm.common import materialise, text_or_empty
from evalspark.llm.tokens import split_words

#: Two numbers a word of the texts in one shard that are learned from; a fourth as much is for calibration.
SHARD_BYTES = 16 << 20
WORD = r"[^\x20\x09-\x0D]+"
#: Of the filter that leaves most texts without a label where they are, built in so many blocks.
FILTER_BITS, FILTER_BLOCKS = 1 << 26, 64
WORDS, STEMS, STEM = 1 << 18, 1 << 16, 5
SIZE, FILTERS, WIDTHS = 8, 6, (1, 2, 3)
EPOCHS, BATCH, RATE = 3, 64, 0.02
STEPS = 300  # small samples are gone over more often, until so many steps
CUT = 0.3
SLICE = 200_000  # words convolved at once
HELD_BYTES = 16 << 20  # of coded texts that mini-batches are drawn from
BINS = 256  # of a raw score's unit, when scores are scaled
SPAN = 60  # raw scores further from zero are taken as this
BLOCK = 1024  # embeddings averaged together
PORTION = 4 << 20
MARKS = ".,;:!?\"'()[]{}*#%&$-_|<>«»¿¡"


class Model(NamedTuple):
    words: np.ndarray
    stems: np.ndarray
    filters: np.ndarray  # (SIZE, sum of widths * FILTERS): width by width, offset by offset
    bias: np.ndarray
    weights: np.ndarray
    last: float
    scale: tuple[float, float]
    thresholds: dict[str, float]


def hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The embedding rows of words: by the bare word and by its first letters."""
    bare = [w.strip(MARKS) for w in words]
    whole = [zlib.crc32(w.encode()) % WORDS for w in bare]
    stem = [zlib.crc32(w[:STEM].encode()) % STEMS for w in bare]
    return np.array(whole, np.int64), np.array(stem, np.int64)


def coded(texts: pa.Array):
    """(distinct words, each position's word, words per text) of an Arrow text array."""
    words, counts = split_words(pc.utf8_lower(texts.cast(pa.large_string())))
    code = words.dictionary_encode()
    return code.dictionary.to_pylist(), code.indices.to_numpy().astype(np.int64), counts


def token_rows(texts: pa.Array, at_once: int = 500):
    """Embedding rows of all words of the texts, a few texts at a time, and words per text."""
    whole, stem, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for at in range(0, len(texts), at_once):
        words, which, count = coded(texts.slice(at, at_once))
        a, b = hashed(words)
        whole.append(a.astype(np.int32)[which])
        stem.append(b.astype(np.int32)[which])
        counts.append(count)
    return np.concatenate(whole), np.concatenate(stem), np.concatenate(counts)


def _columns(width: int, offset: int) -> slice:
    at = (sum(w for w in WIDTHS if w < width) + offset) * FILTERS
    return slice(at, at + FILTERS)


def responses(table: np.ndarray, bias: np.ndarray, at: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Filter responses at each position; zero where the text ends within a filter.

    ``table`` has every distinct word's product with all filters, ``at`` the words (two more
    than there are positions), ``room`` the words from a position to its text's end.
    """
    n = len(room)
    out = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
    for k, width in enumerate(WIDTHS):
        total = table[at[:n], _columns(width, 0)] + bias[k * FILTERS : (k + 1) * FILTERS]
        for o in range(1, width):
            total += table[at[o : o + n], _columns(width, o)]
        total[room < width] = 0
        out[:, k * FILTERS : (k + 1) * FILTERS] = total
    return out


def pooled(table, bias, which: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each text's largest responses, slice by slice over all its words."""
    best = np.zeros((len(counts), len(WIDTHS) * FILTERS), np.float32)
    ends = np.repeat(np.cumsum(counts), counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    padded = np.concatenate((which, np.zeros(2, np.int64)))
    for a in range(0, len(which), SLICE):
        b = min(a + SLICE, len(which))
        found = responses(table, bias, padded[a : b + 2], ends[a:b] - np.arange(a, b))
        mine = owner[a:b]
        starts = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
        texts = mine[starts]
        best[texts] = np.maximum(best[texts], np.maximum.reduceat(found, starts, axis=0))
    return best


def logits(model: Model, texts: pa.Array) -> np.ndarray:
    words, which, counts = coded(texts)
    if not len(which):
        return np.full(len(counts), model.last)
    whole, stem = hashed(words)
    table = (model.words[whole] + model.stems[stem]) @ model.filters
    return pooled(table, model.bias, which, counts) @ model.weights + model.last


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores of the texts, computed for PORTION bytes of them at a time."""
    a, b = model.scale
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    portion = np.cumsum(sizes.astype(np.int64)) // PORTION
    bounds = [0, *(np.flatnonzero(np.diff(portion)) + 1).tolist(), len(texts)]
    found = [logits(model, texts.slice(i, j - i)) for i, j in zip(bounds, bounds[1:]) if j > i]
    z = np.concatenate(found) if found else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))


class Example(NamedTuple):
    """A labelled text as its words' embedding rows."""

    label: float
    lang: str | None
    whole: np.ndarray
    stem: np.ndarray


#: Goes over the same texts in the same order each time it is called.
Examples = Callable[[], Iterable[Example]]


def examples(texts: pa.Array, labels, langs) -> list[Example]:
    whole, stem, counts = token_rows(texts)
    ends = np.cumsum(counts)
    return [
        Example(float(y), lang, whole[b - n : b], stem[b - n : b]) for y, lang, b, n in zip(labels, langs, ends, counts)
    ]


def seen_rows(rows: Iterable[Example]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By kind of embedding: the rows seen, in how many texts and in how many toxic ones."""
    found = {}
    rows = list(rows)
    for kind, size in (("whole", WORDS), ("stem", STEMS)):
        held = [np.unique(getattr(r, kind)) for r in rows]
        every = np.concatenate([*held, np.zeros(0, np.int32)]).astype(np.int64)
        toxic = np.repeat([r.label for r in rows], [len(h) for h in held])
        n, yes = np.bincount(every, minlength=size), np.bincount(every, toxic, size)
        at = np.flatnonzero(n)
        found[kind] = at, n[at], yes[at]
    return found


def _log_odds(seen, n_texts: float, n_toxic: float, size: int) -> np.ndarray:
    """Smoothed log-odds of the texts that hold each hashed word, shrunk where rare."""
    n, yes = np.zeros(size), np.zeros(size)
    n[seen[0]], yes[seen[0]] = seen[1], seen[2]
    odds = np.log((yes + 0.5) / (n_toxic + 1)) - np.log((n - yes + 0.5) / (n_texts - n_toxic + 1))
    return (np.clip(odds, -3, 6) * n / (n + 2)).astype(np.float32)


def untrained(seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    total = sum(WIDTHS) * FILTERS
    return Model(
        rng.normal(0, 0.05, (WORDS, SIZE)).astype(np.float32),
        rng.normal(0, 0.05, (STEMS, SIZE)).astype(np.float32),
        rng.normal(0, 0.2, (SIZE, total)).astype(np.float32),
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32),
        -2.0,
        (1.0, 0.0),
        {},
    )


def fit(learned: Examples, held: Examples, n_texts: int, n_toxic: float, seen, prior: tuple[int, float]) -> Model:
    """Train on some texts (``learned``: so many, so many of them toxic, their ``seen_rows``), scale and
    set thresholds on others (``held``). ``prior``: number and toxic ones of both."""
    model = started(n_texts, n_toxic, seen, prior)
    if not learnable(n_texts, prior):
        return model
    power = fresh_power(model)
    return _calibrated(_train(model, power, learned, epochs(n_texts)), held)


def learnable(n_texts: int, prior: tuple[int, float]) -> bool:
    """Whether there are enough texts, of both kinds."""
    return prior[0] >= 10 and prior[1] not in (0, prior[0]) and n_texts > 0


def epochs(n_texts: int) -> int:
    return max(EPOCHS, -(-STEPS * BATCH // n_texts))


def started(n_texts: int, n_toxic: float, seen, prior: tuple[int, float]) -> Model:
    """The model that training begins with; without enough texts it gives all the share of toxic ones."""
    model = untrained()
    if not learnable(n_texts, prior):
        share = (prior[1] + 0.5) / (prior[0] + 1) if prior[0] else 0.01
        return model._replace(weights=model.weights * 0, last=float(np.log(share / (1 - share))))
    model.words[:, 0] = _log_odds(seen["whole"], n_texts, n_toxic, WORDS)
    model.stems[:, 0] = _log_odds(seen["stem"], n_texts, n_toxic, STEMS)
    for width in WIDTHS:  # one filter of each width starts from the log-odds
        for o in range(width):
            model.filters[0, _columns(width, o).start] = 1 / width
    model.weights[::FILTERS] = 0.4
    return model


def fresh_power(model: Model) -> dict[str, np.ndarray]:
    """The sums of squared gradients before the first step."""
    power = {k: np.full_like(getattr(model, k), 1e-3) for k in ("words", "stems", "filters", "bias", "weights")}
    return power | {"last": np.array([1e-3])}


def _shuffled_batches(rows: Iterable[Example], rng) -> Iterator[list[Example]]:
    """Mini-batches drawn from a buffer of HELD_BYTES, which the rows pass through."""
    held, size = [], 0
    for x in rows:
        held.append(x)
        size += x.whole.nbytes + x.stem.nbytes
        if size > HELD_BYTES and len(held) > BATCH:
            rng.shuffle(held)
            batch, held = held[:BATCH], held[BATCH:]
            size -= sum(x.whole.nbytes + x.stem.nbytes for x in batch)
            yield batch
    order = rng.permutation(len(held))
    for k in range(0, len(held), BATCH):
        yield [held[i] for i in order[k : k + BATCH]]


def _train(model: Model, power: dict[str, np.ndarray], learned: Examples, passes: int, seed: int = 5) -> Model:
    """Stochastic gradients with per-parameter step sizes; ``power`` and the model's arrays are changed."""
    last = model.last
    n_filters = len(WIDTHS) * FILTERS

    def step(name, rows, grad):
        array, squares = getattr(model, name), power[name]
        if rows is None:
            squares += grad**2
            array -= RATE * grad / np.sqrt(squares)
        else:
            unique, inverse = np.unique(rows, return_inverse=True)
            summed = np.zeros((len(unique), SIZE), np.float32)
            np.add.at(summed, inverse, grad)
            squares[unique] += summed**2
            array[unique] -= RATE * summed / np.sqrt(squares[unique])

    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for batch in _shuffled_batches(learned(), rng):
            size = np.array([len(x.whole) for x in batch])
            if not size.sum():
                continue
            docs, y = np.arange(len(batch)), np.array([x.label for x in batch])
            code = np.concatenate([x.whole for x in batch]) * np.int64(STEMS) + np.concatenate([x.stem for x in batch])
            used, local = np.unique(code, return_inverse=True)
            used_whole, used_stem = used // STEMS, used % STEMS
            vectors = model.words[used_whole] + model.stems[used_stem]
            table = vectors @ model.filters
            ends = np.cumsum(size)
            padded = np.concatenate((local, np.zeros(2, np.int64)))
            found = responses(table, model.bias, padded, np.repeat(ends, size) - np.arange(len(local)))
            peak = np.zeros((len(docs), n_filters), np.int64)
            best = np.zeros((len(docs), n_filters), np.float32)
            for k, (a, b) in enumerate(zip(ends - size, ends)):
                if b > a:
                    spot = found[a:b].argmax(axis=0)
                    peak[k], best[k] = a + spot, np.maximum(found[a:b][spot, np.arange(n_filters)], 0)
            p = 1 / (1 + np.exp(-np.clip(best @ model.weights + last, -30, 30)))
            wrong = ((p - y[docs]) / len(docs)).astype(np.float32)
            back = wrong[:, None] * model.weights[None, :] * (best > 0)
            grad_filters = np.zeros_like(model.filters)
            rows, grads = [], []
            for k, width in enumerate(WIDTHS):
                for f in range(FILTERS):
                    g, spot = back[:, k * FILTERS + f], peak[:, k * FILTERS + f]
                    on = g != 0
                    for o in range(width):
                        column = _columns(width, o).start + f
                        token = padded[spot[on] + o]
                        grad_filters[:, column] += g[on] @ vectors[token]
                        rows.append(token)
                        grads.append(g[on][:, None] * model.filters[:, column][None, :])
            rows, grads = np.concatenate(rows), np.concatenate(grads)
            step("words", used_whole[rows], grads)
            step("stems", used_stem[rows], grads)
            step("filters", None, grad_filters)
            step("bias", None, back.sum(axis=0))
            step("weights", None, wrong @ best)
            power["last"] += float(wrong.sum()) ** 2
            last -= RATE * float(wrong.sum()) / float(power["last"][0]) ** 0.5
    return model._replace(last=last)


def _example_logits(model: Model, batch: list[Example]) -> np.ndarray:
    size = np.array([len(x.whole) for x in batch])
    if not size.sum():
        return np.full(len(batch), model.last)
    code = np.concatenate([x.whole for x in batch]) * np.int64(STEMS) + np.concatenate([x.stem for x in batch])
    used, local = np.unique(code, return_inverse=True)
    table = (model.words[used // STEMS] + model.stems[used % STEMS]) @ model.filters
    return pooled(table, model.bias, local, size) @ model.weights + model.last


def binned(z: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(z, -SPAN, SPAN) * BINS).astype(np.int64)


def scaled(bins: np.ndarray, n: np.ndarray, yes: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the raw score, from the texts and toxic texts of each bin."""
    z, a, b = bins / BINS, 1.0, 0.0
    for _ in range(50):  # Newton's steps with a weak pull to the unscaled score
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w, off = n * (p * (1 - p) + 1e-6), n * p - yes
        grad = np.array([(off * z).sum() + (a - 1), off.sum() + 0.1 * b])
        hess = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
        move = np.linalg.solve(hess, grad)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-6:
            break
    return float(max(a, 0.05)), float(b)


GRID = np.linspace(0.15, 0.6, 19)


def tallies(scale: tuple[float, float], z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Texts and toxic texts at or over each threshold of CUT and GRID, and all toxic ones."""
    p = 1 / (1 + np.exp(-np.clip(scale[0] * z + scale[1], -30, 30)))
    over = p[:, None] >= np.concatenate(([CUT], GRID))[None, :]
    return np.concatenate((over.sum(axis=0), y @ over, [y.sum()]))


def threshold(tally: np.ndarray) -> float:
    """The threshold with the best F1, if it gains clearly over CUT."""
    over, hits = tally[: len(GRID) + 1], tally[len(GRID) + 1 : -1]
    f1 = 2 * hits / np.maximum(1, over + tally[-1])
    value, _, t = max((f, -abs(t - CUT), t) for f, t in zip(f1[1:], GRID))
    return float(t) if value > f1[0] + 0.02 else CUT


def _calibrated(model: Model, held: Examples) -> Model:
    """Scale scores by logistic regression on left-out texts; thresholds by language."""
    z, y, langs, rows = [], [], [], iter(held())
    while batch := list(islice(rows, BATCH)):
        z.append(_example_logits(model, batch))
        y += [x.label for x in batch]
        langs += [x.lang for x in batch]
    z, y = np.concatenate([*z, np.zeros(0)]), np.array(y, float)
    scale = scaled(binned(z), np.ones(len(z)), y)
    of = {x: np.array([lang == x for lang in langs]) for x in set(langs) - {None}}
    thresholds = {x: threshold(tallies(scale, z[at], y[at])) for x, at in of.items() if y[at].sum() >= 5}
    return model._replace(scale=scale, thresholds=thresholds)


def held_out() -> Column:
    """Whether a document's label is kept from training."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


#: The parameters that are no embeddings, in the order in which shards send them.
DENSE = ("filters", "bias", "weights", "last")


def _dense(model: Model, power: dict[str, np.ndarray]) -> np.ndarray:
    own = [np.ravel(getattr(model, k)).astype(np.float64) for k in DENSE]
    return np.concatenate(own + [np.ravel(power[k]).astype(np.float64) for k in DENSE])


def _moved(model: Model, power: dict[str, np.ndarray], mean: pa.Table) -> Model:
    """The model after an average of shards; its embeddings and ``power`` are changed in place, a block at a time."""
    changed = {}
    for batch in mean.to_batches():
        for block, at, values in zip(*(batch.column(c) for c in ("block", "at", "values"))):
            if block.as_py() < 0:
                changed = _dense_parts(model, power, np.frombuffer(values.as_buffer(), "<f8"))
                continue
            places = np.frombuffer(at.as_buffer(), "<i4")
            rows = np.frombuffer(values.as_buffer(), "<f4").reshape(-1, 2 * SIZE)
            name, first = ("stems", WORDS) if places[0] >= WORDS else ("words", 0)
            getattr(model, name)[places - first] = rows[:, :SIZE]
            power[name][places - first] = rows[:, SIZE:]
    return model._replace(**changed)


def _dense_parts(model: Model, power: dict[str, np.ndarray], dense: np.ndarray) -> dict:
    """The parameters that ``dense`` has, as ``_dense`` puts them; those of ``power`` are replaced."""
    at, parts = 0, []
    for source in (model._asdict(), power):
        for k in DENSE:
            size, shape = np.size(source[k]), np.shape(source[k])
            parts.append(dense[at : at + size].reshape(shape))
            at += size
    power.update(zip(DENSE, [*(v.astype(np.float32) for v in parts[4:7]), parts[7].astype(np.float64)]))
    return dict(zip(DENSE, [*(v.astype(np.float32) for v in parts[:3]), float(parts[3])]))


def _seen(found: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``seen_rows`` of all shards, from their sums by embedding row."""
    at, n, yes = (found[c].to_numpy() for c in ("at", "n", "yes"))
    return {k: (at[m] - first, n[m], yes[m]) for k, m, first in (("whole", at < WORDS, 0), ("stem", at >= WORDS, WORDS))}


def _average(group: pa.Table) -> pa.Table:
    """The mean of what the shards made of a block of parameters, each over the shards that changed it."""
    group = group.sort_by("shard")
    block = group["block"][0].as_py()
    at = np.concatenate([np.frombuffer(x, "<i4") for x in group["at"].to_pylist()])
    values = np.concatenate([np.frombuffer(x, "<f8" if block < 0 else "<f4") for x in group["values"].to_pylist()])
    values = values.reshape(len(at), -1).astype(np.float64)
    places, which = np.unique(at, return_inverse=True)
    sums = np.zeros((len(places), values.shape[1]))
    np.add.at(sums, which, values)
    mean = sums / np.bincount(which)[:, None]
    out = [[block], [places.astype("<i4").tobytes()], [mean.astype("<f8" if block < 0 else "<f4").tobytes()]]
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], ["block", "at", "values"])


def _maybe_known(known: DataFrame, sent: list | None = None) -> Column:
    """Whether a row's doc_id may be in ``known``: always true if it is. A bitmap of FILTER_BITS is broadcast and put into ``sent``."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    size = FILTER_BITS // FILTER_BLOCKS

    def block(group: pa.Table) -> pa.Table:
        marked = np.zeros(size, bool)
        marked[group["at"].to_numpy()] = True
        parts = [pa.array([group["block"][0].as_py()], pa.int32()), pa.array([np.packbits(marked).tobytes()], pa.binary())]
        return pa.table(parts, ["block", "bits"])

    at = known.select(F.floor(place / size).cast("int").alias("block"), (place % size).alias("at"))
    bits = np.zeros((FILTER_BLOCKS, size // 8), np.uint8)
    for batch in at.groupBy("block").applyInArrow(block, "block int, bits binary").toArrow().to_batches():
        for number, mine in zip(batch.column(0), batch.column(1)):
            bits[number.as_py()] = np.frombuffer(mine.as_buffer(), np.uint8)
    given = known.sparkSession.sparkContext.broadcast(bits.ravel())
    if sent is not None:
        sent.append(given)

    @F.pandas_udf("boolean")
    def marked(places: pd.Series) -> pd.Series:
        at = places.to_numpy()
        return pd.Series((given.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool))

    return marked(place)


PACKED = "shard int, held boolean, labels binary, langs array<string>, sizes binary, whole binary, stem binary, words binary"


def _packed(key: int, held: bool, rows: list[Example]) -> pa.Table:
    """Examples as one row: distinct words' embedding rows, and which word is at each position."""
    whole, stem = (np.concatenate([*(getattr(r, c) for r in rows), np.zeros(0, np.int32)]) for c in ("whole", "stem"))
    used, which = np.unique(whole * np.int64(STEMS) + stem, return_inverse=True)
    numbers = [np.array([r.label for r in rows], "<f8"), np.array([len(r.whole) for r in rows], "<i4")]
    numbers += [(used // STEMS).astype("<i4"), (used % STEMS).astype("<i4"), which.astype("<i4")]
    labels, *rest = (pa.array([x.tobytes()], pa.binary()) for x in numbers)
    langs = pa.array([[r.lang for r in rows]], pa.list_(pa.string()))
    names = ["shard", "held", "labels", "langs", "sizes", "whole", "stem", "words"]
    return pa.table([pa.array([key], pa.int32()), pa.array([held]), labels, langs, *rest], names)


def _unpacked(row: dict) -> list[Example]:
    which = np.frombuffer(row["words"], "<i4")
    whole, stem = (np.frombuffer(row[c], "<i4")[which] for c in ("whole", "stem"))
    sizes = np.frombuffer(row["sizes"], "<i4").astype(np.int64)
    return [
        Example(float(y), lang, whole[b - n : b], stem[b - n : b])
        for y, lang, b, n in zip(np.frombuffer(row["labels"], "<f8"), row["langs"], np.cumsum(sizes), sizes)
    ]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled documents that are not held out.

    Tasks turn each shard's texts into embedding rows, which are written once; log-odds are summed up by Spark, and training
    and calibration go over the shards in tasks. The driver has the model and what replaces it after a round, of fixed size,
    and no broadcast for longer than the tasks that read it.
    Every fifth text, by a hash of the id, is for calibration. Null labels are no labels; of repeated labels of one
    id the largest counts.
    """
    sent: list = []
    try:
        return _train_shards(docs, labels, sent)
    finally:
        for given in sent:
            given.destroy()


def _train_shards(docs: DataFrame, labels: DataFrame, sent: list) -> Model:
    """``train``; what it broadcasts for the whole time is put into ``sent``."""
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isNotNull() & ~F.coalesce(held_out(), F.lit(True)))
    # Both ids as one type, so that equal ones have equal hashes.
    same = dict(docs.dtypes)["doc_id"] == dict(labels.dtypes)["doc_id"]
    key = F.col("doc_id") if same else F.col("doc_id").cast("bigint")
    label = (F.max("toxic").cast("double") > 0).cast("double").alias("label")
    known = materialise(known.groupBy(key.alias("doc_id")).agg(label), "toxicity-labels")
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    texts = docs.select(key.alias("doc_id"), text_or_empty().alias("text"), lang.cast("string").alias("lang"))
    texts = texts.filter(F.col("doc_id").isNotNull()).filter(_maybe_known(known, sent))
    place = F.xxhash64("doc_id")
    of_held = F.pmod(place, F.lit(5)) == 4

    size = F.regexp_count("text", F.lit(WORD)).cast("bigint") * 8
    lengths = texts.select("doc_id", size.alias("size")).join(known, "doc_id")
    both = lengths.groupBy(of_held.alias("held")).agg(F.count("*").alias("n"), F.sum("label").alias("toxic"), F.sum("size").alias("size"))
    both = both.collect()
    sums = {h: next(((r["n"], r["toxic"], r["size"]) for r in both if r["held"] == h), (0, 0.0, 0)) for h in (False, True)}
    n_texts, n_toxic, n_bytes = sums[False]
    prior = n_texts + sums[True][0], n_toxic + sums[True][1]
    if not learnable(n_texts, prior):
        return started(n_texts, n_toxic, {}, prior)
    shards = max(1, -(-n_bytes // SHARD_BYTES))

    def pack(key, rows: pa.Table, marks: pa.Table) -> pa.Table:
        rows = rows.join(marks.select(["doc_id", "label"]), "doc_id", join_type="inner").combine_chunks()
        found = {False: [], True: []}
        for batch in rows.to_batches(BATCH):
            part = {c: batch.column(c) for c in batch.schema.names}
            coded = examples(part["text"], part["label"].to_pylist(), part["lang"].to_pylist())
            for place, of_held, r in zip(part["place"].to_pylist(), part["held"].to_pylist(), coded):
                found[of_held].append(((place, r.whole.tobytes(), r.label, r.stem.tobytes(), r.lang or ""), r))
        for some in found.values():  # in an order that does not depend on the rows'
            some.sort(key=lambda x: x[0])
        return pa.concat_tables([_packed(key[0].as_py(), k, [r for _, r in some]) for k, some in found.items()])

    shard = F.pmod(F.xxhash64(place), F.lit(shards)).cast("int").alias("shard")
    # So many partitions that a task has a few shards at most.
    rows = texts.select("doc_id", "text", "lang", place.alias("place"), of_held.alias("held"), shard)
    marks = known.select("doc_id", "label", shard)
    rows, marks = (x.repartition(2 * shards, "shard").groupBy("shard") for x in (rows, marks))
    packed = rows.cogroup(marks).applyInArrow(pack, PACKED).filter(F.octet_length("labels") > 0)
    packed = materialise(packed, "toxicity-shards")
    learned, held = (packed.filter(F.col("held") == h) for h in (False, True))

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for kind, (at, n, yes) in seen_rows(_unpacked(row)).items():
                    first = WORDS if kind == "stem" else 0
                    yield pa.RecordBatch.from_arrays([pa.array(at + first), pa.array(n), pa.array(yes)], ["at", "n", "yes"])

    # At most one row per embedding row.
    counted = learned.mapInArrow(count, "at bigint, n bigint, yes double")
    summed = counted.groupBy("at").agg(F.sum("n").alias("n"), F.sum("yes").alias("yes"))
    model = started(n_texts, n_toxic, _seen(summed.toArrow()), prior)

    rounds = 1 if shards == 1 else EPOCHS
    passes = -(-epochs(n_texts) // rounds)
    power = fresh_power(model)
    for number in range(rounds):
        given = spark.sparkContext.broadcast((tuple(model), power))

        def learn(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    yield learned_from(row)

        def learned_from(row: dict) -> pa.RecordBatch:
            parameters, powers = given.value
            own = Model(*(x.copy() if isinstance(x, np.ndarray) else x for x in parameters))
            squares = {k: v.copy() for k, v in powers.items()}
            key, rows = row["shard"], _unpacked(row)
            own = _train(own, squares, lambda: rows, passes, 5 + number * shards + key)
            blocks, ats = [-1], [np.zeros(1, "<i4").tobytes()]
            values = [_dense(own, squares).tobytes()]
            for k, first in (("words", 0), ("stems", WORDS)):
                changed = np.flatnonzero((squares[k] != powers[k]).any(axis=1))
                sent = np.hstack((getattr(own, k)[changed], squares[k][changed])).astype("<f4")
                for part in np.split(np.arange(len(changed)), np.flatnonzero(np.diff(changed // BLOCK)) + 1):
                    if len(part):
                        blocks.append(int(changed[part[0]] + first) // BLOCK)
                        ats.append((changed[part] + first).astype("<i4").tobytes())
                        values.append(sent[part].tobytes())
            out = [pa.array([key] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()), pa.array(ats, pa.binary())]
            return pa.RecordBatch.from_arrays([*out, pa.array(values, pa.binary())], ["shard", "block", "at", "values"])

        made = learned.mapInArrow(learn, "shard int, block int, at binary, values binary")
        # At most one row per block of parameters, each parameter once.
        mean = made.groupBy("block").applyInArrow(_average, "block int, at binary, values binary")
        model = _moved(model, power, mean.toArrow())
        pa.default_memory_pool().release_unused()
        given.destroy()
    return calibrated(spark, model, held)


def calibrated(spark, model: Model, held: DataFrame) -> Model:
    """``_calibrated`` over packed shards, by sums of bins and of languages."""
    given = spark.sparkContext.broadcast(tuple(model))

    def raw(batches):
        own = Model(*given.value)
        for batch in batches:
            texts = [x for row in batch.to_pylist() for x in _unpacked(row)]
            for k in range(0, len(texts), BATCH):
                rows = texts[k : k + BATCH]
                z = np.asarray(_example_logits(own, rows), np.float64)
                columns = [pa.array([r.lang for r in rows], pa.string()), pa.array([r.label for r in rows], pa.float64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(z)], ["lang", "label", "z"])

    rows = materialise(held.mapInArrow(raw, "lang string, label double, z double"), "toxicity-held")
    given.destroy()
    near = F.greatest(F.lit(float(-SPAN)), F.least(F.lit(float(SPAN)), "z"))
    # At most 2 * SPAN * BINS + 1 rows.
    bins = rows.groupBy(F.rint(near * BINS).cast("bigint").alias("bin")).agg(F.count("*").alias("n"), F.sum("label").alias("yes"))
    found = bins.orderBy("bin").toArrow()
    scale = scaled(*(found[c].to_numpy().astype(float) for c in ("bin", "n", "yes")))

    def tally(batches):
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            z, y = batch.column(2).to_numpy(), batch.column(1).to_numpy()
            for x in set(names.tolist()):
                mine = names == x
                yield pa.RecordBatch.from_arrays([pa.array([x]), *(pa.array([float(v)]) for v in tallies(scale, z[mine], y[mine]))], ["lang", *sums])

    sums = [f"t{i}" for i in range(2 * len(GRID) + 3)]
    counted = rows.filter("lang IS NOT NULL").mapInArrow(tally, "lang string, " + ", ".join(f"{c} double" for c in sums))
    # One row per language with labels enough.
    by = counted.groupBy("lang").agg(*(F.sum(c).alias(c) for c in sums)).filter(F.col(sums[-1]) >= 5).collect()
    thresholds = {r["lang"]: threshold(np.array([r[c] for c in sums])) for r in by}
    return model._replace(scale=scale, thresholds=thresholds)


def toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= CUT), threshold (of the language), toxic.

    Input: doc_id (integer), text and, for the threshold only, lang; labels (doc_id,
    toxic). One output row per input row. Null and empty texts get the score of a text
    without words. A null doc_id counts as not held out. Without labels of both kinds all
    scores are the share of toxic labels. Languages without enough labels have threshold CUT.
    """
    spark = docs.sparkSession
    # As a plain tuple, so that workers need not have this package to read it.
    fitted = spark.sparkContext.broadcast(tuple(model or train(docs, labels)))

    def scan(batches):
        known = Model(*fitted.value)
        for batch in batches:
            found = pa.array(np.asarray(scores(known, batch.column(1)), np.float64))
            pa.default_memory_pool().release_unused()
            limits = [known.thresholds.get(x, CUT) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), found, pa.array(limits, pa.float64())], ["doc_id", "score", "threshold"]
            )

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    kind = dict(docs.dtypes)["doc_id"]
    found = docs.select("doc_id", text_or_empty().alias("text"), lang.cast("string").alias("lang")).mapInArrow(
        scan, f"doc_id {kind}, score double, threshold double"
    )
    return found.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("toxic"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below their language's threshold, all their columns, in one pass.

    Null and empty texts are scored as a text without words, and repeated rows stay or go together. A null
    lang, or one without enough labels, has the threshold CUT; null ids are scored like others. Without labels
    of both kinds all documents have one score. An empty table gives no rows.
    """
    fitted = docs.sparkSession.sparkContext.broadcast(tuple(train(docs, labels)))
    names = docs.columns
    text, lang = names.index("text"), names.index("lang") if "lang" in names else None

    def scan(batches):
        known = Model(*fitted.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
            found = scores(known, texts)
            pa.default_memory_pool().release_unused()
            codes = batch.column(lang).to_pylist() if lang is not None else [None] * len(batch)
            limits = np.array([known.thresholds.get(x, CUT) for x in codes])
            yield batch.filter(pa.array(found < limits))

    return docs.mapInArrow(scan, docs.schema)
