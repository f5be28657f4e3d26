import collections
import math
import re
import zlib

import llm_data
import numpy as np
import pytest

from evalspark.llm import language_model as lm

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


ROWS = [*enumerate(llm_data.sentences(200, 12, (0, 60))), (900, None), (901, ""), (902, "É x\x0by \u00a0"), (5, "again"), (None, "no id"), (903, "big " * 20_000)]


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 5])
def test_base_scores_are_exact(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    found = lm.score_documents(llm_data.documents(spark, ROWS)).collect()
    counts = collections.Counter(w for i, t in ROWS if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), held(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
         round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 4))
        for i, t in ROWS
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == want
    assert all(r.score < 0 for r in found)


def test_scores_do_not_depend_on_the_broadcast(spark, monkeypatch):
    docs = llm_data.documents(spark, ROWS)
    a = sorted((str(r.doc_id), r.score) for r in lm.score_documents(docs).collect())
    monkeypatch.setattr(lm, "FREQUENT", 3)
    b = sorted((str(r.doc_id), r.score) for r in lm.score_documents(docs).collect())
    assert [x[0] for x in a] == [x[0] for x in b]
    assert np.allclose([x[1] for x in a], [x[1] for x in b], rtol=1e-5)


def test_context_helps_on_held_out_texts(spark):
    import random

    rng = random.Random(3)
    left, right = [f"l{k}aa" for k in range(60)], [f"r{k}zz" for k in range(60)]
    rows = [(i, " ".join(rng.choices(left if i % 2 else right, k=30))) for i in range(400)]
    found = [r for r in lm.score_documents(llm_data.documents(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found) + 0.15 * sum(r.n_tokens for r in found)


@pytest.mark.parametrize("parts", [1, 5])
def test_probabilities_sum_to_one_in_every_context(spark, parts):
    trained = lm.train(llm_data.documents(spark, ROWS, parts))
    p = np.array([10 ** np.array(r.logp, np.float64) for r in trained.words.collect()])
    assert len(p) == trained.types and (p > 0).all()
    assert np.allclose(p.sum(axis=0) + trained.unseen, 1, atol=1e-6)


def test_the_chain_goes_on_from_the_seating_before(monkeypatch):
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 40, (500, lm.CONTEXTS))
    keys = lm._keys(llm_data_words(500))
    first = np.minimum(counts, 1).astype(float)
    state = lm.State(counts.sum(axis=0), first.sum(axis=0), 500, 500, 0.5, 0.5)
    one, root = lm.sweep(state, counts, first, np.ones(500), keys, 0)
    assert ((one >= first) & (one <= counts)).all() and ((root >= 1) & (root <= one.sum(axis=1))).all()
    after = lm.State(counts.sum(axis=0), one.sum(axis=0), root.sum(), 500, 0.5, 0.5)
    again, _ = lm.sweep(after, counts, one, root, keys, 1)
    restarted, _ = lm.sweep(after, counts, first, np.ones(500), keys, 1)
    assert (again != restarted).any()


def llm_data_words(n):
    import pyarrow as pa

    return pa.array([f"w{k}" for k in range(n)])


def test_seating_of_one_dish():
    keys = np.arange(20_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ones = np.ones(20_000)
    tables = lm.seat(np.full(20_000, 3), 0.5 * ones, 2.0 * ones, 0.5, keys)
    # After one customer a table opens with odds 1 / (1 - 0.5 + 1); then the same by hand.
    second = 1 / 1.5
    mean = 1 + second + second * (1 / (2 - 1.0 + 1)) + (1 - second) * (1 / (2 - 0.5 + 1))
    assert abs(tables.mean() - mean) < 0.02
    many = lm.seat(np.full(2000, 10_000), 0.5 * ones[:2000], 2.0 * ones[:2000], 0.5, keys[:2000])
    assert ((many >= 1) & (many <= 10_000)).all()
    assert lm.seat(np.zeros(3, int), np.ones(3), np.ones(3), 0.5, keys[:3]).tolist() == [0, 0, 0]


def test_empty_table(spark):
    empty = llm_data.documents(spark, ROWS[:3]).limit(0)
    assert lm.score_documents(empty).collect() == []
    alone = lm.score_documents(llm_data.documents(spark, [(i, "held") for i in range(100) if held(i)])).collect()
    assert alone and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in alone)


def test_the_chain_of_pairs_goes_on_from_the_seating_before():
    rng = np.random.default_rng(1)
    contexts = 16
    counts = rng.integers(0, 40, (500, contexts))
    word, before = counts.nonzero()
    keys = lm._keys([f"w{k}" for k in range(500)])
    pair_keys = lm._pair_keys(keys[before], keys[word])

    def sweep(first, tables, served, roots, number):
        state = lm.State(None, None, None, float(served.sum()), float(roots.sum()), 500, 0.5, 0.5)
        found = np.zeros(counts.shape)
        found[word, before] = state.seat_pairs(counts[word, before], tables[before], served[word], roots[word], pair_keys, number)
        return found, state.seat_root(found.sum(axis=1).astype(int), keys, number)

    first = np.minimum(counts, 1).astype(float)
    one, root = sweep(first, first.sum(axis=0), first.sum(axis=1), np.ones(500), 0)
    assert ((one >= first) & (one <= counts)).all() and ((root >= 1) & (root <= one.sum(axis=1))).all()
    again, _ = sweep(one, one.sum(axis=0), one.sum(axis=1), root, 1)
    restarted, _ = sweep(first, first.sum(axis=0), first.sum(axis=1), np.ones(500), 1)
    assert (again != restarted).any()


@pytest.mark.parametrize("frequent, bucket", [(lm.FREQUENT, lm.BUCKET), (20, 300)])
def test_restaurants_are_those_of_words(spark, monkeypatch, frequent, bucket):
    """Each word before has a restaurant, whose probabilities sum to one; its customers are the pairs of the training texts."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "BUCKET", bucket)
    trained = lm.train(llm_data.documents(spark, ROWS))
    known = {r.key: r for r in trained.words.collect()}
    after = collections.defaultdict(dict)
    for r in trained.pairs.collect():
        if r.n_train:
            after[r.before][r.word] = r
    want = collections.Counter()
    for i, t in ROWS:
        if not held(i):
            text = [w or "" for w in words(t)]
            want.update(zip(["", *text[:-1]], text, strict=True))
    key = dict(zip(names := sorted({w for pair in want for w in pair}), lm._keys(names).view(np.int64).tolist(), strict=True))
    assert {(a, w): r.n_train for a, row in after.items() for w, r in row.items()} == {(key[a], key[w]): n for (a, w), n in want.items()}
    assert len(known) == trained.types == len(names) == len(after)
    for before, row in after.items():
        others = 1 - sum(np.array(known[w].root) for w in row)
        total = sum(10**r.logp for r in row.values()) + np.mean(np.array(known[before].handed_on) * others)
        assert abs(total - 1) < 1e-9


def test_the_word_before_counts_whatever_its_last_letters(spark):
    import random

    rng = random.Random(5)
    # What follows is known from the word before, not from its last two letters.
    rows = [(i, " ".join(f"a{k}zz b{k}zz" for k in rng.choices(range(40), k=15))) for i in range(400)]
    found = [r for r in lm.score_documents(llm_data.documents(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found) + 0.6 * sum(r.n_tokens for r in found)
