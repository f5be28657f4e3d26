import random

import pytest
from pyspark.sql import functions as F

from evalspark.functions import segment, text


def greedy(vocabulary, t):
    out, at = [], 0
    longest = max(map(len, vocabulary))
    while at < len(t):
        n = next((n for n in range(min(longest, len(t) - at), 0, -1) if t[at : at + n] in vocabulary), 1)
        out.append(t[at : at + n])
        at += n
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_longest_match_equals_a_search_of_the_vocabulary(column, seed):
    rng = random.Random(seed)
    letters = "abé😀.*\n |[" if seed > 1 else "ab"
    vocabulary = {"".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(40)}
    texts = ["".join(rng.choices(letters + "z", k=rng.randrange(60))) for _ in range(200)] + ["", None]
    found = column(texts, segment.longest_match(vocabulary))
    assert found == [greedy(vocabulary, t or "") for t in texts]


def test_long_pieces_that_share_their_beginnings(column):
    vocabulary = ["a" * n for n in range(1, 101)] + ["a" * 50 + "b"]
    assert [len(t) for t in column(["a" * 250 + "b"], segment.longest_match(vocabulary))[0]] == [100, 100, 51]


def test_a_budget_of_pieces(column):
    budget = column(["unthere", "xx", None], lambda c: text.token_budget(c, 2, segment.longest_match(["un", "the", "there"])))
    assert [(r["tokens"], r["n_tokens"], r["truncated"]) for r in budget] == [(["un", "there"], 2, False), (["x", "x"], 2, False), ([], 0, False)]


def test_any_function_of_a_text_is_a_tokenizer(column):
    assert column(["a-b"], lambda c: text.tokens(c, lambda x: F.split(x, "-"))) == [["a", "b"]]


@pytest.mark.parametrize("vocabulary", [[], ["a", ""], ["x" * 101], [str(i) for i in range(20_001)]])
def test_vocabularies_are_bounded(vocabulary):
    with pytest.raises(ValueError):
        segment.trie_pattern(vocabulary)
