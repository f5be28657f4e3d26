"""A tokenizer with a vocabulary: the longest known piece at every place of a text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from evalspark.functions.text import or_empty

Tokenizer = Callable[[Column], Column]

#: The pattern of a vocabulary goes to every task, and each of its pieces is tried as one path.
LARGEST_VOCABULARY, LONGEST_PIECE = 20_000, 100


def _escaped(character: str) -> str:
    return character if character.isalnum() or not character.isascii() else "\\" + character


def trie_pattern(vocabulary: Iterable[str]) -> str:
    """A regular expression that takes the longest piece of a vocabulary at its place.

    The expression is the vocabulary's trie: pieces with one beginning share its path, paths part at
    their next character, and a piece that goes on to longer ones has their rest as a greedy option. At
    a place at most one path fits, so a match costs the length of the path and not the vocabulary's.
    """
    pieces = sorted(set(vocabulary))
    if not pieces or "" in pieces:
        raise ValueError("a vocabulary has pieces, and none of them is empty")
    if len(pieces) > LARGEST_VOCABULARY or max(map(len, pieces)) > LONGEST_PIECE:
        raise ValueError(f"at most {LARGEST_VOCABULARY} pieces of at most {LONGEST_PIECE} characters")
    trie: dict = {}
    for piece in pieces:
        node = trie
        for character in piece:
            node = node.setdefault(character, {})
        node[""] = {}  # a piece ends here

    def paths(node: dict) -> str:
        ends = "" in node
        branches = [_escaped(c) + paths(child) for c, child in node.items() if c]
        if not branches:
            return ""
        return f"(?:{'|'.join(branches)}){'?' if ends else ''}"

    return paths(trie)


def longest_match(vocabulary: Iterable[str]) -> Tokenizer:
    """A tokenizer for ``text.token_budget`` and the text metrics: pieces of a vocabulary, left to right.

    A text is cut from its beginning: each token is the longest piece that fits, and a character
    that begins no piece is a token of its own. Tokens put together are the text. A null text has none.
    """
    pattern = f"(?s){trie_pattern(vocabulary)}|."
    return lambda c: F.regexp_extract_all(or_empty(c), F.lit(pattern), F.lit(0))
