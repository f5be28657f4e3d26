"""Words and token ids of Arrow text batches, one dictionary step per batch.

Texts are cut at ASCII white space, each distinct word of a batch is encoded once, and
ids are gathered by numpy. The tokenizer drops white space and never joins across it, so
words encode alone as they do in their text; a bounded cache keeps them for later batches
and tasks of the same worker.
"""

from __future__ import annotations

import os
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: The file name of the default vocabulary; any tokenizer whose words end at white space fits.
VOCABULARY = "word_bpe_49k.json"
END_OF_TEXT = 49407
CACHED_WORDS = 1_000_000
#: Distinct words are encoded this many at a time as one text.
TOGETHER = 256
#: Words of printable ASCII and Latin letters, whose parts PARTS finds just as the tokenizer does.
SIMPLE = r"^[\x21-\x7E\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and each text's number of words."""
    texts = texts.cast(pa.large_string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = parts.flatten()
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    sizes = np.diff(parts.offsets.to_numpy())
    owner = np.repeat(np.arange(len(texts)), sizes)[full]
    return words.filter(pa.array(full)), np.bincount(owner, minlength=len(texts))


class WordEncoder:
    """Token ids of whole texts; make one per task."""

    def __init__(self, path: str, plain_specials: bool = False, cached: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # If set, a special token's string in a text is ordinary text.
        self.tokenizer.encode_special_tokens = plain_specials
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(WORD_END)]] = True
        self.cached = cached or CACHED_WORDS
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in order, and each word's number of ids, one call per word."""
        codes = [c.ids for c in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        flat = [i for ids in codes for i in ids]
        return np.array(flat, np.uint32), np.array([len(ids) for ids in codes], np.int64)

    def _encode_together(self, words: list[str], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for simple words of so many parts each: their ends tell words apart."""
        flat, sizes = [], []
        for at in range(0, len(words), TOGETHER):
            some, count = words[at : at + TOGETHER], parts[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids])
            if len(stops) == count.sum():
                size = np.diff(stops[np.cumsum(count) - 1], prepend=-1)
            else:
                ids, size = self._encode_words(some)
            flat.append(ids)
            sizes.append(size)
        return np.concatenate(flat), np.concatenate(sizes)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Add words; their places in the cache."""
        simple = pc.and_(pc.match_substring_regex(words, SIMPLE), pc.invert(pc.match_substring(words, "<|")))
        simple = simple.to_numpy(zero_copy_only=False) & self.ends.any()
        base, rest = len(self.known), np.flatnonzero(~simple)
        order = np.concatenate((rest, np.flatnonzero(simple)))
        words = words.take(pa.array(order))
        alone, plain = words.slice(0, len(rest)), words.slice(len(rest))
        parts = pc.count_substring_regex(pc.utf8_lower(plain), PARTS).to_numpy()
        together = lambda some: self._encode_together(some, parts)
        found = [f(w.to_pylist()) for w, f in ((alone, self._encode_words), (plain, together)) if len(w)]
        self.flat = np.concatenate((self.flat, *(flat for flat, _ in found)))
        self.sizes = np.concatenate((self.sizes, *(sizes for _, sizes in found)))
        self.known = pa.concat_arrays([self.known, words])
        place = np.empty(len(order), np.int64)
        place[order] = base + np.arange(len(order))
        return place

    def _lookup(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place in the cache, and the number of words per text."""
        words, counts = split_words(texts)
        if not len(words):
            return np.zeros(0, np.int64), counts
        coded = words.dictionary_encode()
        found = pc.index_in(coded.dictionary, self.known)
        if len(self.known) + found.null_count > self.cached:
            self._clear()
            place = self._learn(coded.dictionary)
        else:
            new = found.is_null().to_numpy(zero_copy_only=False)
            place = found.fill_null(0).to_numpy().astype(np.int64)
            if new.any():
                place[new] = self._learn(coded.dictionary.filter(pa.array(new)))
        return place[coded.indices.to_numpy()], counts

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        which, counts = self._lookup(texts)
        total = np.concatenate(([0], np.cumsum(self.sizes[which])))
        return np.diff(total[np.concatenate(([0], np.cumsum(counts)))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's ids begin and end."""
        which, counts = self._lookup(texts)
        pa.default_memory_pool().release_unused()
        begins = np.concatenate(([0], np.cumsum(self.sizes)))
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(begins[which] - (ends - sizes), sizes) + np.arange(total)
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return self.flat[at], bounds


def encoder(path: str, plain_specials: bool = False, cached: int | None = None) -> WordEncoder:
    """This worker's encoder; tasks of one worker share its cache, of at most ``cached`` words.

    Task functions travel by value, so what outlives a task hangs on the interpreter itself.
    """
    kept = sys.modules.setdefault("_word_encoders", {})  # type: ignore[arg-type]
    if (path, plain_specials) not in kept:
        kept[path, plain_specials] = WordEncoder(path, plain_specials, cached)
    return kept[path, plain_specials]
