"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling and used for scoring.

Every token is served in the restaurant of the word before it; the first of a text in that of END,
as if texts followed each other. All restaurants share one parent, the root over single words, whose own base is
uniform. A customer at dish w sits at a new table with probability proportional to
(strength + discount * tables) * parent probability of w, and each table sends one customer to the
parent. Given the restaurants' numbers of tables and the root's probabilities, pairs of neighbours are independent: one
sweep empties and reseats every dish of every restaurant in parallel. What the next
sweep needs of a seating are its totals: tables by restaurant, customers and tables of the root by word.
A sampled seating's probabilities use the totals of that same seating, so they sum up to one over all words and
the unseen one, and so does their mean over the last sweeps.

Counting, sampling and scoring cover all tokens. Tokens go once, packed, to buckets: those of a word outside the
FREQUENT commonest to the bucket of that word (its home), common words after a rare one to the rare one's home, and pairs of two
common words to a bucket of their own hash, so that no word can be hot. All tokens of one pair meet in one
bucket, which therefore holds the share of all tokens that its commonest pair has, at least. A home knows all of its words' root
totals; tables of a rare word's restaurant that stand in other buckets are sent to its home in each sweep, which
answers with their sum. Totals of the commonest words are summed up and broadcast (a table of fixed size). Buckets then
score their tokens, and the parts are summed up by document.

Words outside the commonest are told apart by 64-bit keys. Should two training words share one, ``train`` raises.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from evalspark.llm.common import materialise, text_or_empty
from evalspark.llm.tokens import split_words

FREQUENT = 32_768
#: Sweeps over the whole table that settle the numbers of tables; sweeps averaged after.
BURN_IN, SAMPLES = 2, 4
STRENGTH, ROOT_STRENGTH = 10.0, 10.0
ALPHA = 0.1  # of the smoothed base score
ONE_BY_ONE, BLOCKS = 64, 16  # customers seated singly; then blocks of 1/BLOCKS of those seated
END = ""  # the token after a text's last word; no word is empty
BUCKET = 2_000_000  # training tokens of a bucket
CHUNK = 2**18  # pairs hashed at a time
PIECE = 1024  # common words whose totals are summed up together
RARE = 0xFFFF  # instead of a common word's rank


def held_out(doc_id: str = "doc_id") -> Column:
    left = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10
    return F.coalesce(left == 0, F.lit(False))


def tokens_in_context(texts: pa.Array):
    """(distinct words with END last, tokens, the tokens before them, tokens per text) of a batch."""
    words, counts = split_words(texts, lower=True)
    code = words.dictionary_encode()
    known = [*code.dictionary.to_pylist(), END]
    tokens = np.insert(code.indices.to_numpy(), np.cumsum(counts), len(known) - 1)
    before = np.roll(tokens, 1)  # a batch's last token is END
    pa.default_memory_pool().release_unused()
    return known, tokens, before, counts + 1


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): how often each training token comes, summed map-side."""

    def scan(batches):
        for batch in batches:
            known, tokens, _, _ = tokens_in_context(batch.column(0))
            found = pa.array(np.bincount(tokens, minlength=len(known)))
            yield pa.RecordBatch.from_arrays([pa.array(known, pa.string()), found], ["word", "c"])

    train = docs.filter(~held_out()).select(text_or_empty().alias("text"))
    return train.mapInArrow(scan, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c")).filter("c > 0")


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step, so that draws depend on word and step only."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(keys: np.ndarray, step: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = _mix(keys + np.uint64(step + 1) * np.uint64(0x9E3779B97F4A7C15))
    return (mixed >> np.uint64(11)).astype(np.float64) / 2**53


def seat(customers: np.ndarray, parent: np.ndarray, weight: np.ndarray, discount: float, keys: np.ndarray):
    """Tables after seating each dish's customers one after the other.

    ``weight`` is strength + discount * tables of the restaurant. Up to ONE_BY_ONE customers
    sit down singly; beyond that, blocks sit down at the same odds, a fraction of a table
    by chance, so that a dish of a billion customers takes some hundred steps.
    """
    tables = (customers > 0).astype(np.float64)
    new = weight * parent
    seated, step = 1, 0
    alive = np.flatnonzero(customers > 1)
    while len(alive):
        t = tables[alive]
        odds = new[alive] / (np.maximum(seated - discount * t, 1e-9) + new[alive])
        draw = _uniform(keys[alive], step)
        if seated < ONE_BY_ONE:
            block = 1
            tables[alive] = t + (draw < odds)
        else:
            block = np.minimum(max(1, seated // BLOCKS), customers[alive] - seated)
            tables[alive] = t + np.minimum(np.floor(block * odds + draw), block)
        seated += 1 if seated < ONE_BY_ONE else max(1, seated // BLOCKS)
        step += 1
        alive = alive[customers[alive] > seated]
    return tables


class State(NamedTuple):
    """Totals that a sweep takes as given, and those of the common words."""

    tables: np.ndarray  # of the common words' restaurants
    served: np.ndarray  # customers of the common words in the root
    roots: np.ndarray  # their tables there
    root_customers: float
    root_tables: float
    types: int
    discount: float
    root_discount: float

    def fresh(self) -> float:
        """Weight of one word's share of the uniform base."""
        return (ROOT_STRENGTH + self.root_discount * self.root_tables) / (self.types + 1)

    def root(self, served, tables):
        """Probability of a word with ``served`` customers on ``tables`` root tables."""
        return (served - self.root_discount * tables + self.fresh()) / (ROOT_STRENGTH + self.root_customers)

    def weight(self, tables):
        return STRENGTH + self.discount * tables

    def seat_pairs(self, customers, tables, served, roots, keys, number: int):
        """Tables of pairs, from their restaurants' numbers of tables and their words' customers and tables in the root."""
        return seat(customers, self.root(served, roots), self.weight(tables), self.discount, _shifted(keys, number))

    def seat_root(self, served, keys, number: int):
        base = np.full(len(served), 1.0 / (self.types + 1))
        whole = np.full(len(served), ROOT_STRENGTH + self.root_discount * self.root_tables)
        return seat(served, base, whole, self.root_discount, _shifted(keys, number))


def _shifted(keys: np.ndarray, number: int) -> np.ndarray:
    return _mix(keys ^ np.uint64((number * 7919) % 2**32))


def _keys(words) -> np.ndarray:
    return hash_array(np.array(words, object), categorize=False)


def _pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return _mix(words + _mix(before + np.uint64(1)))


def _home(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(keys) % np.uint64(buckets)).astype(np.int64)


def _grouped(groups: np.ndarray, items: np.ndarray):
    """(group, its items in order) for every group that comes."""
    order = np.argsort(groups, kind="stable")
    groups = groups[order]
    starts = np.flatnonzero(np.diff(groups, prepend=groups[:1] + 1))
    for start, end in zip(starts, np.append(starts[1:], len(groups))):
        yield int(groups[start]), items[order[start:end]]


def _pack(a: np.ndarray) -> bytes:
    """Compressed, all first bytes of the numbers before their second ones."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return a.nbytes.to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unpack(b: bytes, kind) -> np.ndarray:
    size, width = int.from_bytes(b[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(b[8:], size, codec="zstd", asbytes=True) if size else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).ravel().view(kind)


def _schema(text: str, doc_id: pa.DataType | None = None) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string()}
    pairs = [f.split() for f in text.split(", ")]
    return pa.schema([(n, doc_id if n == "doc_id" and doc_id else kinds[k]) for n, k in pairs])


def _row(schema: pa.Schema, **values) -> pa.Table:
    return pa.Table.from_pylist([values], schema)


#: One row per document, with the sums over its common words, or else the arrays of a bucket.
DOCS = "bucket int, block bigint, at bigint, doc_id {}, n_tokens bigint, n_known bigint, base double"
TOKENS = DOCS + ", before binary, words binary, doc binary, held binary, rare_before binary, rare_words binary"
#: Keys of the words at home here, and those of words away that come before one here: in pairs that come more than once, and others.
#: Words are coded in this order, after the common ones.
KEYS = ["keys", "often_away", "other_away"]
#: Pairs that come more than once with their counts; sums over those that come once by restaurant and by word.
SEATS = ["often_before", "often_words", "often", "once_before", "once_words"]
#: Training tokens of the words at home, all pairs with their counts, the tokens' pairs and documents.
WHOLE = ["n", "pairs_before", "pairs_words", "pairs", "token", "doc", "blocks", "sizes"]
BUCKETS = DOCS + "".join(f", {n} binary" for n in (*KEYS, *SEATS, "once_away", *WHOLE)) + ", n1 bigint, n2 bigint, n_types bigint"
#: What buckets tell homes and homes answer, what a bucket keeps, and parts of the common words' totals.
TOLD = (
    "kind string, bucket int, sender int, keys binary, fixed binary, tables binary, served binary, roots binary,"
    " summed binary, past binary, n_served bigint, n_roots bigint"
)


def scatter(docs: DataFrame, common: Broadcast, base: np.ndarray, buckets: int) -> DataFrame:
    """All tokens with the word before them, sent to their buckets and packed by batch."""
    kind = dict(docs.dtypes)["doc_id"]

    def scan(batches):
        places, n = common.value
        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            known, tokens, before, counts = tokens_in_context(batch.column(1))
            size, schema = len(batch), _schema(TOKENS.format("int"), batch.column(0).type)
            owner = np.repeat(np.arange(size, dtype=np.uint32), counts)
            rank = np.array([places.get(w, -1) for w in known], np.int32)
            keys = _keys(known)
            homes = _home(keys, buckets).astype(np.uint16 if buckets <= 2**16 else np.int64)
            of_word, of_before = rank[tokens], rank[before]
            hit = of_word >= 0
            mine, at = owner[hit], of_word[hit]
            where = np.where(hit, homes[before], homes[tokens])
            both = np.flatnonzero(hit & (of_before >= 0)).astype(np.int32)
            for some in np.split(both, range(CHUNK, len(both), CHUNK)):
                where[some] = _home(_pair_keys(keys[before[some]], keys[tokens[some]]), buckets)
            first = np.full(size, int(_home(np.array([block], np.uint64), buckets)[0]), np.int32)
            docs_table = {
                "bucket": pa.array(first), "block": pa.array(np.full(size, block)), "at": pa.array(np.arange(size)),
                "doc_id": batch.column(0), "n_tokens": pa.array(counts),
                "n_known": pa.array(np.bincount(mine, n[at] > 0, size).astype(np.int64)),
                "base": pa.array(np.bincount(mine, base[at], size).astype(float)),
            }
            yield pa.RecordBatch.from_arrays([docs_table.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)
            del hit, mine, at, both
            held = batch.column(2).to_numpy(zero_copy_only=False)
            rows = []
            for bucket, some in _grouped(where, np.arange(len(where), dtype=np.int32)):
                u, w = of_before[some], of_word[some]
                rows.append({
                    "bucket": bucket, "block": block, "doc": _pack(owner[some]),
                    "before": _pack(np.where(u < 0, RARE, u).astype(np.uint16)), "words": _pack(np.where(w < 0, RARE, w).astype(np.uint16)),
                    "held": _pack(np.packbits(held[owner[some]])),
                    "rare_before": _pack(keys[before[some[u < 0]]]), "rare_words": _pack(keys[tokens[some[w < 0]]]),
                })
            yield from pa.Table.from_pylist(rows, schema).to_batches()
            block += size

    texts = docs.select("doc_id", text_or_empty().alias("text"), held_out().alias("held"))
    return texts.select("doc_id", "text", "held").mapInArrow(scan, TOKENS.format(kind))


def gather(tokens: DataFrame, size: int, buckets: int) -> DataFrame:
    """The pairs of every bucket with their training counts, and which of them its tokens are."""
    kind = dict(tokens.dtypes)["doc_id"]

    def bucket_of(table: pa.Table) -> pa.Table:
        schema = _schema(BUCKETS.format("int"), table.schema.field("doc_id").type)
        own = table.filter(table["doc"].is_valid())
        documents = table.filter(table["doc"].is_null()).select(schema.names[:7])
        documents = pa.table([documents[f.name] if f.name in documents.column_names else pa.nulls(len(documents), f.type) for f in schema], schema)
        if not len(own):
            return documents
        bucket = own["bucket"][0].as_py()
        own = own.sort_by("block")
        column = lambda name, kind: [_unpack(b, kind) for b in own[name].to_pylist()]
        before = np.concatenate(column("before", np.uint16)).astype(np.int64)
        words = np.concatenate(column("words", np.uint16)).astype(np.int32)
        docs = column("doc", np.uint32)
        learn = np.concatenate([np.unpackbits(h, count=len(d)) == 0 for h, d in zip(column("held", np.uint8), docs, strict=True)])
        sizes = np.array([int(d.max()) + 1 for d in docs], np.int64)
        doc = np.concatenate([d + o for d, o in zip(docs, np.cumsum(sizes) - sizes, strict=True)]).astype(np.int32)
        del table
        rare = [np.concatenate(column(c, np.uint64)) for c in ("rare_before", "rare_words")]
        keys, codes = np.unique(np.concatenate(rare), return_inverse=True)
        before[before == RARE] = size + codes[: len(rare[0])]
        words[words == RARE] = size + codes[len(rare[0]) :]
        blocks, both = own["block"].to_numpy(), size + len(keys)
        del rare, codes, own, docs
        before *= both
        before += words
        del words
        pairs, token = np.unique(before, return_inverse=True)
        token = token.astype(np.int32)
        before, words = pairs // both, pairs % both
        c = np.bincount(token, learn, len(pairs)).astype(np.int64)
        once, often = c == 1, c > 1
        homes = _home(keys, buckets)
        sort = np.where(homes == bucket, 0, np.where(np.bincount(before[often], minlength=both)[size:] > 0, 1, 2))
        order = np.lexsort((keys, np.where(sort > 0, homes, 0), sort))
        code = np.arange(both)
        code[size + order] = size + np.arange(len(keys))
        keys, (at_home, asked, _) = keys[order], np.bincount(sort, minlength=3)
        before, words = code[before], code[words]
        n = np.bincount(words, c, both).astype(np.int64)[size : size + at_home]
        single = np.bincount(before[once], minlength=both)
        small = lambda a: _pack(a.astype(np.int32))
        row = _row(
            schema, bucket=bucket, keys=_pack(keys[:at_home]), often_away=_pack(keys[at_home : at_home + asked]),
            other_away=_pack(keys[at_home + asked :]), n=_pack(n), once_before=small(single[: size + at_home]),
            once_words=small(np.bincount(words[once], minlength=both)[: size + at_home]), once_away=small(single[size + at_home :]),
            often_before=small(before[often]), often_words=small(words[often]), often=_pack(c[often]),
            pairs_before=small(before), pairs_words=small(words), pairs=_pack(c), token=small(token), doc=_pack(doc),
            blocks=_pack(blocks), sizes=_pack(sizes),
            n1=int(once.sum()), n2=int((c == 2).sum()), n_types=int((n > 0).sum()),
        )
        pa.default_memory_pool().release_unused()
        return pa.concat_tables([documents, row])

    return tokens.groupBy("bucket").applyInArrow(bucket_of, BUCKETS.format(kind))


class Trained(NamedTuple):
    """The model: its buckets and common words, and the totals of the seatings that are averaged."""

    buckets: DataFrame
    told: DataFrame  # the homes' last answers
    common_n: np.ndarray  # training tokens of the common words, END among them
    common_keys: np.ndarray
    samples: list[State]
    tokens: int
    n_buckets: int

    @property
    def types(self) -> int:
        return self.samples[0].types

    @property
    def unseen(self) -> np.ndarray:
        """The root's probability of a word it has not seen."""
        return np.array([np.mean([s.root(0.0, 0.0) for s in self.samples])])

    def _read(self, columns, rows_of, schema: str) -> DataFrame:
        """Rows of all buckets with the homes' last answers."""

        def rows(left: pa.Table, right: pa.Table) -> pa.Table:
            return rows_of(_first(left), right.to_pylist())

        own = self.buckets.filter("keys is not null").select("bucket", *columns).groupBy("bucket")
        return own.cogroup(self.told.groupBy("bucket")).applyInArrow(rows, schema)

    @property
    def words(self) -> DataFrame:
        """key, n_train, logp (log10 probabilities after a word never seen), and in each of the averaged seatings the share of its
        restaurant's probability that the root has, and its probability in the root."""
        schema = "key bigint, n_train bigint, logp array<double>, handed_on array<double>, root array<double>"

        def table_of(keys, n, totals) -> pa.Table:
            handed = np.array([s.weight(t) / (STRENGTH + n) for s, (t, _, _) in zip(samples, totals, strict=True)])
            root = np.array([s.root(served, roots) for s, (_, served, roots) in zip(samples, totals, strict=True)])
            logp = np.log10(root.mean(axis=0)).reshape(-1, 1).tolist()
            seen, names = pa.array(n > 0), ["key", "n_train", "logp", "handed_on", "root"]
            columns = [pa.array(keys.view(np.int64)), pa.array(n), pa.array(logp, pa.list_(pa.float64()))]
            columns += [pa.array(a.T.tolist(), pa.list_(pa.float64())) for a in (handed, root)]
            return pa.table(columns, names).filter(seen)

        def words_of(row: dict, told: list[dict]) -> pa.Table:
            keys, n = _unpack(row["keys"], np.uint64), _unpack(row["n"], np.int64)
            mine = next(r for r in told if r["kind"] == "state")
            return table_of(keys, n, _unpack(mine["past"], np.int64).reshape(len(samples), 3, len(keys)))

        samples = self.samples
        common = table_of(self.common_keys, self.common_n, [(s.tables, s.served, s.roots) for s in samples])
        common = self.buckets.sparkSession.createDataFrame(common, schema)
        return self._read(("keys", "n"), words_of, schema).unionByName(common)

    @property
    def pairs(self) -> DataFrame:
        """before, word (keys), n_train, logp (log10 probability of the word after the one before), of all pairs in the documents."""
        n, keys, samples, buckets = self.common_n, self.common_keys, self.samples, self.n_buckets

        def pairs_of(row: dict, told: list[dict]) -> pa.Table:
            before, words, chance, _ = _chances(row, told, n, samples, buckets)
            known = np.concatenate((keys, *(_unpack(row[c], np.uint64) for c in KEYS))).view(np.int64)
            columns = [known[before], known[words], _unpack(row["pairs"], np.int64), np.log10(chance)]
            return pa.table([pa.array(c) for c in columns], ["before", "word", "n_train", "logp"])

        return self._read((*KEYS, *WHOLE), pairs_of, "before bigint, word bigint, n_train bigint, logp double")


def _told_rows(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _schema(TOLD))


def _first(table: pa.Table) -> dict:
    return table.to_pylist()[0]


def _sit(row: dict, told: list[dict], given: State | None, common_keys, number: int, last: bool, buckets: int) -> pa.Table:
    """One bucket's seating, what it tells homes, and its parts of the common words' totals; without ``given``, the first one."""
    bucket, size = row["bucket"], len(common_keys)
    keys, away = _unpack(row["keys"], np.uint64), _unpack(row["often_away"], np.uint64)
    before, words = (_unpack(row[c], np.int32) for c in SEATS[:2])
    customers = _unpack(row["often"], np.int64)
    fixed, fixed_served = (_unpack(row[c], np.int32).astype(np.int64) for c in SEATS[3:])
    end = size + len(keys)
    mine = next((r for r in told if r["kind"] == "state"), {})
    if given is None:
        seated, summed = np.ones(len(customers)), np.zeros(len(customers), np.int32)
    else:
        homes, tables = _home(away, buckets), np.zeros(len(away), np.int64)
        for r in told:
            if r["kind"] == "answer":
                tables[homes == r["sender"]] = _unpack(r["tables"], np.int64)
        all_tables = np.concatenate((given.tables, _unpack(mine["tables"], np.int64), tables))
        all_served, all_roots = (
            np.concatenate((top, _unpack(mine[c], np.int64))) for top, c in ((given.served, "served"), (given.roots, "roots"))
        )
        all_keys = np.concatenate((common_keys, keys, away))
        seated = given.seat_pairs(
            customers, all_tables[before], all_served[words], all_roots[words], _pair_keys(all_keys[before], all_keys[words]), number
        )
        summed = _unpack(mine["summed"], np.int32) + (seated if number >= BURN_IN else 0)
    moving = np.bincount(before, seated, end + len(away)).astype(np.int64)
    served = fixed_served + np.bincount(words, seated, end).astype(np.int64)
    own = served[size:]
    roots = np.minimum(own, 1) if given is None else given.seat_root(own, keys, number).astype(np.int64)
    out = [{
        "kind": "state", "bucket": bucket, "sender": bucket, "fixed": mine.get("fixed") or _pack(fixed[size:]), "tables": _pack(moving[size:end]),
        "served": _pack(own), "roots": _pack(roots), "summed": _pack(summed.astype(np.int32)), "past": mine.get("past") or _pack(keys[:0]),
        "n_served": int(own.sum()), "n_roots": int(roots.sum()),
    }]
    # Others have but their pairs that come once to tell at first, and to hear what scoring needs in the end.
    ends = given is None or last
    tell = np.concatenate((away, _unpack(row["other_away"], np.uint64))) if ends else away
    tables, awaited = np.zeros(len(tell), np.int64), np.arange(len(tell)) < len(away)
    tables[: len(away)] = moving[end:]
    once = _unpack(row["once_away"], np.int32).astype(np.int64) if given is None else None
    for home, some in _grouped(_home(tell, buckets), np.arange(len(tell))):
        first = {"fixed": _pack(once[some])} if given is None else {}
        ask = {"kind": "ask", "bucket": home, "sender": bucket, "keys": _pack(tell[some]), "tables": _pack(tables[some])}
        out.append(ask | first | {"served": _pack(awaited[some])})
    for piece in range(0, size, PIECE):
        part = slice(piece, min(size, piece + PIECE))
        out.append({"kind": "common", "bucket": piece // PIECE, "tables": _pack(fixed[part] + moving[part]), "served": _pack(served[part])})
    return _told_rows(out)


def _answer(row: dict, told: list[dict], number: int, last: bool) -> pa.Table:
    """A home's sums of its words' tables, and its answers."""
    keys = _unpack(row["keys"], np.uint64)
    mine = next(r for r in told if r["kind"] == "state")
    asks = sorted((r for r in told if r["kind"] == "ask"), key=lambda r: r["sender"])
    fixed, tables = _unpack(mine["fixed"], np.int64).copy(), _unpack(mine["tables"], np.int64).copy()
    places = [np.searchsorted(keys, _unpack(r["keys"], np.uint64)) for r in asks]
    for r, at in zip(asks, places, strict=True):
        tables[at] += _unpack(r["tables"], np.int64)
        if r["fixed"]:
            fixed[at] += _unpack(r["fixed"], np.int64)
    tables += fixed
    past = _unpack(mine["past"], np.int64).reshape(-1, 3, len(keys)) if len(keys) else np.zeros((0, 3, 0), np.int64)
    if number >= BURN_IN:
        past = np.concatenate((past, [[tables, _unpack(mine["served"], np.int64), _unpack(mine["roots"], np.int64)]]))
    out = [mine | {"fixed": _pack(fixed), "tables": _pack(tables), "past": _pack(past.ravel())}]
    n = _unpack(row["n"], np.int64) if last else None
    for r, at in zip(asks, places, strict=True):
        answer = {"kind": "answer", "bucket": r["sender"], "sender": r["bucket"]}
        if last:
            out.append(answer | {"served": _pack(n[at]), "past": _pack(past[:, 0, at].ravel())})
        else:
            out.append(answer | {"tables": _pack(tables[at[_unpack(r["served"], bool)]])})
    return _told_rows(out)


def _sum_pieces(table: pa.Table) -> pa.Table:
    sums = {c: _pack(sum(_unpack(b, np.int64) for b in table[c].to_pylist())) for c in ("tables", "served")}
    return _told_rows([{"kind": "common", "bucket": table["bucket"][0].as_py()} | sums])


def _steps(given: State | None, common_keys: np.ndarray, number: int, last: bool, buckets: int):
    """The functions of one sweep: a bucket seats with its answers, or without any, and a home sums up."""

    def sit(left: pa.Table, right: pa.Table) -> pa.Table:
        return _sit(_first(left), right.to_pylist(), given, common_keys, number, last, buckets)

    def sit_first(left: pa.Table) -> pa.Table:
        return _sit(_first(left), [], given, common_keys, number, last, buckets)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        return _answer(_first(left), right.to_pylist(), number, last)

    return sit, sit_first, answer


def train(docs: DataFrame) -> Trained:
    """Count the training words and pairs and sample the seating: BURN_IN sweeps, then SAMPLES that are averaged."""
    spark = docs.sparkSession
    words = materialise(count_words(docs), "words")
    one, two = ((F.col("c") == k).cast("long") for k in (1, 2))
    row = words.agg(F.count("*").alias("types"), F.sum("c").alias("n"), F.sum(one).alias("r1"), F.sum(two).alias("r2")).first()
    types, n = row["types"], int(row["n"] or 0)
    share = lambda one, two: min(0.95, max(0.05, (one or 0) / max(1.0, (one or 0) + 2 * (two or 0))))
    top = words.orderBy(F.col("word") != END, F.desc("c"), "word").limit(FREQUENT).toArrow()  # FREQUENT rows at most
    listed, counts = top["word"].to_pylist(), top["c"].to_numpy().astype(np.int64)
    if END not in listed:
        listed, counts = [END, *listed], np.concatenate(([0], counts))
    size, n_buckets, common_keys = len(listed), max(1, -(-n // BUCKET)), _keys(listed)
    common = spark.sparkContext.broadcast(({w: i for i, w in enumerate(listed)}, counts))
    base = np.log10((counts + ALPHA) / (n + ALPHA * (types + 1)))
    buckets = materialise(gather(scatter(docs, common, base, n_buckets), size, n_buckets), "buckets")
    sums = buckets.agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"), F.sum("n_types").alias("types")).first()
    if int(sums["types"] or 0) + int((counts > 0).sum()) != types:
        raise ValueError("two words have the same key")
    discount, root_discount = share(sums["n1"], sums["n2"]), share(row["r1"], row["r2"])
    own = buckets.filter("keys is not null")
    given, told, samples = None, None, []
    # The chain begins with one table for every dish.
    for number in range(-1, BURN_IN + SAMPLES):
        last = number == BURN_IN + SAMPLES - 1
        told_all = ["other_away", "once_away"] if given is None else ["other_away"] if last else []
        seats = own.select("bucket", *KEYS[:2], *SEATS, *told_all).groupBy("bucket")
        homes = own.select("bucket", "keys", *(["n"] if last else [])).groupBy("bucket")
        sit, sit_first, answer = _steps(given, common_keys, number, last, n_buckets)
        seated = seats.applyInArrow(sit_first, TOLD) if told is None else seats.cogroup(told.groupBy("bucket")).applyInArrow(sit, TOLD)
        seated = materialise(seated, f"seating-{number}")
        total = seated.filter("kind = 'state'").agg(F.sum("n_served").alias("s"), F.sum("n_roots").alias("r")).first()
        pieces = seated.filter("kind = 'common'").groupBy("bucket").applyInArrow(_sum_pieces, TOLD).select("bucket", "tables", "served")
        pieces = sorted(pieces.collect(), key=lambda r: r["bucket"])  # FREQUENT / PIECE rows
        tables, served = (
            np.concatenate([_unpack(r[c], np.int64) for r in pieces]) if pieces else np.zeros(size, np.int64) for c in ("tables", "served")
        )
        roots = np.minimum(served, 1) if given is None else given.seat_root(served, common_keys, number).astype(np.int64)
        customers, root_tables = int(total["s"] or 0) + served.sum(), int(total["r"] or 0) + roots.sum()
        given = State(tables, served, roots, float(customers), float(root_tables), types, discount, root_discount)
        samples += [given] if number >= BURN_IN else []
        told = homes.cogroup(seated.filter("kind <> 'common'").groupBy("bucket")).applyInArrow(answer, TOLD)
    return Trained(buckets, told, counts, common_keys, samples, n, n_buckets)


def _chances(row: dict, told: list[dict], common_n: np.ndarray, samples: list[State], buckets: int):
    """(probability of each of a bucket's pairs, the words' training tokens) by code of a word."""
    at_home = len(_unpack(row["keys"], np.uint64))
    homes = _home(np.concatenate([_unpack(row[c], np.uint64) for c in KEYS[1:]]), buckets)
    mine = next(r for r in told if r["kind"] == "state")
    past = _unpack(mine["past"], np.int64).reshape(len(samples), 3, at_home)
    away_n, away = np.zeros(len(homes), np.int64), np.zeros((len(samples), len(homes)), np.int64)
    for r in told:
        if r["kind"] == "answer":
            at = homes == r["sender"]
            away_n[at] = _unpack(r["served"], np.int64)
            away[:, at] = _unpack(r["past"], np.int64).reshape(len(samples), -1)
    n = np.concatenate((common_n, _unpack(row["n"], np.int64), away_n))
    before, words, c = _unpack(row["pairs_before"], np.int32), _unpack(row["pairs_words"], np.int32), _unpack(row["pairs"], np.int64)
    seated = np.minimum(c, 1).astype(float)
    seated[c > 1] = _unpack(mine["summed"], np.int32) / len(samples)
    # Every word is followed by one token, so that its training tokens are its restaurant's customers.
    chance = (c - samples[0].discount * seated) / (STRENGTH + n)[before]
    for s, (tables, served, roots), others in zip(samples, past, away, strict=True):
        handed_on = s.weight(np.concatenate((s.tables, tables, others))) / (STRENGTH + n) / len(samples)
        root = s.root(np.concatenate((s.served, served)), np.concatenate((s.roots, roots)))
        chance += handed_on[before] * root[words]
    return before, words, chance, n


PARTS = "block bigint, at binary, n_known binary, base binary, score binary"


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Input: doc_id (integer), text; other columns are not read. One output row per input row,
    also for repeated ones. Null and empty texts have the end token only. A row without
    doc_id is not held out. ``score`` is the model's log10 probability of all tokens. Without any
    training text the base and the model are uniform over the one unseen token. An
    empty table gives no rows.
    """
    trained = train(docs)
    n_train, types, n_buckets = trained.tokens, trained.types, trained.n_buckets
    counts = trained.common_n
    samples = docs.sparkSession.sparkContext.broadcast([tuple(s) for s in trained.samples])

    def score(row: dict, told: list[dict]) -> pa.Table:
        _, words, chance, n = _chances(row, told, counts, [State(*s) for s in samples.value], n_buckets)
        token, doc = _unpack(row["token"], np.int32), _unpack(row["doc"], np.int32)
        blocks, sizes = _unpack(row["blocks"], np.int64), _unpack(row["sizes"], np.int64)
        rare = words >= len(counts)
        base = np.where(rare, np.log10((n[words] + ALPHA) / (n_train + ALPHA * (types + 1))), 0)
        total = lambda of: np.bincount(doc, of[token], sizes.sum())
        parts = [total(rare & (n[words] > 0)), total(base), total(np.log10(chance))]
        met = np.bincount(doc, minlength=sizes.sum()) > 0
        out = []
        for block, start, end in zip(blocks.tolist(), np.cumsum(sizes) - sizes, np.cumsum(sizes), strict=True):
            at = np.flatnonzero(met[start:end])
            known, base, score = (p[start:end][at] for p in parts)
            out.append({"block": block, "at": _pack(at.astype(np.int32)), "n_known": _pack(known.astype(np.int32)), "base": _pack(base), "score": _pack(score)})
        return pa.Table.from_pylist(out, _schema(PARTS))

    kind = dict(docs.dtypes)["doc_id"]
    rows = "doc_id {}, n_tokens bigint, n_known bigint, base_score double, score double"

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("at")
        known, base, score = left["n_known"].to_numpy().copy(), left["base"].to_numpy().copy(), np.zeros(len(left))
        for r in right.to_pylist():
            at = _unpack(r["at"], np.int32)
            known[at] += _unpack(r["n_known"], np.int32)
            base[at] += _unpack(r["base"], np.float64)
            score[at] += _unpack(r["score"], np.float64)
        return pa.table([left["doc_id"], left["n_tokens"], pa.array(known), pa.array(base), pa.array(score)], _schema(rows.format("int"), left.schema.field("doc_id").type))

    parts = trained._read((*KEYS, *WHOLE), score, PARTS)
    documents = trained.buckets.filter("keys is null").select("block", "at", "doc_id", "n_tokens", "n_known", "base")
    summed = documents.groupBy("block").cogroup(parts.groupBy("block")).applyInArrow(add, rows.format(kind))
    return summed.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
        F.lit(n_train).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
