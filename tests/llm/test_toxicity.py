import random
import zlib

import llm_data
import numpy as np
import pyarrow as pa

from evalspark.llm import toxicity

BAD = ["grimble", "snorkfest", "wuzzle", "dratpot"]


def corpus(n=600, seed=8):
    rng = random.Random(seed)
    rows = []
    for i, t in enumerate(llm_data.sentences(n, seed, (5, 80), llm_data.vocabulary(500, 9))):
        words, toxic = t.split(), int(rng.random() < 0.2)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ",", ".", "s"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_documents_are_told_apart(spark):
    rows = corpus()
    docs = llm_data.documents(spark, [(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (None, "x"), (5, rows[5][1])])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(1, 0, None)], "doc_id bigint, quality int, toxic int")
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == len(rows) + 4
    by = {r.doc_id: r for r in found}
    for i, r in by.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
    held = [(by[i].score, y) for i, _, y in rows if by[i].held_out]
    yes = [s for s, y in held if y]
    no = [s for s, y in held if not y]
    assert np.mean([a > b for a in yes for b in no]) > 0.95
    assert by[5000].score == by[5001].score


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows = corpus(200)
    docs = llm_data.documents(spark, [(i, t) for i, t, _ in rows])
    flip = lambda i, y: 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y
    tables = [spark.createDataFrame([(i, f(i, y)) for i, _, y in rows], "doc_id bigint, toxic int") for f in (lambda i, y: y, flip)]
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(docs, t).collect()} for t in tables)
    assert a == b


def test_slices_do_not_change_the_maxima(monkeypatch):
    rows = corpus(60)
    texts = pa.array([t for _, t, _ in rows] + ["", "one"], pa.large_string())
    learned = toxicity.examples(texts, [y for *_, y in rows] + [0, 1.0], [None] * 62)
    toxic = sum(x.label for x in learned)
    model = toxicity.fit(lambda: learned, lambda: learned, 62, toxic, toxicity.seen_rows(learned), (62, toxic))
    whole = toxicity.logits(model, texts)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert np.allclose(whole, toxicity.logits(model, texts), atol=1e-4)
    assert np.allclose(whole, [toxicity.logits(model, texts.slice(k, 1))[0] for k in range(62)], atol=1e-4)


def test_drop_and_tables_without_labels(spark):
    rows = corpus()
    docs = llm_data.documents(spark, [(i, t) for i, t, _ in rows] + [(7000, None)])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    left = toxicity.drop_toxic(docs, labels)
    ids = {r.doc_id for r in left.collect()}
    assert left.columns == docs.columns and 7000 in ids
    assert len(ids & {i for i, _, y in rows if y}) <= 0.1 * sum(y for *_, y in rows)
    assert len(ids & {i for i, _, y in rows if not y}) >= 0.97 * sum(1 - y for *_, y in rows)
    scores = {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()}
    assert len(scores) == 1
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_all_labelled_documents_are_learned_from_in_shards(spark, monkeypatch):
    """Every text beyond the first hashes counts: one that marks a word toxic is enough in any shard."""
    rows = corpus(1500)
    docs = llm_data.documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    seen = []
    started = toxicity.started
    monkeypatch.setattr(toxicity, "started", lambda *a: seen.append(a) or started(*a))
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 1 << 16)
    monkeypatch.setattr(toxicity, "SAMPLE", 100, raising=False)  # no cut any more
    a, b = ({r.doc_id: r for r in toxicity.toxicity(docs.repartition(n), labels).collect()} for n in (2, 5))
    n_texts, n_toxic, _, prior = seen[0]
    used = [y for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    assert prior == (len(used), sum(used)) and n_texts > 0.7 * len(used)
    assert {i: r.score for i, r in a.items()} == {i: r.score for i, r in b.items()}
    held = [(r.score, rows[i][2]) for i, r in a.items() if r.held_out]
    yes, no = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([x > y for x in yes for y in no]) > 0.95


def test_only_labelled_texts_move_and_only_once(spark, monkeypatch):
    """Rounds read the shards where they are written; texts without a label stay out of them."""
    rows = corpus(900)
    docs = llm_data.documents(spark, [(i, t) for i, t, _ in rows] + [(None, "x"), (1, None)])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3 == 0] + [(9999, 1)], "doc_id int, toxic int")
    written, plans = {}, []
    materialise = toxicity.materialise

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        written[name] = materialise(df, name)
        return written[name]

    monkeypatch.setattr(toxicity, "materialise", kept)
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 1 << 14)
    model = toxicity.train(docs, labels)
    assert model.scale != (1.0, 0.0)
    shards = [toxicity._unpacked(r.asDict()) for r in written["toxicity-shards"].collect()]
    used = [y for i, _, y in rows if i % 3 == 0 and zlib.crc32(str(i).encode()) % 4 != 2]
    assert sum(map(len, shards)) == len(used) and sum(x.label for s in shards for x in s) == sum(used)
    assert len({r.shard for r in written["toxicity-shards"].select("shard").collect()}) > 1
    plan = dict(plans)["toxicity-shards"]
    assert plan.count("Exchange hashpartitioning(shard") == 2 and "SortMergeJoin" not in plan
    found = docs.filter(toxicity._maybe_known(written["toxicity-labels"]))
    ids = [r.doc_id for r in found.collect()]
    assert {i for i, _, y in rows if i % 3 == 0 and zlib.crc32(str(i).encode()) % 4 != 2} <= set(ids)
    assert len(ids) < 1.1 * len(used)
