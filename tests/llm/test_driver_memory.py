"""What the driver holds beside the tables it has to: the classifier's training and the packing plan."""

import tracemalloc

import llm_data
import numpy as np
import pyarrow as pa
import pytest

from evalspark.llm import packing, toxicity

MB = 1 << 20


def test_patterns_are_found_without_a_table_of_all_pairs(monkeypatch):
    counts = np.random.default_rng(1).integers(0, 50, 64)
    counts[0] = 0
    monkeypatch.setattr(packing, "TRIPLES", 20)
    here = [n for n in range(64) if counts[n]]
    pairs = [(a, 64 - a) for a in here if a <= 64 - a and 64 - a in here]
    every = [(a, b, 64 - a - b) for a in here for b in here if a <= b <= 64 - a - b and 64 - a - b in here]
    every.sort(key=lambda t: -min(counts[n] for n in t))
    assert packing.patterns(counts, 64) == pairs + every[:20] and len(every) > 20
    assert packing.patterns(np.zeros(64, np.int64), 64) == []
    tracemalloc.start()
    packing.patterns(np.arange(packing.WINDOW), packing.WINDOW)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * MB


def test_a_round_changes_the_model_in_place():
    model = toxicity.untrained()
    power = toxicity.fresh_power(model)
    rng = np.random.default_rng(2)
    dense = rng.random(len(toxicity._dense(model, power)))
    at, values = [np.zeros(1, "<i4")], [dense.astype("<f8")]
    for first in range(0, toxicity.WORDS + toxicity.STEMS, toxicity.BLOCK):
        at.append(np.arange(first, first + toxicity.BLOCK, 2, dtype="<i4"))
        values.append(rng.random((len(at[-1]), 2 * toxicity.SIZE)).astype("<f4"))
    blocks = [-1, *range(len(at) - 1)]
    mean = [pa.array(blocks, pa.int32()), *(pa.array([x.tobytes() for x in some], pa.binary()) for some in (at, values))]
    mean = pa.table(mean, ["block", "at", "values"])
    before = model.words.copy(), model.stems.copy()
    tracemalloc.start()
    after = toxicity._moved(model, power, mean)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * MB
    for k, size, old in (("words", toxicity.WORDS, before[0]), ("stems", toxicity.STEMS, before[1])):
        first = 0 if k == "words" else toxicity.WORDS
        new = np.concatenate([v for a, v in zip(at[1:], values[1:]) if first <= a[0] < first + size])
        assert (getattr(after, k)[::2] == new[:, : toxicity.SIZE]).all() and (getattr(after, k)[1::2] == old[1::2]).all()
        assert (power[k][::2] == new[:, toxicity.SIZE :]).all() and (power[k][1::2] == np.float32(1e-3)).all()
    assert np.allclose(toxicity._dense(after, power), dense)


@pytest.mark.parametrize("toxic", [0.5, 0.0])
def test_training_leaves_no_broadcast_behind(spark, monkeypatch, toxic):
    made, gone = [], []
    context, kind = type(spark.sparkContext), type(spark.sparkContext.broadcast(0))
    broadcast, destroy = context.broadcast, kind.destroy
    monkeypatch.setattr(context, "broadcast", lambda self, x: made.append(broadcast(self, x)) or made[-1])
    monkeypatch.setattr(kind, "destroy", lambda self, *a: gone.append(self) or destroy(self, *a))
    docs = llm_data.documents(spark, [(i, t) for i, t in enumerate(llm_data.sentences(60))])
    labels = spark.createDataFrame([(i, int(i < 60 * toxic)) for i in range(60)], "doc_id bigint, toxic int")
    toxicity.train(docs, labels)
    assert made and {id(x) for x in made} == {id(x) for x in gone}
