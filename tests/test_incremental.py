import gzip
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from evalspark.operators import incremental as inc, jsoneval, judge, textmetrics
from evalspark.sources import list_files, read_judgements, read_jsonl
from evalspark import schemas

GOOD, BAD = '{"entities":["x","y"],"location":"p","date":"d"}', "no json"


def write(path, rows, age):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def preds(n, checkpoint="c0", start=0, prediction=GOOD):
    return [
        {"id": i, "checkpoint": checkpoint, "instruction": "i", "input": "", "task_type": "t",
         "prediction": prediction if i % 3 else BAD, "reference": GOOD}
        for i in range(start, start + n)
    ]


def shown(df):
    return sorted(json.dumps(r.asDict(True), sort_keys=True, default=str) for r in df.collect())


def check(spark, folder, store):
    rows = read_jsonl(spark, f"{folder}/*.jsonl", schemas.PREDICTIONS)
    scored = jsoneval.score_json(rows)
    assert shown(inc.json_metrics(spark, f"{store}/json")) == shown(jsoneval.json_metrics(scored))
    labels = ("c0", "c9")
    assert shown(inc.json_metrics(spark, f"{store}/json", labels)) == shown(jsoneval.json_metrics(scored, labels))
    assert shown(inc.error_taxonomy(spark, f"{store}/json")) == shown(jsoneval.error_taxonomy(scored))
    assert shown(inc.text_metrics(spark, f"{store}/text")) == shown(textmetrics.text_metrics(rows))


def bring_up(spark, folder, store):
    found = [inc.update(spark, kind, f"{folder}/*.jsonl", f"{store}/{name}") for name, kind in (("json", inc.JSON), ("text", inc.TEXT))]
    assert found[0] == found[1]
    return found[0]


def test_files_come_change_and_go(spark, tmp_path):
    folder, store = tmp_path / "preds", str(tmp_path / "store")
    assert bring_up(spark, folder, store) == {}
    write(folder / "a.jsonl", preds(9), 1)
    write(folder / "b [c]%.jsonl", preds(5, "c1", 100), 1)
    assert bring_up(spark, folder, store) == {"new": 2}
    check(spark, folder, store)
    assert bring_up(spark, folder, store) == {}
    write(folder / "a.jsonl", preds(9, prediction='{"entities":1}'), 2)  # same length of name, other rows
    write(folder / "d.jsonl", preds(4, "c0", 50), 2)
    assert bring_up(spark, folder, store) == {"new": 1, "replaced": 1}
    check(spark, folder, store)
    (folder / "b [c]%.jsonl").unlink()
    write(folder / "empty.jsonl", [], 3)
    assert bring_up(spark, folder, store) == {"gone": 1}  # nothing is listed of an empty file
    check(spark, folder, store)
    write(folder / "b [c]%.jsonl", preds(5, "c1", 100), 1)  # back as it was
    assert bring_up(spark, folder, store) == {"new": 1}
    check(spark, folder, store)


def test_an_update_reads_changed_files_only(spark, tmp_path):
    folder, store = tmp_path / "preds", str(tmp_path / "store")
    write(folder / "a.jsonl", preds(9), 1)
    inc.update(spark, inc.JSON, str(folder), store)
    # Were it read again, the broken line would fail the job.
    (folder / "a.jsonl").write_text("{broken\n" + "x" * (os.path.getsize(folder / "a.jsonl") - 8))
    os.utime(folder / "a.jsonl", (1_700_000_001, 1_700_000_001))
    write(folder / "b.jsonl", preds(3, "c1"), 5)
    assert inc.update(spark, inc.JSON, str(folder), store) == {"new": 1}
    os.utime(folder / "a.jsonl", (1_700_000_009, 1_700_000_009))
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        inc.update(spark, inc.JSON, str(folder), store)
    # The failed update left nothing that counts.
    assert {r.checkpoint: r.total for r in inc.json_metrics(spark, store).collect()} == {"c0": 9, "c1": 3}


def test_an_update_that_stopped_before_its_ledger_does_not_count(spark, tmp_path):
    folder, store = tmp_path / "preds", str(tmp_path / "store")
    write(folder / "a.jsonl", preds(9), 1)
    inc.update(spark, inc.JSON, str(folder), store)
    stray = spark.read.parquet(f"{store}/partials/update=1").withColumn("total", F.lit(1000).cast("bigint"))
    stray.write.parquet(f"{store}/partials/update=2")
    assert [r.total for r in inc.json_metrics(spark, store).collect()] == [9]
    write(folder / "b.jsonl", preds(2), 1)
    inc.update(spark, inc.JSON, str(folder), store)
    assert [r.total for r in inc.json_metrics(spark, store).collect()] == [11]


def judgements(n, a, b, shift=0):
    winners = ["a", "B", "tie", "Ties", "?", None]
    return [
        {"prompt_id": str(i), "checkpoint_a": a, "checkpoint_b": b, "winner": winners[(i + shift) % 6],
         "response_a_scores": {"clarity": i}, "response_b_scores": {"clarity": 2.5, "odd": 1},
         "justification": "", "swapped": False}
        for i in range(n)
    ]


def test_judgements_equal_a_full_run(spark, tmp_path):
    folder, store, labels = tmp_path / "judge", str(tmp_path / "store"), ("c0", "c1", "c2")
    for age, files in enumerate(([("x", "c0", "c1", 13), ("y", "c1", "c2", 8)], [("y", "c2", "c1", 5), ("z", "c0", "other", 4)])):
        for name, a, b, n in files:
            write(folder / f"{name}.jsonl", judgements(n, a, b, age), age)
        inc.update(spark, inc.JUDGEMENTS, f"{folder}/*.jsonl", store)
        full = judge.judge_stats(read_judgements(spark, f"{folder}/*.jsonl"), labels)
        assert shown(inc.judge_stats(spark, store, labels)) == shown(full)


def test_missing_paths_list_nothing(spark, tmp_path):
    assert list_files(spark, [str(tmp_path / "no"), str(tmp_path / "none*")]).collect() == []


def test_files_kept_up_to_date_are_packed_and_of_even_size(spark, monkeypatch):
    from evalspark.workload import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 20, raising=False)
    rows = spark.createDataFrame(preds(400) + preds(200, "c1", 400), schemas.PREDICTIONS)
    store = queries.kept_up_to_date(spark, rows, inc.JSON, "id")
    assert shown(inc.json_metrics(spark, store)) == shown(jsoneval.json_metrics(jsoneval.score_json(rows)))
    files = [x for x in Path(store.removeprefix("file:")).parent.glob("files/part=*/part-*") if x.stat().st_size]
    texts = [gzip.open(x).read() for x in files]
    assert max(x.count(b"\n") for x in texts) <= 20 and sum(x.count(b"\n") for x in texts) == 600
    assert sum(x.stat().st_size for x in files) < 0.5 * sum(map(len, texts))
