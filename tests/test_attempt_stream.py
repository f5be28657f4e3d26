import json
import random

import pytest
from test_attempts import API, BAD, ERR, JUDGE, LIST, OK, TEACHER

from evalspark.streaming import attempt_stream as st

FAR = "2030-01-01T00:00:00Z"


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"idx": i, "attempt": a, "status": s, "text": t, "at": at}) for i, a, s, t, at in rows]
    (folder / f".{name}").write_text("".join(x + "\n" for x in lines))
    (folder / f".{name}").rename(folder / f"{name}.json")


def calls(cases, start=0):
    rows = []
    for idx, attempts in enumerate(cases, start):
        for n, call in enumerate(attempts):
            status, text = call if isinstance(call, tuple) else ("ok", call)
            rows.append((idx, n, status, text, f"2024-01-01T00:{n:02d}:{idx % 60:02d}Z"))
    return rows


def run(spark, tmp_path, follow=st.follow_attempts, **options):
    outcomes = follow(st.read_log(spark, str(tmp_path / "log"), 1), **options)
    st.start(outcomes, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    return {r.idx: (r.outcome, r.attempt, r.text) for r in st.settled(spark, str(tmp_path / "out")).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_a_restart_give_the_rows_of_the_batch_job(spark, tmp_path, seed):
    rows = calls([c for c, _ in TEACHER])
    rows += random.Random(seed).sample(rows, 10)  # some come twice
    random.Random(seed).shuffle(rows)
    write(tmp_path / "log", "a", rows[: len(rows) // 3])
    write(tmp_path / "log", "b", rows[len(rows) // 3 : len(rows) // 2])
    first = run(spark, tmp_path)
    write(tmp_path / "log", "c", rows[len(rows) // 2 :])
    found = run(spark, tmp_path)  # from the checkpoint
    assert first.items() <= found.items()
    wanted = {i: a for i, (_, a) in enumerate(TEACHER) if a is not None}
    assert {i: a for i, (o, a, _) in found.items() if o == st.ACCEPTED} == wanted
    assert all(found[i][2] in (OK, LIST) for i in wanted)
    written = st.settled(spark, str(tmp_path / "out"))
    assert written.count() == written.select("idx").distinct().count()


def test_judge_rules(spark, tmp_path):
    rows = calls([c for c, _ in JUDGE])
    random.Random(3).shuffle(rows)
    write(tmp_path / "log", "a", rows)
    found = run(spark, tmp_path, st.follow_judge_attempts)
    wanted = {i: a for i, (_, a) in enumerate(JUDGE) if a is not None}
    assert {i: a for i, (o, a, _) in found.items() if o == st.ACCEPTED} == wanted


def test_silent_prompts_are_given_up_by_their_timer(spark, tmp_path):
    open_cases = [[API], [API, API], [BAD], []]
    rows = calls([[OK], *open_cases, [ERR]])
    asked = [(i, None, None, None, "2024-01-01T00:00:00Z") for i in range(6)]
    write(tmp_path / "log", "a", asked + rows)
    assert {i: r[0] for i, r in run(spark, tmp_path).items()} == {0: st.ACCEPTED, 5: st.FAILED}
    # Two hours on another prompt's call moves the watermark past the wait of those before.
    write(tmp_path / "log", "b", [(50, 0, "api_error", None, "2024-01-01T03:00:00Z")])
    found = run(spark, tmp_path)
    assert {i: r[0] for i, r in found.items()} == {
        0: st.ACCEPTED, 1: st.TIMED_OUT, 2: st.TIMED_OUT, 3: st.TIMED_OUT, 4: st.TIMED_OUT, 5: st.FAILED
    }
    # What comes behind the watermark is dropped: no prompt is settled twice.
    write(tmp_path / "log", "c", rows + [(50, 1, "ok", OK, "2024-01-01T03:01:00Z")])
    again = run(spark, tmp_path)
    assert again == found | {50: (st.ACCEPTED, 1, OK)}
    waiting = st.pending(st.settled(spark, str(tmp_path / "out"))).collect()
    assert sorted(r.idx for r in waiting) == [1, 2, 3, 4, 5]


def test_a_late_row_within_the_wait_still_counts(spark, tmp_path):
    write(tmp_path / "log", "a", [(1, 1, "ok", OK, "2024-01-01T01:00:00Z")])
    assert run(spark, tmp_path) == {}
    write(tmp_path / "log", "b", [(1, 0, "api_error", None, "2024-01-01T00:10:00Z")])
    assert run(spark, tmp_path) == {1: (st.ACCEPTED, 1, OK)}


def test_outcomes_need_no_gap_free_prefix_beyond_the_deciding_attempt():
    assert st.teacher_outcome("aa.v", 4, 1) is None
    assert st.teacher_outcome("aav.", 4, 1) == (st.ACCEPTED, 2)
    assert st.teacher_outcome("aaaaa", 4, 1) == (st.FAILED, 4)
    assert st.teacher_outcome("ii", 4, 1) == (st.FAILED, 1)
    assert st.judge_outcome("iia", 3) is None and st.judge_outcome("iiai", 3) == (st.FAILED, 3)


def test_nothing_written_yet(spark, tmp_path):
    assert st.settled(spark, str(tmp_path / "none")).collect() == []


def test_prompts_with_ids_in_a_row_share_their_state(spark, tmp_path):
    """A call of Python and a state row for each prompt took most of the time of a long log."""
    ids = [*range(300), 10**15, -5, 2**62]
    rows = [(i, 0, "api_error", None, f"2024-01-01T00:00:{abs(i) % 60:02d}Z") for i in ids]
    write(tmp_path / "log", "a", [*rows, (None, 0, "api_error", None, "2024-01-01T00:00:00Z")])
    outcomes = st.follow_attempts(st.read_log(spark, str(tmp_path / "log")))
    query = st.start(outcomes, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    kept = max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators)
    assert kept <= 300 // 2**6 + 1 + 4
    # A third answers; of the others some are heard later than their block's neighbours and so given up later.
    more = [(i, 1, "ok", OK, "2024-01-01T00:50:00Z") for i in ids if i % 3 == 0]
    more += [(i, 1, "api_error", None, "2024-01-01T00:50:00Z") for i in ids if i % 3 == 1]
    write(tmp_path / "log", "b", more)
    found = run(spark, tmp_path)
    assert found == {i: (st.ACCEPTED, 1, OK) for i in ids if i % 3 == 0}
    write(tmp_path / "log", "c", [(7_000_000, 0, "api_error", None, "2024-01-01T02:30:00Z")])
    found = run(spark, tmp_path)
    assert {i for i, r in found.items() if r[0] == st.TIMED_OUT} == {i for i in ids if i % 3 == 2} | {None}
    write(tmp_path / "log", "d", [(7_000_001, 0, "api_error", None, "2024-01-01T03:30:00Z")])
    found = run(spark, tmp_path)
    assert {i for i, r in found.items() if r[0] == st.TIMED_OUT} == {i for i in ids if i % 3} | {None}
