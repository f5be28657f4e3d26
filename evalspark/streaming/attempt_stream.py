"""Attempt logs as streams: each prompt's outcome as soon as its calls settle it.

State is kept by blocks of up to 64 prompts, ids in a row, since a call of Python costs more than a prompt's
rows do; ids far apart have a block each. Of each prompt there is one letter per attempt, the text of the
earliest usable answer and the time of the latest row. It is bounded by the retry budgets, whatever the order
and number of the rows. A prompt is settled when the attempts up to the deciding one are all there, so rows may
come in any order; repeated rows change nothing. A prompt that hears nothing more is given up by an event-time timer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from evalspark import schemas
from evalspark.functions import jsonx
from evalspark.sources import read_found_parquet

# What an attempt was: a usable answer, one that is not, an API error, another error, not seen yet.
USABLE, UNUSABLE, API_ERROR, ERROR, UNSEEN = "v", "i", "a", "e", "."
ACCEPTED, FAILED, TIMED_OUT = "accepted", "failed", "timeout"

LOG = f"{schemas.ATTEMPT_LOG}, at TIMESTAMP"
OUTCOMES = "idx BIGINT, outcome STRING, attempt INT, text STRING"
# A block's prompts: what was seen of each, the time of its latest row and when it is given up.
_STATE = (
    "idx ARRAY<BIGINT>, codes ARRAY<STRING>, best ARRAY<INT>, text ARRAY<STRING>, latest ARRAY<BIGINT>,"
    " deadline ARRAY<BIGINT>, settled ARRAY<BOOLEAN>"
)
#: Bits of an id within a block: 64 ids in a row share one call of Python and one timer.
TOGETHER = 6


def read_log(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """A folder of attempt logs (JSON Lines with an ``at`` time) as a stream of its files."""
    reader = spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_at_once)
    return reader.option("mode", "FAILFAST").json(path)


def teacher_outcome(codes: str, max_retries: int, max_invalid_retries: int) -> tuple[str, int] | None:
    """How a teacher's attempts end, or None while that is open.

    API errors use up ``max_retries``; after the first answer up to ``max_invalid_retries`` calls may
    follow, and any error among them fails the prompt.
    """
    answered = None
    for attempt, code in enumerate(codes):
        if code == UNSEEN:
            return None
        if code == USABLE:
            return ACCEPTED, attempt
        if answered is None and code == API_ERROR:
            if attempt >= max_retries:
                return FAILED, attempt
            continue
        if code in (API_ERROR, ERROR):
            return FAILED, attempt
        answered = attempt if answered is None else answered
        if attempt >= answered + max_invalid_retries:
            return FAILED, attempt
    return None


def judge_outcome(codes: str, max_retries: int) -> tuple[str, int] | None:
    """How a judge's attempts end: all but other errors are tried again, ``max_retries`` times."""
    for attempt, code in enumerate(codes):
        if code == UNSEEN:
            return None
        if code == USABLE:
            return ACCEPTED, attempt
        if code == ERROR or attempt >= max_retries:
            return FAILED, attempt
    return None


def _coded(log: DataFrame, usable: Column, most: int) -> DataFrame:
    """Rows with what counts of them: their letter, and the text of usable answers only.

    A row without an attempt announces a prompt. Attempts past the budgets settle nothing.
    """
    status = F.col("status")
    code = (
        F.when(F.col("attempt").isNull(), F.lit(None))
        .when(status == "api_error", API_ERROR)
        .when(status != "ok", ERROR)
        .when(usable, USABLE)
        .otherwise(UNUSABLE)
    )
    coded = log.filter(F.col("attempt").isNull() | F.col("attempt").between(0, most)).withColumn("code", code)
    text = F.when(F.col("code") == USABLE, F.col("text"))
    millis = F.unix_millis(F.col("at"))
    return coded.select("idx", "attempt", "code", text.alias("text"), millis.alias("millis"), "at")


def _stateful(log: DataFrame, late: str, wait_ms: int, decide: dict[str, Any]) -> DataFrame:
    budgets = decide["budgets"]
    decided = teacher_outcome if decide["teacher"] else judge_outcome

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        held = {p[0]: list(p[1:]) for p in zip(*state.get)} if state.exists else {}
        heard, found = set(), []
        for frame in () if state.hasTimedOut else frames:
            names = [None] * len(frame) if key[0] is None else frame["idx"].tolist()
            columns = (frame[c].tolist() for c in ("attempt", "code", "text", "millis"))
            for idx, attempt, code, answer, millis in zip(names, *columns):
                prompt = held.setdefault(idx, ["", None, None, 0, 0, False])
                heard.add(idx)
                prompt[3] = max(prompt[3], int(millis))
                if prompt[5] or code is None:
                    continue
                at, codes = int(attempt), prompt[0].ljust(int(attempt) + 1, UNSEEN)
                if codes[at] != UNSEEN:
                    continue  # a row that came before
                prompt[0] = codes[:at] + code + codes[at + 1 :]
                if code == USABLE and (prompt[1] is None or at < prompt[1]):
                    prompt[1:3] = at, answer
        for idx in heard:
            codes, _, text, latest, _, settled = held[idx]
            outcome = None if settled else decided(codes, *budgets)
            if outcome is not None:
                found.append((idx, *outcome, text if outcome[0] == ACCEPTED else None))
                # What is left only tells later copies of the rows that they come too late.
                held[idx] = ["", None, None, latest, 0, True]
            held[idx][4] = max(latest + wait_ms, watermark + 1)
        for idx in [i for i, prompt in held.items() if i not in heard and prompt[4] < watermark]:
            if not held.pop(idx)[5]:
                found.append((idx, TIMED_OUT, None, None))
        if held:
            state.update(tuple(map(list, zip(*((i, *prompt) for i, prompt in held.items())))))
            state.setTimeoutTimestamp(max(min(prompt[4] for prompt in held.values()), watermark + 1))
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame(found, columns=["idx", "outcome", "attempt", "text"])

    return (
        log.withWatermark("at", late)
        .withColumn("block", F.shiftright("idx", TOGETHER))
        .groupBy("block")
        .applyInPandasWithState(follow, OUTCOMES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


def follow_attempts(
    log: DataFrame,
    late: str = "1 hour",
    wait_ms: int = 3_600_000,
    max_retries: int = 4,
    max_invalid_retries: int = 1,
) -> DataFrame:
    """Outcome of every prompt of a teacher's log: idx, outcome, attempt, text.

    ``log`` is a stream of (idx, attempt, status, text, at); a row whose attempt is null announces a
    prompt before its first call. The outcome is accepted (with attempt and text), failed (with the attempt
    that failed it), or timeout, where the watermark passes ``wait_ms`` after a prompt's latest row. Each prompt
    gets one row. Rows later than ``late`` behind the newest are dropped, so copies of old files
    settle no prompt again. Accepted rows are those of ``attempts.accept_attempts`` on the whole log.
    """
    coded = _coded(log, jsonx.is_valid(F.col("text")), max_retries + max_invalid_retries)
    return _stateful(coded, late, wait_ms, {"teacher": True, "budgets": (max_retries, max_invalid_retries)})


def follow_judge_attempts(
    log: DataFrame, late: str = "1 hour", wait_ms: int = 3_600_000, max_retries: int = 3
) -> DataFrame:
    """The same for a judge's log, by the rules of ``attempts.accept_judge_attempts``."""
    coded = _coded(log, jsonx.parse_object(F.col("text"))["error"].isNull(), max_retries)
    return _stateful(coded, late, wait_ms, {"teacher": False, "budgets": (max_retries,)})


def start(outcomes: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write outcomes to a folder of Parquet files, each prompt exactly once.

    A query started again on the same checkpoint goes on where the last one ended. ``once`` ends with the
    files that are there; else the query waits for more.
    """
    writer = outcomes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).outputMode("append").start()


def settled(spark: SparkSession, path: str) -> DataFrame:
    """The outcomes written so far; none where nothing was written."""
    return read_found_parquet(spark, path, OUTCOMES)


def pending(outcomes: DataFrame) -> DataFrame:
    """Prompts whose calls ended without an accepted answer, and how."""
    return outcomes.filter(F.col("outcome") != ACCEPTED).select("idx", "outcome")
