"""Streams give the batch result, drop what is late, and go on after a stop."""

from __future__ import annotations

import pytest
from support import SMALL, rows_of
from pyspark.sql import functions as F

from dayledger.jobs import all_jobs
from dayledger.registry import runnable
from dayledger.session import scratch
from dayledger.streaming.feed import drain_append, in_steps
from dayledger.streaming.jobs import SESSION_ROW, track_sessions

SAME = {
    "stream_window_tumbling": "time_window_tumbling",
    "stream_window_session": "time_window_session",
    "stream_word_count": "word_count",
    "stream_word_count_messages": "word_count",
}


@pytest.mark.parametrize("stream, batch", SAME.items())
def test_stream_equals_batch(spark, stream, batch):
    a, b = (runnable(all_jobs()[n])(spark, SMALL) for n in (stream, batch))
    assert rows_of(a.select(sorted(a.columns))) == rows_of(b.select(sorted(b.columns)))


def test_late_rows_are_dropped(spark):
    total = runnable(all_jobs()["stream_watermark_late"])(spark, SMALL).agg(F.sum("n")).first()[0]
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    late = e.filter("event_id % 50 = 0 AND ts < timestamp_ntz'2024-01-10'").count()
    assert late > 0 and total == e.count() - late


def test_recovered_counts_have_no_loss_and_no_repeats(spark):
    got = runnable(all_jobs()["stream_recover"])(spark, SMALL)
    words = runnable(all_jobs()["word_count"])(spark, SMALL)
    assert got.agg(F.sum("n")).first()[0] == words.agg(F.sum("n")).first()[0]


def test_upsert_stream_and_session_state(spark):
    up = runnable(all_jobs()["stream_foreach_batch_upsert"])(spark, SMALL)
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    assert up.count() == e.select("user_id").distinct().count()
    own = runnable(all_jobs()["stream_session_state"])(spark, SMALL)
    built_in = runnable(all_jobs()["time_window_session"])(spark, SMALL)
    assert rows_of(own.select("user_id", "start", "n")) == rows_of(built_in.select("user_id", "start", "n"))


def test_progress_has_rows(spark):
    rows = runnable(all_jobs()["stream_progress"])(spark, SMALL).collect()
    assert len(rows) == 4
    assert sum(r.input_rows for r in rows) == spark.read.parquet(f"{SMALL}/events.parquet").count()


def test_a_late_row_joins_two_open_sessions(spark):
    """Rows at 0:00 and 11:00; a row of 5:30 within the allowed delay makes them one session."""
    def at(hours):
        return spark.createDataFrame([(7, x) for x in hours], "user_id long, h double").selectExpr(
            "user_id", "CAST(TIMESTAMP'2024-01-01' + make_dt_interval(0, 0, CAST(h * 60 AS INT), 0) AS TIMESTAMP) AS ts")

    out = scratch(spark, "late-join")

    def run(s, checkpoint):
        parts = s.selectExpr("user_id", "ts AS start", "ts AS last", "1L AS n").withWatermark("last", "12 hours")
        kept = parts.groupBy("user_id").applyInPandasWithState(
            track_sessions, SESSION_ROW, "starts array<long>, lasts array<long>, ns array<long>", "append", "EventTimeTimeout")
        return drain_append(kept, "late_join", checkpoint, out)

    rows = in_steps([at([0.0, 11.0]), at([5.5]), at([300.0])], "late-join-in", run)[-1].collect()
    assert [(r.seconds, r.n) for r in rows] == [(11 * 3600.0, 3)]
