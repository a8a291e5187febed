"""A stream takes a week of landed events per batch, however many files the week has."""

import datetime as dt

import pytest

from tidewatch.plans import q_streaming as Q


@pytest.fixture
def sf(spark, tmp_path):
    """900 events over three weeks."""
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(minutes=30 * i), i % 7, "ab"[i % 2], float(i), "") for i in range(900)]
    (spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
     .repartition(6).write.parquet(f"{tmp_path}/events.parquet"))
    return str(tmp_path)


def test_a_batch_per_week(spark, sf, monkeypatch):
    monkeypatch.setattr(Q, "FILE_EVENTS", 100)
    path, files = Q.landed_events(spark, sf)
    assert files == 4
    assert len(spark.read.parquet(path).inputFiles()) == 3 * files
    assert spark.read.parquet(path).count() == 900
    log = Q.t1_t2_continuous_rescoring(spark, sf).orderBy("iteration").collect()
    assert [r["mentions_seen"] for r in log] == [336, 672, 900]


def test_few_events_are_one_file_a_week(spark, sf):
    path, files = Q.landed_events(spark, sf)
    assert files == 1 and len(spark.read.parquet(path).inputFiles()) == 3


def test_repeats_and_windows_over_several_files(spark, sf, monkeypatch):
    monkeypatch.setattr(Q, "FILE_EVENTS", 100)
    assert {r["topic"]: r["mentions"] for r in Q.t3_stream_dedup_ids(spark, sf).collect()} == {"a": 450, "b": 450}
    daily = Q.t4_stream_daily_counts(spark, sf).collect()
    assert len(daily) == 20 and {r["mentions"] for r in daily} == {24}   # ten days lie behind the watermark
