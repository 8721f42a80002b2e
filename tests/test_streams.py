"""Streams over several files, one file a batch, against the batch result."""

import pytest
from pyspark.sql import functions as F

from marlstone.operators.admission import sliding_log
from marlstone.sources.logs import request_log
from marlstone.streaming import jobs
from marlstone.workspace import scratch


@pytest.fixture(scope="module")
def parts(spark, folder):
    """Events in five files by time; files are picked up in the order they were written."""
    path = scratch(spark, "parts")
    events = spark.read.parquet(f"{folder}/events.parquet")
    bounds = [0, 200, 400, 600, 800, 10_000]
    for low, high in zip(bounds, bounds[1:]):
        events.where((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(path)
    return path, events


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_usage_over_batches(spark, parts):
    path, events = parts
    tokens = F.col("prompt_tokens") + F.col("completion_tokens")
    arriving = request_log(jobs.read_files(spark, path, files_per_batch=1))
    stream = jobs.usage(arriving, "ts", ["endpoint"], tokens, "1 day", "60 days")
    got = jobs.run_updates(stream, scratch(spark, "usage"), ["window_start", "endpoint"])
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    want = request_log(events).groupBy(day.alias("window_start"), "endpoint").agg(F.count("*"), F.sum(tokens))
    assert rows(got) == rows(want)


def test_admission_over_batches(spark, parts):
    path, events = parts
    arriving = request_log(jobs.read_files(spark, path, files_per_batch=1)).select("request_id", "user_id", "ts")
    got = jobs.admit(arriving, scratch(spark, "admit"), "user_id", "ts", "request_id", 2, 86_400)
    batch = request_log(events).select("request_id", "user_id", "ts")
    want, _ = sliding_log(batch, "user_id", "ts", "request_id", 2, 86_400)
    assert rows(got.select("request_id", "allowed", "remaining")) == rows(want.select("request_id", "allowed", "remaining"))


def delivered(spark, label, batches, schema):
    """One file per batch; ``s`` (seconds) becomes the timestamp ``ts``."""
    path = scratch(spark, label)
    for rows in batches:
        spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("s")).drop("s").coalesce(1).write.mode("append").parquet(path)
    return path


def test_state_of_keys_that_are_gone_is_cleared(spark):
    """New keys every day: the state store holds the keys of the window and the allowed delay only, and the sink holds all decisions."""
    days = [[(f"r{day}-{i}", f"u{day}-{i}", (day + 1) * 86_400 + i) for i in range(5)] for day in range(6)]
    path, target = delivered(spark, "days", days, "request_id string, user_id string, s long"), scratch(spark, "forgetting")
    arriving = jobs.read_files(spark, path, files_per_batch=1)
    assert jobs.admit(arriving, target, "user_id", "ts", "request_id", 2, 3600, delay=86_400).count() == 30
    state = spark.read.format("statestore").option("stateVarName", "times").load(f"{target}/checkpoint")
    assert 5 <= state.select("key").distinct().count() <= 10
    assert not any("state" in f or "decisions" in f for f in spark.read.parquet(f"{target}/rows").inputFiles())


def test_requests_behind_the_watermark_have_no_decision(spark):
    batches = [[(1, "a", 100_000), (2, "a", 100_010)], [(3, "a", 100_020), (4, "a", 10), (5, "b", 99_995)], [(6, "a", 100_025), (7, "b", 50)]]
    path = delivered(spark, "late", batches, "request_id long, user_id string, s long")
    got = jobs.admit(jobs.read_files(spark, path, files_per_batch=1), scratch(spark, "admit"), "user_id", "ts", "request_id", 2, 60, delay=30)
    assert {r.request_id: (r.allowed, r.remaining) for r in got.collect()} == {
        1: (True, 1),
        2: (True, 0),
        3: (False, 0),
        4: (False, 0),  # long past, but the watermark that its batch began with was still open
        5: (True, 1),
        6: (False, 0),
    }


def test_a_request_is_logged_once_however_often_its_file_comes(spark, parts):
    path, events = parts
    source = scratch(spark, "again")
    for _ in range(3):
        events.coalesce(1).write.mode("append").parquet(source)
    log = jobs.log_once(jobs.read_files(spark, source, files_per_batch=1), scratch(spark, "once"), "event_id", "ts", "60 days")
    assert rows(log) == rows(events)


def test_closed_windows_are_written_once_and_with_the_rest_hold_all_rows(spark):
    """Three batches; the last one brings rows for a window that has been closed."""
    batches = [[(i, "x", 60 * i) for i in range(10)], [(20 + i, "x", 1200 + 30 * i) for i in range(40)], [(70, "x", 30), (71, "x", 61), (72, "y", 5000), (73, "x", 2399)]]
    path, target = delivered(spark, "closing", batches, "id long, k string, s long"), scratch(spark, "closed")
    arriving = jobs.read_files(spark, path, files_per_batch=1)
    closed = jobs.closed_usage(arriving, target, "ts", ["k"], F.lit(1), "1 minute", "5 minutes")
    outside = jobs.outside_closed(spark.read.parquet(path), closed, "ts", ["k"], "1 minute", "5 minutes")
    assert closed.groupBy("window_start", "k").count().where("count > 1").count() == 0
    assert closed.agg(F.sum("n_requests")).first()[0] + outside.agg(F.sum("n")).first()[0] == 54
    assert outside.where("late").agg(F.sum("n")).first()[0] == 2
    assert [r.k for r in outside.where("NOT late").collect()] == ["y"]
    before = closed.count()
    again = jobs.closed_usage(arriving, target, "ts", ["k"], F.lit(1), "1 minute", "5 minutes")
    assert again.count() == before  # a restart writes nothing again


def test_alerts_open_and_resolve_across_batches(spark, parts):
    path, events = parts
    rules = [("error_rate", ">", 0.3), ("mean_latency", ">", 120.0), ("n_requests", ">=", 3.0)]
    found = []
    for files in (1, 100):
        arriving = request_log(jobs.read_files(spark, path, files_per_batch=files))
        found.append(rows(jobs.alert_states(arriving, scratch(spark, "alerts"), "ts", "endpoint", "6 hours", "1 hour", rules)))
    assert found[0] == found[1] and len(found[0]) > 10
    assert len({r[:3] for r in found[0]}) == len(found[0])
    still = [r for r in found[0] if r[3] is None]
    assert len(still) < len(found[0])


def test_restart_adds_only_new_files(spark, parts):
    path, events = parts
    target = scratch(spark, "restart")
    arriving = jobs.read_files(spark, path, files_per_batch=2).select("event_id")
    assert jobs.run_to_parquet(arriving, target).count() == events.count()
    assert jobs.run_to_parquet(arriving, target).count() == events.count()


def test_times_do_not_depend_on_the_session_zone(spark, parts):
    _, events = parts
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        same = events.select("ts", jobs.plain_time(jobs.event_time(events, "ts")).alias("back")).where("ts <> back").count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert same == 0
