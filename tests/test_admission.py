import random
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import admission
from marlstone.operators.admission import fixed_window, sliding_log


@pytest.fixture(scope="module")
def log(hot_events):
    return hot_events.select("id", "key", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, at)").alias("ts"))


def fold(rows, limit, seconds):
    logs, out = {}, {}
    for i, key, at in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        times = logs.setdefault(key, deque())
        while times and at - times[0] > seconds:
            times.popleft()
        allowed = len(times) < limit
        if allowed:
            times.append(at)
        out[i] = (allowed, limit - len(times))
    return out


@pytest.mark.parametrize("chunk", [9, 50, 10_000])
@pytest.mark.parametrize("limit,seconds", [(2, 60), (5, 700), (1, 3)])
def test_sliding_log(hot_events, log, chunk, limit, seconds):
    decided, _ = sliding_log(log, "key", "ts", "id", limit, seconds, chunk_rows=chunk)
    got = {r["id"]: (r["allowed"], r["remaining"]) for r in decided.collect()}
    assert got == fold([(r["id"], r["key"], r["at"]) for r in hot_events.collect()], limit, seconds)


@pytest.mark.parametrize("chunk", [11, 10_000])
def test_sliding_log_in_batches(hot_events, log, chunk):
    got, carried = {}, None
    timed = log.join(hot_events.select("id", "at"), "id")
    for low, high in [(0, 1500), (1500, 3200), (3200, 5000)]:
        part = timed.where((F.col("at") >= low) & (F.col("at") < high)).drop("at")
        decided, carried = sliding_log(part, "key", "ts", "id", 3, 400, carried=carried, chunk_rows=chunk)
        got |= {r["id"]: (r["allowed"], r["remaining"]) for r in decided.collect()}
    assert got == fold([(r["id"], r["key"], r["at"]) for r in hot_events.collect()], 3, 400)


def test_third_request_is_refused(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, 0), (2, 1, 10), (3, 1, 20), (4, 1, 61) AS t(id, key, s)").select(
        "id", "key", F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)").alias("ts")
    )
    decided, _ = sliding_log(df, "key", "ts", "id", 2, 60)
    assert [r["allowed"] for r in decided.orderBy("id").collect()] == [True, True, False, True]


@pytest.mark.parametrize("chunk", [9, 10_000])
def test_fixed_window(hot_events, log, chunk):
    asked = log.withColumn("tokens", F.col("id") % 13)
    found = fixed_window(asked, "ts", "id", "tokens", 600, 40, 200, chunk_rows=chunk)
    got = {r["id"]: r["allowed"] for r in found.collect()}
    used, want = {}, {}
    for i, at in sorted(((r["id"], r["at"]) for r in hot_events.collect()), key=lambda r: (r[1], r[0])):
        n, t = used.get(at // 600, (0, 0))
        want[i] = n < 40 and t < 200
        if want[i]:  # only admitted requests count, which gives the same answer
            used[at // 600] = (n + 1, t + i % 13)
    assert got == want


@pytest.mark.parametrize("chunk", [2, 100])
def test_requests_without_a_key_share_a_log(spark, chunk):
    rows = [(i, None if i % 2 else "a", i) for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, key string, s int").select(
        "id", "key", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, s)").alias("ts")
    )
    decided, _ = sliding_log(df, "key", "ts", "id", 2, 5, chunk_rows=chunk)
    got = {r["id"]: (r["allowed"], r["remaining"]) for r in decided.collect()}
    assert got == fold([(i, k or "-", s) for i, k, s in rows], 2, 5)


def test_transfer_tables_equal_the_fold():
    rng = random.Random(1)
    for _ in range(1500):
        limit, window, gap = rng.randrange(1, 5), rng.choice([1, 3, 10, 40, 200]), rng.choice([1, 2, 5, 30])
        before = np.sort(np.array([rng.randrange(40 * gap) for _ in range(rng.randrange(40))], dtype=np.int64))
        start = (int(before[-1]) if len(before) else 0) + rng.randrange(3)
        at = start + np.sort(np.array([rng.randrange(60 * gap) for _ in range(rng.randrange(1, 60))], dtype=np.int64))
        first = admission._Log(limit, window)
        log = before[first.ask(before)[0]].tolist()[-limit:]
        got = admission.passed_on(log, admission.transfer(at, limit, window), limit)
        folded = admission._Log(limit, window)
        folded.times.extend(log)
        want = [*log, *at[folded.ask(at)[0]].tolist()][-limit:]
        # entries that have expired by the end do not matter
        assert [t for t in got if at[-1] - t <= window] == [t for t in want if at[-1] - t <= window]


def test_a_key_with_all_rows_that_never_pauses_is_not_one_task(spark, monkeypatch):
    """6,000 requests of one key, far above its limit throughout: decisions are right, and beyond the sort nothing but small tables meets in a task."""
    rows = [(i, "hot", i // 3) for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, key string, s int").select("id", "key", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, s)").alias("ts"))
    seen, keep = {}, admission.written

    def watching(frame, label):
        out = keep(frame, label)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(admission, "written", watching)
    decided, _ = sliding_log(df, "key", "ts", "id", 4, 30, chunk_rows=250)
    got = {r["id"]: (r["allowed"], r["remaining"]) for r in decided.collect()}
    assert got == fold(rows, 4, 30)
    assert sum(a for a, _ in got.values()) < 300
    assert seen["groups"] == 24 and seen["transfers"] < 0.5 * len(rows) and seen["trailing"] <= 4 * 24


def test_a_key_in_many_chunks_after_batches(spark):
    """A carried log goes into the tables of the first chunk."""
    rows = [(i, "hot" if i % 5 else f"k{i % 7}", i // 2) for i in range(1200)]
    df = spark.createDataFrame(rows, "id bigint, key string, s int").select("id", "key", "s", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, s)").alias("ts"))
    got, carried = {}, None
    for low, high in [(0, 250), (250, 600)]:
        decided, carried = sliding_log(df.where((F.col("s") >= low) & (F.col("s") < high)).drop("s"), "key", "ts", "id", 3, 20, carried=carried, chunk_rows=40)
        got |= {r["id"]: (r["allowed"], r["remaining"]) for r in decided.collect()}
    assert got == fold(rows, 3, 20)
