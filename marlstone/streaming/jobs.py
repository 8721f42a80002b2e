"""Structured Streaming jobs over a folder of event files.

Every job keeps its checkpoint and its output in the shared folder, so it survives lost executors and
restarts where it stopped. Outputs of a micro-batch go to a directory named by the batch id: a batch that is run again replaces
its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marlstone.operators.admission import NO_KEY, _Log, micros
from marlstone.operators.quality import alerts, compare


def read_files(spark: SparkSession, pattern: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files matching the pattern as a stream, with the schema of the files there now."""
    schema = spark.read.parquet(pattern).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(pattern)


def event_time(df: DataFrame, ts: str) -> Column:
    """The time column as an instant; a timestamp without zone is read as UTC, whatever the session zone."""
    return F.timestamp_micros(micros(ts, df.schema[ts].dataType))


def plain_time(instant: Column | str) -> Column:
    """The instant as a UTC timestamp without zone."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(instant) / 1_000_000).cast("decimal(18,6)")
    )


def run_to_parquet(stream: DataFrame, path: str) -> DataFrame:
    """Run a stateless stream over all files there are; the parquet sink commits each batch once."""
    job = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .option("path", f"{path}/rows")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


def run_batches(stream: DataFrame, path: str, handle: Callable[[DataFrame, int], None], mode: str) -> None:
    job = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{path}/checkpoint")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Keep window state in RocksDB instead of executor memory while a job starts and runs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run_updates(stream: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Run an aggregating stream in update mode and read the newest state of every key.

    Windows the watermark has not closed yet are part of the result, as they are in a batch run.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/updates/batch={batch_id}")

    with _state_on_disk(stream.sparkSession):
        run_batches(stream, path, handle, "update")
    layout = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    updates = stream.sparkSession.read.schema(layout).parquet(f"{path}/updates")
    values = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*values), "batch").alias("_v")
    return updates.groupBy(*keys).agg(newest).select(*keys, "_v.*")


def usage(events: DataFrame, ts: str, keys: Sequence[str], tokens: Column, width: str, delay: str, slide: str | None = None) -> DataFrame:
    """Requests and tokens per window and key. Rows later than ``delay`` behind the newest one are dropped."""
    timed = events.withColumn("_time", event_time(events, ts)).withWatermark("_time", delay)
    return (
        timed.groupBy(F.window("_time", width, slide or width).alias("_w"), *keys)
        .agg(F.count("*").alias("n_requests"), F.sum(tokens).alias("tokens"))
        .select(plain_time("_w.start").alias("window_start"), *keys, "n_requests", "tokens")
    )


def service_windows(log: DataFrame, ts: str, key: str, width: str, slide: str, delay: str, end: str | None = None) -> DataFrame:
    """Per sliding window and key: requests, mean latency, error share; with the window's end as the instant ``end`` instead of its plain start if wanted."""
    timed = log.withColumn("_time", event_time(log, ts)).withWatermark("_time", delay)
    return (
        timed.groupBy(F.window("_time", width, slide).alias("_w"), key)
        .agg(
            F.count("*").alias("n_requests"),
            F.sum("latency_ms").alias("total_latency"),
            F.count_if(F.col("status") != "Success").alias("n_failed"),
        )
        .select(F.col("_w.end").alias(end) if end else plain_time("_w.start").alias("window_start"), key, "n_requests", "total_latency", "n_failed")
    )


def window_fired(rules: Sequence[tuple[str, str, float]]) -> Column:
    """The rules (as text) on mean_latency, error_rate or n_requests that a service window breaks."""
    measured = {
        "mean_latency": F.col("total_latency") / F.col("n_requests"),
        "error_rate": F.col("n_failed") / F.col("n_requests"),
        "n_requests": F.col("n_requests").cast("double"),
    }
    broken = [F.when(compare(measured[m], F.lit(sign), F.lit(float(limit))), F.lit(f"{m} {sign} {float(limit)}")) for m, sign, limit in rules]
    return F.array_compact(F.array(*broken))


def window_alerts(windows: DataFrame, key: str, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Alert rows (window_start, key, fired) for windows that break a rule on mean_latency, error_rate or n_requests."""
    subject = F.struct("window_start", key).alias("subject")
    measured = F.array(
        F.struct(F.lit("mean_latency").alias("metric"), (F.col("total_latency") / F.col("n_requests")).alias("value")),
        F.struct(F.lit("error_rate").alias("metric"), (F.col("n_failed") / F.col("n_requests")).alias("value")),
        F.struct(F.lit("n_requests").alias("metric"), F.col("n_requests").cast("double").alias("value")),
    )
    return alerts(windows.select(subject, F.inline(measured)), "subject", rules).select("subject.*", "fired")


class _Admission(StatefulProcessor):
    """The times a key admitted within the window, in a list that the state store keeps; cleared when they can matter to nobody any more."""

    def __init__(self, limit: int, window: int):
        self.limit, self.window = limit, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        asked = pd.concat([r[["tie", "at"]] for r in rows]).sort_values(["at", "tie"], kind="stable")
        log = _Log(self.limit, self.window)
        log.times.extend(at for (at,) in self.times.get())
        allowed, remaining = log.ask(asked["at"].to_numpy())
        if log.times:
            self.times.put([(int(at),) for at in log.times])
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((log.times[-1] + self.window) // 1000 + 1)
        yield pd.DataFrame({"tie": asked["tie"].to_numpy(), "allowed": allowed, "remaining": remaining})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.times.clear()
        return iter([])

    def close(self) -> None:
        pass


def admit(log: DataFrame, path: str, key: str, ts: str, tie: str, limit: int, seconds: int, delay: int = 86_400) -> DataFrame:
    """Sliding-log admission over a stream: (tie, allowed, remaining) of each request, the log of each key kept as keyed state.

    The state of a key is a list of at most ``limit`` times. A timer clears it when the watermark, ``delay`` seconds behind the newest
    request, has passed the last one by the window. A request at or behind the watermark of the batch before its own is late and
    gets no decision; others are decided in time order within their batch, and admissions that are newer than a request count against it. A key's rows of one batch are one task's work, so the size of a batch
    (files per trigger) bounds it; the batch operator splits a key.
    """
    spark = log.sparkSession
    # names that begin with an underscore do not reach a stateful processor
    timed = log.select(
        F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY)).alias("owner"), micros(ts, log.schema[ts].dataType).alias("at"), F.col(tie).alias("tie"), event_time(log, ts).alias("seen")
    ).withWatermark("seen", f"{delay} seconds")
    schema = T.StructType([T.StructField("tie", log.schema[tie].dataType), T.StructField("allowed", T.BooleanType()), T.StructField("remaining", T.LongType())])
    decided = timed.groupBy("owner").transformWithStateInPandas(_Admission(limit, seconds * 1_000_000), schema, "append", "eventTime")
    with _state_on_disk(spark):
        return run_to_parquet(decided.withColumnRenamed("tie", tie), path)


def log_once(log: DataFrame, path: str, key: str, ts: str, delay: str) -> DataFrame:
    """Append a stream of log rows to a table, each request once: rows of an id that was seen within ``delay`` are left out, as when a file is delivered again."""
    timed = log.withColumn("_time", event_time(log, ts)).withWatermark("_time", delay)
    with _state_on_disk(log.sparkSession):
        return run_to_parquet(timed.dropDuplicatesWithinWatermark([key]).drop("_time"), path)


def closed_usage(events: DataFrame, path: str, ts: str, keys: Sequence[str], tokens: Column, width: str, delay: str) -> DataFrame:
    """Usage per window and key, one row written for each once the watermark has passed the window's end; it is never written again."""
    with _state_on_disk(events.sparkSession):
        return run_to_parquet(usage(events, ts, keys, tokens, width, delay), path)


def outside_closed(events: DataFrame, closed: DataFrame, ts: str, keys: Sequence[str], width: str, delay: str) -> DataFrame:
    """Rows of the files that the closed windows do not hold: (window_start, keys..., n, late). Together with them they are all rows.

    late: the window was written and closed before these rows came; otherwise the window is still open. ``events`` is the batch
    read of the same files. Rows whose time is null belong to no window.
    """
    timed = events.withColumn("_time", event_time(events, ts)).where("_time IS NOT NULL")
    wanted = timed.groupBy(F.window("_time", width).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("_all"))
    wanted = wanted.select(plain_time("_w.start").alias("window_start"), plain_time("_w.end").alias("_end"), *keys, "_all")
    newest = plain_time(F.col("newest")) - F.expr(f"INTERVAL {delay}")
    limit = timed.agg(F.max("_time").alias("newest")).select(newest.alias("limit")).scalar()
    joined = wanted.join(closed.select("window_start", *keys, F.col("n_requests")), ["window_start", *keys], "left")
    rest = joined.withColumn("n", F.col("_all") - F.coalesce("n_requests", F.lit(0))).where("n > 0")
    return rest.select("window_start", *keys, "n", (F.col("_end") <= limit).alias("late"))


class _Alerts(StatefulProcessor):
    """When each broken rule of a subject was first seen, as long as it stays broken."""

    def __init__(self, subject: str, rules: Sequence[str]):
        self.subject, self.rules = subject, list(rules)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.opened = handle.getMapState("opened", "rule string", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(list(rows)).sort_values("at", kind="stable")
        since = {rule: at for (rule,), (at,) in self.opened.iterator()}
        changes = []
        for at, fired in zip(windows["at"].tolist(), windows["fired"].tolist(), strict=True):
            now = set(fired)
            for rule in self.rules:
                if rule in now and rule not in since:
                    since[rule] = at
                    changes.append((key[0], rule, at, None))
                elif rule not in now and rule in since:
                    changes.append((key[0], rule, since.pop(rule), at))
        for (rule,) in list(self.opened.keys()):
            if rule not in since:
                self.opened.removeKey((rule,))
        for rule, at in since.items():
            self.opened.updateValue((rule,), (int(at),))
        columns = list(zip(*changes, strict=True)) if changes else [(), (), (), ()]
        types = ["object", "object", "int64", "Int64"]
        yield pd.DataFrame({n: pd.Series(list(c), dtype=t) for n, c, t in zip([self.subject, "rule", "opened", "resolved"], columns, types, strict=True)})

    def close(self) -> None:
        pass


def alert_states(log: DataFrame, path: str, ts: str, key: str, width: str, delay: str, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Alerts over a stream of requests: (key, rule, opened, resolved).

    Windows are judged once, when they are closed. An alert opens with the first window that breaks a rule, stays open while windows of its subject break
    it, and is resolved by the first one that does not; a window without requests says nothing. Opening and resolving are
    one row each in the sink, which commits a batch once; the result has one row per alert, ``resolved`` null while it is open.
    """
    spark = log.sparkSession
    windows = service_windows(log, ts, key, width, width, delay, end="_end")
    judged = windows.select(key, F.unix_micros(F.col("_end")).alias("at"), window_fired(rules).alias("fired"))
    names = [f"{metric} {sign} {float(limit)}" for metric, sign, limit in rules]
    schema = T.StructType([log.schema[key], *T._parse_datatype_string("rule string, opened bigint, resolved bigint").fields])
    states = judged.groupBy(key).transformWithStateInPandas(_Alerts(key, names), schema, "append", "none")
    with _state_on_disk(spark):
        changes = run_to_parquet(states, path)
    found = changes.groupBy(key, "rule", "opened").agg(F.max("resolved").alias("resolved"))
    return found.select(key, "rule", *[plain_time(F.timestamp_micros(n)).alias(n) for n in ("opened", "resolved")])
