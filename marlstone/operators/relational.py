"""Small reusable pieces over ordinary DataFrames: lookups, summaries, buckets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators.ordered import last_known, quantiles


def part_of_day(hour: Column) -> Column:
    return F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")


def since_and_category(df: DataFrame, date_column: str, start: str, column: str, category: str) -> DataFrame:
    """Rows from ``start`` on; ``category`` 'All' leaves the category open."""
    rows = df.where(F.col(date_column) >= F.lit(start).cast(df.schema[date_column].dataType))
    return rows if category == "All" else rows.where(F.col(column) == category)


def within_last(df: DataFrame, ts: str, now: Column, interval: str) -> DataFrame:
    return df.where(F.col(ts) > now - F.expr(f"INTERVAL {interval}"))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def lookup(labels: DataFrame, features: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Labels with the chosen features of the feature row of the same key, NULL when there is none."""
    return labels.join(features.select(key, *names), key, "left")


def as_of(
    labels: DataFrame, features: DataFrame, keys: Sequence[str], ts: str, tie: str, names: Sequence[str]
) -> DataFrame:
    """Each label row with the last feature row of its key at or before its time.

    Both sides go through one sort by (key, time); features come first at equal times. ``tie`` is a unique id on both sides.
    """
    types = {f.name: f.dataType for f in features.schema}
    seen = F.struct(*[F.col(n) for n in names])
    right = features.select(*keys, ts, F.lit(0).alias("_side"), F.col(tie).alias("_tie"), seen.alias("_seen"))
    left = labels.select(
        *keys, ts, F.lit(1).alias("_side"), F.col(tie).alias("_tie"), F.struct(*labels.columns).alias("_label")
    )
    both = left.unionByName(right, allowMissingColumns=True)
    filled = last_known(both, list(keys), [ts, "_side", "_tie"], ["_seen"])
    return filled.where("_side = 1").select("_label.*", *[F.col(f"_seen.{n}").cast(types[n]).alias(n) for n in names])


def service_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("endpoint").agg(
        F.count("*").alias("n_requests"),
        F.round(F.avg("latency_ms"), 4).alias("mean_latency"),
        F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens"),
        F.round(F.sum(F.when(F.col("status") == "Success", 1).otherwise(0)) * F.lit(100.0) / F.count("*"), 4).alias(
            "success_percent"
        ),
    )


# fixed values: price of one token
INPUT_TOKEN_COST = 0.00001
OUTPUT_TOKEN_COST = 0.00003


def daily_cost(log: DataFrame) -> DataFrame:
    """Tokens and cost of the successful requests per endpoint and day."""
    per_day = log.where("status = 'Success'").groupBy("endpoint", F.to_date("ts").alias("day"))
    tokens = per_day.agg(F.sum("prompt_tokens").alias("input_tokens"), F.sum("completion_tokens").alias("output_tokens"))
    cost = F.col("input_tokens") * F.lit(INPUT_TOKEN_COST) + F.col("output_tokens") * F.lit(OUTPUT_TOKEN_COST)
    return tokens.withColumn("cost", F.round(cost, 6))


def log_summary(log: DataFrame) -> DataFrame:
    """One row, zeros on an empty log. ``success_rate`` is a fraction."""
    ok = F.avg(F.when(F.col("status") == "Success", 1.0).otherwise(0.0))
    return log.agg(
        F.round(F.coalesce(ok, F.lit(0.0)), 6).alias("success_rate"),
        F.round(F.coalesce(F.avg("latency_ms"), F.lit(0.0)), 4).alias("mean_latency"),
        F.coalesce(F.sum(F.col("prompt_tokens") + F.col("completion_tokens")), F.lit(0)).cast("bigint").alias("tokens"),
        F.count("*").alias("n"),
    )


def service_metrics(log: DataFrame, key: str) -> DataFrame:
    """Counters per key; the maximum latency and the true 99th percentile are two columns."""
    ok = F.col("status") == "Success"
    counters = log.groupBy(key).agg(
        F.count("*").alias("total_requests"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.count_if(F.col("status") == "Filtered").alias("violations"),
        F.round(F.avg("latency_ms"), 4).alias("mean_latency"),
        F.max("latency_ms").alias("max_latency_ms"),
    )
    tail = quantiles(log, [key], "latency_ms", {"p99_latency_ms": 0.99})
    return (
        counters.join(tail, key, "left")
        .withColumn("p99_latency_ms", F.round("p99_latency_ms", 6))
        .withColumn("success_rate", F.round(F.col("successful") / F.col("total_requests"), 6))
    )


def statistics(column: str) -> list[Column]:
    """Mean, population deviation, range and number of missing values; zeros when nothing is there.

    NaN counts as missing.
    """
    x = F.when(~F.isnan(column), F.col(column))
    zero = F.lit(0.0)
    return [
        F.coalesce(F.avg(x), zero).alias("mean"),
        F.coalesce(F.stddev_pop(x), zero).alias("stddev"),
        F.coalesce(F.min(x), zero).alias("smallest"),
        F.coalesce(F.max(x), zero).alias("largest"),
        F.count_if(F.col(column).isNull() | F.isnan(column)).alias("n_missing"),
    ]


def full_frame_mean(column: str, size: int) -> Callable[[Window], Column]:
    """Mean over a frame, NULL until the frame holds ``size`` rows."""
    return lambda w: F.when(F.count("*").over(w) == size, F.avg(column).over(w))


def trend(series: DataFrame, key: str, ts: str, value: str, points: int = 5) -> DataFrame:
    """Direction over the last points of each series: relative change above 0.05, below -0.05 or between."""
    newest = Window.partitionBy(key).orderBy(F.desc(ts))
    last = series.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= points)
    ends = last.groupBy(key).agg(F.count("*").alias("_n"), F.min_by(value, ts).alias("_a"), F.max_by(value, ts).alias("_b"))
    change = (F.col("_b") - F.col("_a")) / F.greatest(F.abs("_a"), F.lit(0.001))
    direction = (
        F.when(F.col("_n") < 2, "stable").when(change > 0.05, "improving").when(change < -0.05, "degrading").otherwise("stable")
    )
    return ends.select(key, change.alias("change"), direction.alias("trend"))
