"""Quantile sketches that are stored per day and merged for any span."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.workspace import written

#: Items a sketch keeps per level: a rank is off by about 1.3 / k of the rows.
SIZE = 800


def daily(log: DataFrame, ts: str, keys: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """(day, keys..., sketch, n, smallest, largest): a few KB per day and key, whatever the number of rows. Null values are left out.

    Rows are sketched before the shuffle, so a hot key is one sketch per task.
    """
    day = F.to_date(F.col(ts)).alias("day")
    rows = log.where(F.col(value).isNotNull()).groupBy(day, *keys)
    return rows.agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"),
        F.count(value).alias("n"),
        F.min(value).cast("double").alias("smallest"),
        F.max(value).cast("double").alias("largest"),
    )


def merged(sketches: DataFrame, unit: str, keys: Sequence[str], probabilities: Mapping[str, float], size: int = SIZE) -> DataFrame:
    """(span, keys..., n, one column per probability): quantiles of each ``unit`` (week, month, ...) from the sketches of its days; no row of the log is read."""
    span = F.date_trunc(unit, F.col("day")).cast("date").alias("span")
    found = sketches.groupBy(span, *keys).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("_all"), F.sum("n").alias("n"))
    return found.select("span", *keys, "n", *[F.kll_sketch_get_quantile_double("_all", F.lit(float(p))).alias(name) for name, p in probabilities.items()])


def settled(df: DataFrame, key: str, value: str, percent: int, accuracy: int = 10000) -> DataFrame:
    """(key, n, guess, within, p<percent>): the approximate percentile ``guess``, whether its rank is off by at most 1 / ``accuracy`` of the
    values, and the value at the exact rank ceil(percent / 100 * values).

    The exact value lies between the approximate percentiles two errors below and above, so only the values between them, some 6 /
    ``accuracy`` of the rows, are ordered.
    """
    share, off = percent / 100, 2 / accuracy
    rows = df.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    bounds = F.percentile_approx("_value", [max(share - off, 0.0), share, min(share + off, 1.0)], accuracy)
    guessed = written(rows.groupBy(F.col("_key").alias("_of")).agg(bounds.alias("_q")), "guessed")
    low, guess, high = (F.get("_q", F.lit(i)) for i in range(3))
    met = rows.join(guessed.select("_of", low.alias("_low"), guess.alias("guess"), high.alias("_high")), F.col("_key").eqNullSafe(F.col("_of")))
    counted = met.groupBy("_of", "guess").agg(
        F.count("*").alias("n"),
        F.count("_value").alias("_values"),
        F.count_if(F.col("_value") < F.col("_low")).alias("_under"),
        F.count_if(F.col("_value") < F.col("guess")).alias("_below"),
        F.count_if(F.col("_value") <= F.col("guess")).alias("_upto"),
    )
    near = met.where(F.col("_value").between(F.col("_low"), F.col("_high"))).groupBy("_key", "_value").agg(F.count("*").alias("_times"))
    upto = near.withColumn("_upto_value", F.sum("_times").over(Window.partitionBy("_key").orderBy("_value")))
    rank = F.expr(f"({percent} * _values + 99) div 100")
    room = F.ceil(F.col("_values") / accuracy) + 1
    within = (F.col("_below") <= share * F.col("_values") + room) & (F.col("_upto") >= share * F.col("_values") - room)
    joined = written(counted, "counted").join(upto, F.col("_of").eqNullSafe(F.col("_key")) & (F.col("_under") + F.col("_upto_value") >= rank), "left")
    return joined.groupBy(F.col("_of").alias(key), "n", "guess", within.alias("within")).agg(F.min("_value").alias(f"p{percent}"))
