"""Experiment variants: deterministic assignment, picking by a uniform value, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_variant(uniform: Column, variants: Sequence[tuple[str, float]]) -> Column:
    """First variant whose running weight lies above the value; the last one when none does."""
    bounds, total = [], 0.0
    for name, weight in variants:
        total += weight
        bounds.append((name, round(total, 12)))
    picked = F.lit(bounds[-1][0])
    for name, bound in reversed(bounds):
        picked = F.when(uniform < bound, name).otherwise(picked)
    return picked


def assign_variant(user: Column, variants: Sequence[tuple[str, float]], active: Column) -> Column:
    """Variant by the user id modulo 100; NULL while the experiment is not active.

    Integer ids are used as they are, other ids go through crc32, which is the same on every machine.
    """
    return F.when(active, pick_variant(F.pmod(user, F.lit(100)) / 100, variants))


def hashed_user(user: Column) -> Column:
    """A number for a user key of any type: the first eight hexadecimal digits of the MD5 of its text."""
    return F.conv(F.substring(F.md5(user.cast("string")), 1, 8), 16, 10).cast("bigint")


def summarise(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requests, users, success share and mean latency per variant."""
    return log.groupBy(*keys).agg(
        F.count("*").alias("n_requests"),
        F.count_distinct(F.col("user_id")).alias("n_users"),
        F.round(F.avg((F.col("status") == "Success").cast("int")), 6).alias("success_rate"),
        F.round(F.avg("latency_ms"), 4).alias("mean_latency"),
    )
