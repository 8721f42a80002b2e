"""Feature engineering: scaling, binning, encoding, splits, transform pipelines.

Table-wide statistics enter as scalar subqueries: one plan, no collect, no cross join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.ordered import positioned, rolling, row_numbers
from marlstone.operators.relational import full_frame_mean, relu, sigmoid, statistics

STD_FLOOR = 1e-10
MIN_RANGE = 1e-10


def summary(df: DataFrame, column: str) -> Column:
    """Mean, deviations, minimum and maximum of a column as one scalar subquery (a struct)."""
    return df.agg(
        F.struct(
            F.avg(column).alias("mean"),
            F.stddev_pop(column).alias("std_pop"),
            F.stddev_samp(column).alias("std_samp"),
            F.min(column).alias("low"),
            F.max(column).alias("high"),
        )
    ).scalar()


# --- scaling --------------------------------------------------------------------------


def fit_standard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parameter row: mean and population deviation (at least 1e-10) of each column."""
    if df.isEmpty():
        raise ValueError("cannot fit on an empty table")
    means = [F.avg(c).alias(f"{c}_mean") for c in columns]
    stds = [F.greatest(F.stddev_pop(c), F.lit(STD_FLOOR)).alias(f"{c}_std") for c in columns]
    return df.agg(*means, *stds)


def _parameters(fitted: DataFrame, columns: Sequence[str]) -> Column:
    unfitted = [c for c in columns if f"{c}_mean" not in fitted.columns]
    if unfitted:
        raise ValueError(f"the scaler was not fitted for {unfitted}")
    return fitted.select(F.struct(*fitted.columns)).scalar()


def scale(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    p = _parameters(fitted, columns)
    return df.withColumns({c: (F.col(c) - p[f"{c}_mean"]) / p[f"{c}_std"] for c in columns})


def unscale(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    p = _parameters(fitted, columns)
    return df.withColumns({c: F.col(c) * p[f"{c}_std"] + p[f"{c}_mean"] for c in columns})


def zscore(df: DataFrame, column: str) -> Column:
    """With the sample deviation; NULL when it is zero."""
    s = summary(df, column)
    return (F.col(column) - s["mean"]) / F.nullif(s["std_samp"], F.lit(0.0))


def zscore_or_fail(df: DataFrame, column: str) -> Column:
    """With the population deviation; a constant column is an error."""
    s = summary(df, column)
    failed = F.raise_error(F.lit(f"column {column} is constant")).cast("double")
    return F.when(s["std_pop"] == 0, failed).otherwise((F.col(column) - s["mean"]) / F.nullif(s["std_pop"], F.lit(0.0)))


def minmax(df: DataFrame, column: str) -> Column:
    s = summary(df, column)
    width = s["high"] - s["low"]
    return F.when(width < MIN_RANGE, F.lit(0.0)).otherwise((F.col(column) - s["low"]) / F.greatest(width, F.lit(MIN_RANGE)))


def equal_width_bin(df: DataFrame, column: str, n_bins: int) -> Column:
    """Bin 0..n-1 between minimum and maximum, the maximum in the last bin; all 0 when the range is 0."""
    s = summary(df, column)
    return bin_between(F.col(column), s["low"], s["high"], n_bins)


def bin_between(x: Column, low: Column, high: Column, n_bins: int) -> Column:
    step = (high - low) / n_bins
    at = F.floor((x - low) / F.nullif(step, F.lit(0.0)))
    return F.when(high == low, F.lit(0)).otherwise(F.least(at, F.lit(n_bins - 1))).cast("int")


# --- encoding -------------------------------------------------------------------------


def fit_classes(df: DataFrame, column: str) -> DataFrame:
    """Dictionary (class, code): sorted distinct values numbered from 0."""
    classes = df.select(F.col(column).alias("class")).where("class IS NOT NULL").distinct()
    return row_numbers(classes, ["class"], "code", start=0)


def encode(df: DataFrame, classes: DataFrame, column: str, name: str) -> DataFrame:
    """Add the code of each value; an unknown value is an error."""
    known = classes.select(F.col("class").alias(column), F.col("code").alias("_code"))
    unknown = F.raise_error(F.concat(F.lit("unknown class "), F.coalesce(F.col(column), F.lit("NULL")))).cast("bigint")
    joined = df.join(known, column, "left")
    return joined.withColumn(name, F.when(F.col("_code").isNull(), unknown).otherwise(F.col("_code"))).drop("_code")


def decode(df: DataFrame, classes: DataFrame, code: str, name: str) -> DataFrame:
    return df.join(classes.select(F.col("code").alias(code), F.col("class").alias(name)), code, "left")


def one_hot(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    """0/1 column per (name -> value)."""
    return df.withColumns({n: (F.col(column) == v).cast("int") for n, v in values.items()})


# --- splits ---------------------------------------------------------------------------


def head_tail_split(df: DataFrame, order: Sequence[str], ratio: float) -> DataFrame:
    """``in_head`` for the first floor(n * ratio) rows."""
    placed = positioned(df, order)
    cut = F.floor(placed.agg(F.count("*")).scalar() * F.lit(float(ratio)))
    return placed.withColumn("in_head", F.col("_pos") < cut).drop("_pos", "_chunk")


def shuffle_split(df: DataFrame, key: str, test_size: float, seed: int) -> DataFrame:
    """``in_test`` for round(n * test_size) rows, picked by the MD5 of 'key:seed': the same seed gives the same rows in any engine."""
    hashed = df.withColumn("_hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
    placed = positioned(hashed, ["_hash", key])
    cut = F.round(placed.agg(F.count("*")).scalar() * F.lit(float(test_size)))
    return placed.withColumn("in_test", F.col("_pos") < cut).drop("_pos", "_chunk", "_hash")


# --- transform pipeline ---------------------------------------------------------------


@dataclass(frozen=True)
class Transform:
    """kind: zscore, minmax, log, rolling_mean, bin, relu or sigmoid; size for rolling_mean and bin."""

    name: str
    kind: str
    size: int = 0


def apply_transforms(
    df: DataFrame, column: str, transforms: Sequence[Transform], keys: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """One feature column per transform of ``column``. Rolling means run per key in the given order."""
    made = {
        "zscore": lambda t: zscore_or_fail(df, column),
        "minmax": lambda t: minmax(df, column),
        "log": lambda t: F.log(F.col(column) + 1e-8),
        "bin": lambda t: equal_width_bin(df, column, t.size).cast("double"),
        "relu": lambda t: relu(F.col(column)),
        "sigmoid": lambda t: sigmoid(F.col(column)),
    }
    unknown = [t.kind for t in transforms if t.kind != "rolling_mean" and t.kind not in made]
    if unknown:
        raise ValueError(f"unknown transforms {unknown}")
    result = df
    for t in transforms:
        if t.kind == "rolling_mean":
            result = rolling(result, list(keys), list(order), t.size, {t.name: full_frame_mean(column, t.size)})
    return result.withColumns({t.name: made[t.kind](t) for t in transforms if t.kind != "rolling_mean"})


def feature_statistics(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of statistics per feature column, from a single aggregate."""
    rows = [F.struct(F.lit(n).alias("feature"), *statistics(n)) for n in names]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


# --- fraud features -------------------------------------------------------------------

# fixed values: categories counted as high risk
HIGH_RISK_CATEGORIES = (5, 12, 18)


def fraud_features(df: DataFrame) -> DataFrame:
    """Six features of (amount, merchant_category, hour_of_day, day_of_week, is_online)."""
    s = summary(df, "amount")

    def flag(c: Column) -> Column:
        return c.cast("double")

    return df.withColumns(
        {
            "amount_normalized": (F.col("amount") - s["mean"]) / F.greatest(s["std_pop"], F.lit(1.0)),
            "amount_log": F.log(F.col("amount") + 1.0),
            "is_high_risk_category": flag(F.col("merchant_category").isin(*HIGH_RISK_CATEGORIES)),
            "is_night_transaction": flag((F.col("hour_of_day") < 6) | (F.col("hour_of_day") > 22)),
            "is_weekend": flag(F.col("day_of_week") >= 5),
            "is_online_flag": flag(F.col("is_online")),
        }
    )


def fraud_label() -> Column:
    """Rule-based label over amount, hour, category and the online flag."""
    amount, hour = F.col("amount"), F.col("hour_of_day")
    remote = (amount > 400) & F.col("is_online")
    night = (hour < 6) & (amount > 200)
    risky = (F.col("merchant_category") == 5) & (amount > 300)
    return remote | night | risky
