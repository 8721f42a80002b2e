"""Stored quantile sketches: rank errors of merged ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import sketches


@pytest.fixture(scope="module")
def log(spark):
    rng = np.random.default_rng(3)
    rows = [(int(d), "hot" if rng.random() < 0.5 else f"e{rng.integers(3)}", float(v)) for d, v in zip(rng.integers(0, 28, 40_000), rng.lognormal(3, 1, 40_000), strict=True)]
    rows += [(3, "hot", None), (3, "none", None)]
    return spark.createDataFrame(rows, "d int, endpoint string, ms double").select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(d, 5)").alias("ts"), "endpoint", "ms").repartition(6).cache()


def test_quantiles_of_weeks_from_daily_sketches_are_near_the_exact_rank(log):
    daily = sketches.daily(log, "ts", ["endpoint"], "ms").cache()
    assert daily.count() <= 28 * 4
    values = {}
    for r in log.where("ms IS NOT NULL").select(F.date_trunc("week", "ts").cast("date").alias("span"), "endpoint", "ms").collect():
        values.setdefault((r.span, r.endpoint), []).append(r.ms)
    found = sketches.merged(daily, "week", ["endpoint"], {"p50": 0.5, "p99": 0.99}).collect()
    assert {(r.span, r.endpoint): r.n for r in found} == {k: len(v) for k, v in values.items()}
    for r in found:
        own = np.sort(values[r.span, r.endpoint])
        for name, p in (("p50", 0.5), ("p99", 0.99)):
            rank = np.searchsorted(own, r[name], side="right") / len(own)
            assert abs(rank - p) <= 0.005 + 1 / len(own)


def test_spans_of_any_length_come_from_the_same_sketches(log):
    daily = sketches.daily(log, "ts", ["endpoint"], "ms").cache()
    one = sketches.merged(daily, "month", [], {"p99": 0.99}).first()
    assert one.n == 40_000
    assert one.p99 == pytest.approx(np.quantile([r.ms for r in log.where("ms IS NOT NULL").collect()], 0.99), rel=0.1)


def test_empty_log(log):
    assert sketches.daily(log.limit(0), "ts", ["endpoint"], "ms").collect() == []


def test_settled_percentile_is_the_value_at_its_rank(spark):
    rng = random.Random(9)
    values = {"a": [float(rng.randrange(10**6)) for _ in range(30000)], "b": [1.0] * 150 + [2.0], "c": [None, None], None: [5.0, 7.0, None]}
    rows = [(k, v) for k, found in values.items() for v in found]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "kind string, value double").repartition(7)
    got = {r.kind: r for r in sketches.settled(df, "kind", "value", 99).collect()}
    assert set(got) == set(values)
    for k, found in values.items():
        held = sorted(v for v in found if v is not None)
        assert got[k].n == len(found) and got[k].within
        assert got[k].p99 == (held[-(-99 * len(held) // 100) - 1] if held else None)


def test_approximate_percentile_has_a_twin_with_its_rows(spark, folder):
    from marlstone.plans import load

    twin = load()["agg_08_approximate_p99"]
    assert twin.sql and {"n", "within", "p99"} <= set(twin.run(spark, folder).columns)
