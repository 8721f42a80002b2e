"""Chunked operators against plain windows and plain Python, with a hot key and tiny chunks."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marlstone.operators import ordered
from marlstone.operators.relational import as_of

CHUNKS = [7, 64, 10_000]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_positions_are_dense(hot_events):
    placed = ordered.positioned(hot_events, ["key", "at", "id"], 10)
    got = [(r["_pos"], r["_chunk"]) for r in placed.orderBy("_pos").collect()]
    assert got == [(i, i // 10) for i in range(1000)]
    by_order = [r["id"] for r in placed.orderBy("_pos").collect()]
    assert by_order == [r["id"] for r in hot_events.orderBy("key", "at", "id").collect()]


def test_positions_descending(hot_events):
    placed = ordered.positioned(hot_events, [F.desc("at"), "id"])
    got = [r["id"] for r in placed.orderBy("_pos").collect()]
    assert got == [r["id"] for r in hot_events.orderBy(F.desc("at"), "id").collect()]


def test_positions_of_nothing(hot_events):
    assert ordered.positioned(hot_events.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("chunk", CHUNKS)
def test_rolling(hot_events, chunk):
    w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(-4, 0)
    want = hot_events.withColumns({"s": F.sum("value").over(w), "n": F.count("*").over(w)})
    got = ordered.rolling(
        hot_events, ["key"], ["at", "id"], 5, {"s": lambda x: F.sum("value").over(x), "n": lambda x: F.count("*").over(x)}, chunk
    )
    assert rows(got, "id", "s", "n") == rows(want, "id", "s", "n")


def test_rolling_refuses_short_chunks(hot_events):
    with pytest.raises(ValueError):
        ordered.rolling(hot_events, ["key"], ["at", "id"], 5, {}, chunk_rows=4)


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_totals(hot_events, chunk, keys, inclusive):
    w = Window.partitionBy(*keys).orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = hot_events.withColumns(
        {"s": F.coalesce(F.sum("value").over(w), F.lit(0)), "n": F.coalesce(F.sum(F.lit(1)).over(w), F.lit(0))}
    )
    terms = {"s": F.col("value"), "n": F.lit(1)}
    got = ordered.running_totals(hot_events, keys, ["at", "id"], terms, inclusive, chunk)
    assert rows(got, "id", "s", "n") == rows(want, "id", "s", "n")


@pytest.mark.parametrize("chunk", CHUNKS)
def test_last_known(hot_events, chunk):
    w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = hot_events.withColumn("value", F.last("value", ignorenulls=True).over(w))
    assert rows(ordered.last_known(hot_events, ["key"], ["at", "id"], ["value"], chunk), "id", "value") == rows(want, "id", "value")


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, None, None), (3, 1, 2.0), (4, None, None)], "id bigint, key bigint, value double")
    got = ordered.last_known(df, ["key"], ["id"], ["value"], chunk_rows=1)
    assert rows(got, "id", "value") == [(1, 5.0), (2, 5.0), (3, 2.0), (4, 5.0)]


@pytest.mark.parametrize("tiles", [1, 3, 10, 2500])
def test_ntile(hot_events, tiles):
    want = hot_events.withColumn("t", F.ntile(tiles).over(Window.orderBy("at", "id")))
    assert rows(ordered.ntile(hot_events, tiles, ["at", "id"], "t"), "id", "t") == rows(want, "id", "t")


def test_quantiles(hot_events):
    got = ordered.quantiles(hot_events, ["key"], "at", {"p50": 0.5, "p99": 0.99}).orderBy("key").toPandas()
    want = hot_events.toPandas().groupby("key")["at"].quantile([0.5, 0.99]).unstack()
    np.testing.assert_allclose(got[["p50", "p99"]].to_numpy(), want.to_numpy())


def test_quantiles_skip_nulls(hot_events):
    got = ordered.quantiles(hot_events, [], "value", {"p10": 0.1}).first()["p10"]
    assert got == pytest.approx(hot_events.toPandas()["value"].quantile(0.1))


def test_as_of(hot_events):
    features = hot_events.where("id % 3 = 0").withColumn("seen", F.col("id"))
    labels = hot_events.where("id % 3 <> 0").select("id", "key", "at")
    got = {r["id"]: r["seen"] for r in as_of(labels, features, ["key"], "at", "id", ["seen"]).collect()}
    known = [tuple(r) for r in features.select("key", "at", "id").collect()]
    for r in labels.collect():
        before = [(at, i) for k, at, i in known if k == r["key"] and at <= r["at"]]
        assert got[r["id"]] == (max(before)[1] if before else None)


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_quantiles_of_a_value_that_half_of_the_rows_have(spark, keys):
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.pmod(F.hash("id"), F.lit(1000)).cast("double")).alias("v"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("key"),
    )
    got = ordered.quantiles(df, keys, "v", {"a": 0.25, "b": 0.5, "c": 0.999}, chunk_rows=50).collect()
    frame = df.toPandas()
    groups = frame.groupby("key", dropna=False) if keys else [(None, frame)]
    want = [[g["v"].quantile(p) for p in (0.25, 0.5, 0.999)] for _, g in groups]
    assert np.allclose(sorted([r["a"], r["b"], r["c"]] for r in got), sorted(want))
