import math

import pytest
from pyspark.sql import functions as F

from marlstone.operators import features as fe
from marlstone.operators import relational as rel


@pytest.fixture
def numbers(spark):
    return lambda *xs: spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id bigint, x double")


def values(df, column, name="y"):
    return [r[name] for r in df.withColumn(name, column).orderBy("id").collect()]


def test_statistics(spark, numbers):
    row = numbers(1, 2, 3, 4, 5).agg(*rel.statistics("x")).first()
    assert (row["mean"], row["smallest"], row["largest"], row["n_missing"]) == (3.0, 1.0, 5.0, 0)
    assert tuple(numbers(1).limit(0).agg(*rel.statistics("x")).first()) == (0.0, 0.0, 0.0, 0.0, 0)
    assert numbers(1, math.nan, 3, 4, 5).agg(*rel.statistics("x")).first()["n_missing"] == 1


def test_minmax_and_bins(numbers):
    df = numbers(0, 25, 50, 75, 100)
    assert values(df, fe.minmax(df, "x")) == [0, 0.25, 0.5, 0.75, 1]
    df = numbers(0, 0.25, 0.5, 0.75, 1)
    assert values(df, fe.equal_width_bin(df, "x", 4)) == [0, 1, 2, 3, 3]
    flat = numbers(3, 3, 3)
    assert values(flat, fe.minmax(flat, "x")) == [0, 0, 0]
    assert values(flat, fe.equal_width_bin(flat, "x", 4)) == [0, 0, 0]


def test_rolling_mean(numbers):
    df = numbers(1, 2, 3, 4, 5)
    got = fe.apply_transforms(df, "x", [fe.Transform("m", "rolling_mean", 3)], [], ["id"]).orderBy("id").collect()
    assert [r["m"] for r in got] == [None, None, 2, 3, 4]
    short = fe.apply_transforms(numbers(1, 2, 3), "x", [fe.Transform("m", "rolling_mean", 5)], [], ["id"])
    assert {r["m"] for r in short.collect()} == {None}


def test_activations(numbers):
    assert values(numbers(-2, -1, 0, 1, 2), rel.relu(F.col("x"))) == [0, 0, 0, 1, 2]
    low, middle, high = values(numbers(-10, 0, 10), rel.sigmoid(F.col("x")))
    assert low < 0.01 and middle == 0.5 and high > 0.99


def test_zscores(numbers):
    df = numbers(2, 4, 4, 4, 5, 5, 7, 9)
    assert values(df, fe.zscore_or_fail(df, "x"))[0] == pytest.approx(-1.5)
    flat = numbers(3, 3)
    assert values(flat, fe.zscore(flat, "x")) == [None, None]
    with pytest.raises(Exception, match="constant"):
        values(flat, fe.zscore_or_fail(flat, "x"))


def test_scaler(numbers):
    df = numbers(1, 2, 6)
    fitted = fe.fit_standard(df, ["x"])
    back = fe.unscale(fe.scale(df, fitted, ["x"]), fitted, ["x"])
    assert [r["x"] for r in back.orderBy("id").collect()] == pytest.approx([1, 2, 6])
    with pytest.raises(ValueError, match="empty"):
        fe.fit_standard(df.limit(0), ["x"])
    with pytest.raises(ValueError, match="not fitted"):
        fe.scale(df, fitted, ["id"])


def test_classes(spark):
    df = spark.createDataFrame([("cat",), ("dog",), ("bird",), ("cat",)], "c string")
    classes = fe.fit_classes(df, "c")
    assert {r["class"]: r["code"] for r in classes.collect()} == {"bird": 0, "cat": 1, "dog": 2}
    coded = fe.encode(df, classes, "c", "code")
    assert sorted(r["name"] for r in fe.decode(coded, classes, "code", "name").collect()) == ["bird", "cat", "cat", "dog"]
    with pytest.raises(Exception, match="unknown class cow"):
        fe.encode(spark.createDataFrame([("cow",)], "c string"), classes, "c", "code").collect()


def test_splits(spark):
    df = spark.range(100)
    first, second = (fe.shuffle_split(df, "id", 0.2, 5) for _ in range(2))
    picked = sorted(r["id"] for r in first.where("in_test").collect())
    assert len(picked) == 20 and picked == sorted(r["id"] for r in second.where("in_test").collect())
    assert picked != sorted(r["id"] for r in fe.shuffle_split(df, "id", 0.2, 6).where("in_test").collect())
    head = fe.head_tail_split(spark.range(10), ["id"], 0.75)
    assert sorted(r["id"] for r in head.where("in_head").collect()) == list(range(7))


def test_unknown_transform(numbers):
    with pytest.raises(ValueError, match="unknown"):
        fe.apply_transforms(numbers(1), "x", [fe.Transform("m", "cube")])


def test_lab_amounts(spark):
    hours = spark.createDataFrame([(h,) for h in (8, 9, 10, 12, 14, 15, 20, 22, 3)], "h int")
    got = [r["b"] for r in hours.withColumn("b", rel.part_of_day(F.col("h"))).orderBy("h").collect()]
    assert got == ["night"] + ["morning"] * 3 + ["afternoon"] * 3 + ["evening"] * 2
