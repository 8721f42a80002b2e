import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import models as mo


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2)).round(1)
    y = 1.5 * x[:, 0] - 0.5 * x[:, 1] + 2 + rng.normal(scale=0.1, size=300)
    label = (x[:, 0] + rng.normal(scale=0.5, size=300) > 0.2).astype(int)
    rows = [(i, float(a), float(b), float(t), int(c)) for i, ((a, b), t, c) in enumerate(zip(x, y, label, strict=True))]
    return x, y, label, spark.createDataFrame(rows, "id bigint, a double, b double, t double, label int").repartition(4).cache()


def test_gradient_descent_takes_the_same_steps(frame):
    x, y, _, df = frame
    weights, bias = np.zeros(2), 0.0
    for _ in range(50):
        error = x @ weights + bias - y
        weights, bias = weights - 0.1 * (x.T @ error) / len(y), bias - 0.1 * error.mean()
    got, got_bias = mo.descend_linear(df, ["a", "b"], "t", 0.1, 50)
    assert got == pytest.approx(weights.tolist()) and got_bias == pytest.approx(bias)
    scored = df.withColumn("p", mo.linear(["a", "b"], got, got_bias))
    want = 1 - ((y - x @ weights - bias) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert mo.r_squared(scored, "t", "p").first()["r_squared"] == pytest.approx(want)


def gini(labels):
    p = labels.mean()
    return 1 - p * p - (1 - p) * (1 - p)


def test_stump_is_the_best_split(frame):
    x, _, label, df = frame
    best = min(
        (round((m.sum() * gini(label[m]) + (~m).sum() * gini(label[~m])) / len(label), 12), f, t)
        for f in range(2)
        for t in np.unique(x[:, f])
        for m in [x[:, f] <= t]
        if m.any() and not m.all()
    )
    got = mo.fit_stump(df, ["a", "b"], "label").first()
    assert (got["gini"], got["feature"], got["threshold"]) == (pytest.approx(best[0]), "ab"[best[1]], best[2])
    assert (got["left_class"], got["right_class"]) == (0, 1)
    guess = mo.stump_class(mo.fit_stump(df, ["a", "b"], "label"), ["a", "b"])
    scored = df.withColumn("g", guess)
    assert mo.accuracy(scored, "label", "g").first()["accuracy"] == pytest.approx(((x[:, 0] > best[2]) == label).mean())


def test_auc(frame):
    x, _, label, df = frame
    positive, negative = x[label == 1, 0], x[label == 0, 0]
    won = (positive[:, None] > negative).sum() + 0.5 * (positive[:, None] == negative).sum()
    assert mo.auc(df, "label", "a").first()["auc"] == pytest.approx(won / (len(positive) * len(negative)))


def test_confusion_on_empty_denominators(spark):
    df = spark.createDataFrame([(False, False)], "l boolean, p boolean")
    row = mo.confusion(df, F.col("l"), F.col("p"), latency_ms=11).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["passed"]) == (1.0, 0.0, 0.0, 0.0, False)


def test_classifiers_learn(frame):
    _, _, label, df = frame
    base = max(label.mean(), 1 - label.mean())
    for model in (mo.fit_logistic(df, ["a", "b"], "label"), mo.fit_forest(df, ["a", "b"], "label", 5, 3)):
        scored = model.transform(df)
        assert mo.accuracy(scored, "label", "prediction").first()["accuracy"] > base + 0.1
    names = {r["feature"]: r["importance"] for r in mo.importances(model, ["a", "b"], df).collect()}
    assert names["a"] > names["b"]


def test_linear_batch_rejects_other_lengths(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id int, v array<double>")
    scored, rejected = mo.linear_batch(df, "v", [2.0, 3.0], 1.0)
    assert [(r["id"], r["score"]) for r in scored.collect()] == [(1, 9.0)]
    assert sorted(r["id"] for r in rejected.collect()) == [2, 3]


def test_row_descent_in_one_partition_is_the_plain_loop(frame):
    x, _, label, df = frame
    weights = np.zeros(3)
    for _ in range(4):
        for row, y in zip(x, label, strict=True):
            step = 0.05 * (y - 1 / (1 + np.exp(-(weights[:2] @ row + weights[2]))))
            weights += step * np.array([*row, 1.0])
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        got, bias = mo.descend_rows(df, ["a", "b"], "label", "id", epochs=4, rate=0.05)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [*got, bias] == pytest.approx(weights.tolist())


def test_row_descent_in_parallel_learns_as_well(frame):
    _, _, label, df = frame
    rows = df.unionByName(df.limit(5).withColumn("a", F.lit(None).cast("double"))).withColumn("in_test", F.col("id") % 4 == 0)
    weights, bias = mo.descend_rows(rows.where("NOT in_test"), ["a", "b"], "label", "id", epochs=20)
    scored = rows.where("in_test AND a IS NOT NULL").withColumn("p", (mo.linear(["a", "b"], weights, bias) >= 0).cast("int"))
    base = max(label.mean(), 1 - label.mean())
    assert mo.accuracy(scored, "label", "p").first()["accuracy"] > base + 0.1
    with pytest.raises(ValueError, match="empty"):
        mo.descend_rows(rows.limit(0), ["a", "b"], "label", "id", epochs=1)


@pytest.fixture(scope="module")
def separable(spark):
    """2,000 rows whose label follows from the features but for a twentieth of them."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 3))
    label = ((x[:, 0] + 0.7 * x[:, 1] > 0.2) ^ (rng.random(2000) < 0.05)).astype(int)
    rows = [(i, *map(float, r), int(y)) for i, (r, y) in enumerate(zip(x, label, strict=True))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, quality int").repartition(4).cache()
    return df.where("id % 5 > 0"), df.where("id % 5 = 0"), label[::5]


def test_held_out_limits_of_the_classifiers(separable):
    train, test, label = separable
    share = max(label.mean(), 1 - label.mean())
    names = ["a", "b", "c"]
    logistic = mo.fit_logistic(train, names, "quality").transform(test)
    forest = mo.fit_forest(train, names, "quality", trees=20, depth=5)
    boosted = mo.fit_boosted(train, names, "quality", depths=[2, 3], folds=2)
    for scored in (logistic, forest.transform(test), boosted.transform(test)):
        found = mo.confusion(scored, F.col("quality") == 1, F.col("prediction") == 1.0).first()
        assert found["tp"] + found["fn"] == label.sum() and found["accuracy"] >= share - 0.05 and found["accuracy"] > 0.8
    assert max(boosted.avgMetrics) > 0.8
    weight = {r["feature"]: r["importance"] for r in mo.importances(forest, names, train).collect()}
    assert sum(weight.values()) == pytest.approx(1) and weight["c"] < weight["b"] < weight["a"]
