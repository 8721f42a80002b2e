"""Model fitting and scoring. Fits are distributed aggregates or MLlib; scoring is column arithmetic."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.ordered import running_totals
from marlstone.workspace import written


def descend_linear(df: DataFrame, features: Sequence[str], target: str, rate: float, steps: int) -> tuple[list[float], float]:
    """Weights and bias of linear regression after ``steps`` of batch gradient descent from zero.

    The gradient needs only the sums of products of the columns, so the table is read once;
    the steps then run on a (features + 2)^2 matrix.
    """
    columns = [*features, "_one", target]
    with_one = df.withColumn("_one", F.lit(1.0))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = with_one.agg(*[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"s{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = sums[f"s{i}_{j}"] or 0.0
    n = gram[len(features), len(features)]
    if n == 0:
        raise ValueError("cannot fit on an empty table")
    inputs, answer = gram[:-1, :-1], gram[:-1, -1]
    weights = np.zeros(len(features) + 1)
    for _ in range(steps):
        weights = weights - rate * (inputs @ weights - answer) / n
    return [float(w) for w in weights[:-1]], float(weights[-1])


def descend_rows(df: DataFrame, features: Sequence[str], label: str, order: str, epochs: int = 100, rate: float = 0.01) -> tuple[list[float], float]:
    """Weights and bias of logistic regression by descent in row order: every row moves the weights at once.

    Each epoch every partition walks through its rows in ``order`` from the weights of the epoch before, and the partitions' weights
    are averaged by their rows. One partition gives the plain loop over all rows. The rows are range-partitioned and written
    once; an epoch sends the weights out and one row per partition back. Rows with a null feature or label are left out.
    """
    columns = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(features)]
    rows = df.select(*columns, F.col(label).cast("double").alias("_y"), F.col(order).alias("_order")).dropna()
    stored = written(rows.repartitionByRange("_order").sortWithinPartitions("_order").drop("_order"), "descent")
    size = len(features)
    schema = ", ".join(f"w{i} double" for i in range(size + 1)) + ", n bigint"
    weights = [0.0] * (size + 1)
    for _ in range(epochs):

        def walk(batches: Iterator[pd.DataFrame], start=tuple(weights)) -> Iterator[pd.DataFrame]:
            own, n = list(start), 0
            for pdf in batches:
                for *x, y in pdf.itertuples(index=False, name=None):
                    score = own[-1] + sum(w * v for w, v in zip(own, x, strict=False))
                    step = rate * (y - 1.0 / (1.0 + math.exp(-min(max(score, -500.0), 500.0))))
                    own = [w + step * v for w, v in zip(own, x, strict=False)] + [own[-1] + step]
                    n += 1
            if n:
                yield pd.DataFrame([(*own, n)], columns=[c.split()[0] for c in schema.split(", ")])

        found = stored.mapInPandas(walk, schema).agg(*[(F.sum(F.col(f"w{i}") * F.col("n")) / F.sum("n")).alias(f"w{i}") for i in range(size + 1)]).first()
        if found[0] is None:
            raise ValueError("cannot fit on an empty table")
        weights = [float(v) for v in found]
    return weights[:-1], weights[-1]


def linear(features: Sequence[str], weights: Sequence[float], bias: float) -> Column:
    score = F.lit(float(bias))
    for name, w in zip(features, weights, strict=True):
        score = score + F.lit(float(w)) * F.col(name)
    return score


def r_squared(df: DataFrame, target: str, predicted: str) -> DataFrame:
    """1 - residual sum of squares / total sum of squares."""
    residual = F.sum((F.col(target) - F.col(predicted)) * (F.col(target) - F.col(predicted)))
    return df.agg((1 - residual / F.nullif(F.count(target) * F.var_pop(target), F.lit(0.0))).alias("r_squared"))


def linear_batch(df: DataFrame, vector: str, weights: Sequence[float], bias: float) -> tuple[DataFrame, DataFrame]:
    """Scored rows and rejected rows (vector of another length)."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    fits = F.coalesce(F.size(vector) == len(weights), F.lit(False))
    products = F.zip_with(F.col(vector).cast("array<double>"), w, lambda a, b: a * b)
    score = F.aggregate(products, F.lit(float(bias)), lambda acc, x: acc + x)
    return df.where(fits).withColumn("score", score), df.where(~fits)


def verdict(probability: Column, threshold: float) -> list[Column]:
    return [
        probability.alias("probability"),
        (probability >= threshold).alias("is_positive"),
        (F.abs(probability - 0.5) * 2.0).alias("confidence"),
    ]


def model_udf(load: Callable[[], Callable[[pd.DataFrame], np.ndarray]]):
    """A model over a struct of features as an iterator UDF. ``load`` runs once per task and returns the function that scores a batch."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = load()
        for rows in batches:
            yield pd.Series(np.asarray(predict(rows), dtype=float))

    return run


# --- decision stump -------------------------------------------------------------------


def fit_stump(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row (feature, threshold, left_class, right_class, gini): the best split by weighted Gini.

    Exact: class counts per distinct value, then running sums over the sorted values.
    Ties go to the feature listed first, then to the lower threshold. A split with an empty side does not count.
    """
    listed = F.array(
        *[F.struct(F.lit(i).alias("_feature_no"), F.col(c).cast("double").alias("threshold")) for i, c in enumerate(features)]
    )
    positive = F.least(F.col(label).cast("int"), F.lit(1))
    long = df.select(F.explode(listed).alias("_f"), positive.alias("_y")).select("_f.*", "_y")
    counts = long.groupBy("_feature_no", "threshold").agg(F.count("*").alias("_n"), F.sum("_y").alias("_ones"))
    left = running_totals(counts, ["_feature_no"], ["threshold"], {"_ln": F.col("_n"), "_l1": F.col("_ones")})
    totals = df.agg(F.struct(F.count("*").alias("n"), F.sum(positive).alias("ones"))).scalar()
    sides = left.withColumns({"_rn": totals["n"] - F.col("_ln"), "_r1": totals["ones"] - F.col("_l1")}).where("_ln > 0 AND _rn > 0")

    def impurity(ones: str, n: str) -> Column:
        p = F.col(ones) / F.col(n)
        return 1 - (p * p + (1 - p) * (1 - p))

    weighted = (F.col("_ln") * impurity("_l1", "_ln") + F.col("_rn") * impurity("_r1", "_rn")) / (F.col("_ln") + F.col("_rn"))
    names = F.array(*[F.lit(c) for c in features])
    best = F.min(F.struct(F.round(weighted, 12).alias("gini"), "_feature_no", "threshold", "_ln", "_l1", "_rn", "_r1"))
    return sides.agg(best.alias("_b")).select(
        F.element_at(names, F.col("_b._feature_no") + 1).alias("feature"),
        "_b.threshold",
        (F.col("_b._l1") > F.col("_b._ln") / 2).cast("int").alias("left_class"),
        (F.col("_b._r1") > F.col("_b._rn") / 2).cast("int").alias("right_class"),
        "_b.gini",
    )


def stump_class(stump: DataFrame, features: Sequence[str]) -> Column:
    """Class of a row by a fitted stump."""
    chosen = stump.select(F.struct("feature", "threshold", "left_class", "right_class")).scalar()
    value = F.lit(None).cast("double")
    for c in features:
        value = F.when(chosen["feature"] == c, F.col(c).cast("double")).otherwise(value)
    return F.when(value <= chosen["threshold"], chosen["left_class"]).otherwise(chosen["right_class"])


# --- MLlib classifiers ----------------------------------------------------------------


def _with_assembler(features: Sequence[str], classifier) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), classifier])


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 100, reg: float = 0.0) -> PipelineModel:
    model = LogisticRegression(labelCol=label, maxIter=max_iter, regParam=reg)
    return _with_assembler(features, model).fit(df)


def fit_forest(df: DataFrame, features: Sequence[str], label: str, trees: int, depth: int, seed: int = 42) -> PipelineModel:
    model = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return _with_assembler(features, model).fit(df)


def fit_boosted(
    df: DataFrame, features: Sequence[str], label: str, depths: Sequence[int], folds: int, max_iter: int = 5, seed: int = 42
) -> CrossValidatorModel:
    model = GBTClassifier(labelCol=label, maxIter=max_iter, seed=seed)
    return CrossValidator(
        estimator=_with_assembler(features, model),
        estimatorParamMaps=ParamGridBuilder().addGrid(model.maxDepth, list(depths)).build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label),
        numFolds=folds,
        seed=seed,
    ).fit(df)


def positive_probability() -> Column:
    return F.element_at(vector_to_array("probability"), 2)


def importances(model: PipelineModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance), one row per feature."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(features, values, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


# --- evaluation -----------------------------------------------------------------------


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / F.nullif(b, F.lit(0))).otherwise(F.lit(0.0))


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(F.avg(F.when(F.col(label) == F.col(predicted), 1.0).otherwise(0.0)).alias("accuracy"))


def confusion(df: DataFrame, label: Column, predicted: Column, latency_ms: float = 0.0) -> DataFrame:
    """Counts, accuracy, precision, recall, F1 (0 on empty denominators) and the pass flag."""
    counts = df.agg(
        F.count_if(predicted & label).alias("tp"),
        F.count_if(predicted & ~label).alias("fp"),
        F.count_if(~predicted & ~label).alias("tn"),
        F.count_if(~predicted & label).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rates = counts.withColumns(
        {"accuracy": _ratio(tp + tn, tp + tn + fp + fn), "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)}
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", _ratio(2.0 * p * r, p + r)).withColumn(
        "passed", (F.col("accuracy") >= 0.8) & (F.lit(float(latency_ms)) <= 10.0)
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve: each positive beats the negatives below it and half of those level with it."""
    levels = df.groupBy(F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    below = running_totals(levels, [], ["_s"], {"_below": F.col("_n")}, inclusive=False)
    won = F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2))
    return below.agg((won / F.nullif(F.sum("_p") * F.sum("_n"), F.lit(0))).alias("auc"))
