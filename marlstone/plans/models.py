"""Model training, scoring, evaluation and run tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from marlstone.operators import features as fe
from marlstone.operators import models as mo
from marlstone.operators import runs as ru
from marlstone.plans.features import FRAUD_FEATURES_SQL, TRANSACTIONS_SQL, transactions
from marlstone.plans.registry import query, table
from marlstone.sources.logs import RUN_METRICS_SQL, RUN_RECORDS_SQL, run_metrics, run_records
from marlstone.sources.snapshots import SnapshotTable
from marlstone.workspace import scratch, written

_PRICE_SQL = """priced AS (SELECT l_quantity / 50 AS quantity, l_discount * 10 AS discount, l_extendedprice / 100000 AS price FROM lineitem)"""


def _priced(spark, folder):
    """Line items on scales near one, so that plain gradient steps converge."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_quantity") / 50).alias("quantity"),
        (F.col("l_discount") * 10).alias("discount"),
        (F.col("l_extendedprice") / 100000).alias("price"),
    )


_MOMENTS = "avg(quantity * quantity) AS qq, avg(quantity * discount) AS qd, avg(quantity) AS q, avg(discount * discount) AS dd, avg(discount) AS d, avg(quantity * price) AS qp, avg(discount * price) AS dp, avg(price) AS p"


@query(
    "ml_01_linear_regression",
    f"""WITH RECURSIVE {_PRICE_SQL}, m AS (SELECT {_MOMENTS} FROM priced),
    steps AS (SELECT 0 AS i, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 0.0::DOUBLE AS b
      UNION ALL SELECT i + 1, w1 - 0.1::DOUBLE * (qq * w1 + qd * w2 + q * b - qp), w2 - 0.1::DOUBLE * (qd * w1 + dd * w2 + d * b - dp),
        b - 0.1::DOUBLE * (q * w1 + d * w2 + b - p) FROM steps, m WHERE i < 200)
    SELECT round(w1, 6) AS quantity_weight, round(w2, 6) AS discount_weight, round(b, 6) AS bias,
           (SELECT count(*) FROM priced) AS n FROM steps WHERE i = 200""",
)
def linear_regression(spark, folder):
    lines = _priced(spark, folder)
    weights, bias = mo.descend_linear(lines, ["quantity", "discount"], "price", 0.1, 200)
    return lines.agg(
        F.lit(round(weights[0], 6)).alias("quantity_weight"),
        F.lit(round(weights[1], 6)).alias("discount_weight"),
        F.lit(round(bias, 6)).alias("bias"),
        F.count("*").alias("n"),
    )


@query(
    "ml_02_r_squared",
    f"""WITH {_PRICE_SQL}, scored AS (SELECT price, 0.5::DOUBLE * quantity + 0.1::DOUBLE * discount AS guess FROM priced)
    SELECT round(1 - sum((price - guess) * (price - guess)) / (count(*) * var_pop(price)), 6) AS r_squared FROM scored""",
)
def r_squared(spark, folder):
    scored = _priced(spark, folder).withColumn("guess", mo.linear(["quantity", "discount"], [0.5, 0.1], 0.0))
    return mo.r_squared(scored, "price", "guess").withColumn("r_squared", F.round("r_squared", 6))


_DOC_FEATURES = ["n_chars", "n_words", "n_digits"]
DOC_FEATURES_SQL = r"""df AS (SELECT l.doc_id, l.quality, d.n_chars, len(list_filter(string_split_regex(d.text, '\s+'), lambda w: w <> '')) AS n_words,
    length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS n_digits FROM labels l JOIN documents d USING (doc_id))"""


def labelled_documents(spark, folder):
    """Written once: every fit reads its rows several times, the texts should be read once."""
    documents = table(spark, folder, "documents").select(
        "doc_id",
        "n_chars",
        F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("bigint").alias("n_digits"),
    )
    return written(table(spark, folder, "labels").select("doc_id", "quality").join(documents, "doc_id"), "labelled")


_STUMP_SQL = f"""{DOC_FEATURES_SQL},
  long AS (SELECT 0 AS f, n_chars::DOUBLE AS v, quality AS y FROM df UNION ALL SELECT 1, n_words, quality FROM df
           UNION ALL SELECT 2, n_digits, quality FROM df),
  counts AS (SELECT f, v, count(*) AS n, sum(y) AS ones FROM long GROUP BY 1, 2),
  sums AS (SELECT f, v, sum(n) OVER w AS ln, sum(ones) OVER w AS l1, sum(n) OVER (PARTITION BY f) AS n, sum(ones) OVER (PARTITION BY f) AS ones
           FROM counts WINDOW w AS (PARTITION BY f ORDER BY v)),
  sides AS (SELECT f, v, ln, l1, n - ln AS rn, ones - l1 AS r1 FROM sums WHERE n > ln),
  ginis AS (SELECT *, round((ln * (1 - ((l1 / ln) ** 2 + (1 - l1 / ln) ** 2)) + rn * (1 - ((r1 / rn) ** 2 + (1 - r1 / rn) ** 2))) / (ln + rn), 12) AS gini FROM sides),
  stump AS (SELECT ['n_chars', 'n_words', 'n_digits'][f + 1] AS feature, f, v AS threshold, CAST(l1 > ln / 2 AS INTEGER) AS left_class,
            CAST(r1 > rn / 2 AS INTEGER) AS right_class, gini FROM ginis ORDER BY gini, f, v LIMIT 1)"""


@query(
    "ml_03_stump_fit",
    f"WITH {_STUMP_SQL} SELECT feature, threshold, left_class, right_class, round(gini, 9) AS gini FROM stump",
)
def stump_fit(spark, folder):
    return mo.fit_stump(labelled_documents(spark, folder), _DOC_FEATURES, "quality").withColumn("gini", F.round("gini", 9))


@query(
    "ml_04_stump_score",
    f"""WITH {_STUMP_SQL}, scored AS (SELECT quality, CASE WHEN (CASE f WHEN 0 THEN n_chars WHEN 1 THEN n_words ELSE n_digits END) <= threshold
        THEN left_class ELSE right_class END AS guess FROM df, stump)
    SELECT guess, count(*) AS n, round(avg(CASE WHEN guess = quality THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored GROUP BY 1""",
)
def stump_score(spark, folder):
    rows = labelled_documents(spark, folder)
    scored = rows.withColumn("guess", mo.stump_class(mo.fit_stump(rows, _DOC_FEATURES, "quality"), _DOC_FEATURES))
    hit = F.avg(F.when(F.col("guess") == F.col("quality"), 1.0).otherwise(0.0))
    return scored.groupBy("guess").agg(F.count("*").alias("n"), F.round(hit, 6).alias("accuracy"))


def _split(spark, folder):
    """Training and held-out rows."""
    rows = written(fe.shuffle_split(labelled_documents(spark, folder), "doc_id", 0.2, 42), "split")
    return rows.where("NOT in_test"), rows.where("in_test")


def _held_out(scored):
    """Confusion counts and rates of predictions for held-out rows."""
    return mo.confusion(scored, F.col("quality") == 1, F.col("prediction") == 1.0)


# Fitted weights, and what follows from them, are not SQL: these queries have no twin; tests hold them to limits on held-out rows.


@query("ml_05_logistic_regression")
def logistic_regression(spark, folder):
    train, test = _split(spark, folder)
    return _held_out(mo.fit_logistic(train, _DOC_FEATURES, "quality").transform(test))


@query("ml_05_row_descent")
def row_descent(spark, folder):
    """Weights per feature of row-order descent over standardised features, and the held-out accuracy."""
    train, test = _split(spark, folder)
    scaler = fe.fit_standard(train, _DOC_FEATURES)
    weights, bias = mo.descend_rows(fe.scale(train, scaler, _DOC_FEATURES), _DOC_FEATURES, "quality", "doc_id")
    scored = fe.scale(test, scaler, _DOC_FEATURES).withColumn("prediction", (mo.linear(_DOC_FEATURES, weights, bias) >= 0).cast("double"))
    rows = [("bias", bias), *zip(_DOC_FEATURES, weights, strict=True)]
    found = spark.createDataFrame(rows, "feature string, weight double")
    return found.withColumn("accuracy", mo.accuracy(scored, "quality", "prediction").scalar())


@query("ml_06_random_forest")
def random_forest(spark, folder):
    """Importance per feature, with the accuracy on held-out rows."""
    train, test = _split(spark, folder)
    model = mo.fit_forest(train, _DOC_FEATURES, "quality", trees=20, depth=5)
    return mo.importances(model, _DOC_FEATURES, train).withColumn("accuracy", _held_out(model.transform(test)).select("accuracy").scalar())


_WEIGHTS = [((i % 7) - 3) / 10 for i in range(64)]


@query(
    "ml_07_linear_batch",
    """SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]),
    list_transform(range(64), lambda i: ((i % 7) - 3) / 10::DOUBLE)) + 0.5, 8) AS score FROM embeddings WHERE len(embedding) = 64""",
)
def linear_batch(spark, folder):
    scored, _ = mo.linear_batch(table(spark, folder, "embeddings"), "embedding", _WEIGHTS, 0.5)
    return scored.select("vec_id", F.round("score", 8).alias("score"))


# weights of a fitted fraud model, in the order of the six features
_FRAUD_FEATURES = ["amount_normalized", "amount_log", "is_high_risk_category", "is_night_transaction", "is_weekend", "is_online_flag"]
_FRAUD_WEIGHTS = [1.2, 0.3, 0.8, 0.6, 0.1, 0.4]
_FRAUD_BIAS = -3.0
_FRAUD_SCORED_SQL = f"""{TRANSACTIONS_SQL}, {FRAUD_FEATURES_SQL},
  scored AS (SELECT transaction_id, is_fraud, round(1 / (1 + exp(-(-3.0::DOUBLE + {" + ".join(f"{w}::DOUBLE * {n}" for w, n in zip(_FRAUD_WEIGHTS, _FRAUD_FEATURES, strict=True))}))), 8) AS p FROM ff)"""


def _fraud_scored(spark, folder):
    rows = fe.fraud_features(transactions(table(spark, folder, "events"))).withColumn("is_fraud", fe.fraud_label())
    return rows.withColumn("p", F.round(fe.sigmoid(mo.linear(_FRAUD_FEATURES, _FRAUD_WEIGHTS, _FRAUD_BIAS)), 8))


@query(
    "ml_08_probability",
    f"""WITH {_FRAUD_SCORED_SQL}
    SELECT transaction_id, p AS probability, p >= 0.5 AS is_positive, round(abs(p - 0.5) * 2, 8) AS confidence FROM scored""",
)
def probability(spark, folder):
    found = _fraud_scored(spark, folder).select("transaction_id", *mo.verdict(F.col("p"), 0.5))
    return found.withColumn("confidence", F.round("confidence", 8))


@query(
    "ml_09_model_udf",
    f"WITH {_FRAUD_SCORED_SQL} SELECT transaction_id, p AS prediction FROM scored",
)
def model_udf(spark, folder):
    def load():
        weights = np.array(_FRAUD_WEIGHTS)
        return lambda rows: 1 / (1 + np.exp(-(rows.to_numpy(dtype=float) @ weights + _FRAUD_BIAS)))

    score = mo.model_udf(load)
    rows = fe.fraud_features(transactions(table(spark, folder, "events")))
    return rows.select("transaction_id", F.round(score(F.struct(*_FRAUD_FEATURES)), 8).alias("prediction"))


@query(
    "ml_10_accuracy",
    """SELECT round(sum(CASE WHEN CAST(n_chars > 1000 AS INTEGER) = quality THEN 1 ELSE 0 END) / count(*), 6) AS accuracy
    FROM labels JOIN documents USING (doc_id)""",
)
def accuracy(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("guess"))
    scored = table(spark, folder, "labels").join(documents, "doc_id")
    return mo.accuracy(scored, "quality", "guess").withColumn("accuracy", F.round("accuracy", 6))


@query(
    "ml_11_confusion",
    f"""WITH {_FRAUD_SCORED_SQL}, c AS (SELECT count(*) FILTER (p >= 0.2 AND is_fraud) AS tp, count(*) FILTER (p >= 0.2 AND NOT is_fraud) AS fp,
      count(*) FILTER (p < 0.2 AND NOT is_fraud) AS tn, count(*) FILTER (p < 0.2 AND is_fraud) AS fn FROM scored)
    SELECT tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
    (tp + tn) / (tp + fp + tn + fn) >= 0.8 AS passed FROM c""",
)
def confusion(spark, folder):
    found = mo.confusion(_fraud_scored(spark, folder), F.col("is_fraud"), F.col("p") >= 0.2, latency_ms=4.0)
    return found.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query(
    "ml_12_auc",
    f"""WITH {_FRAUD_SCORED_SQL}, levels AS (SELECT p, count(*) FILTER (is_fraud) AS pos, count(*) FILTER (NOT is_fraud) AS neg FROM scored GROUP BY 1),
    r AS (SELECT *, sum(neg) OVER (ORDER BY p) - neg AS below FROM levels)
    SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM r""",
)
def auc(spark, folder):
    rows = _fraud_scored(spark, folder).withColumn("y", F.col("is_fraud").cast("int"))
    return mo.auc(rows, "y", "p").withColumn("auc", F.round("auc", 6))


@query("ml_13_run_log", f"WITH {RUN_RECORDS_SQL} SELECT run_id, kind, key, step, logged_at, value, text FROM records")
def run_log(spark, folder):
    """Metrics, parameters and tags of runs, appended to one log."""
    records = run_records(table(spark, folder, "events"))
    stored = SnapshotTable(spark, scratch(spark, "runs"))
    stored.overwrite(records.where("kind = 'param'"), "log")
    stored.append(records.where("kind = 'tag'"))
    stored.append(records.where("kind = 'metric'"))
    return stored.read()


_LATEST_SQL = f"{RUN_METRICS_SQL}, latest AS (SELECT run_id, key, arg_max(value, step) AS value FROM runs GROUP BY 1, 2)"


@query(
    "ml_14_run_search",
    f"""WITH {RUN_RECORDS_SQL}, latest AS (SELECT run_id, key, arg_max(value, step) AS value FROM records WHERE kind = 'metric' GROUP BY 1, 2),
    chosen AS (SELECT DISTINCT run_id FROM records WHERE kind = 'tag' AND key = 'experiment' AND text = 'exp-1'),
    wide AS (SELECT run_id, max(value) FILTER (key = 'purchase') AS purchase, max(value) FILTER (key = 'signup') AS signup,
    max(value) FILTER (key = 'click') AS click FROM latest JOIN chosen USING (run_id) GROUP BY 1) SELECT * FROM wide WHERE click > 5 ORDER BY purchase DESC, run_id""",
)
def run_search(spark, folder):
    records = run_records(table(spark, folder, "events"))
    return ru.search_runs(ru.of_experiment(records, "exp-1"), ["purchase", "signup", "click"], "click > 5", "purchase")


@query(
    "ml_15_best_run",
    f"WITH {_LATEST_SQL} SELECT run_id, value FROM latest WHERE key = 'purchase' ORDER BY value DESC, run_id LIMIT 1",
)
def best_run(spark, folder):
    return ru.best_run(run_metrics(table(spark, folder, "events")), "purchase")


@query(
    "ml_16_model_versions",
    """WITH v AS (SELECT 'model-' || (user_id % 5) AS name, value, row_number() OVER (PARTITION BY user_id % 5 ORDER BY ts, event_id) AS version
    FROM events WHERE event_type = 'signup')
    SELECT name, 'latest' AS alias, max(version) AS version FROM v GROUP BY 1
    UNION ALL SELECT name, 'champion', arg_min(version, (-value, version)) FROM v GROUP BY 1""",
)
def model_versions(spark, folder):
    registered = (
        table(spark, folder, "events")
        .where("event_type = 'signup'")
        .select("event_id", "ts", "value", F.concat(F.lit("model-"), F.pmod("user_id", F.lit(5)).cast("string")).alias("name"))
    )
    return ru.resolve_aliases(ru.model_versions(registered, "name", ["ts", "event_id"]), "name", "value")


@query(
    "ml_17_model_card",
    f"""WITH {RUN_RECORDS_SQL}, latest AS (SELECT run_id, key, arg_max(value, step) AS value FROM records WHERE kind = 'metric' GROUP BY 1, 2),
    m AS (SELECT run_id, '{{' || string_agg('"' || key || '":' || value, ',' ORDER BY key) || '}}' AS metrics FROM latest GROUP BY 1),
    p AS (SELECT run_id, '{{' || string_agg('"' || key || '":"' || text || '"', ',' ORDER BY key) || '}}' AS params FROM records WHERE kind = 'param' GROUP BY 1),
    n AS (SELECT run_id, text AS name, row_number() OVER (PARTITION BY text ORDER BY step, run_id) AS version FROM records WHERE kind = 'tag' AND key = 'model')
    SELECT name, version, run_id, metrics, params FROM n JOIN m USING (run_id) JOIN p USING (run_id)""",
)
def model_card(spark, folder):
    return ru.model_cards(run_records(table(spark, folder, "events")))


@query("doc_07_boosted_trees")
def boosted_trees(spark, folder):
    """Gradient boosted trees picked by cross-validation over the tree depth, evaluated on held-out rows."""
    train, test = _split(spark, folder)
    model = mo.fit_boosted(train, _DOC_FEATURES, "quality", depths=[2, 3], folds=2)
    return _held_out(model.transform(test)).withColumn("best_cv_auc", F.lit(float(max(model.avgMetrics))))
