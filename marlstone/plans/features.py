"""Feature engineering jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import features as fe
from marlstone.plans.registry import query, table

_SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "feat_01_standard_scaler",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM lineitem)) / greatest((SELECT stddev_pop({c}) FROM lineitem), 1e-10), 6) AS {c}"
        for c in _SCALED
    )
    + " FROM lineitem",
)
def standard_scaler(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *_SCALED)
    return _rounded(fe.scale(lines, fe.fit_standard(lines, _SCALED), _SCALED), _SCALED)


@query(
    "feat_02_inverse_scaling",
    f"SELECT l_orderkey, l_linenumber, {', '.join(f'round({c}, 4) AS {c}' for c in _SCALED)} FROM lineitem",
)
def inverse_scaling(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *_SCALED)
    fitted = fe.fit_standard(lines, _SCALED)
    return _rounded(fe.unscale(fe.scale(lines, fitted, _SCALED), fitted, _SCALED), _SCALED, 4)


@query(
    "feat_03_zscore_sample",
    """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
    / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS amount_zscore FROM orders""",
)
def zscore_sample(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", F.round(fe.zscore(orders, "o_totalprice"), 6).alias("amount_zscore"))


@query(
    "feat_04_zscore_strict",
    """SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer))
    / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS balance_zscore FROM customer""",
)
def zscore_strict(spark, folder):
    customers = table(spark, folder, "customer")
    return customers.select("c_custkey", F.round(fe.zscore_or_fail(customers, "c_acctbal"), 6).alias("balance_zscore"))


@query(
    "feat_05_minmax",
    """SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders))
    / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders), 6) AS amount_scaled FROM orders""",
)
def minmax(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", F.round(fe.minmax(orders, "o_totalprice"), 6).alias("amount_scaled"))


@query(
    "feat_06_equal_width_bins",
    """WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
    SELECT o_orderkey, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS amount_bin FROM orders, r""",
)
def equal_width_bins(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", fe.equal_width_bin(orders, "o_totalprice", 10).alias("amount_bin"))


@query(
    "feat_07_label_encoding",
    """SELECT p_partkey, p_brand, c.code, c.p_brand AS decoded
    FROM part JOIN (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code
                    FROM (SELECT DISTINCT p_brand FROM part)) c USING (p_brand)""",
)
def label_encoding(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    classes = fe.fit_classes(parts, "p_brand")
    return fe.decode(fe.encode(parts, classes, "p_brand", "code"), classes, "code", "decoded")


_PRIORITY_FLAGS = {"is_urgent": "1-URGENT", "is_high": "2-HIGH", "is_medium": "3-MEDIUM", "is_unspecified": "4-NOT SPECIFIED", "is_low": "5-LOW"}


@query(
    "feat_08_one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderpriority = '{v}' AS INTEGER) AS {n}" for n, v in _PRIORITY_FLAGS.items())
    + " FROM orders",
)
def one_hot(spark, folder):
    return fe.one_hot(table(spark, folder, "orders"), "o_orderpriority", _PRIORITY_FLAGS).select("o_orderkey", *_PRIORITY_FLAGS)


def transactions(events):
    """Events read as card transactions."""
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("value").alias("amount"),
        F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(20)).alias("merchant_category"),
        F.hour("ts").alias("hour_of_day"),
        F.weekday("ts").alias("day_of_week"),
        F.col("event_type").isin("click", "view").alias("is_online"),
    )


TRANSACTIONS_SQL = """tx AS (SELECT event_id AS transaction_id, value AS amount,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 20 AS merchant_category, hour(ts) AS hour_of_day,
    isodow(ts) - 1 AS day_of_week, event_type IN ('click', 'view') AS is_online FROM events)"""

FRAUD_FEATURES_SQL = """ff AS (SELECT *, (amount - (SELECT avg(amount) FROM tx)) / greatest((SELECT stddev_pop(amount) FROM tx), 1.0)
      AS amount_normalized, ln(amount + 1) AS amount_log,
    CAST(merchant_category IN (5, 12, 18) AS DOUBLE) AS is_high_risk_category,
    CAST(hour_of_day < 6 OR hour_of_day > 22 AS DOUBLE) AS is_night_transaction,
    CAST(day_of_week >= 5 AS DOUBLE) AS is_weekend, CAST(is_online AS DOUBLE) AS is_online_flag,
    (amount > 400 AND is_online) OR (hour_of_day < 6 AND amount > 200) OR (merchant_category = 5 AND amount > 300) AS is_fraud
    FROM tx)"""


@query(
    "feat_09_fraud_features",
    f"""WITH {TRANSACTIONS_SQL}, {FRAUD_FEATURES_SQL}
    SELECT transaction_id, round(amount_normalized, 6) AS amount_normalized, round(amount_log, 6) AS amount_log,
    is_high_risk_category, is_night_transaction, is_weekend, is_online_flag FROM ff""",
)
def fraud_features(spark, folder):
    found = fe.fraud_features(transactions(table(spark, folder, "events")))
    return _rounded(found, ["amount_normalized", "amount_log"]).select(
        "transaction_id",
        "amount_normalized",
        "amount_log",
        "is_high_risk_category",
        "is_night_transaction",
        "is_weekend",
        "is_online_flag",
    )


_TRANSFORMS = [
    fe.Transform("f_zscore", "zscore"),
    fe.Transform("f_minmax", "minmax"),
    fe.Transform("f_log", "log"),
    fe.Transform("f_rolling", "rolling_mean", 4),
    fe.Transform("f_bin", "bin", 8),
    fe.Transform("f_relu", "relu"),
    fe.Transform("f_sigmoid", "sigmoid"),
]
_PIPELINE_SQL = """r AS (SELECT avg(value) AS m, stddev_pop(value) AS s, min(value) AS lo, max(value) AS hi FROM events),
  piped AS (SELECT event_id, (value - m) / s AS f_zscore, (value - lo) / (hi - lo) AS f_minmax, ln(value + 1e-8) AS f_log,
    CASE WHEN count(*) OVER w = 4 THEN avg(value) OVER w END AS f_rolling,
    CAST(least(floor((value - lo) / ((hi - lo) / 8)), 7) AS DOUBLE) AS f_bin, greatest(value, 0) AS f_relu,
    1 / (1 + exp(-value)) AS f_sigmoid FROM events, r
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""
_FEATURES = [t.name for t in _TRANSFORMS]


def _piped(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return fe.apply_transforms(events, "value", _TRANSFORMS, ["user_id"], ["ts", "event_id"])


@query(
    "feat_10_transform_pipeline",
    f"WITH {_PIPELINE_SQL} SELECT event_id, {', '.join(f'round({n}, 6) AS {n}' for n in _FEATURES)} FROM piped",
)
def transform_pipeline(spark, folder):
    return _rounded(_piped(spark, folder), _FEATURES).select("event_id", *_FEATURES)


@query(
    "feat_10_transform_statistics",
    f"WITH {_PIPELINE_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS feature, round(avg({n}), 6) AS mean, round(stddev_pop({n}), 6) AS stddev, round(min({n}), 6) AS smallest,
        round(max({n}), 6) AS largest, count(*) FILTER ({n} IS NULL) AS n_missing FROM piped"""
        for n in _FEATURES
    ),
)
def transform_statistics(spark, folder):
    return _rounded(fe.feature_statistics(_piped(spark, folder), _FEATURES), ["mean", "stddev", "smallest", "largest"])


@query(
    "feat_11_head_tail_split",
    """SELECT doc_id, quality, row_number() OVER (ORDER BY doc_id) <= floor(0.8 * (SELECT count(*) FROM labels)) AS in_head FROM labels""",
)
def head_tail_split(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return fe.head_tail_split(labels, ["doc_id"], 0.8)


@query(
    "feat_12_shuffle_split",
    """SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) <= round((SELECT count(*) FROM labels) * 0.2) AS in_test FROM labels""",
)
def shuffle_split(spark, folder):
    return fe.shuffle_split(table(spark, folder, "labels").select("doc_id"), "doc_id", 0.2, seed=42)


@query(
    "feat_13_rule_label",
    f"WITH {TRANSACTIONS_SQL}, {FRAUD_FEATURES_SQL} SELECT transaction_id, is_fraud FROM ff",
)
def rule_label(spark, folder):
    return transactions(table(spark, folder, "events")).select("transaction_id", fe.fraud_label().alias("is_fraud"))
