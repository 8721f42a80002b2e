"""Projections, predicates, sorting, set operations, joins, aggregates, windows and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.functions import vectors as vx
from marlstone.operators import blocks, ordered, relational as rel, sketches, vectors
from marlstone.plans.registry import query, table
from marlstone.sources.logs import REQUEST_LOG_SQL, RUN_METRICS_SQL, request_log, run_metrics
from marlstone.workspace import written

# --- projections, predicates, sorting, set operations ---------------------------------


@query("rel_01_projection", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def projection(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "rel_02_derived_columns",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue,
    round(l_extendedprice * 0.9, 4) AS discounted_price, lower(l_returnflag) AS flag FROM lineitem""",
)
def derived_columns(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue"),
        F.round(F.col("l_extendedprice") * 0.9, 4).alias("discounted_price"),
        F.lower("l_returnflag").alias("flag"),
    )


@query("rel_03_comparison_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def comparison_filter(spark, folder):
    return table(spark, folder, "orders").filter(F.col("o_totalprice") > 250000).select("o_orderkey", "o_totalprice")


@query(
    "rel_04_conjunctive_filter",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000",
)
def conjunctive_filter(spark, folder):
    return (
        table(spark, folder, "customer")
        .filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 1000))
        .select("c_custkey", "c_name", "c_acctbal")
    )


@query(
    "rel_05_between",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000
    AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'""",
)
def between(spark, folder):
    return (
        table(spark, folder, "orders")
        .where(
            "o_totalprice BETWEEN 100000 AND 200000 AND "
            "o_orderdate BETWEEN TIMESTAMP_NTZ '1996-01-01' AND TIMESTAMP_NTZ '1997-12-31'"
        )
        .select("o_orderkey", "o_orderdate")
    )


@query(
    "rel_06_parameters",
    """SELECT 'All' AS priority, o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-06-01' GROUP BY 2
    UNION ALL SELECT '2-HIGH', o_orderstatus, count(*) FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-06-01' AND o_orderpriority = '2-HIGH' GROUP BY 2""",
)
def parameters(spark, folder):
    orders = table(spark, folder, "orders")

    def report(choice):
        rows = rel.since_and_category(orders, "o_orderdate", "1996-06-01", "o_orderpriority", choice)
        return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n")).select(F.lit(choice).alias("priority"), "o_orderstatus", "n")

    return report("All").unionByName(report("2-HIGH"))


@query(
    "rel_07_etl_transform",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CAST(year(o_orderdate) AS INTEGER) AS order_year,
    round(o_totalprice * 1.1, 4) AS gross FROM orders WHERE o_orderstatus = 'F'""",
)
def etl_transform(spark, folder):
    return (
        table(spark, folder, "orders")
        .withColumns({"order_day": F.to_date("o_orderdate"), "order_year": F.year("o_orderdate")})
        .filter(F.col("o_orderstatus") == "F")
        .withColumn("gross", F.round(F.col("o_totalprice") * 1.1, 4))
        .select("o_orderkey", "order_day", "order_year", "gross")
    )


@query(
    "rel_08_order_by",
    "SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 4) AS mean_balance FROM customer GROUP BY 1 ORDER BY 2 DESC, 1",
)
def order_by(spark, folder):
    return (
        table(spark, folder, "customer")
        .groupBy("c_nationkey")
        .agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance"))
        .orderBy(F.desc("n"), "c_nationkey")
    )


@query(
    "rel_09_top_k",
    """SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
)
def top_k(spark, folder):
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(revenue.alias("revenue"))
        .orderBy(F.desc("revenue"), "l_partkey")
        .limit(5)
    )


@query(
    "rel_10_union_all",
    "SELECT c_nationkey AS nation_key, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def union_all(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation_key"))
    return customers.unionByName(suppliers)


@query("rel_11_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(spark, folder):
    return table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority").distinct()


_PART_OF_DAY_SQL = """CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
    WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END"""


@query("rel_12_part_of_day", f"SELECT {_PART_OF_DAY_SQL} AS part_of_day, count(*) AS n FROM events GROUP BY 1")
def part_of_day(spark, folder):
    bucket = rel.part_of_day(F.hour("ts"))
    return table(spark, folder, "events").groupBy(bucket.alias("part_of_day")).agg(F.count("*").alias("n"))


# --- joins ----------------------------------------------------------------------------
# Small sides are broadcast when Spark sees that they are small; larger ones shuffle, and adaptive
# execution splits skewed partitions. Facts are aggregated before the join where the result allows it.


@query(
    "join_01_inner_two_names",
    "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def inner_two_names(spark, folder):
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey, "inner").select("c_custkey", "c_name", "n_name")


@query(
    "join_02_inner_using",
    """SELECT l_orderkey AS order_key, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity, min(o_orderdate) AS o_orderdate
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
)
def inner_using(spark, folder):
    lines = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_key"))
        .agg(F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderdate")
    return lines.join(orders, "order_key", "inner")


@query(
    "join_03_left_outer",
    """SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def left_outer(spark, folder):
    """Labels cover a part of the documents."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return table(spark, folder, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")


@query(
    "join_04_right_and_full",
    """SELECT 'right' AS kind, doc_id, item_id, l.quality FROM labels l RIGHT JOIN (SELECT doc_id, doc_id % 7 AS item_id FROM documents) d USING (doc_id)
    UNION ALL SELECT 'full', coalesce(l.doc_id, b.item_id), b.item_id, l.quality FROM labels l FULL JOIN benchmark b ON l.doc_id = b.item_id""",
)
def right_and_full(spark, folder):
    """Labels cover a part of the documents, and neither labels nor benchmark items cover the other's ids."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    documents = table(spark, folder, "documents").select("doc_id", F.pmod("doc_id", F.lit(7)).alias("item_id"))
    columns = ["kind", "doc_id", "item_id", "quality"]
    right = labels.join(documents, "doc_id", "right").withColumn("kind", F.lit("right")).select(*columns)
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"), "item_id")
    return right.unionByName(labels.join(items, "doc_id", "full").withColumn("kind", F.lit("full")).select(*columns))


@query(
    "join_05_join_aggregate",
    """SELECT n_name, c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2 ORDER BY 1, 2""",
)
def join_aggregate(spark, folder):
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("spent"))
    )
    return (
        per_customer.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "c_mktsegment")
        .agg(F.sum("n").alias("n_orders"), F.round(F.sum("spent"), 2).alias("revenue"))
        .orderBy("n_name", "c_mktsegment")
    )


@query(
    "join_06_self_join",
    """SELECT n.n_name, r.customers, round(r.balance, 2) AS balance, e.customers AS elite
    FROM (SELECT c_nationkey, count(*) AS customers, sum(c_acctbal) AS balance FROM customer GROUP BY 1) r
    JOIN (SELECT c_nationkey, count(*) AS customers FROM customer WHERE c_acctbal > 5000 GROUP BY 1) e USING (c_nationkey)
    JOIN nation n ON n.n_nationkey = c_nationkey WHERE e.customers * 2 > r.customers""",
)
def self_join(spark, folder):
    customers = table(spark, folder, "customer")
    current = customers.groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.sum("c_acctbal").alias("balance"))
    elite = customers.where("c_acctbal > 5000").groupBy("c_nationkey").agg(F.count("*").alias("elite"))
    return (
        current.alias("curr")
        .join(elite.alias("prev"), "c_nationkey")
        .where("elite * 2 > customers")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "customers", F.round("balance", 2).alias("balance"), "elite")
    )


@query(
    "join_07_feature_lookup",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def feature_lookup(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return rel.lookup(documents, table(spark, folder, "labels"), "doc_id", ["quality", "toxic"])


@query(
    "join_08_as_of",
    """SELECT e.event_id, e.user_id, e.ts, p.ts AS purchase_ts, p.value AS purchase_value
    FROM (SELECT * FROM events WHERE event_type = 'error') e
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON p.user_id = e.user_id AND p.ts <= e.ts""",
)
def as_of(spark, folder):
    events = table(spark, folder, "events")
    labels = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    features = events.where("event_type = 'purchase'").select(
        "event_id", "user_id", "ts", F.col("ts").alias("purchase_ts"), F.col("value").alias("purchase_value")
    )
    return rel.as_of(labels, features, ["user_id"], "ts", "event_id", ["purchase_ts", "purchase_value"])


CENTROIDS_SQL = """slots AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
    FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) GROUP BY 1, 2),
  centroids AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM slots GROUP BY 1)"""


@query(
    "join_10_query_corpus",
    f"""WITH {CENTROIDS_SQL},
    scored AS (SELECT query_id, vec_id, round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 8) AS s
               FROM centroids CROSS JOIN embeddings)
    SELECT query_id, count(*) AS n_scored, round(avg(s), 6) AS mean_score, max(s) AS best_score,
           arg_min(vec_id, (-s, vec_id)) AS vec_id FROM scored GROUP BY 1""",
)
def query_corpus(spark, folder):
    embeddings = table(spark, folder, "embeddings")
    found = blocks.score_summary(
        embeddings.select("vec_id", "embedding"),
        ["vec_id"],
        vectors.centroids(embeddings, "label", "embedding"),
        "query_id",
        vectors.vector_scorer("cosine"),
    )
    return found.withColumn("mean_score", F.round("mean_score", 6))


# --- aggregates -----------------------------------------------------------------------


@query(
    "agg_01_one_key",
    """SELECT o_orderstatus, round(avg(o_totalprice), 4) AS mean_price, count(*) AS n,
    max(o_totalprice) AS dearest, min(o_totalprice) AS cheapest FROM orders GROUP BY 1""",
)
def one_key(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy("o_orderstatus")
        .agg(
            F.round(F.avg("o_totalprice"), 4).alias("mean_price"),
            F.count("*").alias("n"),
            F.max("o_totalprice").alias("dearest"),
            F.min("o_totalprice").alias("cheapest"),
        )
    )


@query(
    "agg_02_two_keys",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1, 2""",
)
def two_keys(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@query(
    "agg_03_revenue_by_category",
    """SELECT p_brand, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue, round(avg(l_extendedprice), 2) AS mean_revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 3 DESC, 1""",
)
def revenue_by_category(spark, folder):
    per_part = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("revenue"))
    )
    return (
        per_part.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(
            F.sum("n").alias("n"),
            F.round(F.sum("revenue"), 2).alias("revenue"),
            F.round(F.sum("revenue") / F.sum("n"), 2).alias("mean_revenue"),
        )
        .orderBy(F.desc("revenue"), "p_brand")
    )


@query(
    "agg_04_hourly",
    "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, round(sum(value), 2) AS revenue FROM events GROUP BY 1 ORDER BY 1",
)
def hourly(spark, folder):
    return (
        table(spark, folder, "events")
        .groupBy(F.hour("ts").alias("hour"))
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("revenue"))
        .orderBy("hour")
    )


@query(
    "agg_05_sum_of_expression",
    "SELECT l_returnflag, round(sum(l_extendedprice * l_quantity), 2) AS revenue FROM lineitem GROUP BY 1",
)
def sum_of_expression(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_quantity")), 2).alias("revenue"))
    )


@query(
    "agg_06_group_maximum",
    """SELECT p_brand, max(p_retailprice) AS top_price, arg_min(p_name, (-p_retailprice, p_partkey)) AS top_name
    FROM part GROUP BY 1""",
)
def group_maximum(spark, folder):
    dearest_first = F.struct(-F.col("p_retailprice"), F.col("p_partkey"))
    return (
        table(spark, folder, "part")
        .groupBy("p_brand")
        .agg(F.max("p_retailprice").alias("top_price"), F.min_by("p_name", dearest_first).alias("top_name"))
    )


@query(
    "agg_07_global_statistics",
    """SELECT round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS stddev,
    min(o_totalprice) AS smallest, max(o_totalprice) AS largest FROM orders""",
)
def global_statistics(spark, folder):
    return table(spark, folder, "orders").agg(
        F.round(F.avg("o_totalprice"), 4).alias("mean"),
        F.round(F.stddev_samp("o_totalprice"), 4).alias("stddev"),
        F.min("o_totalprice").alias("smallest"),
        F.max("o_totalprice").alias("largest"),
    )


@query("agg_08_approximate_p99", "SELECT event_type, count(*) AS n, true AS within, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1")
def approximate_p99(spark, folder):
    """Whether the approximate percentile lies within its stated error (0.0001 of the rows) of the exact rank, and the value at that rank."""
    return sketches.settled(table(spark, folder, "events"), "event_type", "value", 99).select("event_type", "n", "within", "p99")


@query("agg_09_weekly_p99")
def weekly_p99(spark, folder):
    """p50 and p99 of each week and endpoint out of the stored sketches of its days."""
    log = request_log(table(spark, folder, "events"))
    daily = written(sketches.daily(log, "ts", ["endpoint"], "latency_ms"), "daily")
    return sketches.merged(daily, "week", ["endpoint"], {"p50": 0.5, "p99": 0.99})


@query(
    "agg_08_exact_p99",
    "SELECT event_type, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1",
)
def exact_p99(spark, folder):
    found = ordered.quantiles(table(spark, folder, "events"), ["event_type"], "value", {"p99": 0.99})
    return found.withColumn("p99", F.round("p99", 6))


@query(
    "agg_09_latency_percentiles",
    """SELECT round(avg(value), 4) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99
    FROM events""",
)
def latency_percentiles(spark, folder):
    events = table(spark, folder, "events")
    found = ordered.quantiles(events, [], "value", {"p50": 0.5, "p99": 0.99})
    mean = events.agg(F.avg("value")).scalar()
    return found.select(F.round(mean, 4).alias("mean"), F.round("p50", 6).alias("p50"), F.round("p99", 6).alias("p99"))


@query(
    "agg_10_recent_service_summary",
    f"""WITH {REQUEST_LOG_SQL}
    SELECT endpoint, count(*) AS n_requests, round(avg(latency_ms), 4) AS mean_latency,
    CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS tokens,
    round(sum(CASE WHEN status = 'Success' THEN 1 ELSE 0 END) * 100.0 / count(*), 4) AS success_percent
    FROM log WHERE ts > (SELECT max(ts) FROM log) - INTERVAL 1 HOUR GROUP BY 1""",
)
def recent_service_summary(spark, folder):
    log = request_log(table(spark, folder, "events"))
    now = log.agg(F.max("ts")).scalar()
    return rel.service_summary(rel.within_last(log, "ts", now, "1 HOUR"))


@query(
    "agg_11_daily_cost",
    f"""WITH {REQUEST_LOG_SQL}
    SELECT endpoint, CAST(ts AS DATE) AS day, CAST(sum(prompt_tokens) AS BIGINT) AS input_tokens,
    CAST(sum(completion_tokens) AS BIGINT) AS output_tokens,
    round(sum(prompt_tokens) * 0.00001::DOUBLE + sum(completion_tokens) * 0.00003::DOUBLE, 6) AS cost
    FROM log WHERE status = 'Success' GROUP BY 1, 2""",
)
def daily_cost(spark, folder):
    return rel.daily_cost(request_log(table(spark, folder, "events")))


@query(
    "agg_12_log_summary",
    f"""WITH {REQUEST_LOG_SQL}
    SELECT round(coalesce(avg(CASE WHEN status = 'Success' THEN 1.0 ELSE 0.0 END), 0), 6) AS success_rate,
    round(coalesce(avg(latency_ms), 0), 4) AS mean_latency,
    CAST(coalesce(sum(prompt_tokens + completion_tokens), 0) AS BIGINT) AS tokens, count(*) AS n FROM log""",
)
def log_summary(spark, folder):
    return rel.log_summary(request_log(table(spark, folder, "events")))


@query(
    "agg_13_service_metrics",
    f"""WITH {REQUEST_LOG_SQL}
    SELECT endpoint, count(*) AS total_requests, count(*) FILTER (status = 'Success') AS successful,
    count(*) FILTER (status <> 'Success') AS failed, count(*) FILTER (status = 'Filtered') AS violations,
    round(avg(latency_ms), 4) AS mean_latency, max(latency_ms) AS max_latency_ms,
    round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms,
    round(count(*) FILTER (status = 'Success') / count(*), 6) AS success_rate FROM log GROUP BY 1""",
)
def service_metrics(spark, folder):
    return rel.service_metrics(request_log(table(spark, folder, "events")), "endpoint")


@query(
    "agg_14_class_balance",
    """SELECT quality, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labels), 4) AS percent FROM labels GROUP BY 1""",
)
def class_balance(spark, folder):
    labels = table(spark, folder, "labels")
    total = labels.agg(F.count("*")).scalar()
    return labels.groupBy("quality").agg(F.count("*").alias("n")).withColumn("percent", F.round(F.col("n") * 100.0 / total, 4))


@query(
    "agg_15_feature_statistics",
    """WITH v AS (SELECT event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS x FROM events)
    SELECT event_type, round(coalesce(avg(x), 0), 6) AS mean, round(coalesce(stddev_pop(x), 0), 6) AS stddev,
    coalesce(min(x), 0) AS smallest, coalesce(max(x), 0) AS largest, count(*) FILTER (x IS NULL) AS n_missing
    FROM v GROUP BY 1""",
)
def feature_statistics(spark, folder):
    # every seventh value is made a NaN, every fourteenth a NULL
    holes = F.when(F.col("event_id") % 14 == 0, F.lit(None)).when(F.col("event_id") % 7 == 0, F.lit("NaN").cast("double"))
    events = table(spark, folder, "events").withColumn(
        "x", F.when(F.col("event_id") % 7 == 0, holes).otherwise(F.col("value"))
    )
    found = events.groupBy("event_type").agg(*rel.statistics("x"))
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "agg_16_run_aggregates",
    f"""WITH {RUN_METRICS_SQL}
    SELECT run_id, arg_max(value, step) AS latest_loss, round(avg(value), 6) AS mean_loss, min(value) AS min_loss
    FROM runs GROUP BY 1""",
)
def run_aggregates(spark, folder):
    return (
        run_metrics(table(spark, folder, "events"))
        .groupBy("run_id")
        .agg(
            F.max_by("value", "step").alias("latest_loss"),
            F.round(F.avg("value"), 6).alias("mean_loss"),
            F.min("value").alias("min_loss"),
        )
    )


@query("agg_17_status_breakdown", f"WITH {REQUEST_LOG_SQL} SELECT status, count(*) AS n FROM log GROUP BY 1")
def status_breakdown(spark, folder):
    return request_log(table(spark, folder, "events")).groupBy("status").agg(F.count("*").alias("n"))


# --- windows --------------------------------------------------------------------------


@query(
    "win_01_decile",
    """SELECT o_orderkey, CAST(ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS amount_bin FROM orders""",
)
def decile(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordered.ntile(orders, 10, ["o_totalprice", "o_orderkey"], "amount_bin").select("o_orderkey", "amount_bin")


@query(
    "win_02_rolling_mean",
    """SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_mean FROM events""",
)
def rolling_mean(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    found = ordered.rolling(events, ["user_id"], ["ts", "event_id"], 7, {"rolling_mean": lambda w: F.avg("value").over(w)})
    return found.select("event_id", "user_id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "win_03_rolling_mean_full",
    """SELECT event_id, user_id, CASE WHEN count(*) OVER w = 5 THEN round(avg(value) OVER w, 6) END AS rolling_mean FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_full(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    found = ordered.rolling(events, ["user_id"], ["ts", "event_id"], 5, {"rolling_mean": rel.full_frame_mean("value", 5)})
    return found.select("event_id", "user_id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "win_04_cumulative_sum",
    """SELECT day, round(revenue, 2) AS revenue, round(sum(revenue) OVER (ORDER BY day), 2) AS cumulative
    FROM (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS revenue FROM orders GROUP BY 1)""",
)
def cumulative_sum(spark, folder):
    daily = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("revenue"))
    found = ordered.running_totals(daily, [], ["day"], {"cumulative": F.col("revenue")})
    return found.select("day", F.round("revenue", 2).alias("revenue"), F.round("cumulative", 2).alias("cumulative"))


@query(
    "win_05_result_rank",
    f"""WITH {CENTROIDS_SQL}
    SELECT query_id, vec_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank
    FROM (SELECT query_id, vec_id, round(list_dot_product(q, CAST(embedding AS DOUBLE[])), 8) AS s
          FROM centroids CROSS JOIN embeddings)
    QUALIFY rank <= 10""",
)
def result_rank(spark, folder):
    embeddings = table(spark, folder, "embeddings")
    found = blocks.top_k(
        embeddings.select("vec_id", "embedding"),
        ["vec_id"],
        vectors.centroids(embeddings, "label", "embedding"),
        "query_id",
        vectors.vector_scorer("dot"),
        10,
    )
    return found.select("query_id", "vec_id", "rank")


_DAILY_SQL = """daily AS (SELECT event_type AS metric, CAST(ts AS DATE) AS day, round(avg(value), 6) AS value FROM events GROUP BY 1, 2)"""


def _daily(spark, folder):
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("metric"), F.to_date("ts").alias("day"))
        .agg(F.round(F.avg("value"), 6).alias("value"))
    )


@query(
    "win_06_trend",
    f"""WITH {_DAILY_SQL},
    five AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY day DESC) AS r FROM daily QUALIFY r <= 5),
    ends AS (SELECT metric, count(*) AS n, arg_min(value, day) AS a, arg_max(value, day) AS b FROM five GROUP BY 1)
    SELECT metric, round((b - a) / greatest(abs(a), 0.001), 6) AS change,
    CASE WHEN n < 2 THEN 'stable' WHEN (b - a) / greatest(abs(a), 0.001) > 0.05 THEN 'improving'
    WHEN (b - a) / greatest(abs(a), 0.001) < -0.05 THEN 'degrading' ELSE 'stable' END AS trend FROM ends""",
)
def trend(spark, folder):
    return rel.trend(_daily(spark, folder), "metric", "day", "value").withColumn("change", F.round("change", 6))


@query(
    "win_07_latest_and_mean",
    f"""WITH {_DAILY_SQL}
    SELECT metric, arg_max(value, day) AS latest, round(avg(value), 5) AS mean FROM daily GROUP BY 1""",
)
def latest_and_mean(spark, folder):
    return _daily(spark, folder).groupBy("metric").agg(
        F.max_by("value", "day").alias("latest"), F.round(F.avg("value"), 5).alias("mean")
    )


# --- scalar, date, math and array expressions -----------------------------------------


@query(
    "fn_01_strings",
    """SELECT doc_id, upper(lang) AS lang, source || '/' || lang AS label, substring(text, 1, 50) || '...' AS preview FROM documents""",
)
def strings(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        F.upper("lang").alias("lang"),
        F.concat("source", F.lit("/"), "lang").alias("label"),
        tx.preview(F.col("text"), 50).alias("preview"),
    )


@query(
    "fn_02_arithmetic",
    """SELECT o_orderkey, round(o_totalprice * 1.1, 4) AS gross, round(o_totalprice / 7, 3) AS weekly, -o_totalprice AS negated,
    o_orderkey % 12 AS remainder FROM orders""",
)
def arithmetic(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.round(price * 1.1, 4).alias("gross"),
        F.round(price / 7, 3).alias("weekly"),
        (-price).alias("negated"),
        (F.col("o_orderkey") % 12).alias("remainder"),
    )


@query(
    "fn_03_dates",
    """SELECT event_id, ts AS parsed, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events""",
)
def dates(spark, folder):
    printed = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return (
        table(spark, folder, "events")
        .withColumn("parsed", F.to_timestamp_ntz(printed, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))
        .select("event_id", "parsed", F.to_date("parsed").alias("day"), F.hour("parsed").alias("hour"))
    )


@query(
    "fn_04_recent_rows",
    "SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY",
)
def recent_rows(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return rel.within_last(events, "ts", events.agg(F.max("ts")).scalar(), "1 DAY")


@query(
    "fn_05_log_transforms",
    """SELECT o_orderkey, round(ln(o_totalprice + 1e-8), 8) AS log_shifted, round(ln(o_totalprice + 1), 8) AS log_plus_one FROM orders""",
)
def log_transforms(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.round(F.log(F.col("o_totalprice") + 1e-8), 8).alias("log_shifted"),
        F.round(F.log1p("o_totalprice"), 8).alias("log_plus_one"),
    )


@query(
    "fn_06_activations",
    """SELECT c_custkey, greatest(c_acctbal, 0) AS relu, round(1 / (1 + exp(-c_acctbal / 1000)), 8) AS sigmoid FROM customer""",
)
def activations(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        rel.relu(F.col("c_acctbal")).alias("relu"),
        F.round(rel.sigmoid(F.col("c_acctbal") / 1000), 8).alias("sigmoid"),
    )


@query(
    "fn_07_vector_norms",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v)
    SELECT vec_id, round(list_dot_product(e, list_reverse(e)), 8) AS mirrored_dot, round(l, 8) AS l2_norm,
    round(e[1] / l, 8) AS first_unit, round(e[len(e)] / l, 8) AS last_unit FROM n""",
)
def vector_norms(spark, folder):
    e = F.col("embedding")
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.round(vx.dot(e, F.reverse(e)), 8).alias("mirrored_dot"),
        F.round(vx.norm(e), 8).alias("l2_norm"),
        F.round(F.element_at(vx.unit(e), 1), 8).alias("first_unit"),
        F.round(F.element_at(vx.unit(e), -1), 8).alias("last_unit"),
    )


@query(
    "fn_08_cosine",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT vec_id, round(list_cosine_similarity(e, list_reverse(e)), 8) AS mirrored, 0.0::DOUBLE AS shorter FROM v""",
)
def cosine(spark, folder):
    e = F.col("embedding")
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.round(vx.cosine(e, F.reverse(e)), 8).alias("mirrored"),
        vx.cosine(e, F.slice(e, 1, F.size(e) - 1)).alias("shorter"),
    )


@query(
    "fn_09_euclidean",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT vec_id, round(list_distance(e, list_reverse(e)), 8) AS distance, round(-list_distance(e, list_reverse(e)), 8) AS score FROM v""",
)
def euclidean(spark, folder):
    e = F.col("embedding")
    far = vx.euclidean(e, F.reverse(e))
    return table(spark, folder, "embeddings").select("vec_id", F.round(far, 8).alias("distance"), F.round(-far, 8).alias("score"))


@query(
    "fn_10_dimension_check",
    """SELECT vec_id, 64 - vec_id % 3 AS found, CAST(64 AS INTEGER) AS expected FROM embeddings WHERE vec_id % 3 <> 0""",
)
def dimension_check(spark, folder):
    # vectors are cut by 0, 1 or 2 slots so that some fail the check
    cut = F.expr("slice(embedding, 1, size(embedding) - cast(vec_id % 3 as int))")
    vectors_in = table(spark, folder, "embeddings").select("vec_id", cut.alias("embedding"))
    _, rejected = vectors.split_by_dimension(vectors_in, "embedding", 64)
    return rejected.select("vec_id", F.size("embedding").cast("bigint").alias("found"), F.lit(64).alias("expected"))
