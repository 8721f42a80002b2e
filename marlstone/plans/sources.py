"""Scans, sinks and inline tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.plans.registry import query, table
from marlstone.sources.files import round_trip
from marlstone.sources.logs import CHAT_PAIRS_SQL, REQUEST_LOG_SQL, chat_pairs, request_log
from marlstone.sources.snapshots import SchemaMismatch, SnapshotTable
from marlstone.workspace import scratch, temp_view

PRIORITIES = [("1-URGENT", 1, True), ("2-HIGH", 2, True), ("3-MEDIUM", 3, False), ("4-NOT SPECIFIED", 4, False), ("5-LOW", 5, False)]
PRIORITY_VALUES = ", ".join(f"('{name}', {rank}, {str(rush).lower()})" for name, rank, rush in PRIORITIES)


@query(
    "src_01_inline_rows",
    f"""SELECT p.priority_rank, p.rush, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN (VALUES {PRIORITY_VALUES}) AS p(priority, priority_rank, rush) ON o_orderpriority = p.priority
    GROUP BY 1, 2""",
)
def inline_rows(spark, folder):
    schema = T.StructType(
        [
            T.StructField("priority", T.StringType(), False),
            T.StructField("priority_rank", T.IntegerType(), False),
            T.StructField("rush", T.BooleanType(), False),
        ]
    )
    priorities = spark.createDataFrame(PRIORITIES, schema)
    per_priority = (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("total"))
    )
    return per_priority.join(priorities, F.col("o_orderpriority") == F.col("priority")).select(
        "priority_rank", "rush", "n_orders", F.round("total", 2).alias("total")
    )


@query("src_02_csv_scan", "SELECT * FROM customer")
def csv_scan(spark, folder):
    return round_trip(table(spark, folder, "customer"), "csv", header="true")


@query("src_03_json_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_scan(spark, folder):
    return round_trip(table(spark, folder, "documents"), "json")


@query(
    "src_04_parquet_scan",
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity > 25""",
)
def parquet_scan(spark, folder):
    lines = table(spark, folder, "lineitem")
    recent = (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 25)
    return lines.where(recent).select("l_orderkey", "l_partkey", "l_quantity")


@query("src_05_orc_scan", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def orc_scan(spark, folder):
    return round_trip(table(spark, folder, "supplier"), "orc").select("s_suppkey", "s_name", "s_acctbal")


@query(
    "src_06_values_view",
    f"""SELECT o_orderkey, p.priority_rank FROM orders
    JOIN (VALUES {PRIORITY_VALUES}) AS p(priority, priority_rank, rush) ON o_orderpriority = p.priority WHERE p.rush""",
)
def values_view(spark, folder):
    orders = temp_view(table(spark, folder, "orders"), "orders")
    priorities = temp_view(spark.sql(f"SELECT * FROM VALUES {PRIORITY_VALUES} AS p(priority, priority_rank, rush)"), "priorities")
    return spark.sql(f"SELECT o_orderkey, priority_rank FROM {orders} JOIN {priorities} ON o_orderpriority = priority WHERE rush")


@query("src_07_overwrite", "SELECT p_partkey, p_brand, round(p_retailprice * 2, 4) AS p_retailprice FROM part")
def overwrite(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice")
    stored = SnapshotTable(spark, scratch(spark, "overwrite"))
    stored.overwrite(parts)
    stored.overwrite(parts.withColumn("p_retailprice", F.round(F.col("p_retailprice") * 2, 4)))
    return stored.read()


@query("src_08_append", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stored = SnapshotTable(spark, scratch(spark, "append"))
    stored.overwrite(orders.where("o_orderstatus = 'F'"))
    stored.append(orders.where("o_orderstatus <> 'F'"))
    return stored.read()


@query(
    "src_09_append_evolved",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS added_date FROM orders""",
)
def append_evolved(spark, folder):
    orders = table(spark, folder, "orders")
    stored = SnapshotTable(spark, scratch(spark, "evolve"))
    stored.overwrite(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"))
    later = orders.where("o_orderstatus <> 'F'")
    stored.append(later.select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("added_date")), evolve=True)
    return stored.read()


@query(
    "src_10_schema_enforcement",
    """SELECT 'c_acctbal,c_mktsegment' AS missing_columns, 'note' AS extra_columns, count(*) AS n_rows,
    CAST(0 AS BIGINT) AS version FROM customer""",
)
def schema_enforcement(spark, folder):
    customers = table(spark, folder, "customer")
    stored = SnapshotTable(spark, scratch(spark, "enforce"))
    stored.overwrite(customers)
    try:
        stored.append(customers.select("c_custkey", "c_name", "c_nationkey", F.lit("x").alias("note")))
    except SchemaMismatch as refused:
        missing, extra = ",".join(refused.missing), ",".join(refused.extra)
    return stored.read().agg(
        F.lit(missing).alias("missing_columns"),
        F.lit(extra).alias("extra_columns"),
        F.count("*").alias("n_rows"),
        F.lit(stored.version).cast("bigint").alias("version"),
    )


@query(
    "src_11_create_and_insert",
    """SELECT event_id AS request_id, ts, event_type AS endpoint, CAST(floor(value) AS INTEGER) AS latency_ms FROM events""",
)
def create_and_insert(spark, folder):
    path = scratch(spark, "table")
    name = "created_" + path.rsplit("-", 1)[-1]
    spark.sql(
        f"CREATE TABLE {name} (request_id BIGINT, ts TIMESTAMP_NTZ, endpoint STRING, latency_ms INT) "
        f"USING parquet LOCATION '{path}'"
    )
    events = temp_view(table(spark, folder, "events"), "events")
    spark.sql(f"INSERT INTO {name} SELECT event_id, ts, event_type, CAST(floor(value) AS INT) FROM {events}")
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.schema(schema).parquet(path)


_SUMMARISED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "src_12_column_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
        min({c}) AS smallest, max({c}) AS largest FROM lineitem"""
        for c in _SUMMARISED
    ),
)
def column_summary(spark, folder):
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.round(F.avg(c), 4).alias("mean"),
            F.round(F.stddev_samp(c), 4).alias("stddev"),
            F.min(c).alias("smallest"),
            F.max(c).alias("largest"),
        )
        for c in _SUMMARISED
    ]
    return table(spark, folder, "lineitem").agg(F.array(*per_column).alias("s")).select(F.inline("s"))


@query("src_13_jsonl_samples", f"WITH {CHAT_PAIRS_SQL} SELECT instruction, input, output FROM pairs")
def jsonl_samples(spark, folder):
    samples = chat_pairs(table(spark, folder, "conversations")).select("instruction", "input", "output")
    return round_trip(samples, "json")


@query(
    "src_14_vector_store",
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS slot, CAST(embedding[i] AS DOUBLE) AS weight, label
    FROM (SELECT vec_id, embedding, label, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)""",
)
def vector_store(spark, folder):
    vectors = table(spark, folder, "embeddings")
    stored = SnapshotTable(spark, scratch(spark, "vectors"))
    stored.overwrite(vectors)
    return stored.read().select("vec_id", F.posexplode("embedding").alias("slot", "weight"), "label").withColumn(
        "weight", F.col("weight").cast("double")
    )


@query("src_15_request_log_sink", f"WITH {REQUEST_LOG_SQL} SELECT * FROM log")
def request_log_sink(spark, folder):
    log = request_log(table(spark, folder, "events"))
    stored = SnapshotTable(spark, scratch(spark, "requests"))
    stored.overwrite(log.where("status = 'Success'"))
    stored.append(log.where("status <> 'Success'"))
    return stored.read()
