"""Streaming jobs. Each equals its batch twin over the same files."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import models as mo
from marlstone.operators import quality as qu
from marlstone.operators.relational import sigmoid
from marlstone.plans.features import transactions
from marlstone.plans.monitoring import INPUT_GUARD_SQL, SLIDING_LOG_SQL
from marlstone.plans.registry import query, table
from marlstone.sources.logs import REQUEST_LOG_SQL, request_log
from marlstone.streaming import jobs
from marlstone.workspace import scratch


@query(
    "str_01_stream_scoring",
    """SELECT event_id AS transaction_id, round(1 / (1 + exp(-(-3.0::DOUBLE + 0.01::DOUBLE * value + 0.5::DOUBLE * CAST(event_type IN ('click', 'view') AS DOUBLE)))), 8) AS probability,
    round(1 / (1 + exp(-(-3.0::DOUBLE + 0.01::DOUBLE * value + 0.5::DOUBLE * CAST(event_type IN ('click', 'view') AS DOUBLE)))), 8) >= 0.5 AS is_positive FROM events""",
)
def stream_scoring(spark, folder):
    arriving = transactions(jobs.read_files(spark, f"{folder}/events*.parquet"))
    score = mo.linear(["amount", "online"], [0.01, 0.5], -3.0)
    probability = F.round(sigmoid(score), 8)
    scored = arriving.withColumn("online", F.col("is_online").cast("double")).select(
        "transaction_id", probability.alias("probability"), (probability >= 0.5).alias("is_positive")
    )
    return jobs.run_to_parquet(scored, scratch(spark, "scored"))


@query(
    "str_02_stream_guard",
    f"SELECT doc_id, CASE WHEN violations = '' THEN 'Success' ELSE 'Filtered' END AS status, violations FROM ({INPUT_GUARD_SQL})",
)
def stream_guard(spark, folder):
    arriving = jobs.read_files(spark, f"{folder}/documents*.parquet")
    checked = arriving.select("doc_id", F.array_join(qu.input_violations(F.col("text")), "; ").alias("violations"))
    log = checked.select("doc_id", F.when(F.col("violations") == "", "Success").otherwise("Filtered").alias("status"), "violations")
    return jobs.run_to_parquet(log, scratch(spark, "guarded"))


@query(
    "str_03_minute_usage",
    f"""WITH {REQUEST_LOG_SQL} SELECT date_trunc('minute', ts) AS window_start, endpoint, count(*) AS n_requests,
    CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS tokens FROM log GROUP BY 1, 2""",
)
def minute_usage(spark, folder):
    arriving = request_log(jobs.read_files(spark, f"{folder}/events*.parquet"))
    tokens = F.col("prompt_tokens") + F.col("completion_tokens")
    counted = jobs.usage(arriving, "ts", ["endpoint"], tokens, "1 minute", "10 minutes")
    return jobs.run_updates(counted, scratch(spark, "usage"), ["window_start", "endpoint"])


@query(
    "str_02_log_once",
    f"WITH {REQUEST_LOG_SQL} SELECT request_id, ts, user_id, endpoint, latency_ms, prompt_tokens, completion_tokens, status FROM log",
)
def stream_log_once(spark, folder):
    """The request log arrives twice, as when files are delivered again; the sink takes every request once."""
    source = scratch(spark, "delivered")
    log = request_log(table(spark, folder, "events"))
    for _ in range(2):
        log.write.mode("append").parquet(source)
    batches = len(spark.read.parquet(source).inputFiles()) // 2
    return jobs.log_once(jobs.read_files(spark, source, files_per_batch=max(1, batches)), scratch(spark, "log"), "request_id", "ts", "60 days")


_CLOSED_SQL = f"""{REQUEST_LOG_SQL}, limits AS (SELECT max(ts) - INTERVAL 10 MINUTE AS newest FROM log),
    w AS (SELECT date_trunc('minute', ts) AS window_start, endpoint, count(*) AS n_requests, CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS tokens FROM log GROUP BY 1, 2)"""


@query("str_03_closed_minutes", f"WITH {_CLOSED_SQL} SELECT w.* FROM w, limits WHERE window_start + INTERVAL 1 MINUTE <= newest")
def closed_minutes(spark, folder):
    """Usage of the minutes that the watermark has passed, each written once."""
    return _closed(spark, folder)


def _closed(spark, folder):
    arriving = request_log(jobs.read_files(spark, f"{folder}/events*.parquet"))
    tokens = F.col("prompt_tokens") + F.col("completion_tokens")
    return jobs.closed_usage(arriving, scratch(spark, "closed"), "ts", ["endpoint"], tokens, "1 minute", "10 minutes")


@query(
    "str_03_outside_closed",
    f"WITH {_CLOSED_SQL} SELECT window_start, endpoint, n_requests AS n, false AS late FROM w, limits WHERE window_start + INTERVAL 1 MINUTE > newest",
)
def outside_closed_minutes(spark, folder):
    """Rows in windows that are still open, and rows that came too late for theirs (none in one file)."""
    log = request_log(table(spark, folder, "events"))
    return jobs.outside_closed(log, _closed(spark, folder), "ts", ["endpoint"], "1 minute", "10 minutes")


@query("str_04_stream_admission", SLIDING_LOG_SQL)
def stream_admission(spark, folder):
    """Events arrive in four parts by time, each of many files, one part a batch."""
    events, source = table(spark, folder, "events"), scratch(spark, "arriving")
    instant = F.unix_micros(jobs.event_time(events, "ts"))
    cuts = events.agg(F.percentile_approx(instant, [0.25, 0.5, 0.75], 1000)).first()[0] or []
    part = F.lit(0)
    for cut in cuts:
        part = part + (instant > cut).cast("int")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for number in range(4):
        events.where(part == number).repartition(files, "event_id").write.mode("append").parquet(source)
    arriving = request_log(jobs.read_files(spark, source, files_per_batch=files)).select("request_id", "user_id", "ts")
    decided = jobs.admit(arriving, scratch(spark, "admitted"), "user_id", "ts", "request_id", limit=3, seconds=43200)
    return request_log(events).select("request_id", "user_id", "ts").join(decided, "request_id")


_RULES = [("error_rate", ">", 0.5), ("mean_latency", ">", 120.0), ("n_requests", ">=", 8.0)]


@query(
    "str_05_stream_alerts",
    f"""WITH {REQUEST_LOG_SQL}, s AS (SELECT *, date_trunc('hour', ts) + (minute(ts) // 5) * INTERVAL 5 MINUTE AS slot FROM log),
    w AS (SELECT slot - k * INTERVAL 5 MINUTE AS window_start, endpoint, count(*) AS n, sum(latency_ms) / count(*) AS mean_latency,
      count(*) FILTER (status <> 'Success') / count(*) AS error_rate FROM s, range(12) r(k) GROUP BY 1, 2)
    SELECT window_start, endpoint, concat_ws('; ', CASE WHEN error_rate > 0.5 AND n > 0 THEN 'error_rate > 0.5' END,
      CASE WHEN mean_latency > 120 THEN 'mean_latency > 120.0' END, CASE WHEN n >= 8 THEN 'n_requests >= 8.0' END) AS fired
    FROM w WHERE error_rate > 0.5 OR mean_latency > 120 OR n >= 8""",
)
def stream_alerts(spark, folder):
    arriving = request_log(jobs.read_files(spark, f"{folder}/events*.parquet"))
    windows = jobs.service_windows(arriving, "ts", "endpoint", "1 hour", "5 minutes", "10 minutes")
    newest = jobs.run_updates(windows, scratch(spark, "windows"), ["window_start", "endpoint"])
    return jobs.window_alerts(newest, "endpoint", _RULES).withColumn("fired", F.array_join("fired", "; "))


@query(
    "str_05_alert_states",
    f"""WITH {REQUEST_LOG_SQL}, limits AS (SELECT max(ts) - INTERVAL 10 MINUTE AS newest FROM log),
    w AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ended, endpoint, count(*) AS n, sum(latency_ms) / count(*) AS mean_latency,
      count(*) FILTER (status <> 'Success') / count(*) AS error_rate FROM log GROUP BY 1, 2),
    r AS (SELECT endpoint, ended, 'error_rate > 0.5' AS rule, error_rate > 0.5 AS broken FROM w, limits WHERE ended <= newest
      UNION ALL SELECT endpoint, ended, 'mean_latency > 120.0', mean_latency > 120 FROM w, limits WHERE ended <= newest
      UNION ALL SELECT endpoint, ended, 'n_requests >= 8.0', n >= 8 FROM w, limits WHERE ended <= newest),
    b AS (SELECT *, coalesce(lag(broken) OVER (PARTITION BY endpoint, rule ORDER BY ended), false) AS earlier FROM r),
    c AS (SELECT * FROM b WHERE broken <> earlier)
    SELECT endpoint, rule, ended AS opened, lead(ended) OVER (PARTITION BY endpoint, rule ORDER BY ended) AS resolved FROM c QUALIFY broken""",
)
def stream_alert_states(spark, folder):
    """When each alert opened and when it was resolved, over the closed hours."""
    arriving = request_log(jobs.read_files(spark, f"{folder}/events*.parquet"))
    return jobs.alert_states(arriving, scratch(spark, "alerts"), "ts", "endpoint", "1 hour", "10 minutes", _RULES)
