"""Tables the monitoring, run and chat operators work on, derived from the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def request_log(events: DataFrame) -> DataFrame:
    """One row per request: id, time, user, endpoint, latency, tokens, status."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    status = (
        F.when(F.col("event_type") == "error", "Error")
        .when(k >= 95, "RateLimited")
        .when(k < 5, "Filtered")
        .otherwise("Success")
    )
    return events.select(
        F.col("event_id").alias("request_id"),
        "ts",
        "user_id",
        F.col("event_type").alias("endpoint"),
        F.col("value").alias("latency_ms"),
        k.alias("prompt_tokens"),
        F.pmod("event_id", F.lit(50)).alias("completion_tokens"),
        status.alias("status"),
    )


REQUEST_LOG_SQL = """log AS (
  SELECT event_id AS request_id, ts, user_id, event_type AS endpoint, value AS latency_ms,
         k AS prompt_tokens, event_id % 50 AS completion_tokens,
         CASE WHEN event_type = 'error' THEN 'Error' WHEN k >= 95 THEN 'RateLimited'
              WHEN k < 5 THEN 'Filtered' ELSE 'Success' END AS status
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events))"""


def run_metrics(events: DataFrame) -> DataFrame:
    """Long metric table: run_id, step, key, value."""
    return events.select(
        F.pmod("user_id", F.lit(20)).alias("run_id"),
        F.col("event_id").alias("step"),
        F.col("ts").alias("logged_at"),
        F.col("event_type").alias("key"),
        F.col("value"),
    )


RUN_METRICS_SQL = """runs AS (
  SELECT user_id % 20 AS run_id, event_id AS step, ts AS logged_at, event_type AS key, value FROM events)"""


def run_records(events: DataFrame) -> DataFrame:
    """Long run log: run_id, kind (metric, param, tag), key, step, logged_at, value (of metrics), text (of params and tags).

    A run's parameters and tags are logged with its first step.
    """
    metrics = run_metrics(events)
    first = metrics.groupBy("run_id").agg(F.min("step").alias("step"), F.min_by("logged_at", "step").alias("logged_at"))
    rate = F.concat(F.lit("0."), (F.pmod("run_id", F.lit(9)) + 1).cast("string"))
    told = {
        ("param", "learning_rate"): rate,
        ("param", "depth"): (F.pmod("run_id", F.lit(4)) + 2).cast("string"),
        ("tag", "experiment"): F.concat(F.lit("exp-"), F.pmod("run_id", F.lit(3)).cast("string")),
        ("tag", "model"): F.concat(F.lit("model-"), F.pmod("run_id", F.lit(5)).cast("string")),
    }
    listed = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), text.alias("text")) for (kind, key), text in told.items()])
    texts = first.select("run_id", "step", "logged_at", F.inline(listed)).withColumn("value", F.lit(None).cast("double"))
    columns = ["run_id", "kind", "key", "step", "logged_at", "value", "text"]
    numbers = metrics.withColumn("kind", F.lit("metric")).withColumn("text", F.lit(None).cast("string"))
    return numbers.select(*columns).unionByName(texts.select(*columns))


RUN_RECORDS_SQL = f"""{RUN_METRICS_SQL},
  first_steps AS (SELECT run_id, min(step) AS step, arg_min(logged_at, step) AS logged_at FROM runs GROUP BY 1),
  records AS (SELECT run_id, 'metric' AS kind, key, step, logged_at, value, NULL::VARCHAR AS text FROM runs
    UNION ALL SELECT run_id, 'param', 'learning_rate', step, logged_at, NULL, '0.' || (run_id % 9 + 1) FROM first_steps
    UNION ALL SELECT run_id, 'param', 'depth', step, logged_at, NULL, CAST(run_id % 4 + 2 AS VARCHAR) FROM first_steps
    UNION ALL SELECT run_id, 'tag', 'experiment', step, logged_at, NULL, 'exp-' || (run_id % 3) FROM first_steps
    UNION ALL SELECT run_id, 'tag', 'model', step, logged_at, NULL, 'model-' || (run_id % 5) FROM first_steps)"""


def chat_pairs(conversations: DataFrame) -> DataFrame:
    """A user message with the assistant message of the next turn."""
    asked = conversations.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    replied = conversations.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    opening = conversations.where("role = 'system' AND turn = 0").select("conv_id", F.col("text").alias("input"))
    return (
        asked.join(replied, ["conv_id", "turn"])
        .join(opening, "conv_id", "left")
        .select("conv_id", "turn", "instruction", F.coalesce("input", F.lit("")).alias("input"), "output")
    )


CHAT_PAIRS_SQL = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS instruction, coalesce(s.text, '') AS input, a.text AS output
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.role = 'system' AND s.turn = 0
  WHERE u.role = 'user')"""
