"""Drift, gates, alerts, safety, experiments and usage limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators import admission
from marlstone.operators import experiments as ex
from marlstone.operators import quality as qu
from marlstone.operators.ordered import quantiles
from marlstone.plans.registry import query, table
from marlstone.sources.logs import REQUEST_LOG_SQL, request_log

_MIDDLE = "TIMESTAMP '2024-01-16'"


def _middle():
    return F.lit("2024-01-16").cast("timestamp_ntz")


@query(
    "mon_01_stability_index",
    f"""WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    b AS (SELECT least(floor((value - lo) / ((hi - lo) / 10)), 9) AS bin, count(*) FILTER (ts < {_MIDDLE}) AS x, count(*) FILTER (ts >= {_MIDDLE}) AS y
          FROM events, r GROUP BY 1),
    f AS (SELECT coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM range(10) g(bin) LEFT JOIN b USING (bin)),
    p AS (SELECT (x + 1e-10) / ((SELECT sum(x) FROM b) + 1e-9) AS b, (y + 1e-10) / ((SELECT sum(y) FROM b) + 1e-9) AS c FROM f),
    s AS (SELECT sum((c - b) * ln(c / b)) AS psi FROM p)
    SELECT round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END AS band FROM s""",
)
def stability_index(spark, folder):
    events = table(spark, folder, "events").select("ts", "value")
    found = qu.psi(events.where(F.col("ts") < _middle()), events.where(F.col("ts") >= _middle()), "value")
    return found.withColumn("psi", F.round("psi", 6))


@query(
    "mon_02_mean_shift",
    f"""WITH m AS (SELECT event_type, avg(value) FILTER (ts < {_MIDDLE}) AS b, avg(value) FILTER (ts >= {_MIDDLE}) AS c FROM events GROUP BY 1)
    SELECT event_type, round(b, 6) AS baseline_mean, round(c, 6) AS current_mean, round(abs(c / b - 1), 6) AS mean_shift, abs(c / b - 1) > 0.1 AS drift FROM m""",
)
def mean_shift(spark, folder):
    found = qu.mean_shift(table(spark, folder, "events"), "event_type", "value", F.col("ts") < _middle())
    return found.withColumns({c: F.round(c, 6) for c in ("baseline_mean", "current_mean", "mean_shift")})


_RULES = [("purchase", ">=", 20.0), ("signup", ">", 10.0), ("click", "<=", 60.0), ("view", "<", 80.0), ("refund", "<=", 1.0), ("error", "==", 0.0)]
_METRICS_SQL = """metrics AS (SELECT user_id, event_type AS metric, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2)"""
_CHECKS_SQL = f"""{_METRICS_SQL}, rules(metric, op, threshold) AS (VALUES {", ".join(f"('{m}', '{o}', {t}::DOUBLE)" for m, o, t in _RULES)}),
  v AS (SELECT u.user_id, r.*, coalesce(m.value, 0.0) AS value, m.value IS NULL AS missing FROM (SELECT DISTINCT user_id FROM metrics) u
        CROSS JOIN rules r LEFT JOIN metrics m ON m.user_id = u.user_id AND m.metric = r.metric),
  c AS (SELECT *, CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold WHEN '>=' THEN value >= threshold
        WHEN '<=' THEN value <= threshold ELSE value = threshold END AS passed FROM v),
  checks AS (SELECT user_id, metric, value, threshold, passed, missing, CASE WHEN passed THEN printf('%s = %.2f (OK)', metric, value)
        ELSE printf('%s = %.2f (FAILED, threshold: %.2f)', metric, value, threshold) END AS message FROM c)"""


def _metrics(spark, folder):
    """Latest value of each metric (event type) per user."""
    return (
        table(spark, folder, "events")
        .groupBy("user_id", F.col("event_type").alias("metric"))
        .agg(F.max_by("value", "event_id").alias("value"))
    )


@query("mon_03_gate_checks", f"WITH {_CHECKS_SQL} SELECT * FROM checks")
def gate_checks(spark, folder):
    return qu.check_gates(_metrics(spark, folder), "user_id", _RULES)


_ENDPOINT_SQL = f"""{REQUEST_LOG_SQL}, e AS (SELECT endpoint, avg((status = 'Success')::INT) AS relevance, avg((prompt_tokens >= 20)::INT) AS coherence,
  avg((status <> 'Filtered')::INT) AS safety, quantile_cont(latency_ms, 0.95) AS p95 FROM log GROUP BY 1)"""


@query(
    "mon_04_response_gate",
    f"""WITH {_ENDPOINT_SQL}, i AS (SELECT endpoint, list_filter([CASE WHEN relevance < 0.92 THEN printf('Relevance %.2f < 0.92', relevance) END,
      CASE WHEN coherence < 0.81 THEN printf('Coherence %.2f < 0.81', coherence) END, CASE WHEN safety < 0.95 THEN printf('Safety %.2f < 0.95', safety) END,
      CASE WHEN p95 > 140 THEN printf('Latency %dms > 140ms', CAST(floor(p95) AS BIGINT)) END], lambda x: x IS NOT NULL) AS issues FROM e)
    SELECT endpoint, len(issues) = 0 AS passed, array_to_string(issues, '; ') AS issues FROM i""",
)
def response_gate(spark, folder):
    log = request_log(table(spark, folder, "events"))
    scores = log.groupBy("endpoint").agg(
        F.avg((F.col("status") == "Success").cast("int")).alias("relevance"),
        F.avg((F.col("prompt_tokens") >= 20).cast("int")).alias("coherence"),
        F.avg((F.col("status") != "Filtered").cast("int")).alias("safety"),
    )
    tail = quantiles(log, ["endpoint"], "latency_ms", {"p95": 0.95})
    issues = qu.response_issues(
        F.col("relevance"), F.col("coherence"), F.col("safety"), F.col("p95"), 0.92, 0.81, 0.95, 140
    )
    checked = scores.join(tail, "endpoint").withColumn("issues", issues)
    return checked.select("endpoint", (F.size("issues") == 0).alias("passed"), F.array_join("issues", "; ").alias("issues"))


_COMPONENTS = {
    "cyclomatic_avg": "avg(value) / 10",
    "cognitive_avg": "max(value) / 10",
    "line_coverage": "100.0 * avg(CASE WHEN value > 10 THEN 1 ELSE 0 END)",
    "branch_coverage": "100.0 * avg(CASE WHEN value > 5 THEN 1 ELSE 0 END)",
    "mutation_score": "100.0 * avg(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)",
    "doc_coverage": "100.0 * avg(CASE WHEN value < 100 THEN 1 ELSE 0 END)",
    "readme_score": "100.0 * avg(CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END)",
    "vulnerabilities": "sum(CASE WHEN value > 300 THEN 1 ELSE 0 END)",
    "advisories": "sum(CASE WHEN value > 250 THEN 1 ELSE 0 END)",
}
_COMPONENTS_SQL = "m AS (SELECT user_id, " + ", ".join(f"{e} AS {n}" for n, e in _COMPONENTS.items()).replace("100.0", "100.0::DOUBLE") + " FROM events GROUP BY 1)"


@query(
    "mon_05_weighted_grade",
    f"""WITH {_COMPONENTS_SQL}, s AS (SELECT user_id, round(0.25::DOUBLE * ((30 - least(cyclomatic_avg, 30)) / 30 * 100 + (25 - least(cognitive_avg, 25)) / 25 * 100) / 2
      + 0.35::DOUBLE * (line_coverage + branch_coverage + mutation_score) / 3 + 0.15::DOUBLE * (doc_coverage + readme_score) / 2
      + 0.25::DOUBLE * CASE WHEN vulnerabilities > 0 THEN 0 WHEN advisories > 0 THEN 50 ELSE 100 END, 6) AS score,
      round(0.35::DOUBLE * line_coverage + 0.25::DOUBLE * mutation_score + 0.2::DOUBLE * least(greatest(100 - cyclomatic_avg * 5, 0), 100) + 0.2::DOUBLE * doc_coverage, 6) AS share_score FROM m),
    g AS (SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade FROM s)
    SELECT *, CAST(CASE grade WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 ELSE 0 END AS INTEGER) AS grade_value FROM g""",
)
def weighted_grade(spark, folder):
    parts = table(spark, folder, "events").groupBy("user_id").agg(*[F.expr(e).cast("double").alias(n) for n, e in _COMPONENTS.items()])
    shares = qu.share_score(
        F.col("line_coverage") / 100, F.col("mutation_score") / 100, F.col("cyclomatic_avg"), F.col("doc_coverage") / 100
    )
    scored = parts.select("user_id", F.round(qu.component_score(), 6).alias("score"), F.round(shares, 6).alias("share_score"))
    return scored.withColumn("grade", qu.grade(F.col("score"))).withColumn("grade_value", qu.grade_value(F.col("grade")))


@query(
    "mon_06_gate_report",
    f"""WITH {_CHECKS_SQL}, r AS (SELECT user_id, bool_and(passed) AS passed, count(*) FILTER (passed) AS n_passed,
      coalesce(string_agg(message, '; ' ORDER BY message) FILTER (NOT passed), '') AS failures FROM checks GROUP BY 1), {_COMPONENTS_SQL}
    SELECT r.*, concat_ws('; ', CASE WHEN line_coverage / 100 < 0.80 THEN printf('tests cover %.1f%%, below 80%%', floor(line_coverage * 10 + 0.5) / 10) END,
      CASE WHEN mutation_score / 100 < 0.70 THEN printf('mutants caught: %.1f%%, below 70%%', floor(mutation_score * 10 + 0.5) / 10) END,
      CASE WHEN cyclomatic_avg > 10 THEN printf('mean complexity %.1f, above 10', floor(cyclomatic_avg * 10 + 0.5) / 10) END,
      CASE WHEN doc_coverage / 100 < 0.5 THEN printf('documented: %.1f%%, below 50%%', floor(doc_coverage * 10 + 0.5) / 10) END) AS recommendations
    FROM r JOIN m USING (user_id)""",
)
def gate_report(spark, folder):
    report = qu.gate_report(qu.check_gates(_metrics(spark, folder), "user_id", _RULES), "user_id")
    parts = table(spark, folder, "events").groupBy("user_id").agg(*[F.expr(e).cast("double").alias(n) for n, e in _COMPONENTS.items()])
    advice = qu.recommendations(
        F.col("line_coverage") / 100, F.col("mutation_score") / 100, F.col("cyclomatic_avg"), F.col("doc_coverage") / 100
    )
    return report.join(parts, "user_id").select(
        "user_id", "passed", "n_passed", F.array_join("failures", "; ").alias("failures"), F.array_join(advice, "; ").alias("recommendations")
    )


_ALERTS = [("error", ">", 200.0), ("purchase", "<", 5.0), ("refund", ">", 0.0)]


@query(
    "mon_07_alerts",
    f"""WITH {_METRICS_SQL}, f AS (SELECT user_id, metric, CASE metric WHEN 'error' THEN 'error > 200.0' ELSE 'purchase < 5.0' END AS name FROM metrics
      WHERE (metric = 'error' AND value > 200) OR (metric = 'purchase' AND value < 5))
    SELECT user_id, string_agg(name, '; ' ORDER BY name) AS fired FROM f GROUP BY 1""",
)
def alerts(spark, folder):
    return qu.alerts(_metrics(spark, folder), "user_id", _ALERTS).withColumn("fired", F.array_join("fired", "; "))


@query(
    "mon_08_expectations",
    """SELECT 'row_count' AS "check", count(*) >= 100 AS passed FROM orders UNION ALL SELECT 'has_o_orderkey', true UNION ALL SELECT 'has_o_comment', false
    UNION ALL SELECT 'allowed_o_orderstatus', bool_and(o_orderstatus IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'allowed_o_orderpriority', bool_and(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) FROM orders
    UNION ALL SELECT 'groups_o_orderpriority', count(DISTINCT o_orderpriority) = 5 FROM orders""",
)
def expectations(spark, folder):
    return qu.expectations(
        table(spark, folder, "orders"),
        ["o_orderkey", "o_comment"],
        {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]},
        100,
        {"o_orderpriority": 5},
    )


INPUT_GUARD_SQL = f"""SELECT doc_id, concat_ws('; ', CASE WHEN length(text) > 4096 THEN 'input length over the limit: ' || length(text) || ' > 4096' END,
    {", ".join(f"CASE WHEN contains(lower(text), '{p}') THEN 'forbidden text: {p}' END" for p in qu.BLOCKED_PATTERNS)},
    CASE WHEN contains(text, '@') AND contains(text, '.') THEN 'personal data: e-mail' END,
    CASE WHEN length(regexp_replace(text, '[^0-9]', '', 'g')) >= 10 THEN 'personal data: phone' END) AS violations FROM documents"""


@query("mon_09_input_guard", f"SELECT doc_id, violations = '' AS passed, violations FROM ({INPUT_GUARD_SQL})")
def input_guard(spark, folder):
    checked = table(spark, folder, "documents").select("doc_id", qu.input_violations(F.col("text")).alias("v"))
    return checked.select("doc_id", (F.size("v") == 0).alias("passed"), F.array_join("v", "; ").alias("violations"))


@query(
    "mon_10_output_guard",
    """SELECT doc_id, length(text) <= 2048 AS passed, CASE WHEN length(text) > 2048 THEN 'answer length over the limit: ' || length(text) || ' > 2048'
    ELSE '' END AS violations FROM documents""",
)
def output_guard(spark, folder):
    checked = table(spark, folder, "documents").select("doc_id", qu.output_violations(F.col("text")).alias("v"))
    return checked.select("doc_id", (F.size("v") == 0).alias("passed"), F.array_join("v", "; ").alias("violations"))


@query(
    "mon_11_pii_flags",
    r"""SELECT doc_id, contains(text, '@') AND contains(text, '.') AS email_signs, length(regexp_replace(text, '[^0-9]', '', 'g')) >= 10 AS phone_digits,
    regexp_matches(text, '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b') AS ssn, regexp_matches(text, '[A-Za-z0-9._-]+@[A-Za-z0-9-]+[.][A-Za-z]+') AS email_strict FROM documents""",
)
def pii_flags(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        tx.has_email_signs(text).alias("email_signs"),
        tx.has_ten_digits(text).alias("phone_digits"),
        tx.has_ssn(text).alias("ssn"),
        text.rlike(r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+[.][A-Za-z]+").alias("email_strict"),
    )


_FILTER_BLOCKED, _FILTER_TOPICS = ["api_key", "password"], ["license", "@"]


@query(
    "mon_12_content_filter",
    """SELECT doc_id, CASE WHEN contains(t, 'api_key') OR contains(t, 'password') THEN 'Blocked' WHEN contains(t, 'license') OR contains(t, '@') THEN 'Flagged'
    ELSE 'Allowed' END AS verdict, CASE WHEN contains(t, 'api_key') THEN 'api_key' WHEN contains(t, 'password') THEN 'password'
    WHEN contains(t, 'license') THEN 'license' WHEN contains(t, '@') THEN '@' ELSE '' END AS reason FROM (SELECT doc_id, lower(text) AS t FROM documents)""",
)
def content_filter(spark, folder):
    checked = table(spark, folder, "documents").select(
        "doc_id", qu.content_filter(F.col("text"), _FILTER_BLOCKED, _FILTER_TOPICS).alias("f")
    )
    return checked.select("doc_id", "f.verdict", "f.reason")


_VARIANTS = [("control", 0.5), ("treatment", 0.3), ("holdout", 0.2)]
_VARIANT_SQL = "CASE WHEN {0} < 0.5 THEN 'control' WHEN {0} < 0.8 THEN 'treatment' ELSE 'holdout' END"


@query(
    "mon_12_many_patterns",
    """WITH w AS (SELECT DISTINCT lower(p) AS p FROM (SELECT unnest(string_split(p_name, ' ')) AS p FROM part UNION ALL SELECT p_brand FROM part UNION ALL SELECT text FROM benchmark) WHERE p <> ''),
    h AS (SELECT doc_id, count(*) AS n, min(p) AS first FROM documents JOIN w ON contains(lower(text), p) GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_found, first FROM documents LEFT JOIN h USING (doc_id)""",
)
def many_patterns(spark, folder):
    """How many of all part words, brands and benchmark texts a document holds, and the first one of them."""
    parts = table(spark, folder, "part")
    words = parts.select(F.explode(F.split("p_name", " ")).alias("p")).unionByName(parts.select(F.col("p_brand").alias("p"))).unionByName(table(spark, folder, "benchmark").select(F.col("text").alias("p")))
    # as many as the automaton takes; more are refused
    patterns = sorted(r["p"] for r in words.select(F.lower("p").alias("p")).where("p <> ''").distinct().collect())
    found = tx.found_many(F.col("text"), patterns)
    listed = F.array(*[F.lit(p) for p in patterns])
    return table(spark, folder, "documents").select("doc_id", found.alias("f")).select("doc_id", F.size("f").cast("bigint").alias("n_found"), F.get(listed, F.get("f", F.lit(0))).alias("first"))


@query(
    "mon_13_variant_assignment",
    f"""SELECT event_id, user_id, CASE WHEN ts < TIMESTAMP '2024-01-25' THEN {_VARIANT_SQL.format("(user_id % 100) / 100")} END AS variant,
    CASE WHEN ts < TIMESTAMP '2024-01-25' THEN {_VARIANT_SQL.format("(CAST('0x' || substring(md5(event_type), 1, 8) AS BIGINT) % 100) / 100")} END AS by_name FROM events""",
)
def variant_assignment(spark, folder):
    active = F.col("ts") < F.lit("2024-01-25").cast("timestamp_ntz")
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        ex.assign_variant(F.col("user_id"), _VARIANTS, active).alias("variant"),
        ex.assign_variant(ex.hashed_user(F.col("event_type")), _VARIANTS, active).alias("by_name"),
    )


_UNIFORM_SQL = "(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 100) / 100"


@query(
    "mon_14_variant_pick",
    f"""WITH p AS (SELECT {_VARIANT_SQL.format(_UNIFORM_SQL)} AS variant FROM events)
    SELECT variant, count(*) AS n, round(count(*) / (SELECT count(*) FROM p), 6) AS share FROM p GROUP BY 1""",
)
def variant_pick(spark, folder):
    uniform = F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(100)) / 100
    picked = table(spark, folder, "events").select(ex.pick_variant(uniform, _VARIANTS).alias("variant"))
    total = picked.agg(F.count("*")).scalar()
    return picked.groupBy("variant").agg(F.count("*").alias("n")).withColumn("share", F.round(F.col("n") / total, 6))


@query(
    "mon_15_experiment_summary",
    f"""WITH {REQUEST_LOG_SQL}, v AS (SELECT *, 'model_comparison' AS test, {_VARIANT_SQL.format("(user_id % 100) / 100")} AS variant FROM log)
    SELECT test, variant, count(*) AS n_requests, count(DISTINCT user_id) AS n_users, round(avg((status = 'Success')::INT), 6) AS success_rate,
    round(avg(latency_ms), 4) AS mean_latency FROM v GROUP BY 1, 2""",
)
def experiment_summary(spark, folder):
    log = request_log(table(spark, folder, "events")).withColumns(
        {"test": F.lit("model_comparison"), "variant": ex.assign_variant(F.col("user_id"), _VARIANTS, F.lit(True))}
    )
    return ex.summarise(log, ["test", "variant"])


@query(
    "mon_16_fixed_window",
    f"""WITH {REQUEST_LOG_SQL}, w AS (SELECT request_id, epoch_us(ts) // 3600000000 AS window_no, ts, prompt_tokens + completion_tokens AS tokens FROM log),
    b AS (SELECT request_id, window_no, count(*) OVER o - 1 AS r, sum(tokens) OVER o - tokens AS t FROM w
          WINDOW o AS (PARTITION BY window_no ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING))
    SELECT request_id, window_no, r < 12 AND t < 700 AS allowed, round(least(r, 12) / 12, 6) AS request_share FROM b""",
)
def fixed_window(spark, folder):
    log = request_log(table(spark, folder, "events")).select(
        "request_id", "ts", (F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens")
    )
    found = admission.fixed_window(log, "ts", "request_id", "tokens", 3600, 12, 700)
    return found.select("request_id", "window_no", "allowed", F.round("request_share", 6).alias("request_share"))


SLIDING_LOG_SQL = """WITH RECURSIVE r AS (SELECT event_id AS request_id, user_id, ts, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
  f AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n, []::BIGINT[] AS log, NULL::BIGINT AS request_id, NULL::TIMESTAMP AS ts, NULL::BOOLEAN AS allowed FROM r
    UNION ALL SELECT user_id, n, CASE WHEN len(kept) < 3 THEN list_append(kept, t) ELSE kept END, request_id, ts, len(kept) < 3
    FROM (SELECT r.user_id, r.n, r.request_id, r.ts, r.t, list_filter(f.log, lambda x: r.t - x <= 43200000000) AS kept FROM f JOIN r ON r.user_id = f.user_id AND r.n = f.n + 1))
  SELECT request_id, user_id, ts, allowed, CAST(3 - len(log) AS BIGINT) AS remaining FROM f WHERE n > 0"""


@query("mon_17_sliding_log", SLIDING_LOG_SQL)
def sliding_log(spark, folder):
    log = request_log(table(spark, folder, "events")).select("request_id", "user_id", "ts")
    decided, _ = admission.sliding_log(log, "user_id", "ts", "request_id", limit=3, seconds=43200)
    return decided
