"""Drift, gates, grades, alerts, expectations, guardrails and content filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import found_patterns, has_email_signs, has_ten_digits
from marlstone.operators.features import bin_between

# --- drift ----------------------------------------------------------------------------

# fixed values: smoothing and band limits of the stability index, drift limit of the mean shift
PSI_EPS = 1e-10
PSI_MODERATE, PSI_SIGNIFICANT = 0.1, 0.25
SHIFT_LIMIT = 0.1


def psi(baseline: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """One row (psi, band) over equal bins between the joint minimum and maximum."""
    both = baseline.select(column, F.lit(1).alias("_b")).unionByName(current.select(column, F.lit(0).alias("_b")))
    joint = both.agg(
        F.struct(
            F.min(column).alias("low"),
            F.max(column).alias("high"),
            F.sum("_b").alias("n_base"),
            F.sum(1 - F.col("_b")).alias("n_cur"),
        )
    ).scalar()
    counts = (
        both.withColumn("_bin", bin_between(F.col(column), joint["low"], joint["high"], bins))
        .groupBy("_bin")
        .agg(F.sum("_b").alias("_base"), F.sum(1 - F.col("_b")).alias("_cur"))
    )
    every = baseline.sparkSession.range(bins).select(F.col("id").cast("int").alias("_bin"))
    full = every.join(counts, "_bin", "left").na.fill(0, ["_base", "_cur"])

    def part(hits: str, n: Column) -> Column:
        return (F.col(hits) + PSI_EPS) / (n + PSI_EPS * bins)

    b, c = part("_base", joint["n_base"]), part("_cur", joint["n_cur"])
    total = full.agg(F.sum((c - b) * F.log(c / b)).alias("psi"))
    band = F.when(F.col("psi") < PSI_MODERATE, "none").when(F.col("psi") < PSI_SIGNIFICANT, "moderate").otherwise("significant")
    return total.withColumn("band", band)


def mean_shift(df: DataFrame, key: str, value: str, is_baseline: Column) -> DataFrame:
    """Per key: means of both parts, abs(current / baseline - 1), and whether it is above 0.1; 0 for a zero baseline."""
    means = df.groupBy(key).agg(
        F.avg(F.when(is_baseline, F.col(value))).alias("baseline_mean"),
        F.avg(F.when(~is_baseline, F.col(value))).alias("current_mean"),
    )
    ratio = F.abs(F.col("current_mean") / F.nullif(F.col("baseline_mean"), F.lit(0.0)) - 1)
    shift = F.when(F.col("baseline_mean") == 0, F.lit(0.0)).otherwise(ratio)
    return means.withColumn("mean_shift", shift).withColumn("drift", F.col("mean_shift") > SHIFT_LIMIT)


# --- gates ----------------------------------------------------------------------------

COMPARATORS = (">", "<", ">=", "<=", "==")


def compare(value: Column, op: Column, threshold: Column) -> Column:
    return (
        F.when(op == ">", value > threshold)
        .when(op == "<", value < threshold)
        .when(op == ">=", value >= threshold)
        .when(op == "<=", value <= threshold)
        .otherwise(value == threshold)
    )


def check_gates(metrics: DataFrame, subject: str, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """One row per (subject, rule): value, passed, missing and a message.

    ``metrics`` is (subject, metric, value), one row per metric. A metric that is not there counts as 0 and is marked as missing.
    One aggregate over the metrics gives all rules of a subject; nothing is joined back.
    """
    wrong = [op for _, op, _ in rules if op not in COMPARATORS]
    if wrong:
        raise ValueError(f"unknown comparators {wrong}")
    names = list(dict.fromkeys(m for m, _, _ in rules))
    values = metrics.groupBy(subject).agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(f"_{i}") for i, m in enumerate(names)])
    listed = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(op).alias("op"), F.lit(float(t)).alias("threshold"), F.col(f"_{names.index(m)}").alias("_v"))
            for m, op, t in rules
        ]
    )
    found = values.select(subject, F.inline(listed))
    value = F.coalesce("_v", F.lit(0.0))
    passed = compare(value, F.col("op"), F.col("threshold"))
    # fixed values: the two messages
    good = F.format_string("%s = %.2f (OK)", "metric", value)
    bad = F.format_string("%s = %.2f (FAILED, threshold: %.2f)", "metric", value, "threshold")
    return found.select(
        subject,
        "metric",
        value.alias("value"),
        "threshold",
        passed.alias("passed"),
        F.col("_v").isNull().alias("missing"),
        F.when(passed, good).otherwise(bad).alias("message"),
    )


def gate_report(checks: DataFrame, subject: str) -> DataFrame:
    """One row per subject: all passed, number passed, and the messages of failed checks."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("message"))))
    return checks.groupBy(subject).agg(
        F.bool_and("passed").alias("passed"), F.count_if("passed").alias("n_passed"), failed.alias("failures")
    )


def response_issues(
    relevance: Column,
    coherence: Column,
    safety: Column,
    latency_p95: Column,
    min_relevance: float = 0.7,
    min_coherence: float = 0.7,
    min_safety: float = 0.9,
    max_latency_ms: int = 5000,
) -> Column:
    """Issues of the fixed response gate; an empty array passes."""

    def low(name: str, value: Column, least: float) -> Column:
        return F.when(value < least, F.format_string(f"{name} %.2f < %.2f", value, F.lit(least)))

    whole_ms = F.floor(latency_p95)
    late = F.when(latency_p95 > max_latency_ms, F.format_string("Latency %dms > %dms", whole_ms, F.lit(max_latency_ms)))
    return F.array_compact(
        F.array(
            low("Relevance", relevance, min_relevance),
            low("Coherence", coherence, min_coherence),
            low("Safety", safety, min_safety),
            late,
        )
    )


# --- scores and grades ----------------------------------------------------------------


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def grade_value(letter: Column) -> Column:
    """A is 4, F is 0."""
    return F.array_position(F.array(*[F.lit(x) for x in "FDCBA"]), letter).cast("int") - 1


def component_score() -> Column:
    """Weighted score over complexity, coverage, documentation and security columns."""
    cyclomatic = (30 - F.least(F.col("cyclomatic_avg"), F.lit(30.0))) / 30 * 100
    cognitive = (25 - F.least(F.col("cognitive_avg"), F.lit(25.0))) / 25 * 100
    coverage = (F.col("line_coverage") + F.col("branch_coverage") + F.col("mutation_score")) / 3
    documentation = (F.col("doc_coverage") + F.col("readme_score")) / 2
    security = F.when(F.col("vulnerabilities") > 0, 0.0).when(F.col("advisories") > 0, 50.0).otherwise(100.0)
    return (cyclomatic + cognitive) / 2 * 0.25 + coverage * 0.35 + documentation * 0.15 + security * 0.25


def share_score(test_coverage: Column, mutation: Column, complexity: Column, documentation: Column) -> Column:
    """Weighted score of shares in 0..1 and a complexity where lower is better."""
    simple = F.least(F.greatest(100 - complexity * 5, F.lit(0.0)), F.lit(100.0))
    return test_coverage * 100 * 0.35 + mutation * 100 * 0.25 + simple * 0.20 + documentation * 100 * 0.20


def recommendations(test_coverage: Column, mutation: Column, complexity: Column, documentation: Column) -> Column:
    """What to improve, as an array of messages."""
    return F.array_compact(
        F.array(
            F.when(test_coverage < 0.80, F.format_string("tests cover %.1f%%, below 80%%", test_coverage * 100)),
            F.when(mutation < 0.70, F.format_string("mutants caught: %.1f%%, below 70%%", mutation * 100)),
            F.when(complexity > 10, F.format_string("mean complexity %.1f, above 10", complexity)),
            F.when(
                documentation < 0.50,
                F.format_string("documented: %.1f%%, below 50%%", documentation * 100),
            ),
        )
    )


# --- alerts and expectations ----------------------------------------------------------


def alerts(metrics: DataFrame, subject: str, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Subjects for which any rule holds, with the rules that fired. Rules on absent metrics do not fire.

    The rules are a short list, so they become column expressions and ``metrics`` is not joined.
    """
    value = F.col("value")
    hits = [
        F.when((F.col("metric") == m) & compare(value, F.lit(op), F.lit(float(t))), F.lit(f"{m} {op} {float(t)}"))
        for m, op, t in rules
    ]
    fired = metrics.select(subject, F.explode(F.array_compact(F.array(*hits))).alias("rule"))
    return fired.groupBy(subject).agg(F.array_sort(F.collect_set("rule")).alias("fired"))


def expectations(
    df: DataFrame,
    columns: Sequence[str],
    allowed: Mapping[str, Sequence[str]],
    min_rows: int,
    groups: Mapping[str, int],
) -> DataFrame:
    """(check, passed) rows from one aggregate: row count, columns present, allowed values, number of groups."""
    checks = [F.struct(F.lit("row_count").alias("check"), (F.count("*") >= min_rows).alias("passed"))]
    checks += [F.struct(F.lit(f"has_{c}").alias("check"), F.lit(c in df.columns).alias("passed")) for c in columns]
    for c, values in allowed.items():
        only = F.coalesce(F.bool_and(F.col(c).isin(*values)), F.lit(True))
        checks.append(F.struct(F.lit(f"allowed_{c}").alias("check"), only.alias("passed")))
    for c, n in groups.items():
        checks.append(F.struct(F.lit(f"groups_{c}").alias("check"), (F.count_distinct(F.col(c)) == n).alias("passed")))
    return df.agg(F.array(*checks).alias("_c")).select(F.inline("_c"))


# --- guardrails -----------------------------------------------------------------------

# fixed values: blocked patterns and length limits of the guardrails
BLOCKED_PATTERNS = ("password", "credit card", "ssn", "api key")
MAX_PROMPT_LENGTH = 4096
MAX_OUTPUT_LENGTH = 2048


def input_violations(
    text: Column, blocked: Sequence[str] = BLOCKED_PATTERNS, max_length: int = MAX_PROMPT_LENGTH, pii: bool = True
) -> Column:
    """Length, blocked patterns and personal data, as an array of messages; an empty array passes."""
    long = F.when(
        F.length(text) > max_length, F.format_string("input length over the limit: %d > %d", F.length(text), F.lit(max_length))
    )
    named = F.transform(found_patterns(text, blocked), lambda p: F.concat(F.lit("forbidden text: "), p))
    personal = [
        F.when(has_email_signs(text), F.lit("personal data: e-mail")),
        F.when(has_ten_digits(text), F.lit("personal data: phone")),
    ]
    return F.concat(F.array_compact(F.array(long)), named, F.array_compact(F.array(*personal)) if pii else F.array().cast("array<string>"))


def output_violations(text: Column, max_length: int = MAX_OUTPUT_LENGTH) -> Column:
    long = F.when(
        F.length(text) > max_length, F.format_string("answer length over the limit: %d > %d", F.length(text), F.lit(max_length))
    )
    return F.array_compact(F.array(long))


def content_filter(text: Column, blocked: Sequence[str], topics: Sequence[str]) -> Column:
    """Struct (verdict, reason): Blocked by the first pattern found, else Flagged by the first topic, else Allowed."""
    pattern, topic = F.get(found_patterns(text, blocked), F.lit(0)), F.get(found_patterns(text, topics), F.lit(0))
    verdict = F.when(pattern.isNotNull(), "Blocked").when(topic.isNotNull(), "Flagged").otherwise("Allowed")
    return F.struct(verdict.alias("verdict"), F.coalesce(pattern, topic, F.lit("")).alias("reason"))
