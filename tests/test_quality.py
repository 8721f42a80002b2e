import pytest
from pyspark.sql import functions as F

from marlstone.operators import experiments as ex
from marlstone.operators import quality as qu


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture(scope="module")
def samples(spark):
    i = spark.range(100)
    return {
        "base": i.select((100 + 0.1 * F.col("id")).alias("x")),
        "ok": i.select((101 + 0.1 * F.col("id")).alias("x")),
        "drift": i.select((150 + 0.5 * F.col("id")).alias("x")),
    }


def test_psi(samples):
    assert qu.psi(samples["base"], samples["ok"], "x").first()["psi"] == pytest.approx(0.479579, abs=1e-6)
    row = qu.psi(samples["base"], samples["drift"], "x").first()
    assert row["psi"] == pytest.approx(53.652604, abs=1e-6) and row["band"] == "significant"
    same = qu.psi(samples["base"], samples["base"], "x").first()
    assert same["psi"] == pytest.approx(0) and same["band"] == "none"


def shifted(base, current):
    both = base.withColumn("b", F.lit(True)).unionByName(current.withColumn("b", F.lit(False))).withColumn("f", F.lit("f"))
    return qu.mean_shift(both, "f", "x", F.col("b")).first()


def test_mean_shift(samples):
    ok, drift = shifted(samples["base"], samples["ok"]), shifted(samples["base"], samples["drift"])
    assert ok["mean_shift"] == pytest.approx(0.009528, abs=1e-6) and not ok["drift"]
    assert drift["mean_shift"] == pytest.approx(0.665079, abs=1e-6) and drift["drift"]
    zero = samples["base"].select((F.col("x") * 0).alias("x"))
    assert shifted(zero, samples["ok"])["mean_shift"] == 0


GATE = [("accuracy", ">=", 0.90), ("f1_score", ">=", 0.85), ("latency_p99_ms", "<=", 100), ("error_rate", "<=", 0.01)]


def test_gates(spark):
    good = {"accuracy": 0.95, "f1_score": 0.92, "latency_p99_ms": 85.0, "error_rate": 0.005}
    bad = {"accuracy": 0.88, "f1_score": 0.80, "latency_p99_ms": 150.0, "error_rate": 0.02}
    part = {"accuracy": 0.95}
    rows = [(n, k, v) for n, m in {"good": good, "bad": bad, "part": part}.items() for k, v in m.items()]
    checks = qu.check_gates(spark.createDataFrame(rows, "model string, metric string, value double"), "model", GATE)
    report = {r["model"]: r for r in qu.gate_report(checks, "model").collect()}
    assert report["good"]["passed"] and report["good"]["failures"] == []
    assert not report["bad"]["passed"] and report["bad"]["n_passed"] == 0
    assert "accuracy = 0.88 (FAILED, threshold: 0.90)" in report["bad"]["failures"]
    missing = {r["metric"]: (r["passed"], r["missing"]) for r in checks.where("model = 'part'").collect()}
    assert missing["error_rate"] == (True, True) and missing["f1_score"] == (False, True)
    with pytest.raises(ValueError):
        qu.check_gates(checks, "model", [("a", "~", 1)])


def test_response_gate(spark):
    def issues(*values):
        return one(spark, qu.response_issues(*[F.lit(v) for v in values]))

    assert issues(0.7, 0.7, 0.9, 5000.0) == []
    assert issues(0.5, 0.9, 0.5, 6000.0) == ["Relevance 0.50 < 0.70", "Safety 0.50 < 0.90", "Latency 6000ms > 5000ms"]


def test_grades(spark):
    scores = {95.0: ("A", 4), 90.0: ("A", 4), 89.9: ("B", 3), 70.0: ("C", 2), 60.0: ("D", 1), 10.0: ("F", 0)}
    for score, (letter, value) in scores.items():
        assert one(spark, qu.grade(F.lit(score))) == letter
        assert one(spark, qu.grade_value(F.lit(letter))) == value


def test_guards(spark):
    def check(text):
        return one(spark, qu.input_violations(F.lit(text)))

    assert check("What is machine learning?") == []
    assert check("My password is secret123") == ["forbidden text: password"]
    assert check("Contact user@email.com") == ["personal data: e-mail"]
    assert check("call 555-123-4567 x") == ["personal data: phone"]
    assert check("a" * 4097) == ["input length over the limit: 4097 > 4096"]
    assert one(spark, qu.output_violations(F.lit("a" * 2048))) == []


def test_content_filter(spark):
    def verdict(text):
        return tuple(one(spark, qu.content_filter(F.lit(text), ["bomb"], ["politics", "war"])))

    assert verdict("A BOMB in politics") == ("Blocked", "bomb")
    assert verdict("war and Politics") == ("Flagged", "politics")
    assert verdict("fine") == ("Allowed", "")


def test_alerts(spark):
    rows = [("a", "accuracy", 0.8), ("a", "error_rate", 0.01), ("b", "accuracy", 0.95)]
    metrics = spark.createDataFrame(rows, "model string, metric string, value double")
    rules = [("accuracy", "<", 0.90), ("error_rate", ">", 0.05), ("psi", ">", 0.25)]
    assert [(r["model"], r["fired"]) for r in qu.alerts(metrics, "model", rules).collect()] == [("a", ["accuracy < 0.9"])]


def test_variants(spark):
    variants = [("control", 0.5), ("treatment", 0.5)]
    users = spark.range(200)
    got = users.select(ex.assign_variant(F.col("id"), variants, F.lit(True)).alias("v")).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"control": 100, "treatment": 100}
    assert one(spark, ex.assign_variant(F.lit(7), variants, F.lit(False))) is None
    assert one(spark, ex.pick_variant(F.lit(0.999), [("a", 0.3), ("b", 0.3)])) == "b"
    assert one(spark, ex.hashed_user(F.lit("user-1"))) == one(spark, ex.hashed_user(F.lit("user-1")))
