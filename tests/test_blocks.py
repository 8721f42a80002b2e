"""Block scoring against brute force, on both ways of meeting the queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import blocks, vectors


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    corpus = rng.integers(-3, 4, size=(150, 4)).astype(float)  # small integers: many ties
    queries = rng.integers(-3, 4, size=(17, 4)).astype(float)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id bigint, embedding array<double>").repartition(5)
    q = spark.createDataFrame([(i + 100, v.tolist()) for i, v in enumerate(queries)], "qid bigint, query array<double>")
    return corpus, queries, c, q


def brute(corpus, queries, metric, k):
    scores = np.round(vectors.similarities(corpus, queries, metric), 8)
    found = set()
    for j in range(len(queries)):
        order = sorted(range(len(corpus)), key=lambda i: (-scores[i, j], i))[:k]
        found |= {(j + 100, i, scores[i, j] + 0.0, r + 1) for r, i in enumerate(order)}
    return found


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
@pytest.mark.parametrize("sizes", [{}, {"block_queries": 4}])
@pytest.mark.parametrize("k", [1, 6, 400])
def test_top_k(data, metric, sizes, k):
    corpus, queries, c, q = data
    got = blocks.top_k(c, ["id"], q, "qid", vectors.vector_scorer(metric), k, **sizes)
    assert {(r["query_id"], r["id"], r["score"] + 0.0, r["rank"]) for r in got.collect()} == brute(corpus, queries, metric, k)


def test_small_matrices(data, monkeypatch):
    corpus, queries, c, q = data
    monkeypatch.setattr(blocks, "MATRIX_CELLS", 40)
    got = blocks.top_k(c, ["id"], q, "qid", vectors.vector_scorer("dot"), 3)
    assert {(r["query_id"], r["id"], r["score"] + 0.0, r["rank"]) for r in got.collect()} == brute(corpus, queries, "dot", 3)


@pytest.mark.parametrize("most", [4096, 5])
def test_score_summary(data, most):
    corpus, queries, c, q = data
    got = blocks.score_summary(c, ["id"], q, "qid", vectors.vector_scorer("cosine"), block_queries=most).collect()
    scores = np.round(vectors.similarities(corpus, queries, "cosine"), 8)
    assert len(got) == len(queries)
    for r in got:
        s = scores[:, r["query_id"] - 100]
        assert r["n_scored"] == len(corpus) and r["best_score"] == s.max()
        assert r["id"] == min(np.flatnonzero(s == s.max()))
        assert r["mean_score"] == pytest.approx(s.mean())


def test_zero_norm_scores_zero():
    got = vectors.similarities(np.array([[0.0, 0.0], [1.0, 0.0]]), np.array([[1.0, 0.0]]), "cosine")
    assert got.tolist() == [[0.0], [1.0]]


def test_metadata_predicates(spark):
    df = spark.sql("SELECT 1 AS id, map('a', 'x') AS m UNION ALL SELECT 2, map('a', 'y') UNION ALL SELECT 3, map('b', 'x')")
    m = F.col("m")

    def ids(c):
        return sorted(r["id"] for r in df.where(c).collect())

    assert ids(vectors.equals(m, "a", "x")) == [1]
    assert ids(vectors.not_equals(m, "a", "x")) == [2, 3]
    assert ids(vectors.one_of(m, "a", ["x", "y"])) == [1, 2]


def test_nearest_others(spark, data):
    corpus, _, c, _ = data
    vectors_in = c.select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    got = vectors.nearest_others(vectors_in, 3, block_queries=20)
    scores = np.round(vectors.similarities(corpus, corpus, "cosine"), 8)
    for r in got.collect():
        order = sorted((j for j in range(len(corpus)) if j != r["query_id"]), key=lambda j: (-scores[j, r["query_id"]], j))
        assert order[r["rank"] - 1] == r["other_id"]


def test_text_ids_and_missing_text(spark):
    corpus = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", None), ("d", "")], "id string, text string")
    asked = spark.createDataFrame([("q", "x y")], "qid string, query string")
    got = blocks.top_k(corpus, ["id"], asked, "qid", vectors.text_scorer(16), 4).orderBy("rank").collect()
    assert [(r["query_id"], r["id"], r["score"]) for r in got] == [("q", "a", 1.0), ("q", "b", 1.0), ("q", "c", 0.0), ("q", "d", 0.0)]


def test_no_queries_no_rows(spark, data):
    _, _, c, q = data
    assert blocks.top_k(c, ["id"], q.limit(0), "qid", vectors.vector_scorer("dot"), 3).count() == 0
    assert blocks.top_k(c.limit(0), ["id"], q, "qid", vectors.vector_scorer("dot"), 3).count() == 0


def test_not_a_number_takes_no_place(spark):
    rows = [(0, [0.9]), (1, [0.8]), (2, [0.7]), (3, [float("nan")]), (4, [0.1]), (5, [float("nan")])]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(9, [1.0])], "qid long, query array<double>")
    got = blocks.top_k(corpus, ["id"], asked, "qid", vectors.vector_scorer("dot"), 3).orderBy("rank").collect()
    assert [r["id"] for r in got] == [0, 1, 2]
    total = blocks.score_summary(corpus, ["id"], asked, "qid", vectors.vector_scorer("dot")).first()
    assert (total["n_scored"], total["id"]) == (4, 0) and total["mean_score"] == pytest.approx(0.625)


def test_bad_vectors_are_set_aside_with_a_reason(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [])]
    good, bad = vectors.split_by_dimension(spark.createDataFrame(rows, "id long, embedding array<double>"), "embedding", 2)
    assert [r["id"] for r in good.collect()] == [0]
    assert {r["id"]: r["reason"] for r in bad.collect()} == {1: "missing", 2: "length", 3: "not a number", 4: "not a number", 5: "length"}
