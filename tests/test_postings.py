"""The stored inverted index: contents, exactness of the bounds, and what a search reads."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.functions import text
from marlstone.operators import postings as ps
from marlstone.operators import retrieval as re
from marlstone.workspace import scope, state_of, stored


@pytest.fixture(scope="module")
def corpus(spark):
    """Words of a Zipf-like vocabulary; a third of the rows are one text."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(3000)], k=rng.randrange(0, 90))) for _ in range(1400)]
    texts += ["the same text again w1 w2"] * 700 + [None, "", " \t "]
    rows = [(i, f"s{i % 3}", t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id bigint, part string, text string").repartition(5).cache()


@pytest.fixture(scope="module")
def index(spark, corpus, tmp_path_factory):
    return ps.build(corpus, ["doc_id", "part"], "text", str(tmp_path_factory.mktemp("postings") / "index"))


@pytest.fixture(scope="module")
def questions(spark):
    asked = [(0, "w900 w901 W1"), (1, "same text"), (2, "nothing there"), (3, "w0 w1 w2 w3 w4"), (4, ""), (5, "w2500"), (6, "w17 w17 again")]
    return spark.createDataFrame(asked, "query_id bigint, question string")


def test_index_holds_every_word_once(corpus, index):
    want = {}
    for r in corpus.collect():
        for w in (r.text or "").split():
            n, texts = want.get(w, (0, set()))
            want[w] = n + 1, texts | {r.doc_id}
    assert {r.term: (r.occurrences, r.n) for r in index.terms.collect()} == {w: (n, len(t)) for w, (n, t) in want.items()}
    assert index.blocks.agg(F.max(F.size("ids"))).first()[0] <= ps.TILE
    n, mean = index.size.first()
    assert n == corpus.count() and mean == pytest.approx(sum(c for c, _ in want.values()) / n)


@pytest.mark.parametrize("k", [1, 5, 50])
def test_search_with_bounds_equals_the_scan_of_all_texts(corpus, index, questions, k):
    got = {(r.query_id, r.doc_id, r.part, r.score, r["rank"]) for r in ps.search(index, questions, k).collect()}
    want = {(r.query_id, r.doc_id, r.part, r.score, r["rank"]) for r in re.bm25_search(corpus, ["doc_id", "part"], questions, k).collect()}
    assert got == want and got


def test_bounds_skip_tiles(index, questions):
    every, kept = ps.kept_tiles(index, ps.asked_terms(index, questions), 3)
    n, m = every.count(), kept.count()
    assert 0 < m < 0.7 * n
    assert every.join(kept, ["query_id", "tile"]).count() == m


def test_only_asked_terms_are_read_and_no_text(index, questions):
    plan = ps.search(index, questions, 3)._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan and "question" not in plan
    rare = ps.scored(index, ps.asked_terms(index, questions.where("query_id = 5")), index.blocks.selectExpr("CAST(5 AS BIGINT) AS query_id", "tile").distinct())
    assert "dynamicpruning" in rare._jdf.queryExecution().executedPlan().toString()


def test_occurrences_stay_with_their_text(spark, corpus, index):
    wanted = corpus.selectExpr("CAST(1 AS BIGINT) AS query_id", "doc_id", "part").withColumn("term", F.lit("w1"))
    got = {r.doc_id: r.n for r in ps.occurrences(index, wanted).collect()}
    want = {r.doc_id: (r.text or "").split().count("w1") for r in corpus.collect()}
    assert got == {i: n for i, n in want.items() if n}


def test_empty_corpus(spark, tmp_path, questions):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    index = ps.build(empty, ["doc_id"], "text", str(tmp_path / "empty"))
    assert ps.search(index, questions, 3).collect() == []


def test_stored_things_follow_their_source_and_their_scope(spark, tmp_path):
    source, made = str(tmp_path / "source"), []

    def get():
        return stored(spark, ("n", source, state_of(spark, source)), "n", lambda path: (made.append(path), spark.read.parquet(source).write.parquet(path)))

    spark.range(3).write.parquet(source)
    assert get() == get() and len(made) == 1
    spark.range(2).write.mode("append").parquet(source)
    assert spark.read.parquet(get()).count() == 5 and len(made) == 2
    with scope(spark):
        spark.range(1).write.mode("append").parquet(source)
        inner = get()
        assert spark.read.parquet(inner).count() == 6
    assert get() != inner and spark.read.parquet(get()).count() == 6


def test_no_text_is_split_above_a_generator(spark, corpus, questions):
    """Splitting a text once for every word in it is quadratic in its length."""
    seen = []
    import marlstone.operators.retrieval as module

    keep = module.written
    module.written = lambda df, label: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), keep(df, label))[1]
    try:
        module.bm25_search(corpus, ["doc_id"], questions, 3)
    finally:
        module.written = keep
    lines = seen[0].splitlines()
    generator = next(i for i, line in enumerate(lines) if "explode" in line)
    assert not any("split(" in line for line in lines[:generator])


def test_a_term_has_one_stored_row_per_segment(spark):
    """Before, every term had a row for each tile of 64 texts, which the layout shuffled one by one."""
    rows = spark.range(0, 1000, 1, 1).selectExpr("id AS doc_id", "concat('every word', id % 7, ' ', IF(id % 100 = 0, NULL, '')) AS text")
    held = ps.segments(rows, ["doc_id"], "text", lambda n, long: n / long).collect()
    assert sorted(r.term for r in held) == ["every", *[f"word{i}" for i in range(7)]]
    every = next(r for r in held if r.term == "every")
    assert len(every.tiles) == -(-1000 // ps.TILE) and sum(len(t.ids) for t in every.tiles) == 990
    assert {t.top for t in every.tiles} == {0.5}


def folder_bytes(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_the_stored_index_is_smaller_than_the_texts(spark, tmp_path):
    """Before, each rare word was a nested row of its own, stored and shuffled; the index took several times the texts."""
    rng = random.Random(5)
    texts = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(30_000)}" for _ in range(300))) for i in range(600)]
    texts = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2)
    texts.write.parquet(str(tmp_path / "texts"))
    index = ps.build(spark.read.parquet(str(tmp_path / "texts")), ["doc_id"], "text", str(tmp_path / "index"))
    assert folder_bytes(tmp_path / "index" / "blocks") < folder_bytes(tmp_path / "texts")
    assert index.stored.count() <= 2 * (ps.BUCKETS + 1)


def test_bounds_shuffle_no_stored_row_to_its_term(spark, index, questions):
    """Before, the whole index was shuffled to be joined when the asked terms were not broadcast, and each (question, tile, bucket) was a row."""
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    asked = ps.written(ps.asked_terms(index, questions), "asked")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ps.bounds(index, asked)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "SortMergeJoin" not in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert shuffles and all("hashpartitioning(segment" in line or "hashpartitioning(bucket" in line for line in shuffles)


@pytest.mark.parametrize("limit", ["BLOCK_QUERIES", "BLOCK_TERMS", "SEGMENT", "SEGMENT_BYTES", "MATRIX_CELLS"])
def test_search_in_many_parts_equals_the_scan(spark, corpus, questions, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(ps, limit, {"SEGMENT": 70, "SEGMENT_BYTES": 2000, "MATRIX_CELLS": 9}.get(limit, 3))
    index = ps.build(corpus, ["doc_id", "part"], "text", str(tmp_path / "index"))
    got = {(r.query_id, r.doc_id, r.part, r.score, r["rank"]) for r in ps.search(index, questions, 5).collect()}
    want = {(r.query_id, r.doc_id, r.part, r.score, r["rank"]) for r in re.bm25_search(corpus, ["doc_id", "part"], questions, 5).collect()}
    assert got == want and got
    wanted = corpus.selectExpr("CAST(1 AS BIGINT) AS query_id", "doc_id", "part", "explode(array('w1', 'w2', 'again', 'never', NULL, '')) AS term")
    found = ps.occurrences(index, wanted).collect()
    words = {r.doc_id: (r.text or "").split() for r in corpus.collect()}
    assert {(r.doc_id, r.term): r.n for r in found} == {(i, t): w.count(t) for i, w in words.items() for t in ("w1", "w2", "again") if t in w}


def test_terms_counted_in_pieces_are_each_there_once(spark, corpus, index, tmp_path, monkeypatch):
    monkeypatch.setattr(ps, "PIECE_TERMS", 7)
    pieces = ps.counted_terms(index.stored).select("bucket", "term", "n", "occurrences", "n_blocks")
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, index.terms.select(*pieces.columns).collect()))


def test_ids_of_other_kinds_and_odd_words(spark, tmp_path):
    rows = [(None, "ß Straße 語 w"), ("b", "w W w x 🙂"), ("a", "w w w\ttab"), ("", "🙂 " * 300), ("z", "x" * 100_000 + " w"), ("n", None)]
    corpus = spark.createDataFrame(rows, "id string, text string")
    index = ps.build(corpus, ["id"], "text", str(tmp_path / "index"))
    asked = spark.createDataFrame([("q1", "w"), ("q2", "🙂 語"), (None, "w"), ("q3", "x" * 100_000)], "query_id string, question string")
    got = [(r.query_id, r.id, r.score, r["rank"]) for r in ps.search(index, asked, 4).collect()]
    want = [(r.query_id, r.id, r.score, r["rank"]) for r in re.bm25_search(corpus.where("id IS NOT NULL"), ["id"], asked.where("query_id IS NOT NULL"), 4).collect()]
    assert {q for q, *_ in got} == {"q1", "q2", "q3"} == {q for q, *_ in want}
    assert sorted(i or "" for q, i, *_ in got if q == "q1") == ["", "a", "b", "z"] and [i for q, i, *_ in got if q == "q3"] == ["z"]
    tied = spark.createDataFrame([("b", "w"), (None, "w"), ("a", "w")], "id string, text string")
    same = ps.search(ps.build(tied, ["id"], "text", str(tmp_path / "tied")), asked, 3).where("query_id = 'q1'").orderBy("rank").collect()
    assert [r.id for r in same] == [None, "a", "b"]


def test_packed_columns_come_back_as_they_were():
    import numpy as np

    columns = [np.array([0, 255, 256, 1 << 40]), np.array([], dtype=np.int64), np.zeros(3, np.int64), np.arange(70_000)]
    assert [list(c) for c in ps._unpack(ps._pack(*columns))] == [list(c) for c in columns]
    tops = np.array([0.5, 1 / 3, 2.4999999, 1e-9, 12345.678])
    read = ps._tops(ps._rounded_up(tops))
    assert (read >= tops).all() and (read <= tops * 1.001).all() and read[0] == 0.5


def test_words_are_parted_where_the_jvm_parts_them(spark, tmp_path):
    """All control characters, and spaces beyond ASCII."""
    odd = [chr(i) for i in range(1, 161)] + list("\u1680\u2000\u2003\u2028\u202f\u3000\ufeff\u0130")
    rows = [(i, f"{c}Left{c}{c}right{i} {c}") for i, c in enumerate(odd)]
    corpus = spark.createDataFrame(rows, "doc_id bigint, text string")
    index = ps.build(corpus, ["doc_id"], "text", str(tmp_path / "index"))
    want = corpus.select("doc_id", F.explode(text.words(F.col("text"))).alias("term")).groupBy("term").agg(F.countDistinct("doc_id"), F.count("*"))
    assert sorted(map(tuple, index.terms.select("term", "n", "occurrences").collect())) == sorted(map(tuple, want.collect()))
    assert index.size.first()["mean"] == pytest.approx(corpus.select(F.avg(F.size(text.words(F.col("text"))))).first()[0])


def test_rank_fusion_stores_little_more_than_its_texts_and_vectors(spark, tmp_path, monkeypatch):
    """Before, 2.9 times the input was stored here, and more was shuffled."""
    import pathlib

    from marlstone import workspace
    from marlstone.plans import load

    rng = random.Random(3)
    (tmp_path / "in").mkdir()
    texts = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(20_000)}" for _ in range(300))) for i in range(1500)]
    spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    asked = spark.createDataFrame([(i, t[:200]) for i, t in texts[:100]], "item_id bigint, text string")
    asked.write.parquet(str(tmp_path / "in" / "benchmark.parquet"))
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path / "shared"))
    with workspace.scope(spark):
        found = load()["doc_02_rank_fusion"].run(spark, str(tmp_path / "in")).collect()
        left = folder_bytes(pathlib.Path(tmp_path / "shared"))
    assert len(found) == 500
    assert left < 2.6 * folder_bytes(tmp_path / "in")
