import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlstone.llm import sharding
from marlstone.llm.queries import op8_sharding
from tests.llm.brute import by_id, empty_documents, odd_documents, rows


def test_query_places_every_document(spark, folder):
    found = op8_sharding(spark, folder)
    out, docs = by_id(found), rows(folder, "documents")
    assert len(out) == len(docs)
    slots = Counter()
    for d in docs:
        raw, r = (d["text"] or "").encode(), out[d["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"], r["slot"]] += 1
    assert max(slots.values()) == 1
    count = Counter(shard for shard, _ in slots)
    assert all(slots[s, i] == 1 for s, n in count.items() for i in range(n))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shares_follow_weights_and_few_keys_move(spark):
    keys = spark.range(40000)
    weights = [1.0, 2.0, 1.0, 4.0]
    out = keys.select(
        "id",
        sharding.shard_of(F.col("id"), weights).alias("a"),
        sharding.shard_of(F.col("id"), [*weights, 2.0]).alias("b"),
        sharding.shard_of(F.col("id"), [1.0, 2.0, 3.0, 4.0]).alias("c"),
    ).collect()
    share = Counter(r.a for r in out)
    assert all(abs(share[i] / 40000 - w / 8) < 0.01 for i, w in enumerate(weights))
    moved = [r for r in out if r.a != r.b]
    assert all(r.b == 4 for r in moved) and abs(len(moved) / 40000 - 0.2) < 0.01
    assert all(r.c == 2 for r in out if r.a != r.c)


def test_scores_equal_brute_force(spark):
    import math

    weights = [1.0, 0.5, 3.0]
    keys = spark.range(200).crossJoin(spark.range(3).select(F.col("id").cast("int").alias("shard")))
    drawn = keys.select("id", "shard", F.xxhash64("id", "shard").alias("hash")).collect()
    best = {}
    for r in drawn:
        u = ((r.hash % (1 << 64) >> 11) + 0.5) / (1 << 53)
        best[r.id] = max(best.get(r.id, (-1.0, -1)), (weights[r.shard] / -math.log(u), r.shard))
    out = spark.range(200).select("id", sharding.shard_of(F.col("id"), weights).alias("s")).collect()
    assert {r.id: r.s for r in out} == {i: s for i, (_, s) in best.items()}


def test_odd_documents(spark):
    df = odd_documents(spark).withColumn("shard", F.lit("clash"))
    out = sharding.assign(df, "doc_id", [1.0, 1.0], ["text"], pieces=3).collect()
    assert len(out) == df.count() and {r.shard for r in out} <= {0, 1}
    for s in (0, 1):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert sharding.placed_documents(empty_documents(spark)).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("x"), [1.0, 0.0])


def test_rows_of_one_key_are_numbered_in_many_pieces(spark):
    """A third of all rows has one key, and as many have none; every slot is there once, and no piece holds more than a few hundredths of the rows."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.placed_documents(df).collect()
    for shard in {r.shard for r in out}:
        own = sorted(r.slot for r in out if r.shard == shard)
        assert own == list(range(len(own)))
    slim = df.select("doc_id", F.crc32(F.col("text").cast("binary")).alias("c"))
    plan = sharding.assign(slim, "doc_id", [1.0] * 4, ["c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "shard piece" in plan
    pieces = slim.groupBy(F.pmod(F.xxhash64(F.lit("piece"), "doc_id", "c"), F.lit(sharding.PIECES))).count()
    assert pieces.agg(F.max("count")).first()[0] < 60
    assert all(r.grown_shard in (r.shard, 40) for r in out)
