import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from marlstone.llm import toxicity as tox
from marlstone.llm.queries import op10_toxicity
from tests.llm.brute import by_id, empty_documents, odd_documents, rows


def grams(text, table):
    """Hashes of all grams of a text, one by one."""
    folded = [int(table[min(ord(c), 0xFFFF)]) for c in text or ""]
    found = set()
    for size in tox.SIZES:
        for i in range(len(folded) - size + 1):
            hashed = 0
            for c in folded[i : i + size]:
                hashed = (hashed * int(tox._SPREAD) + c) & 0xFFFFFFFF
            found.add(((hashed + size) * int(tox._SPREAD) & 0xFFFFFFFF) >> (32 - 22))
    return found


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_ratios_and_scores_equal_brute_force(spark, folder):
    docs, labels = rows(folder, "documents")[:60], {r["doc_id"]: r["toxic"] for r in rows(folder, "labels")}
    table = tox.fold_table()
    own = {d["doc_id"]: grams(d["text"], table) for d in docs}
    known = [i for i in own if i in labels and not held_out(i)]
    sample = spark.createDataFrame([(labels[d["doc_id"]], d["text"]) for d in docs if d["doc_id"] in known], "label int, text string").repartition(3)
    slots, ratio = tox.ratios(sample)
    p = sum(labels[i] for i in known)
    n = len(known) - p
    want = {}
    for g in set().union(*(own[i] for i in known)):
        a, b = sum(g in own[i] and labels[i] for i in known), sum(g in own[i] and not labels[i] for i in known)
        r = math.log((a + 1) / (p + 2)) - math.log((b + 1) / (n + 2))
        if abs(r) / math.sqrt(1 / (a + 1) + 1 / (b + 1)) >= tox.ERRORS - 1e-9:
            want[g] = r
    assert len(want) <= tox.FEATURES
    assert dict(zip(slots.tolist(), np.round(ratio, 9).tolist(), strict=True)) == {g: round(r, 9) for g, r in sorted(want.items())}
    chosen = np.array(sorted(random.Random(1).sample(sorted(set().union(*own.values())), 200)))
    model = tox.Classifier(chosen, np.linspace(-1, 1, 200), -0.5)
    df = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string")
    out = by_id(tox.score(df, model, ["doc_id"]))
    weight = dict(zip(chosen.tolist(), model.weights, strict=True))
    for i, found in own.items():
        assert math.isclose(out[i]["score"], 1 / (1 + math.exp(0.5 - sum(weight.get(g, 0) for g in found))), rel_tol=1e-9)


def test_descent_reaches_the_minimum():
    rng = np.random.default_rng(2)
    on = rng.random((80, 5)) < 0.4
    texts, features = np.nonzero(on)
    ratio = np.array([2.0, -1.0, 1.5, 0.5, 3.0])
    labels = (on[:, 0] | (rng.random(80) < 0.2)).astype(float)

    def loss(w, b):
        margin = b + (on * ratio) @ w
        return np.mean(np.logaddexp(0, margin) - labels * margin) + 0.5e-3 * (w @ w)

    weights, bias = tox.descend(texts, features, labels, ratio, steps=3000)
    best = loss(weights, bias)
    for _ in range(200):
        assert best <= loss(weights + rng.normal(0, 0.05, 5), bias + rng.normal(0, 0.05)) + 1e-5


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out, labels = by_id(op10_toxicity(spark, folder)), rows(folder, "labels")
    assert len(out) == len(rows(folder, "documents"))
    assert all(r["held_out"] == held_out(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in out.items())
    tested = [r for r in labels if held_out(r["doc_id"])]
    right = sum(out[r["doc_id"]]["predicted"] == r["toxic"] for r in tested)
    assert right >= 0.93 * len(tested)


def test_labels_of_held_out_rows_change_nothing(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    before = by_id(tox.toxicity(docs, labels))
    turned = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    after = by_id(tox.toxicity(docs.withColumn("lang", F.lit("xx")), turned))
    assert all(math.isclose(before[i]["score"], after[i]["score"], rel_tol=1e-9) for i in before)


def test_odd_documents(spark):
    df = odd_documents(spark)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(12)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    out = tox.toxicity(df, labels).collect()
    assert len(out) == df.count() and all(0 <= r.score <= 1 for r in out)
    none = tox.toxicity(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert tox.toxicity(empty_documents(spark), labels).collect() == []


def test_repeated_rows_of_a_document_enter_the_sample_once(spark):
    docs = spark.createDataFrame([(1, "hot text")] * 500 + [(1, "hot words"), (3, "b"), (4, None)], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    known = {i for i in (1, 3, 4) if not held_out(i)}
    want = sorted((t, x) for i, t, x in ((1, 1, "hot text"), (3, 0, "b"), (4, 0, "")) if i in known)
    assert 1 in known
    assert sorted((r.label, r.text) for r in tox.labelled(docs, labels).collect()) == want
    assert tox.labelled(docs, labels, rows=1).count() == 1
