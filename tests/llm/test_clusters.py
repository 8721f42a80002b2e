import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import clusters as c
from marlstone.llm.queries import SQL, op12_clusters
from tests.oracle import connect, differences


def brute(rows):
    """Clusters of rows (vec_id, components) with Python integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in order[:8]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), k) for k, p in enumerate(points))

    for _ in range(10):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        points = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else p for k, p in enumerate(points)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = [sum(d for _, k, d in found if k == n) for n in range(len(points))]
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    top = (1 << 63) - 1
    return sorted(((i if i is not None else -99, k, min(d, top), min(total[k], top), min(sum(total), top), digest[k]) for i, k, d in found))


def out(df):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(tuple(-99 if r[n] is None else r[n] for n in names) for r in c.cluster(df).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, vector string").repartition(3)


def test_query_equals_sql(spark, folder):
    assert differences(op12_clusters(spark, folder), connect(folder), SQL["op12_clusters"]) == ""


def test_clusters_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.25, -0.5]) + (i % 5) for _ in range(64)]) for i in range(120)]
    rows += [(500 + i, [0.125] * 64) for i in range(60)]  # a third of all rows alike
    rows += [(3, rows[0][1]), (3, rows[0][1]), (None, rows[1][1]), (900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65)]
    rows += [(904, [None] + [1.0] * 63), (905, [math.nan] + [1.0] * 63), (906, [math.inf] + [1.0] * 63)]
    assert out(frame(spark, rows)) == brute(rows)


def test_ties_few_vectors_and_empty_tables(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(5)]
    assert out(frame(spark, rows)) == brute(rows)
    assert out(frame(spark, rows).limit(0)) == []
    assert out(frame(spark, [(1, None)])) == []


def test_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e6, -3e5, 2.0, 4e9]) * rng.random() for _ in range(64)]) for i in range(40)]
    assert out(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("values", [2, 50, 100_000])
def test_dictionaries_are_lossless_and_blocks_grow_where_values_repeat(values):
    rng = np.random.default_rng(1)
    vectors = rng.integers(0, values, (3000, 64)).astype(float)
    blocks = c.blocks_of(vectors)
    assert np.array_equal(np.hstack([entries[codes] for entries, codes in blocks]), vectors)
    assert all(len(np.unique(entries, axis=0)) == len(entries) for entries, _ in blocks)
    widths = [entries.shape[1] for entries, _ in blocks]
    assert sum(widths) == 64
    assert max(widths) > 4 if values == 2 else max(widths) <= 2
    assert c.blocks_of(np.ones((10, 64)))[0][0].shape == (1, 64)


def test_vectors_do_not_move(spark, folder):
    named = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", c.scaled(F.col("embedding")).alias("vector"))
    plan = c.encoded(named)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
