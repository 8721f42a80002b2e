"""Operator 12: k-means on integer vectors through dictionaries of distinct subvectors.

Vectors are written once as chunks. A chunk's dimensions are cut into blocks; a block has a dictionary of its distinct subvectors
and one code per vector, from which the vectors can be put together again without loss. A round computes the exact squared
distances of the dictionary entries to the centroids once, and a vector's distance is the sum of those that its codes name. Only
the centroids travel to the tasks, and only sums per cluster travel back; vectors never move.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.workspace import written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Vectors of a chunk, and the widest block. Neighbouring blocks grow together while they have few distinct subvectors.
CHUNK, WIDEST = 16_384, 64
#: Blocks whose subvectors repeat less often than this (on average) stay apart.
REPEATS = 4
#: Scaled components are below this, so sums of them stay exact. Anything larger counts as not finite.
LIMIT = float(1 << 62)
#: Below this, 64 squared differences fit a 64-bit integer; larger ones are computed with integers of any length.
_SMALL = 1 << 27
_LARGEST = (1 << 63) - 1


def scaled(vector: Column, dimensions: int = DIMENSIONS, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as doubles; null unless there are ``dimensions`` of them, none null or non-finite."""
    values = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    fine = F.forall(vector.cast("array<double>"), lambda x: F.coalesce(F.abs(x) * scale < LIMIT, F.lit(False)) & ~F.isnan(x))
    return F.when((F.size(vector) == dimensions) & fine, values)


def blocks_of(vectors: np.ndarray, widest: int = WIDEST) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct subvectors, code of each vector) of neighbouring blocks of dimensions.

    Blocks begin as single dimensions. Two of them become one as long as their distinct subvectors repeat ``REPEATS`` times on average.
    """
    found = [tuple(np.unique(column, return_inverse=True)) for column in vectors.T]
    blocks = [(values[:, None], codes.ravel()) for values, codes in found]
    width = 1
    while width < widest and len(blocks) > 1:
        merged, grown = [], False
        for i in range(0, len(blocks) - 1, 2):
            (left, one), (right, two) = blocks[i], blocks[i + 1]
            distinct, codes = np.unique(one.astype(np.int64) * len(right) + two, return_inverse=True)
            if len(distinct) * REPEATS <= max(len(vectors), REPEATS):
                merged.append((np.hstack([left[distinct // len(right)], right[distinct % len(right)]]), codes.ravel()))
                grown = True
            else:
                merged += [blocks[i], blocks[i + 1]]
        if len(blocks) % 2:
            merged.append(blocks[-1])
        if not grown:
            break
        blocks, width = merged, 2 * width
    return blocks


def encoded(vectors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunks of ``vectors`` (vec_id, vector): ids, and for each block its width, dictionary (doubles) and codes (32 bits). Written by the caller."""

    def run(batches):
        held, ids, size = [], [], 0

        def out():
            table, names = np.concatenate(held), [i for part in ids for i in part]
            blocks = blocks_of(table)
            row = [
                pa.array([names], type=pa.list_(pa.int64())),
                pa.array([[entries.shape[1] for entries, _ in blocks]], type=pa.list_(pa.int32())),
                pa.array([[np.ascontiguousarray(entries).tobytes() for entries, _ in blocks]], type=pa.list_(pa.binary())),
                pa.array([[codes.astype("<u4").tobytes() for _, codes in blocks]], type=pa.list_(pa.binary())),
            ]
            return pa.RecordBatch.from_arrays(row, names=["ids", "widths", "entries", "codes"])

        for batch in batches:
            width = len(batch.column(1)[0]) if batch.num_rows else 0
            values = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, width)
            names = batch.column(0).to_pylist()
            for start in range(0, batch.num_rows, chunk):
                part = values[start : start + chunk]
                if size + len(part) > chunk and size:
                    yield out()
                    held, ids, size = [], [], 0
                held.append(part)
                ids.append(names[start : start + chunk])
                size += len(part)
        if size:
            yield out()

    return vectors.select("vec_id", "vector").mapInArrow(run, "ids array<long>, widths array<int>, entries array<binary>, codes array<binary>")


def _integers(values: np.ndarray, far: bool) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape) if far else values.astype(np.int64)


def _chunk(row: dict, centroids: list[list[int]]):
    """ids, blocks, and of each vector the nearest centroid and its distance: partial distances of the dictionaries, summed by code."""
    widths = row["widths"]
    raw = [np.frombuffer(e, dtype="<f8").reshape(-1, w) for e, w in zip(row["entries"], widths, strict=True)]
    far = max((abs(v) for c in centroids for v in c), default=0) >= _SMALL or any(np.abs(r).max(initial=0) >= _SMALL for r in raw)
    kind = object if far else np.int64
    points = np.array(centroids, dtype=kind).reshape(len(centroids), -1)
    total = np.zeros((len(row["ids"]), len(centroids)), dtype=kind)
    blocks, at = [], 0
    for values, codes, width in zip(raw, row["codes"], widths, strict=True):
        entries, codes = _integers(values, far), np.frombuffer(codes, dtype="<u4")
        part = entries[:, None, :] - points[None, :, at : at + width]
        total += (part * part).sum(axis=2)[codes]
        blocks.append((entries, codes))
        at += width
    nearest = np.argmin(total, axis=1)
    return blocks, nearest, total[np.arange(len(total)), nearest]


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def sums(chunks: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of the vectors of each non-empty cluster: one row per cluster and task, added up by Spark."""

    def run(batches):
        counts = [0] * len(centroids)
        totals = [[0] * len(centroids[0]) for _ in centroids]
        for row in _rows(batches):
            blocks, nearest, _ = _chunk(row, centroids)
            for c, n in enumerate(np.bincount(nearest, minlength=len(centroids)).tolist()):
                if not n:
                    continue
                counts[c] += n
                at = 0
                for entries, codes in blocks:
                    often = np.bincount(codes[nearest == c], minlength=len(entries))
                    used = np.flatnonzero(often)
                    part = (entries[used] * often[used][:, None]).sum(axis=0)
                    for value in part.tolist():
                        totals[c][at] += int(value)
                        at += 1
        some = [c for c, n in enumerate(counts) if n]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0))]
        columns = [some, [counts[c] for c in some], [[Decimal(v) for v in totals[c]] for c in some]]
        yield pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(columns, kinds, strict=True)], names=["cluster", "n", "totals"])

    parts = chunks.mapInArrow(run, "cluster int, n long, totals array<decimal(38,0)>")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("totals")[i]) for i in range(len(centroids[0]))]).alias("totals"))
    return {r["cluster"]: (r["n"], [int(v) for v in r["totals"]]) for r in added.collect()}


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes; equal ids by their components, null ids last."""
    named = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select("vector", named.alias("h")).orderBy(F.asc_nulls_last("h"), "vector").limit(clusters).collect()
    return [[int(v) for v in r["vector"]] for r in rows]


def lloyd(chunks: DataFrame, centroids: list[list[int]], rounds: int = ROUNDS) -> list[list[int]]:
    """The centroids after ``rounds`` rounds: floors of exact means. A round that changes nothing is the last one needed."""
    for _ in range(rounds):
        found = sums(chunks, centroids)
        after = [[v // found[c][0] for v in found[c][1]] if c in found else own for c, own in enumerate(centroids)]
        if after == centroids:
            break
        centroids = after
    return centroids


def assign(chunks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, exact (the squared distance as a decimal) of every vector; ties go to the smaller cluster number."""

    def run(batches):
        for row in _rows(batches):
            _, nearest, distance = _chunk(row, centroids)
            exact = pa.array([Decimal(int(v)) for v in distance], type=pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], type=pa.int64()), pa.array(nearest.astype(np.int32)), exact], names=["vec_id", "cluster", "exact"])

    return chunks.mapInArrow(run, "vec_id long, cluster int, exact decimal(38,0)")


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector with 64 finite components.

    Vectors of another size, or with a null or non-finite component (also one that is not below 2^62 when scaled), have no row.
    Rows of one id are vectors of their own; null ids are kept. With fewer than eight vectors there are as many clusters; an empty table
    gives no rows. Everything is exact; a distance or sum beyond 64 bits is given as the largest long.
    """
    named = df.select(df[key].cast("long").alias("vec_id"), scaled(df[vector]).alias("vector")).filter("vector IS NOT NULL")
    chunks = written(encoded(named), "chunks")
    start = first_centroids(named)
    if not start:
        long = F.lit(None).cast("long")
        return named.select("vec_id", F.lit(None).cast("int").alias("cluster"), *[long.alias(n) for n in ("distance", "cluster_inertia", "inertia")], F.lit(None).cast("string").alias("centroid_sha256"))
    centroids = lloyd(chunks, start)
    found = written(assign(chunks, centroids), "assigned")
    # one row per cluster
    totals = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum("exact").alias("s")).collect()}

    def per_cluster(values: list, kind: str) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")]

    inertia = [min(totals.get(c, 0), _LARGEST) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return found.select(
        "vec_id",
        "cluster",
        F.least("exact", F.lit(Decimal(_LARGEST))).cast("long").alias("distance"),
        per_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(min(sum(totals.values()), _LARGEST)).cast("long").alias("inertia"),
        per_cluster(digests, "string").alias("centroid_sha256"),
    )


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same clusters in DuckDB: one assignment and one update per round, components as rows."""

    def nearest(points: str) -> str:
        distances = f"SELECT v.vec_id, c.cluster, SUM((v.x - c.x) * (v.x - c.x))::HUGEINT AS distance FROM parts v JOIN {points} c USING (d) GROUP BY ALL"
        return f"SELECT vec_id, cluster, distance FROM ({distances}) QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1"

    steps = [
        f"kept AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})",
        f"parts AS MATERIALIZED (SELECT vec_id, d::INTEGER AS d, floor({SCALE} * embedding[d]::DOUBLE)::BIGINT AS x FROM kept, range(1, {DIMENSIONS + 1}) r(d))",
        f"chosen AS (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < {clusters})",
        "c0 AS MATERIALIZED (SELECT cluster, d, x FROM chosen JOIN parts USING (vec_id))",
    ]
    for i in range(rounds):
        steps.append(f"n{i} AS MATERIALIZED ({nearest(f'c{i}')})")
        steps.append(f"m{i} AS (SELECT cluster, d, SUM(x)::HUGEINT AS s, COUNT(*) AS n FROM n{i} JOIN parts USING (vec_id) GROUP BY ALL)")
        floor = "((s - ((s % n) + n) % n) // n)::BIGINT"
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cluster, c.d, CASE WHEN m.n IS NULL THEN c.x ELSE {floor} END AS x FROM c{i} c LEFT JOIN m{i} m USING (cluster, d))")
    steps.append(f"last AS MATERIALIZED ({nearest(f'c{rounds}')})")
    steps.append(f"digests AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)")
    return (
        f"WITH {', '.join(steps)} SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance, (SUM(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,"
        " (SUM(distance) OVER ())::BIGINT AS inertia, centroid_sha256 FROM last JOIN digests USING (cluster)"
    )
