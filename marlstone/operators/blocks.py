"""Exact scoring of every query against every corpus row, without a cross join.

Corpus partitions stream through ``mapInPandas``; each Arrow batch is scored against a block of
queries as one matrix, and only the best ``k`` rows per query leave the task. Queries are dealt to blocks by a hash of their
id. One block at a time is on the driver and travels with the tasks; what its pass over the corpus finds is written before
the next block is read. The corpus is neither shuffled nor copied, however many blocks there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.workspace import written

BLOCK_QUERIES = 2048
MATRIX_CELLS = 1_000_000
#: Characters of text that are scored at a time, unless a single text is longer.
SLICE_CHARS = 300_000
SCORE_DIGITS = 8

# prepares the queries once and returns a function: corpus batch -> matrix (rows x queries)
Scorer = Callable[[pd.DataFrame], Callable[[pd.DataFrame], np.ndarray]]


def _best(scores: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and query indexes of the best k rows per query: score descending, ``order`` ascending.

    ``order`` ranks the rows of the batch by id. A score that is not a number belongs to no result.
    """
    n, n_queries = scores.shape
    scores = np.where(np.isnan(scores), -np.inf, scores)
    cuts = np.partition(scores, n - k, axis=0)[n - k] if n > k else np.full(n_queries, -np.inf)
    rows, columns = np.nonzero((scores >= cuts) & (scores > -np.inf))
    sorted_ = np.lexsort((order[rows], -scores[rows, columns], columns))
    rows, columns = rows[sorted_], columns[sorted_]
    place = np.arange(len(columns)) - np.searchsorted(columns, np.arange(n_queries))[columns]
    return rows[place < k], columns[place < k]


def _trim(pdf: pd.DataFrame, ids: list[str], k: int) -> pd.DataFrame:
    ranked = pdf.sort_values(["score", *ids], ascending=[False] + [True] * len(ids), kind="mergesort")
    return ranked.groupby("query_id", sort=False).head(k)


def _score_batch(pdf, score, query_ids, ids, k):
    if len(pdf) == 0:
        return None
    scores = np.round(score(pdf), SCORE_DIGITS)
    order = np.empty(len(pdf), dtype=np.int64)
    order[np.lexsort([pdf[c].to_numpy() for c in reversed(ids)])] = np.arange(len(pdf))
    rows, columns = _best(scores, order, k)
    out = pdf[ids].iloc[rows].reset_index(drop=True)
    out.insert(0, "query_id", query_ids[columns])
    out["score"] = scores[rows, columns]
    return out


def _slices(batches: Iterator[pd.DataFrame], n_queries: int) -> Iterator[pd.DataFrame]:
    """Batches cut so that a score matrix has at most ``MATRIX_CELLS`` cells and is made from ``SLICE_CHARS`` characters at most."""
    rows = max(1, MATRIX_CELLS // max(n_queries, 1))
    for pdf in batches:
        sizes = np.zeros(len(pdf), dtype=np.int64)
        for c in pdf.columns:
            if pdf[c].dtype == object:
                sizes += [len(v) if isinstance(v, str) else 0 for v in pdf[c]]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(pdf):
            fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_CHARS, side="right"))
            stop = max(at + 1, min(at + rows, fit))
            yield pdf.iloc[at:stop]
            at = stop


def _merged(batches: Iterator[pd.DataFrame], score, query_ids, ids, k) -> pd.DataFrame | None:
    """Best k per query over a stream of batches; memory is queries x k plus one batch."""
    held = None
    for pdf in _slices(batches, len(query_ids)):
        found = _score_batch(pdf, score, query_ids, ids, k)
        if found is not None:
            held = found if held is None else _trim(pd.concat([held, found], ignore_index=True), ids, k)
    return held


def _blocks(queries: DataFrame, query_id: str, most: int) -> Iterator[pd.DataFrame]:
    """The queries in blocks of about ``most`` rows, one at a time."""
    queries = written(queries, "queries")
    blocks = max(1, math.ceil(queries.count() / most))
    for block in range(blocks):
        asked = queries.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block).toPandas()
        if len(asked):
            yield asked


def _over_blocks(corpus: DataFrame, queries: DataFrame, query_id: str, most: int, task: Callable, schema: T.StructType) -> DataFrame:
    """What ``task(asked)`` finds in the corpus for every block of queries, each pass written."""
    found = corpus.sparkSession.createDataFrame([], schema)
    for asked in _blocks(queries, query_id, most):
        found = found.unionByName(written(corpus.mapInPandas(task(asked), schema), "scores"))
    return found


def top_k(
    corpus: DataFrame, ids: list[str], queries: DataFrame, query_id: str, scorer: Scorer, k: int, block_queries: int = BLOCK_QUERIES
) -> DataFrame:
    """(query_id, ids..., score, rank): the k best corpus rows of each query, ties by id."""
    id_fields = [corpus.schema[c] for c in ids]
    schema = T.StructType([T.StructField("query_id", queries.schema[query_id].dataType), *id_fields, T.StructField("score", T.DoubleType())])

    def part(asked: pd.DataFrame):
        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = _merged(batches, scorer(asked), asked[query_id].to_numpy(), ids, k)
            if held is not None:
                yield held

        return task

    partial = _over_blocks(corpus, queries, query_id, block_queries, part, schema)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), *ids)
    return partial.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def score_summary(
    corpus: DataFrame, ids: list[str], queries: DataFrame, query_id: str, scorer: Scorer, block_queries: int = BLOCK_QUERIES
) -> DataFrame:
    """(query_id, n_scored, mean_score, best_score, best ids...): all pairs scored, one row per query kept.

    Scores that are not a number count neither as scored nor in the mean.
    """
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema[query_id].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            *[corpus.schema[c] for c in ids],
        ]
    )

    def part(asked: pd.DataFrame):
        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            score, names = scorer(asked), asked[query_id].to_numpy()
            for pdf in _slices(batches, len(names)):
                if pdf.empty:
                    continue
                scores = np.round(score(pdf), SCORE_DIGITS)
                order = np.empty(len(pdf), dtype=np.int64)
                order[np.lexsort([pdf[c].to_numpy() for c in reversed(ids)])] = np.arange(len(pdf))
                rows, columns = _best(scores, order, 1)
                best = pdf[ids].iloc[rows].reset_index(drop=True)
                best.insert(0, "query_id", names[columns])
                best["n"] = (~np.isnan(scores)).sum(axis=0)[columns]
                best["total"] = np.nansum(scores, axis=0)[columns]
                best["score"] = scores[rows, columns]
                yield best

        return task

    partial = _over_blocks(corpus, queries, query_id, block_queries, part, schema)
    lead = F.struct((-F.col("score")).alias("_minus"), *ids)  # its minimum: best score, then smallest id
    grouped = partial.groupBy("query_id").agg(
        F.sum("n").alias("n_scored"),
        (F.sum("total") / F.sum("n")).alias("mean_score"),
        F.max("score").alias("best_score"),
        F.min(lead).alias("_lead"),
    )
    return grouped.select("query_id", "n_scored", "mean_score", "best_score", *[F.col(f"_lead.{c}").alias(c) for c in ids])
