"""Vector search: centroids, scorers for block search, metadata predicates, dimension check."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.embed import word_hash
from marlstone.functions.vectors import TINY_NORM
from marlstone.operators.blocks import Scorer, top_k


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(query_id, query): mean vector of each label, by a partial aggregate over whole vectors."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy(F.col(label).alias("query_id")).agg(vector_to_array(mean).alias("query"))


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=float) for v in vectors])


def _cosines(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    lengths = np.outer(np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1))
    return np.where(lengths < TINY_NORM, 0.0, rows @ queries.T / np.maximum(lengths, TINY_NORM))


def similarities(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Matrix rows x queries; a larger score is better, so the Euclidean distance is negated."""
    if metric == "cosine":
        return _cosines(rows, queries)
    if metric == "dot":
        return rows @ queries.T
    if metric == "euclidean":
        squares = (rows * rows).sum(1)[:, None] - 2 * rows @ queries.T + (queries * queries).sum(1)[None, :]
        return -np.sqrt(np.maximum(squares, 0.0))
    raise ValueError(f"unknown metric {metric}")


def vector_scorer(metric: str, vector: str = "embedding", query: str = "query") -> Scorer:
    def prepare(asked: pd.DataFrame):
        queries = _stack(asked[query])
        return lambda rows: similarities(_stack(rows[vector]), queries, metric)

    return prepare


def text_scorer(dim: int, text: str = "text", query: str = "query") -> Scorer:
    """Cosine of word-hash embeddings; texts come as words parted by one space."""

    def prepare(asked: pd.DataFrame):
        queries = word_hash(asked[query], dim)
        return lambda rows: _cosines(word_hash(rows[text], dim), queries)

    return prepare


def equals(metadata: Column, key: str, value: str) -> Column:
    return F.coalesce(F.element_at(metadata, F.lit(key)) == value, F.lit(False))


def not_equals(metadata: Column, key: str, value: str) -> Column:
    """Also true when the key is missing."""
    return ~equals(metadata, key, value)


def one_of(metadata: Column, key: str, values: Sequence[str]) -> Column:
    return F.coalesce(F.element_at(metadata, F.lit(key)).isin(*values), F.lit(False))


def nearest_others(vectors: DataFrame, k: int, **block_sizes: int) -> DataFrame:
    """For each (query_id, query) row of a vector set its k most similar other rows, by cosine."""
    corpus = vectors.select(F.col("query_id").alias("other_id"), F.col("query").alias("embedding"))
    found = top_k(corpus, ["other_id"], vectors, "query_id", vector_scorer("cosine"), k + 1, **block_sizes)
    order = Window.partitionBy("query_id").orderBy("rank")
    return (
        found.where("query_id <> other_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def reject_reason(vector: Column, dim: int) -> Column:
    """Why a vector cannot be searched: `missing`, `length` or `not a number`; null for a good one."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.when(vector.isNull(), "missing").when(F.size(vector) != dim, "length").when(odd, "not a number")


def split_by_dimension(df: DataFrame, vector: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a good vector of ``dim`` slots, and the rejected rest with a column ``reason``. Search the first part only."""
    reason = reject_reason(F.col(vector), dim)
    return df.where(reason.isNull()), df.withColumn("reason", reason).where("reason IS NOT NULL")
