"""Operator 10: a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.texts import code_points, held_out, map_texts, per_process, slices

#: Lengths of grams, and values of their hashes.
SIZES, SLOTS = (3, 4, 5, 6), 1 << 22
#: Labelled rows that the classifier is fitted on at most, the first ones by a hash of their id.
SAMPLE_ROWS = 20_000
#: Grams with a weight at most, and the standard errors that a log-count ratio must be away from 0.
FEATURES, ERRORS = 4096, 3.0
#: A document is called toxic from this score on.
THRESHOLD = 0.3

_SPREAD = np.uint32(0x9E3779B1)


class Classifier(NamedTuple):
    slots: np.ndarray  # hashes of the grams, sorted
    weights: np.ndarray  # weight times log-count ratio
    bias: float


def fold_table() -> np.ndarray:
    """Lower-case letters and digits of all planes; anything else is a space."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalnum():
            table[point] = ord(c.lower()[0])
    return table


def gram_slots(texts: list[str | None], table: np.ndarray):
    """For each gram length: hashes of all grams of all texts, and the text of each."""
    points, begins = code_points(texts)
    folded = table[points]
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    hashed = folded.copy()
    for size in range(1, max(SIZES) + 1):
        if size > 1:
            hashed = hashed[:-1] * _SPREAD + folded[size - 1 :]
        if size in SIZES:
            inside = owner[: len(hashed)] == owner[size - 1 :]
            slots = ((hashed + np.uint32(size)) * _SPREAD) >> np.uint32(32 - SLOTS.bit_length() + 1)
            yield slots[inside], owner[: len(hashed)][inside]


def features_of(texts: list[str | None], places: np.ndarray, width: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every chosen gram that a text has, once each. ``places``: the feature of a hash, -1 for none."""
    found = []
    for slots, owner in gram_slots(texts, table):
        feature = places[slots]
        hit = np.flatnonzero(feature >= 0)
        found.append(owner[hit] * width + feature[hit])
    pairs = np.unique(np.concatenate(found))
    return pairs // max(width, 1), pairs % max(width, 1)


def places_of(slots: np.ndarray) -> np.ndarray:
    places = np.full(SLOTS, -1, dtype=np.int16)
    places[slots] = np.arange(len(slots))
    return places


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(label, text) of at most ``rows`` labelled documents that are not held out, one row per label. The labels are broadcast.

    A document that occurs in several rows counts once, with the smallest of its texts; so does a label that occurs in several rows.
    """
    known = labels.select(labels[key].cast("long").alias("id"), labels[label].cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    chosen = known.filter(~held_out(F.col("id"))).distinct().orderBy(F.xxhash64("id"), "id", "label").limit(rows)
    texts = docs.select(docs[key].cast("long").alias("id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text")


def ratios(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The grams whose log-count ratio is farthest from 0 in standard errors, and the ratios. Spark counts the texts that have a gram."""

    def run(batches):
        table = per_process(("toxicity letters",), fold_table)
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist())
            for start, texts in slices(batch.column(1)):
                sums = np.zeros((2, SLOTS), dtype=np.int32)
                for slots, owner in gram_slots(texts, table):
                    once = np.unique((owner.astype(np.int64) << 22) | slots)
                    kinds, at = labels[start : start + len(texts)][once >> 22], once & (SLOTS - 1)
                    for kind in (0, 1):
                        sums[kind] += np.bincount(at[kinds == kind], minlength=SLOTS).astype(np.int32)
                seen = np.flatnonzero(sums.any(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[0][seen].astype(np.int64)), pa.array(sums[1][seen].astype(np.int64))], names=["slot", "clean", "toxic"])

    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n, p = totals.get(0, 0), totals.get(1, 0)
    counts = sample.mapInArrow(run, "slot long, clean long, toxic long").groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = F.log((F.col("toxic") + 1) / F.lit(p + 2.0)) - F.log((F.col("clean") + 1) / F.lit(n + 2.0))
    errors = F.abs("ratio") / F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("clean") + 1))
    rows = counts.withColumn("ratio", ratio).withColumn("errors", errors).filter(F.col("errors") >= ERRORS).orderBy(F.desc("errors"), "slot").limit(FEATURES).select("slot", "ratio").collect()
    rows.sort()
    return np.array([r["slot"] for r in rows], dtype=np.int64), np.array([r["ratio"] for r in rows])


def descend(texts: np.ndarray, features: np.ndarray, labels: np.ndarray, ratio: np.ndarray, steps: int = 400, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression with squared penalty on features (text, feature) of value ``ratio[feature]``, by Adam steps."""
    weights, bias = np.zeros(len(ratio)), math.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    value = ratio[features]
    moment, square = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for step in range(1, steps + 1):
        margin = bias + np.bincount(texts, weights=weights[features] * value, minlength=len(labels))
        slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / max(len(labels), 1)
        gradient = np.append(np.bincount(features, weights=slope[texts] * value, minlength=len(ratio)) + penalty * weights, slope.sum())
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        change = 0.02 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - change[:-1], bias - change[-1]
    return weights, bias


def fit(sample: DataFrame) -> Classifier:
    """Fit on (label, text). The driver gets at most SAMPLE_ROWS lists of at most FEATURES numbers.

    Without any labelled row, or with one label only, there are no features and every score is the share of label 1.
    """
    slots, ratio = ratios(sample)

    def factory():
        table, places = per_process(("toxicity letters",), fold_table), places_of(slots)

        def work(texts):
            owner, feature = features_of(texts, places, len(slots), table)
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
            return ([feature[a:b].astype(np.int16) for a, b in zip(ends, ends[1:], strict=False)],)

        return work

    found = map_texts(sample, ["label"], "text", [T.StructField("features", T.ArrayType(T.ShortType()))], factory).toArrow().combine_chunks()
    labels = found["label"].to_numpy().astype(float)
    features = found["features"]
    sizes = pc.fill_null(pc.list_value_length(features), 0).to_numpy().astype(np.int64)
    texts = np.repeat(np.arange(len(labels)), sizes)
    weights, bias = descend(texts, pc.list_flatten(features).to_numpy().astype(np.int64), labels, ratio)
    return Classifier(slots, weights * ratio, bias)


def score(df: DataFrame, model: Classifier, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """``keep`` and the probability of label 1 of every whole text; null and empty texts have no grams and get the bias alone."""

    def factory():
        table, places = per_process(("toxicity letters",), fold_table), places_of(model.slots)

        def work(texts):
            owner, feature = features_of(texts, places, len(model.slots), table)
            margin = model.bias + np.bincount(owner, weights=model.weights[feature], minlength=len(texts))
            return (1 / (1 + np.exp(-np.clip(margin, -500, 500))),)

        return work

    return map_texts(df, keep, text, [T.StructField(name, T.DoubleType())], factory)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every document; a null id is not held out. Repeated rows get equal scores, empty tables none."""
    model = fit(labelled(docs, labels, key, text))
    named = docs.select(docs[key].alias("doc_id"), F.coalesce(held_out(docs[key]), F.lit(False)).alias("held_out"), docs[text].alias("text"))
    found = score(named, model, ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
