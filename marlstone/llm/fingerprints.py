"""Operator 9: document fingerprints of closed syncmers."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.texts import map_texts, mix

#: Code points of an anchor, and of the inner substring that decides.
K, S = 24, 13
#: Characters of results that a task gathers before it hands them on, unless a single row has more.
HELD_CHARS = 8_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, size: int) -> np.ndarray:
    """1, base, base² ... modulo 2^64."""
    if len(_powers.get(name, ())) < size:
        steps = np.full(1 << max(12, size.bit_length()), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:size]


def window_hashes(points: np.ndarray, size: int, sums: np.ndarray) -> np.ndarray:
    """A hash of every run of ``size`` code points, from prefix sums of code points times powers."""
    n = len(points) - size + 1
    return mix((sums[size:] - sums[:n]) * _power("down", _INVERSE, n))


class Anchors(NamedTuple):
    hashes: np.ndarray  # uint64, in order of their places
    places: np.ndarray


def syncmers(text: str, k: int = K, s: int = S) -> Anchors:
    """Closed syncmers: runs of ``k`` code points whose smallest run of ``s`` is the first or the last one in it.

    Whether a run is chosen depends on itself alone, so equal passages have equal anchors wherever they stand. A text
    without any, such as one shorter than ``k``, has itself as its one anchor; an empty text has none.
    """
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    if not len(points):
        return Anchors(np.empty(0, np.uint64), np.empty(0, np.int64))
    if len(points) >= k:
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(points)), out=sums[1:])
        inner = window_hashes(points, s, sums)
        width, done, least = k - s + 1, 1, inner
        while done < width:  # smallest of ``width`` neighbours, by doubling
            step = min(done, width - done)
            least = np.minimum(least[: len(least) - step], least[step:])
            done += step
        chosen = np.flatnonzero((least == inner[: len(least)]) | (least == inner[width - 1 :]))
        if len(chosen):
            runs = (sums[chosen + k] - sums[chosen]) * _power("down", _INVERSE, len(points))[chosen]
            return Anchors(mix(runs), chosen)
    whole = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")
    return Anchors(np.array([whole], dtype=np.uint64), np.zeros(1, np.int64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two sorted sets of anchors; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def sketch(distinct: np.ndarray) -> str:
    """All distinct anchors in ascending order as hexadecimal digits, 16 each."""
    return distinct.astype(">u8").tobytes().hex()


def distinct_anchors(text: str) -> Anchors:
    """The distinct anchors in ascending order, each with its first place."""
    found = syncmers(text)
    hashes, first = np.unique(found.hashes, return_index=True)
    return Anchors(hashes, found.places[first])


def passage_share(a: Anchors, b: Anchors) -> float:
    """Anchors of the largest passage that both have at one distance, as a share of the distinct anchors of the smaller side; 1 for two empty ones."""
    if not len(a.hashes) or not len(b.hashes):
        return float(len(a.hashes) == len(b.hashes))
    return max((n for _, _, n in shared_passages(a, b)), default=0) / min(len(a.hashes), len(b.hashes))


def shared_passages(a: Anchors, b: Anchors) -> list[tuple[int, int, int]]:
    """(place in a, place in b, anchors): anchors that both have, gathered by their distance, with the first place of each run."""
    common, in_a, in_b = np.intersect1d(a.hashes, b.hashes, return_indices=True)
    if not len(common):
        return []
    at, other = a.places[in_a], b.places[in_b]
    order = np.lexsort((at, at - other))
    at, other = at[order], other[order]
    begins = np.flatnonzero(np.concatenate([[True], np.diff(at - other) != 0]))
    counts = np.diff(np.concatenate([begins, [len(at)]]))
    return list(zip(at[begins].tolist(), other[begins].tolist(), counts.tolist(), strict=True))


def anchors(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the anchors of every whole text as an array of (place, hash), in order of places; null and empty texts have none."""

    def factory():
        def work(texts):
            found = [syncmers(t or "") for t in texts]
            return ([[{"place": p, "hash": h} for p, h in zip(x.places.tolist(), x.hashes.view(np.int64).tolist(), strict=True)] for x in found],)

        return work

    item = T.StructType([T.StructField("place", T.LongType()), T.StructField("hash", T.LongType())])
    return map_texts(df, keep, text, [T.StructField("anchors", T.ArrayType(item))], factory)


def neighbours(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in runs that a partition can walk through, each followed by the next one: (run, borrowed, doc_id, text).

    Order: descending key (null last), then text. Split points of the key (a few per partition) deal the rows to runs, and
    a run borrows the first rows of the next run, the last one those of the first. Texts are shuffled once.
    """
    spark = df.sparkSession
    lowest = -(1 << 63)
    ids = df.select(F.coalesce(df[key].cast("long"), F.lit(lowest)).alias("id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    splits = (ids.agg(F.percentile_approx("id", shares, 100 * parts)).first()[0] if shares else None) or []
    limits = F.array(*[F.lit(x) for x in sorted(set(splits))]).cast("array<bigint>")
    run = F.size(F.filter(limits, lambda x: x > F.col("id"))).cast("int")
    # one row per run: its first key
    heads = sorted((r["run"], r["head"]) for r in ids.withColumn("run", run).groupBy("run").agg(F.max("id").alias("head")).collect())
    before = {run: heads[i - 1][0] for i, (run, _) in enumerate(heads)}
    lender = F.create_map(*[F.lit(x) for _, head in heads for x in (head, before[_])]) if heads else F.create_map()
    named = df.select(
        df[key].cast("long").alias("doc_id"), F.coalesce(df[text].cast("string"), F.lit("")).alias("text"), F.coalesce(df[key].cast("long"), F.lit(lowest)).alias("id")
    ).withColumn("run", run)
    own = F.struct(F.col("run").alias("run"), F.lit(False).alias("borrowed"))
    if heads:
        to = F.try_element_at(lender, F.col("id"))
        places = F.when(to.isNull(), F.array(own)).otherwise(F.array(own, F.struct(to.alias("run"), F.lit(True).alias("borrowed"))))
    else:
        places = F.array(own)
    dealt = named.select(F.explode(places).alias("at"), "doc_id", "text", "id").select("at.run", "at.borrowed", "doc_id", "text", "id")
    # the number of the run is the number of the partition
    spread = dealt.repartitionById(max(1, len(set(splits)) + 1), F.col("run"))
    return spread.sortWithinPartitions("run", "borrowed", F.desc("id"), "text").select("run", "borrowed", "doc_id", "text")


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text (null: empty) and of its edited text, whose second half comes from the next document.

    A fingerprint holds all distinct anchors, and the places beside it (in the same order) where each stands first. ``near``
    compares the sets of anchors, ``passage`` matches them by their places.

    The next document is the one after it by descending key, and after the last one the first; rows of one key are ordered
    by text, a null key comes last. A single row follows itself. An empty table gives no rows.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, places array<long>, edited_places array<long>, passage_edited double, passage_next double"
    names = [c.split()[0] for c in schema.split(", ")]

    def walk(batches):
        held = None  # (run, doc_id, text, distinct anchors)
        rows = []

        def settle(following_text, following):
            _, doc_id, body, own = held
            half = len(body) // 2
            edited = body[: len(body) - half] + following_text[:half]
            changed = distinct_anchors(edited)
            digest = hashlib.sha256(edited.encode()).hexdigest()
            near = likeness(own.hashes, changed.hashes), likeness(own.hashes, following.hashes)
            passages = passage_share(own, changed), passage_share(own, following)
            rows.append((doc_id, len(body), digest, sketch(own.hashes), sketch(changed.hashes), *near, own.places, changed.places, *passages))
            return 24 * (len(own.hashes) + len(changed.hashes))

        def gathered():
            made = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)
            rows.clear()
            return made

        size = 0
        for batch in batches:
            for run, borrowed, doc_id, body in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                distinct = distinct_anchors(body)
                if held and held[0] == run:
                    size += settle(body, distinct)
                held = None if borrowed else (run, doc_id, body, distinct)
                if size > HELD_CHARS:
                    yield gathered()
                    size = 0
            if rows:
                yield gathered()
                size = 0

    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}
    kinds = pa.schema([(n, types[c.split()[1]]) for n, c in zip(names, schema.split(", "), strict=True)])
    return neighbours(df, key, text).mapInArrow(walk, schema)
