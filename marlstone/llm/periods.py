"""Operator 13: runs of words that repeat with a period, found by recursive frequency splitting and a lag scan.

A run of period q and length 4 q or more holds each of its words at least four times. So a word that a segment holds less often
is in no run of the segment and splits it; in the smaller segments more words are too rare, until nothing changes. What
is left is scanned lag by lag.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import Counter
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.texts import map_texts

#: A run has at least so many words, and at least so many times its period.
LEAST_LENGTH, LEAST_REPEATS = 6, 4

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def stretches(inside: np.ndarray, least: int = LEAST_LENGTH) -> list[tuple[int, int]]:
    """(start, end) of the stretches of true values that have at least ``least`` of them."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= least]


def segments(words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of ``words`` (numbers, negative: in no run) in which every word occurs often enough to join a run of the stretch."""
    found, todo = [], stretches(words >= 0)
    while todo:
        start, end = todo.pop()
        _, inverse, counts = np.unique(words[start:end], return_inverse=True, return_counts=True)
        often = (counts >= LEAST_REPEATS)[inverse]
        if often.all():
            found.append((start, end))
        else:
            todo += [(start + a, start + b) for a, b in stretches(often)]
    return sorted(found)


def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment.

    At lag q, a run of length 4 q or more holds a whole block [iq, iq + q) that equals the next one, so hashes of the blocks are
    compared first: that is n / q comparisons for lag q, and n log n for all lags. Neighbouring equal blocks are one stretch,
    which is compared word by word at its ends and inside. A stretch within a run whose period divides q is that run again.
    """
    n = len(words)
    values = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _powers(_BASE, n), out=sums[1:])
    down = _powers(_INVERSE, n)
    runs: dict[tuple[int, int], int] = {}  # (start, end): smallest period
    by_start: list[tuple[int, int, int]] = []
    for q in range(1, n // LEAST_REPEATS + 1):
        at = np.arange(0, n - q + 1, q)
        blocks = (sums[at + q] - sums[at]) * down[at]
        same = blocks[1:] == blocks[:-1]
        if not same.any():
            continue
        found = _of_lag(words, q, same, by_start)
        if found is None:  # two unlike blocks of one hash
            found = _of_lag(words, q, np.add.reduceat(words[: len(same) * q] != words[q : (len(same) + 1) * q], at[:-1]) == 0, by_start)
        for start, end in found:
            if (start, end) not in runs:
                runs[start, end] = q
                insort(by_start, (start, end, q))
    return [(start, end - start, q) for (start, end), q in runs.items()]


def _of_lag(words: np.ndarray, q: int, same: np.ndarray, known: list[tuple[int, int, int]]) -> list[tuple[int, int]] | None:
    """(start, end) of the stretches with period ``q`` that are long enough, from the blocks that equal the next one. None if a block does not."""
    found, n, least = [], len(words), max(LEAST_LENGTH, LEAST_REPEATS * q)
    for first, stop in stretches(same, 1):
        start, end = first * q, (stop + 1) * q
        if end - start + 2 * (q - 1) < least:
            continue
        place = bisect_right(known, (start, n, n))
        if any(a <= start and end <= b and q % p == 0 for a, b, p in known[max(0, place - 3) : place]):
            continue  # the same run, found by its smallest period
        if not np.array_equal(words[start : end - q], words[start + q : end]):
            return None
        left, right = max(0, start - q), min(n, end + q)
        before = np.flatnonzero(words[left:start] != words[left + q : start + q])
        after = np.flatnonzero(words[end:right] != words[end - q : right - q])
        begin = left + (int(before[-1]) + 1 if len(before) else 0)
        close = end + int(after[0]) if len(after) else right
        if close - begin >= least:
            found.append((begin, close))
    return found


def periodic_runs(words: list) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of words, by start, then period.

    A run is a stretch with smallest period q (words q apart are equal) of at least max(6, 4 q) words that cannot be extended
    on either side. Runs may overlap; no run of fewer words exists.
    """
    often = {w: i for i, w in enumerate(w for w, n in Counter(words).items() if n >= LEAST_REPEATS)}
    if not often:
        return []
    numbers = np.fromiter((often.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    return sorted(((start + a, length, q) for start, end in segments(numbers) for a, length, q in scan(numbers[start:end])), key=lambda r: (r[0], r[2]))


def without_repeats(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def find_runs(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``runs`` (array of start, length, period; places are word numbers), ``strongest`` and ``collapsed`` for every whole text.

    Words are stretches without ASCII white space. ``strongest`` is the run of most repeats (ties: smallest start, then period), null
    without runs. ``collapsed``: the text's words, joined by a space, without those that a run holds after its first period. Null,
    empty and blank texts have no runs and an empty collapsed text. Rows are independent: repeated rows, ties and clashing
    names change nothing; an empty table gives no rows. Rows stay where the scan put them.
    """

    def factory():
        def work(texts):
            found, best, short = [], [], []
            for body in texts:
                words = body.encode().split() if body else []  # bytes split at ASCII white space alone
                runs = periodic_runs(words)
                dicts = [{"start": a, "length": n, "period": q} for a, n, q in runs]
                found.append(dicts)
                best.append(min(dicts, key=lambda r: (Fraction(-r["length"], r["period"]), r["start"], r["period"])) if dicts else None)
                short.append(b" ".join(without_repeats(words, runs)).decode())
            return found, best, short

        return work

    fields = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("strongest", RUN), T.StructField("collapsed", T.StringType())]
    return map_texts(df, keep, text, fields, factory)


def echoed(text: Column, key: Column) -> Column:
    """Texts of a tenth of all keys (by CRC-32) with a part repeated: n words, of which word i >= a becomes word a + (i - a) % p."""
    draw = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(draw / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return F.when((draw % 10 == 0) & (n > 0), repeated).otherwise(text)


def run_digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli; nulls without runs) and digests of all runs and of
    the collapsed text, for every whole text, of which a tenth is ``echoed`` first. A null key is never echoed."""
    named = df.select(df[key].cast("long").alias("doc_id"), echoed(df[text].cast("string"), df[key].cast("long")).alias("text"))
    found = find_runs(named, ["doc_id"])
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = [F.col(f"strongest.{n}").alias(n) for n in ("start", "length", "period")]
    exponent = F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent, F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    )
