"""Operator 7: language identification by rank-order n-gram profiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.texts import code_points, held_out, map_texts, per_process, slices

#: Grams have one to three letters; their hashes have so many values.
LONGEST, SLOTS = 3, 1 << 20
#: Ranks of a profile. A gram that a profile lacks is this far out of place.
RANKS = 400

_SPREAD = np.uint32(0x9E3779B1)


def letter_table() -> np.ndarray:
    """Lower-case letters of all planes; anything else is 0 and separates words."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = ord(c.lower()[0])
    return table


def gram_slots(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams within words (a word's ends count as a letter) of all texts, and the text of each gram."""
    points, begins = code_points(texts)
    letters = table[points]
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    slots, owners = [], []
    hashed = letters.copy()
    for size in range(1, LONGEST + 1):
        if size > 1:
            hashed = hashed[:-1] * _SPREAD + letters[size - 1 :]
        use = owner[: len(hashed)] == owner[size - 1 :] if size > 1 else np.ones(len(hashed), dtype=bool)
        inner = letters[: len(hashed)] > 0
        if size > 1:  # some letter, and no separator inside
            inner = inner | (letters[size - 1 :] > 0)
            for i in range(1, size - 1):
                inner &= letters[i : i + len(hashed)] > 0
        use &= inner
        slots.append(((hashed[use] + np.uint32(size)) * _SPREAD) >> np.uint32(12))
        owners.append(owner[: len(use)][use])
    return np.concatenate(slots), np.concatenate(owners)


def profiles(df: DataFrame, text: str, lang: str) -> dict[str, np.ndarray]:
    """The most frequent grams of each language, in order: counted by Spark over all rows with a language and a text.

    Collected: RANKS numbers per language.
    """
    source = df.select(df[lang].cast("string").alias("lang"), df[text].cast("string").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")

    def run(batches):
        table, sums = per_process(("letters",), letter_table), {}

        def flush():
            for name, total in sums.items():
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen), type=pa.string()), pa.array(seen), pa.array(total[seen])], names=["lang", "slot", "count"])
            sums.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start, texts in slices(batch.column(1)):
                own = langs[start : start + len(texts)]
                for name in sorted(set(own)):
                    slots, _ = gram_slots([t for t, x in zip(texts, own, strict=True) if x == name], table)
                    if name not in sums:
                        if len(sums) == 16:  # 8 MB each
                            yield from flush()
                        sums[name] = np.zeros(SLOTS, dtype=np.int64)
                    sums[name] += np.bincount(slots, minlength=SLOTS)
        yield from flush()

    counts = source.mapInArrow(run, "lang string, slot long, count long").groupBy("lang", "slot").agg(F.sum("count").alias("count"))
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "slot")
    top = counts.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < RANKS)
    found: dict[str, np.ndarray] = {}
    for row in top.orderBy("lang", "rank").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "slot")))["slot"].alias("slots")).collect():
        found[row["lang"]] = np.array(row["slots"], dtype=np.int64)
    return dict(sorted(found.items()))


def ranked(slots: np.ndarray) -> np.ndarray:
    """The RANKS most frequent grams of one text, the most frequent first; ties by hash."""
    distinct, counts = np.unique(slots, return_counts=True)
    order = np.argsort(((counts.astype(np.int64) << 32) - distinct.astype(np.int64)))[::-1]
    return distinct[order[:RANKS]]


def out_of_place(own: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """How far the grams of a text are from their ranks in each profile, in all. ``ranks``: (languages, slots), RANKS where a gram is not."""
    there = ranks[:, own].astype(np.int64)
    return np.where(there < RANKS, np.abs(there - np.arange(len(own))), RANKS).sum(axis=1)


def predict(df: DataFrame, keep: list[str], known: dict[str, np.ndarray], text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep``, lang_pred and score (or ``names``) for every whole text.

    lang_pred is the language whose profile is least out of place, the first in order on a tie; `und` (score 0) for a
    null text, one without a letter, or without any profile. The score is 1 for grams that all stand at their
    ranks, 0 when the profile has none of them.
    """
    langs = list(known)

    def factory():
        table = per_process(("letters",), letter_table)
        ranks = np.full((len(langs), SLOTS), RANKS, dtype=np.int16)
        for row, slots in zip(ranks, known.values(), strict=True):
            row[slots] = np.arange(len(slots))

        def work(texts):
            slots, owner = gram_slots(texts, table)
            order = np.argsort(owner, kind="stable")
            slots = slots[order]
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
            found, scores = ["und"] * len(texts), [0.0] * len(texts)
            for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                if not langs or a == b:
                    continue
                own = ranked(slots[a:b])
                distance = out_of_place(own, ranks)
                best = int(np.argmin(distance))
                found[i], scores[i] = langs[best], float(1 - distance[best] / (RANKS * len(own)))
            return found, scores

        return work

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return map_texts(df, keep, text, fields, factory)


def learned(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Profiles from the documents that are not held out."""
    return profiles(docs.filter(~F.coalesce(held_out(docs[key]), F.lit(False))), text, lang)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; a null id is not held out. Empty tables give no rows."""
    named = docs.select(docs[key].alias("doc_id"), F.coalesce(held_out(docs[key]), F.lit(False)).alias("held_out"), docs[text].alias("text"))
    return predict(named, ["doc_id", "held_out"], learned(docs, key, text, lang))
