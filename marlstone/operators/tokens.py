"""Word vocabularies, encoding, decoding and token counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.slices import by_slices, row_slices
from marlstone.functions.text import words
from marlstone.operators.ordered import row_numbers
from marlstone.workspace import written

# fixed values: special tokens of the word vocabulary
PAD, UNK, BOS, EOS = 0, 1, 2, 3
FIRST_ID = 4

#: Words that travel with the tasks; Zipf's law lets a few hundred thousand cover nearly all tokens of a corpus.
SHARED_WORDS = 200_000
_RARE = -1  # stands for a word outside the shared part until it is joined


def build_vocabulary(df: DataFrame, text: str, min_freq: int = 2) -> DataFrame:
    """(word, token, n): words seen at least ``min_freq`` times, numbered from 4 in word order.

    Words are counted before they are shuffled, so a frequent word costs one row per task.
    """
    counts = df.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return row_numbers(counts.where(F.col("n") >= min_freq), ["word"], "token", start=FIRST_ID).withColumn(
        "token", F.col("token").cast("int")
    )


def _shared(vocabulary: DataFrame, limit: int):
    """The ``limit`` most frequent words as a broadcast (words, tokens)."""
    rows = vocabulary.orderBy(F.desc("n"), "word").limit(limit).select("word", "token").toPandas()
    return vocabulary.sparkSession.sparkContext.broadcast((rows["word"].tolist(), rows["token"].tolist()))


def _looked_up(rows: DataFrame, listed: str, found: str, rare: Callable[[Column], Column], name: str, table: DataFrame, default) -> DataFrame:
    """``rows`` with the places of ``found`` that ``rare`` marks filled from ``table`` (key, value), or with ``default``; others keep their value.

    Every row gets a number of its own and is written with its rare entries; only those leave their row, meet the table
    and come back as two arrays per row, places and values, which are put in by one pass over the row. So repeated keys stay apart, and the
    plan is the same for a table of any size.
    """
    pairs = F.zip_with(listed, found, lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    entries = F.transform(pairs, lambda e, i: F.struct(i.alias("at"), e["key"].alias("key"), e["value"].alias("value")))
    marked = rows.withColumn("_rare", F.transform(F.filter(entries, lambda e: rare(e["value"])), lambda e: F.struct(e["at"], e["key"])))
    placed = written(marked.drop(listed).withColumn("_row", F.monotonically_increasing_id()), "looked_up")
    sent = placed.select("_row", F.explode("_rare").alias("_e")).select("_row", F.col("_e.at").alias("_at"), F.col("_e.key").alias("key"))
    # every rare place comes back, those without a match as nulls
    back = sent.join(table, "key", "left").groupBy("_row").agg(F.collect_list(F.struct("_at", "value")).alias("_back"))

    @F.arrow_udf(rows.schema[found].dataType)
    def fill(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            for part in row_slices(columns):
                yield _put(*part, default)

    joined = placed.join(back, "_row", "left")
    filled = fill(found, F.transform("_back", lambda e: e["_at"]), F.transform("_back", lambda e: e["value"]))
    return joined.withColumn(name, filled).drop("_row", "_rare", "_back")


def _ends(lists: pa.Array) -> np.ndarray:
    """Where each list begins among the values of all, and their number."""
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])


def _put(values: pa.Array, places: pa.Array, others: pa.Array, default) -> pa.Array:
    """Lists ``values`` with ``others`` at their ``places``, nulls as ``default``; without a Python object per value."""
    ends, sizes = _ends(values), np.diff(_ends(places))
    flat, new = values.flatten(), others.flatten()
    at = np.repeat(ends[:-1], sizes) + places.flatten().to_numpy(zero_copy_only=False)
    if len(at):
        mask = np.zeros(len(flat), dtype=bool)
        mask[at] = True
        new = new.take(pa.array(np.argsort(at))).cast(flat.type)
        flat = pc.replace_with_mask(flat, pa.array(mask), new if default is None else pc.fill_null(new, default))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def encode(
    df: DataFrame, key: str, text: str, vocabulary: DataFrame, special: bool = True, carry: Sequence[str] = (), shared_words: int = SHARED_WORDS
) -> DataFrame:
    """(key, carry..., tokens): word ids in text order, unknown words as 1, with begin and end tokens if wanted.

    The most frequent words travel with the tasks. Any other word is joined, so no joined word is hot.
    """
    shared = _shared(vocabulary, shared_words)

    def factory():
        ids = dict(zip(*shared.value, strict=True))
        return lambda texts: pa.array([[ids.get(w, _RARE) for w in t.split(" ") if w] for t in texts.to_pylist()], type=pa.list_(pa.int32()))

    look_up = by_slices(factory, T.ArrayType(T.IntegerType()))
    listed = F.coalesce(words(F.col(text)), F.array().cast("array<string>"))
    coded = df.select(key, *carry, listed.alias("_words")).withColumn("_found", look_up(F.array_join("_words", " ")))
    table = vocabulary.select(F.col("word").alias("key"), F.col("token").alias("value"))
    coded = _looked_up(coded, "_words", "_found", lambda v: v == _RARE, "tokens", table, UNK).select(key, *carry, "tokens")
    if not special:
        return coded
    return coded.withColumn("tokens", F.concat(F.array(F.lit(BOS)), "tokens", F.array(F.lit(EOS))))


def decode(df: DataFrame, key: str, tokens: str, vocabulary: DataFrame, shared_words: int = SHARED_WORDS) -> DataFrame:
    """(key, text): words of the ids, special tokens and unknown ids left out. Rare ids are joined as in ``encode``."""
    shared = _shared(vocabulary, shared_words)

    def factory():
        named, ids = shared.value
        order = np.argsort(ids)
        known, names = np.array(ids, dtype=np.int64)[order], pa.array([*named, None], type=pa.string())
        place = np.append(order, len(named))

        def work(lists: pa.Array) -> pa.Array:
            asked = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(known, asked)
            hit = np.append(known, -1)[at] == asked
            return pa.ListArray.from_arrays(pa.array(_ends(lists), pa.int32()), names.take(pa.array(place[np.where(hit, at, len(known))])))

        return work

    look_up = by_slices(factory, T.ArrayType(T.StringType()))
    plain = df.select(key, F.filter(F.col(tokens), lambda t: t >= FIRST_ID).alias("_ids"))
    named = plain.withColumn("_found", look_up("_ids"))
    table = vocabulary.select(F.col("token").alias("key"), F.col("word").alias("value"))
    found = _looked_up(named, "_ids", "_found", lambda v: v.isNull(), "_words", table, None)
    return found.select(key, F.array_join("_words", " ").alias("text"))


def count_tokens(tokens: str) -> list[Column]:
    return [
        F.size(tokens).cast("bigint").alias("total_tokens"),
        F.size(F.array_distinct(tokens)).cast("bigint").alias("unique_tokens"),
        F.size(F.filter(tokens, lambda t: t == UNK)).cast("bigint").alias("unknown_tokens"),
    ]


def padded(tokens: Column, length: int) -> Column:
    """Exactly ``length`` ids: longer lists are cut, shorter ones filled with the padding id."""
    return F.slice(F.concat(tokens, F.array_repeat(F.lit(PAD), length)), 1, length)


# fixed values: the tokens of the two small character-fallback vocabularies, in id order after four special tokens
SERVER_TOKENS = (
    "the", "a", "an", "is", "are", "was", "were", "be", "been", "have", "has", "had", "do", "does", "did", "will",
    "would", "could", "should", "may", "might", "must", "shall", "can", "hello", "world", "how", "what", "when",
    "where", "why", "who", "capital", "france", "paris", "of", "in", "on", "at", "to", "and", "or", "but", "not",
    "this", "that", "it", "for", "with", "AI", "machine", "learning", "model", "data", "train", "test", " ", ".",
    ",", "?", "!", ":", ";", "'", "\"", "-", "_",
)
ENGINE_TOKENS = (
    "the", "a", "an", "is", "are", "was", "be", "have", "has", "do", "does", "will", "can", "could", "would",
    "should", "hello", "world", "how", "what", "when", "where", "why", "who", "capital", "france", "paris", "of",
    "in", "on", "at", "to", "and", "or", "but", "not", "this", "that", "it", "for", "with", "AI", "artificial",
    "intelligence", "machine", "learning", "model", "data", " ", ".", ",", "?", "!", "\n",
)
# fixed values: ids of the begin, end and unknown tokens of the two versions
SERVER_SPECIALS = {"bos": 0, "eos": 1, "unk": 3}
ENGINE_SPECIALS = {"bos": 1, "eos": None, "unk": 3}


def _id_map(listed: Sequence[str]) -> Column:
    pairs = [F.lit(x) for i, token in enumerate(listed) for x in (token, FIRST_ID + i)]
    return F.create_map(*pairs)


def encode_with_characters(text: Column, listed: Sequence[str], specials: Mapping[str, int | None]) -> Column:
    """Begin token, then known words as one id and others as one id per character, a space id between words,
    and the end token in the version that has one."""
    ids = _id_map(listed)
    space = F.lit(FIRST_ID + list(listed).index(" "))
    unknown = F.lit(specials["unk"])

    def word(w: Column) -> Column:
        letters = F.transform(F.split(w, ""), lambda c: F.coalesce(F.try_element_at(ids, c), unknown))
        known = F.try_element_at(ids, w)
        return F.concat(F.when(known.isNotNull(), F.array(known)).otherwise(letters), F.array(space))

    coded = F.flatten(F.transform(words(text, lower=False), word))
    trimmed = F.slice(coded, F.lit(1), F.greatest(F.size(coded) - 1, F.lit(0)))
    ends = [] if specials["eos"] is None else [F.array(F.lit(specials["eos"]))]
    return F.concat(F.array(F.lit(specials["bos"])), trimmed, *ends)


def decode_characters(tokens: Column, listed: Sequence[str]) -> Column:
    """Tokens of the ids joined without a gap, special ids left out."""
    table = F.array(*[F.lit(t) for t in listed])
    named = F.transform(F.filter(tokens, lambda t: t >= FIRST_ID), lambda t: F.element_at(table, t - FIRST_ID + 1))
    return F.array_join(named, "")
