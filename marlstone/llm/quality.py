"""Operator 3: quality rules with an n-gram perplexity band per language.

The model of a language is a modified Kneser-Ney model of runs of four code points. Spark counts, for every run, the texts that hold it, fits all
orders by grouped aggregates and joins, and lays the model out as sorted arrays of hashes, in shards of bounded size: everything
that scores a code point behind a given one is in one shard. Texts are scored shard by shard; no limit is set on grams or languages.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.texts import code_points, map_texts, mix, per_process, slices
from marlstone.workspace import written

ORDER = 4
#: Entries of a shard, 12 bytes each: what a task holds, and what the driver passes on at a time.
SHARD_ENTRIES = 4_000_000
#: Different grams that a counting task gathers before it hands them on.
HELD_GRAMS = 1_000_000
#: Width of a band in interquartile ranges beyond the quartiles.
REACH = 3.0

# --- fixed values: limits and symbols of the base rules
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
# --- end of fixed values

_SYMBOLS = ["a", "b", "c", "d"]
#: One odd number per place of a symbol, counted from the last one of a gram.
_PLACES = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_CONTEXT = np.uint64(0x2545F4914F6CDD1D)


def fold_table() -> np.ndarray:
    """Code points as the model sees them: lower-case letters of all planes, one digit, one space; others are themselves."""
    table = np.arange(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isspace():
            table[point] = 32
        elif c.isdigit():
            table[point] = 48
        elif c.isalpha():
            table[point] = ord(c.lower()[0])
    return table


def runs(texts: list[str | None], table: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The symbols of the gram that ends at each code point of each text (spaces stand before a text), first symbol first, and where each text begins."""
    points, begins = code_points(texts)
    symbols = table[points]
    place = np.arange(len(points)) - np.repeat(begins[:-1], np.diff(begins))
    columns = []
    for back in range(ORDER - 1, -1, -1):
        earlier = np.full(len(symbols), 32, dtype=np.uint32)
        earlier[back:] = symbols[: len(symbols) - back]
        earlier[place < back] = 32
        columns.append(earlier)
    return columns, begins


def language_seed(name: str) -> np.uint64:
    """A number per language that goes into all its hashes."""
    seed = 0xCBF29CE484222325
    for byte in name.encode():
        seed = (seed ^ byte) * 0x100000001B3 % (1 << 64)
    return np.uint64(seed)


def hashes(symbols: list[np.ndarray], seed, context: bool = False) -> np.ndarray:
    """Hashes of grams (or of contexts) from their symbols, first symbol first. A context's last symbol stands one place before the next one."""
    total = np.atleast_1d(np.asarray(seed, dtype=np.uint64)) + np.uint64(len(symbols))
    total = np.broadcast_to(total + _CONTEXT if context else total, symbols[0].shape).copy()
    for place, column in enumerate(reversed(symbols)):
        total += (column.astype(np.uint64) + np.uint64(1)) * _PLACES[place]
    return mix(total)


def counted(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, a, b, c, d, n): the number n of other texts of the language that hold a gram some text holds; grams of one text alone are left out.

    Every occurrence in every whole text is looked at; a text counts once per gram. Tasks add up before the shuffle.
    """
    source = df.select(df[lang].alias("lang"), df[text].alias("text")).filter("text IS NOT NULL AND text <> ''")

    def run(batches):
        table = per_process(("quality symbols",), fold_table)
        held: dict[str, list] = {}
        size = 0

        def out():
            for name, parts in held.items():
                columns = [np.concatenate([p[i] for p in parts]) for i in range(ORDER + 1)]
                keys, first, where = np.unique(hashes(columns[:ORDER], np.uint64(0)), return_index=True, return_inverse=True)
                n = np.bincount(where.ravel(), weights=columns[ORDER], minlength=len(keys)).astype(np.int64)
                arrays = [pa.array([name] * len(keys), type=pa.string()), *[pa.array(columns[i][first].astype(np.int32)) for i in range(ORDER)], pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", *_SYMBOLS, "n"])
            held.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start, texts in slices(batch.column(1)):
                own = langs[start : start + len(texts)]
                for name in sorted(set(own)):
                    chosen = [t for t, x in zip(texts, own, strict=True) if x == name]
                    columns, begins = runs(chosen, table)
                    keys = hashes(columns, np.uint64(0))
                    owner = np.repeat(np.arange(len(chosen), dtype=np.uint64), np.diff(begins))
                    once = np.unique(mix(keys + owner * _CONTEXT), return_index=True)[1]  # a gram of a text
                    _, first, n = np.unique(keys[once], return_index=True, return_counts=True)
                    at = once[first]
                    held.setdefault(name, []).append([*[c[at] for c in columns], n])
                    size += len(at)
                if size > HELD_GRAMS:
                    yield from out()
                    size = 0
        yield from out()

    found = source.mapInArrow(run, "lang string, a int, b int, c int, d int, n long")
    return found.groupBy("lang", *_SYMBOLS).agg((F.sum("n") - 1).alias("n")).filter("n > 0")


def discounts(table: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): what is taken off counts 1, 2 and from 3 on, from the counts of counts; one row per language."""
    n = [F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]
    found = table.groupBy("lang").agg(*[x.cast("double").alias(f"n{k}") for k, x in enumerate(n, 1)])
    usual = F.least(*[F.col(f"n{k}") for k in (1, 2, 3, 4)]) > 0
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    raw = [k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
    return found.select("lang", *[F.when(usual, F.greatest(F.lit(0.05), F.least(F.lit(float(k)), x))).otherwise(0.5).alias(f"d{k}") for k, x in enumerate(raw, 1)])


def _off(n: Column) -> Column:
    return F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """Entries (lang, order, a, b, c, d, chance, weight) of the model: the chance of a gram's last symbol behind the others, and the weight of the
    next shorter order behind a context (its symbols end in ``c``; d is null). Order 0 is a language's weight of the uniform distribution.

    Lower orders count the symbols that precede a gram, not its occurrences. Symbols that an order does not use are null.
    """
    tables = [counts]
    for order in range(ORDER - 1, 0, -1):
        tables.insert(0, written(tables[0].groupBy("lang", *_SYMBOLS[ORDER - order :]).agg(F.count(F.lit(1)).alias("n")), f"order-{order}"))
    entries, lower = [], None
    none = F.lit(None).cast("int")
    for order, own in enumerate(tables, 1):
        symbols = _SYMBOLS[ORDER - order :]
        context = symbols[:-1]
        priced = own.join(F.broadcast(discounts(own)), "lang")  # one row per language
        behind = priced.groupBy("lang", *context).agg(F.sum("n").alias("total"), (F.sum(_off(F.col("n"))) / F.sum("n")).alias("weight"))
        below = priced.join(behind, ["lang", *context])
        if lower is None:
            # all symbols that a language has, and one for any other, are alike
            sizes = behind.join(own.groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("size")), "lang")
            below = priced.join(F.broadcast(sizes), "lang").withColumn("less", 1 / F.col("size"))
            behind = sizes.withColumn("weight", F.col("weight") / F.col("size"))
        else:
            below = below.join(lower.withColumnRenamed("chance", "less"), ["lang", *symbols[1:]])
        chance = (F.col("n") - _off(F.col("n"))) / F.col("total") + F.col("weight") * F.col("less")
        lower = written(below.select("lang", *symbols, chance.alias("chance")), f"chances-{order}")
        every = [F.col(x) if x in symbols else none.alias(x) for x in _SYMBOLS]
        entries.append(lower.select("lang", F.lit(order).alias("order"), *every, "chance", F.lit(None).cast("double").alias("weight")))
        ends = [F.col(x) if x in context else none.alias(x) for x in _SYMBOLS]
        entries.append(behind.select("lang", F.lit(order - 1).alias("order"), *ends, F.lit(None).cast("double").alias("chance"), "weight"))
    found = entries[0]
    for more in entries[1:]:
        found = found.unionByName(more)
    return found


def laid_out(entries: DataFrame) -> DataFrame:
    """(part, key, value): hashes with logarithms. ``part`` is drawn from the language and the context's last symbol, so all that scores one code
    point is in one part; what needs no context (single symbols and a language's own weight) has part -1 and goes everywhere."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {n: batch.column(i) for i, n in enumerate(("lang", "order", *_SYMBOLS, "chance", "weight"))}
            order = rows["order"].to_numpy(zero_copy_only=False)
            names, which = np.unique(np.array(rows["lang"].to_pylist(), dtype=object), return_inverse=True)
            seeds = np.array([language_seed(n) for n in names], dtype=np.uint64)[which.ravel()]
            symbols = [rows[x].fill_null(0).to_numpy(zero_copy_only=False) for x in _SYMBOLS]
            gram = np.asarray(rows["chance"].is_valid())
            value = np.log(np.where(gram, rows["chance"].fill_null(1.0).to_numpy(zero_copy_only=False), rows["weight"].fill_null(1.0).to_numpy(zero_copy_only=False)))
            key = np.zeros(len(order), dtype=np.uint64)
            for k in range(ORDER + 1):
                for kind in (True, False):
                    at = np.flatnonzero((order == k) & (gram == kind))
                    if len(at):
                        used = symbols[ORDER - k :] if kind else symbols[ORDER - 1 - k : ORDER - 1]
                        key[at] = hashes([x[at] for x in used], seeds[at], context=not kind) if k else mix(seeds[at] + _CONTEXT)
            part = (part_of(symbols[ORDER - 2], seeds) >> np.uint64(1)).astype(np.int64)
            part[(gram & (order == 1)) | (~gram & (order == 0))] = -1
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(key.view(np.int64)), pa.array(value)], names=["part", "key", "value"])

    return entries.select("lang", "order", *_SYMBOLS, "chance", "weight").mapInArrow(run, "part long, key long, value double")


def part_of(symbol: np.ndarray, seed) -> np.ndarray:
    return mix((symbol.astype(np.uint64) + np.uint64(1)) * _PLACES[0] + np.atleast_1d(np.asarray(seed, dtype=np.uint64)))


class Shard:
    """Sorted hashes with their values. A table of the leading bits tells where to look."""

    BITS = 18

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = np.append(keys, np.uint64((1 << 64) - 1)), np.append(values, np.float32(0))
        self.starts = np.searchsorted(keys, np.arange(1 << self.BITS, dtype=np.uint64) << np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found or not, value) of each hash."""
        at = self.starts[(asked >> np.uint64(64 - self.BITS)).astype(np.int64)]
        behind = np.flatnonzero(self.keys[at] < asked)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < asked[behind]]
        return self.keys[at] == asked, self.values[at]


def log_chances(columns: list[np.ndarray], seed: np.uint64, shard: Shard) -> np.ndarray:
    """The log probability of each gram's last symbol: of the longest order that has the gram, times the weights of the known contexts of the
    orders that lack it."""
    out = np.zeros(len(columns[0]))
    rest = np.arange(len(out))
    for order in range(ORDER, 0, -1):
        own = [c[rest] for c in columns[ORDER - order :]]
        hit, value = shard.find(hashes(own, seed))
        out[rest[hit]] += value[hit]
        rest, own = rest[~hit], [c[~hit] for c in own[:-1]]
        if not len(rest):
            return out
        if order > 1:
            known, weight = shard.find(hashes(own, seed, context=True))
            out[rest] += np.where(known, weight, 0)
    known, weight = shard.find(mix(np.atleast_1d(seed) + _CONTEXT))
    out[rest] += weight[0] if known[0] else 0.0
    return out


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word that equal an earlier one, words in windows of three that occur twice."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at ASCII white space alone
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(text.split("\n"))
    doubled = sum(n - 1 for line, n in lines.items() if n > 1 and line.strip(" \t\v\f\r"))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        reach = -1
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return len(words), chars, symbols, doubled, repeated


def scored(named: DataFrame, shards: int, part: int, laid: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """``named`` (row, lang, text) with the base counts and the sum of log probabilities of the code points that shard ``part`` of ``shards`` has."""
    own = laid.filter((F.col("part") < 0) | (F.pmod("part", F.lit(shards)) == part)).select("key", "value").toArrow().combine_chunks()
    keys, values = own["key"].to_numpy().view(np.uint64), own["value"].to_numpy().astype(np.float32)
    order = np.argsort(keys)
    carrier = named.sparkSession.sparkContext.broadcast((keys[order], values[order]))

    def factory():
        table = per_process(("quality symbols",), fold_table)
        shard = Shard(*carrier.value)

        def work(texts, langs):
            rows = [base_counts(t) if part == 0 else (0,) * 5 for t in texts]
            sums = [None if not t else 0.0 for t in texts]
            for name in sorted(set(langs)):
                chosen = [i for i, x in enumerate(langs) if x == name and texts[i]]
                if not chosen:
                    continue
                columns, begins = runs([texts[i] for i in chosen], table)
                seed = language_seed(name)
                owner = np.repeat(np.arange(len(chosen)), np.diff(begins))
                if shards > 1:
                    here = ((part_of(columns[ORDER - 2], seed) >> np.uint64(1)) % np.uint64(shards)) == part
                    columns, owner = [c[here] for c in columns], owner[here]
                total = np.bincount(owner, weights=log_chances(columns, seed, shard), minlength=len(chosen))
                for i, x in zip(chosen, total.tolist(), strict=True):
                    sums[i] = x
            return [*zip(*rows, strict=True), [len(t) if t else 0 for t in texts], sums]

        return work

    return map_texts(named, ["row", "doc_id", "model"], "text", fields, factory, also=["model"])


def quality(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", reach: float = REACH, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, perplexity for every whole text.

    Words are runs without ASCII white space; a null text has none. base_failed: under 50 words, or more than half of
    them in repeated windows. Others are kept if their log perplexity under the model of their language (null: a language of its own) lies in
    its band: between the quartiles of the language's documents, ``reach`` interquartile ranges beyond them; a document
    shorter than the median gets as much more room as its mean varies more. Models and bands cover all documents; a gram counts as often as
    other documents hold it, so a text does not vouch for itself. Texts without code points have no perplexity. Repeated rows count as
    often as they occur; empty tables give no rows.
    """
    model = F.coalesce(df[lang].cast("string"), F.lit(""))
    named = df.select(F.monotonically_increasing_id().alias("row"), df[key].alias("doc_id"), df[text].cast("string").alias("text"), model.alias("model"))
    laid = written(laid_out(kneser_ney(written(counted(named, "text", "model"), "grams"))), "model")
    shards = max(1, -(-laid.count() // shard_entries))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_points"]
    fields = [T.StructField(n, T.LongType()) for n in names] + [T.StructField("log_sum", T.DoubleType())]
    if shards > 1:
        named = written(named, "numbered")  # a row keeps its number from shard to shard
    parts = scored(named, shards, 0, laid, fields)
    for part in range(1, shards):
        parts = parts.unionByName(scored(named, shards, part, laid, fields))
    if shards > 1:
        parts = parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("model").alias("model"), *[F.max(n).alias(n) for n in names], F.sum("log_sum").alias("log_sum"))
    found = written(parts.withColumn("log_perplexity", F.try_divide(-F.col("log_sum"), F.col("n_points"))), "scored")
    usual = found.filter("n_words >= 50").groupBy("model").agg(
        F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("q"), F.percentile_approx("n_points", 0.5, 10000).alias("usual")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    spread = F.greatest(F.col("q")[2] - F.col("q")[0], F.lit(0.005)) * reach * F.sqrt(F.greatest(F.try_divide("usual", "n_points"), F.lit(1.0)))
    inside = F.col("log_perplexity").between(F.col("q")[0] - spread, F.col("q")[2] + spread)
    return found.join(usual, "model", "left").select(
        "doc_id", *names[:5], failed.alias("base_failed"), (~failed & F.coalesce(inside, F.lit(False))).alias("kept"), F.exp("log_perplexity").alias("perplexity")
    )
