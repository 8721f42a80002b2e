"""A stored inverted index of texts, read for the asked terms only, with exact search by block maxima.

Texts are cut into tiles of a fixed number, where the scan put them. A posting block is one term in one tile: which of its
texts hold the term, and how often. All blocks of a segment of many tiles whose terms share a hash bucket are one stored
row of packed columns, made inside a task by numpy; ids and lengths of the segment's texts are one more row. So no word
and no posting is ever a row of its own on its way, neither when rows are laid out by bucket nor in a search.

A search takes the asked terms out of the stored rows and brings what is left together by segment. It first reads block
maxima: their weighted sum over a question's terms bounds every score in a tile. The best tiles
are scored in full, which gives a score that the k-th best result reaches at least; only tiles whose bound is
not below it are scored as well. The result is the same as without bounds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.text import word_count, word_set
from marlstone.operators.blocks import BLOCK_QUERIES, MATRIX_CELLS, SCORE_DIGITS, _best
from marlstone.workspace import written

TILE, BUCKETS = 64, 32
#: The bucket of the rows that hold ids and lengths of a segment's texts.
TEXTS = -1
#: A segment has at most so many texts and about so many bytes of them; a task holds one at a time.
SEGMENT, SEGMENT_BYTES = 2048, 8_000_000
#: Tiles are numbered so that the lower bits count within a segment.
SEGMENT_BITS = (SEGMENT - 1).bit_length()
#: Tiles of each question that are scored first.
FIRST_TILES = 3
#: Room for the rounding of sums that are added up in another order.
SLACK = 1e-7
#: Asked terms of all questions that are on the driver at a time.
BLOCK_TERMS = 500_000
#: Terms that are counted in one piece.
PIECE_TERMS = 300_000
#: Low bits of a maximum's single precision that are not stored; maxima are rounded up.
TOP_BITS = 12

_PACKED = "segment bigint, words binary, tiles binary, tops binary, postings binary, ids binary, lengths binary"


def _bucket(term: Column) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(BUCKETS)).cast("int").alias("bucket")


def _hashes(terms: pa.Array) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms.cast(pa.binary()).to_pylist()), np.int64, len(terms))


# --- packed columns -------------------------------------------------------------------


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers from 0: each in the least bytes that hold it, the first byte of all, then the second of all, compressed."""
    out = [bytes([len(columns)])]
    for c in columns:
        c = c.astype(np.min_scalar_type(int(c.max()) if len(c) else 0))
        body = pa.compress(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes(), codec="zstd", asbytes=True)
        out += [bytes([c.itemsize]), len(c).to_bytes(8, "little"), len(body).to_bytes(8, "little"), body]
    return b"".join(out)


def _unpack(packed: bytes) -> list[np.ndarray]:
    out, at = [], 1
    for _ in range(packed[0]):
        width, n, size = packed[at], int.from_bytes(packed[at + 1 : at + 9], "little"), int.from_bytes(packed[at + 9 : at + 17], "little")
        raw = np.frombuffer(pa.decompress(packed[at + 17 : at + 17 + size], n * width, codec="zstd"), np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(width, n).T).view(f"<u{width}").ravel().astype(np.int64))
        at += 17 + size
    return out


def _pack_words(terms: pa.Array) -> bytes:
    data = np.frombuffer(b"".join(terms.cast(pa.binary()).to_pylist()), np.uint8)
    return _pack(pc.binary_length(terms).to_numpy(zero_copy_only=False).astype(np.int64), data)


def _unpack_words(packed: bytes) -> pa.Array:
    lengths, data = _unpack(packed)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends.tobytes()), pa.py_buffer(data.astype(np.uint8).tobytes()))


def _rounded_up(tops: np.ndarray) -> np.ndarray:
    """The bits of single precision numbers that are not below ``tops``, without the lowest ones."""
    single = tops.astype(np.float32)
    single = np.where(single < tops, np.nextafter(single, np.float32(np.inf)), single).astype(np.float32)
    return (single.view(np.uint32).astype(np.int64) + (1 << TOP_BITS) - 1) >> TOP_BITS


def _tops(bits: np.ndarray) -> np.ndarray:
    return (bits << TOP_BITS).astype(np.uint32).view(np.float32).astype(float)


def _pack_ids(ids: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ids.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(ids)
    return sink.getvalue().to_pybytes()


def _unpack_ids(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all members of runs, run by run."""
    return np.repeat(starts - _starts(sizes), sizes) + np.arange(sizes.sum())


# --- the index ------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """Tables of a stored index: ``stored`` (bucket, segment, packed columns), ``terms`` (bucket, term, n, occurrences), ``size`` (n, mean), ``weights`` (mean, k1, b); ``item`` has the types of the ids."""

    ids: tuple[str, ...]
    item: T.StructType
    stored: DataFrame
    terms: DataFrame
    size: DataFrame
    weights: DataFrame

    @property
    def blocks(self) -> DataFrame:
        """(bucket, term, tile, ids, counts, lengths, top), one row per term and tile."""
        return _opened(self.stored, self.item).select(_bucket(F.col("term")), "term", "tile", "ids", "counts", "lengths", "top")

    @staticmethod
    def read(spark: SparkSession, path: str) -> Index:
        size = spark.read.parquet(f"{path}/size")
        item = size.schema["ids"].dataType.elementType  # the tables of an empty corpus have no file that tells it
        stored = spark.read.schema(f"{_PACKED}, bucket int").parquet(f"{path}/blocks")
        terms = spark.read.schema("term string, n bigint, occurrences bigint, n_blocks bigint, bucket int").parquet(f"{path}/terms")
        return Index(tuple(item.names), item, stored, terms, size.select("n", "mean"), size.select("mean", "k1", "b"))


def _pieces(batch: pa.RecordBatch, room: int, room_bytes: int) -> int:
    """How many rows of the batch fit; at least one."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    return max(1, min(room, int(np.searchsorted(ends, room_bytes, side="right"))))


def _segment(rows: pa.Table, ids: Sequence[str], tile: int, first_tile: int, part: Callable) -> pa.RecordBatch:
    """The packed rows of the lower-case texts: one per bucket of terms, with the largest ``part(counts, lengths)`` of each block, and one of ids and lengths."""
    n = rows.num_rows
    split = pc.ascii_split_whitespace(pc.fill_null(rows.column("text").combine_chunks(), ""))  # at the same characters as the JVM
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    at, flat = np.repeat(np.arange(n), pc.list_value_length(split).to_numpy(zero_copy_only=False)), split.flatten()
    named = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    at, coded = at[named], flat.filter(pa.array(named)).dictionary_encode()
    lengths = np.bincount(at, minlength=n)
    turn = np.argsort(lengths, kind="stable")  # texts of like length share tiles, or every tile's maxima would be those of its shortest texts
    placed = np.empty(n, np.int64)
    placed[turn] = np.arange(n)
    at, lengths = placed[at], lengths[turn]
    names = coded.dictionary.cast(pa.string())
    buckets = _hashes(names) % BUCKETS
    order = pc.sort_indices(pa.table({"b": buckets, "w": names}), [("b", "ascending"), ("w", "ascending")]).to_numpy(zero_copy_only=False)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))  # of a term by bucket and name, so that neighbours look alike
    names, buckets = names.take(pa.array(order)), buckets[order]
    pairs, counts = np.unique(number[coded.indices.to_numpy(zero_copy_only=False)] * n + at, return_counts=True)
    term, row = pairs // n, pairs % n
    block = term * (n // tile + 1) + row // tile
    begins = np.flatnonzero(np.diff(block, prepend=-1))  # of the blocks among the postings
    tops = np.maximum.reduceat(part(counts.astype(float), lengths[row].astype(float)), begins) if len(row) else np.zeros(0)
    sizes, tiles, per_term = np.diff(begins, append=len(row)), row[begins] // tile, np.bincount(term[begins], minlength=len(names))
    of_term, of_block = np.append(_starts(per_term), len(begins)), np.append(begins, len(row))
    found: dict[str, list] = {c: [] for c in ("bucket", "words", "tiles", "tops", "postings", "ids", "lengths")}

    def add(**row) -> None:
        for c, values in found.items():
            values.append(row.get(c))

    held = pa.RecordBatch.from_arrays([rows.column(i).combine_chunks().take(pa.array(turn)) for i in ids], list(ids))
    add(bucket=TEXTS, ids=_pack_ids(held), lengths=_pack(np.array([tile]), lengths))
    for bucket in np.unique(buckets):
        t, t_end = np.searchsorted(buckets, [bucket, bucket + 1])
        b, b_end = of_term[[t, t_end]]
        p, p_end = of_block[[b, b_end]]
        add(
            bucket=int(bucket),
            words=_pack_words(names.slice(t, t_end - t)),
            tiles=_pack(per_term[t:t_end], tiles[b:b_end]),
            tops=_pack(_rounded_up(tops[b:b_end])),
            postings=_pack(sizes[b:b_end], row[p:p_end] % tile, counts[p:p_end]),
        )
    kinds = {"bucket": pa.int32()}
    arrays = [pa.array(np.full(len(found["bucket"]), first_tile), pa.int64()), *[pa.array(v, kinds.get(c, pa.binary())) for c, v in found.items()]]
    return pa.RecordBatch.from_arrays(arrays, names=["segment", *found])


def packed(corpus: DataFrame, ids: Sequence[str], text: str, part: Callable, tile: int = TILE) -> DataFrame:
    """(segment, bucket, packed columns) of the lower-case words of ``text``: a row per segment and bucket of terms, and one for its texts.

    A segment is a run of rows of one partition; null and blank texts have length 0.
    """
    names = list(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        n = size = 0
        for batch in batches:
            while batch.num_rows:
                fit = _pieces(batch, SEGMENT - n, SEGMENT_BYTES - size)
                piece, batch = batch.slice(0, fit), batch.slice(fit)
                held.append(piece)
                n, size = n + fit, size + piece.column("text").nbytes
                if n >= SEGMENT or size >= SEGMENT_BYTES or batch.num_rows:
                    yield _segment(pa.Table.from_batches(held), names, tile, (task << 33) + (number << SEGMENT_BITS), part)
                    held, n, size, number = [], 0, 0, number + 1
        if held:
            yield _segment(pa.Table.from_batches(held), names, tile, (task << 33) + (number << SEGMENT_BITS), part)

    rows = corpus.select(*ids, F.lower(text).alias("text"))
    return rows.mapInArrow(run, "segment bigint, bucket int, words binary, tiles binary, tops binary, postings binary, ids binary, lengths binary")


def _item(corpus: DataFrame, ids: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(i, corpus.schema[i].dataType) for i in ids])


def _text_row(group: pa.Table) -> tuple[pa.Table, int, np.ndarray]:
    """Ids, texts per tile and lengths of a segment's texts."""
    held = group.filter(pc.is_valid(group["ids"]))
    tile, lengths = _unpack(held["lengths"][0].as_py())
    return _unpack_ids(held["ids"][0].as_py()), int(tile[0]), lengths


def _opened(rows: DataFrame, item: T.StructType) -> DataFrame:
    """(term, segment, tile, ids, counts, lengths, top): the blocks of packed rows, one row each."""

    def run(group: pa.Table) -> pa.Table:
        ids, size, lengths = _text_row(group)
        key = pa.StructArray.from_arrays([c.combine_chunks() for c in ids.columns], ids.column_names)
        segment, made = group["segment"][0].as_py(), []
        for r in group.filter(pc.is_valid(group["words"])).select(["words", "tiles", "tops", "postings"]).to_pylist():
            (per_term, tiles), (tops,), (sizes, places, counts) = _unpack(r["tiles"]), _unpack(r["tops"]), _unpack(r["postings"])
            at, ends = np.repeat(tiles, sizes) * size + places, pa.array(np.append(_starts(sizes), len(places)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, x) for x in (key.take(pa.array(at)), pa.array(counts, pa.int32()), pa.array(lengths[at], pa.int32()))]
            terms = _unpack_words(r["words"]).take(pa.array(np.repeat(np.arange(len(per_term)), per_term)))
            made.append(pa.table([terms, pa.array(np.full(len(tiles), segment)), pa.array(segment + tiles), *lists, pa.array(_tops(tops))], names=names))
        return pa.concat_tables(made) if made else empty.empty_table()

    names = ["term", "segment", "tile", "ids", "counts", "lengths", "top"]
    schema = f"term string, segment bigint, tile bigint, ids array<{item.simpleString()}>, counts array<int>, lengths array<int>, top double"
    empty = _arrow(T.StructType.fromDDL(schema))
    return rows.groupBy("segment").applyInArrow(run, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def segments(corpus: DataFrame, ids: Sequence[str], text: str, part: Callable, tile: int = TILE) -> DataFrame:
    """(term, segment, tiles): the posting blocks (tile, ids, counts, lengths, top) of the lower-case words of ``text``, a row per term and segment.

    ``top`` is the largest ``part(counts, lengths)`` of a block, rounded up to some three digits.
    """
    opened = _opened(packed(corpus, ids, text, part, tile), _item(corpus, ids))
    tiles = F.array_sort(F.collect_list(F.struct("tile", "ids", "counts", "lengths", "top")))
    return opened.groupBy("term", "segment").agg(tiles.alias("tiles"))


def _part(n, long, mean, k1, b):
    """What ``n`` occurrences in a text of ``long`` words count."""
    return n * (k1 + 1) / (n + k1 * (1 - b + b * long / mean))


def build(corpus: DataFrame, ids: Sequence[str], text: str, path: str, k1: float = 1.5, b: float = 0.75, tile: int = TILE) -> Index:
    """Store the index of ``corpus`` below ``path``: laid out by term hash, with the largest BM25 part of each block.

    The texts are read twice: their mean length is known before the blocks are made, which go straight to where they stay.
    """
    spark = corpus.sparkSession
    length = F.coalesce(word_count(F.col(text)), F.lit(0))
    size = corpus.select(length.alias("_long")).agg(F.count(F.lit(1)).alias("n"), F.try_divide(F.sum("_long"), F.count(F.lit(1))).alias("mean"))
    size = size.select("n", "mean", F.lit(float(k1)).alias("k1"), F.lit(float(b)).alias("b"), F.lit(None).cast(T.ArrayType(_item(corpus, ids))).alias("ids"))
    size.coalesce(1).write.parquet(f"{path}/size")
    mean = spark.read.parquet(f"{path}/size").first()["mean"] or 1.0  # without words there is no block
    made = packed(corpus, ids, text, lambda n, long: _part(n, long, mean, k1, b), tile)
    # a frequent term has blocks in every segment, so its bucket is dealt by segment as well
    laid = made.repartition("bucket", F.pmod(F.xxhash64("segment"), F.lit(8))).sortWithinPartitions("bucket", "segment")
    laid.write.option("compression", "none").partitionBy("bucket").parquet(f"{path}/blocks")
    stored = spark.read.schema(f"{_PACKED}, bucket int").parquet(f"{path}/blocks")
    counted_terms(stored).write.partitionBy("bucket").parquet(f"{path}/terms")
    return Index.read(spark, path)


# --- counts of terms ------------------------------------------------------------------


def _added_up(terms: list[pa.Array], numbers: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """Every term once, with the sums of its columns of ``numbers``."""
    coded = pa.chunked_array(terms, pa.string()).combine_chunks().dictionary_encode()
    at, n = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    every = np.concatenate(numbers, axis=1)
    return coded.dictionary, np.array([np.bincount(at, weights=x, minlength=n) for x in every]).astype(np.int64)


def counted_terms(stored: DataFrame) -> DataFrame:
    """(term, n, occurrences, n_blocks, bucket) of packed rows: texts and blocks that hold the term, and how often they do.

    Terms leave a task added up, packed, and dealt to pieces by hash; a piece has about ``PIECE_TERMS`` terms of as many segments as there are.
    """
    rows = stored.where(F.col("bucket") != TEXTS).select("bucket", "words", "tiles", "postings")
    n_bytes = stored.where(F.col("bucket") != TEXTS).agg(F.sum(F.length("words"))).first()[0] or 0
    pieces = max(1, math.ceil(n_bytes / 4 / BUCKETS / PIECE_TERMS))  # a packed word takes four bytes or more

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: list[pa.Array] = []
        numbers: list[np.ndarray] = []
        of, n = None, 0

        def done() -> Iterator[pa.RecordBatch]:
            names, sums = _added_up(terms, numbers)
            piece = _hashes(names) // BUCKETS % pieces
            for k in np.unique(piece):
                at = np.flatnonzero(piece == k)
                row = [pa.array([of], pa.int32()), pa.array([k], pa.int32()), pa.array([_pack_words(names.take(pa.array(at)))]), pa.array([_pack(*sums[:, at])])]
                yield pa.RecordBatch.from_arrays(row, names=["bucket", "piece", "words", "numbers"])

        for batch in batches:
            for i in range(batch.num_rows):
                bucket, packed_words, tiles, postings = (c[i].as_py() for c in batch.columns)
                if terms and (bucket != of or n > PIECE_TERMS):
                    yield from done()
                    terms, numbers, n = [], [], 0
                (per_term, _), (sizes, _, counts) = _unpack(tiles), _unpack(postings)
                at, of = _starts(per_term), bucket
                terms.append(_unpack_words(packed_words))
                numbers.append(np.array([np.add.reduceat(sizes, at), np.add.reduceat(np.add.reduceat(counts, _starts(sizes)), at), per_term]))
                n += len(per_term)
        if terms:
            yield from done()

    def merge(group: pa.Table) -> pa.Table:
        names, sums = _added_up([_unpack_words(w.as_py()) for w in group["words"]], [np.array(_unpack(x.as_py())) for x in group["numbers"]])
        bucket = pa.array(np.full(len(names), group["bucket"][0].as_py()), pa.int32())
        return pa.table([names, *map(pa.array, sums), bucket], names=["term", "n", "occurrences", "n_blocks", "bucket"])

    counted = rows.mapInArrow(count, "bucket int, piece int, words binary, numbers binary")
    return counted.groupBy("bucket", "piece").applyInArrow(merge, "term string, n bigint, occurrences bigint, n_blocks bigint, bucket int")


# --- search ---------------------------------------------------------------------------


def asked_terms(index: Index, questions: DataFrame) -> DataFrame:
    """(query_id, bucket, term, weight): distinct words of each question that the index has, idf = ln(1 + (N - n + 0.5) / (n + 0.5))."""
    n_texts = index.size.select("n").scalar()
    asked = questions.select("query_id", F.explode(word_set(F.col("question"))).alias("term")).withColumn("bucket", _bucket(F.col("term")))
    found = asked.join(index.terms, ["bucket", "term"])
    return found.select("query_id", "bucket", "term", F.log(1 + (n_texts - F.col("n") + 0.5) / (F.col("n") + 0.5)).alias("weight"))


class _Asked:
    """Terms that a block of questions asks for, numbered, and the questions of each; it travels with the tasks."""

    def __init__(self, asked: DataFrame):
        rows = asked.where("query_id IS NOT NULL").toArrow().sort_by([("query_id", "ascending"), ("term", "ascending")])
        self.query_field = rows.schema.field("query_id")
        coded, terms = rows["query_id"].combine_chunks().dictionary_encode(), rows["term"].combine_chunks().dictionary_encode()
        self.queries, self.query = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.term, self.n_terms = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(terms.dictionary)
        self.weight = rows["weight"].to_numpy()
        buckets = np.zeros(self.n_terms, np.int64)
        buckets[self.term] = rows["bucket"].to_numpy()
        self.by_bucket = {int(b): (terms.dictionary.take(pa.array(at)), at) for b in np.unique(buckets) for at in [np.flatnonzero(buckets == b)]}

    def entries(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, weight, place of the term in ``numbers``) of all pairs of a question and a term of ``numbers``, by question."""
        place = np.full(self.n_terms, -1)
        place[numbers] = np.arange(len(numbers))
        at = place[self.term]
        return self.query[at >= 0], self.weight[at >= 0], at[at >= 0]


def _met(index: Index, terms: DataFrame, by_bucket: dict[int, tuple[pa.Array, np.ndarray]], column: str, within: Sequence[int] | None = None) -> DataFrame:
    """(segment, met, ids, lengths): of packed rows, the numbers of the terms in ``by_bucket`` and their blocks, with ``tops`` or ``postings``; and the rows of texts.

    ``terms`` has their buckets: only these are read. ``within`` names segments.
    """
    buckets = terms.where(F.col("bucket") >= 0).select("bucket").distinct()  # never more than BUCKETS rows
    stored = index.stored if within is None else index.stored.where(F.col("segment").isin([int(s) for s in within]))
    rows = stored.select("segment", "bucket", "words", "tiles", column).join(F.broadcast(buckets), "bucket").select("segment", "bucket", "words", "tiles", column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment, bucket, packed_words, tiles, rest = (c[i].as_py() for c in batch.columns)
                asked, numbers = by_bucket.get(bucket, (None, None))
                found = pc.fill_null(pc.index_in(_unpack_words(packed_words), value_set=asked), -1).to_numpy(zero_copy_only=False) if asked is not None else np.zeros(0)
                held = np.flatnonzero(found >= 0)
                if not len(held):
                    continue
                per_term, at_tiles = _unpack(tiles)
                blocks = _runs(_starts(per_term)[held], per_term[held])
                out = [numbers[found[held]], per_term[held], at_tiles[blocks]]
                if column == "tops":
                    out.append(_unpack(rest)[0][blocks])
                else:
                    sizes, places, counts = _unpack(rest)
                    postings = _runs(_starts(sizes)[blocks], sizes[blocks])
                    out += [sizes[blocks], places[postings], counts[postings]]
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([_pack(*out)])], names=["segment", "met"])

    null = F.lit(None).cast("binary")
    parts = rows.mapInArrow(run, "segment bigint, met binary").select("segment", "met", null.alias("ids"), null.alias("lengths"))
    if column == "tops":
        return parts
    return parts.unionByName(stored.where(F.col("bucket") == TEXTS).select("segment", null.alias("met"), "ids", "lengths"))


def _gathered(group: pa.Table) -> list[np.ndarray] | None:
    """The columns of all ``met`` of a segment, one after the other."""
    found = [_unpack(m.as_py()) for m in group["met"] if m.is_valid]
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else None


def _cuts(query: np.ndarray, sizes: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Runs of whole questions with at most ``MATRIX_CELLS`` cells of ``width`` a question and about twice as many of ``sizes``, unless a single one has more."""
    begins = np.append(np.flatnonzero(np.diff(query, prepend=-1)), len(query))
    work, at = np.append(0, np.cumsum(sizes))[begins], 0
    while at < len(begins) - 1:
        fit = np.searchsorted(work, work[at] + 2 * MATRIX_CELLS, side="right") - 1
        wide = np.searchsorted(query[begins[:-1]], query[begins[at]] + max(1, MATRIX_CELLS // width))
        stop = max(at + 1, min(int(fit), int(wide)))
        yield int(begins[at]), int(begins[stop])
        at = stop


def bounds(index: Index, asked: DataFrame) -> DataFrame:
    """(query_id, tile, bound): no text of the tile scores more. Only block maxima are read. ``asked`` is one block of questions."""
    held = _Asked(asked)
    schema = T.StructType([asked.schema["query_id"], T.StructField("tile", T.LongType()), T.StructField("bound", T.DoubleType())])
    empty = _arrow(schema)

    def run(group: pa.Table) -> pa.Table:
        numbers, per_term, tiles, bits = _gathered(group)
        segment, tops, begins = group["segment"][0].as_py(), _tops(bits), _starts(per_term)
        query, weight, at = held.entries(numbers)
        width, made = int(tiles.max()) + 1, []
        for lo, hi in _cuts(query, per_term[at], width):
            sizes = per_term[at[lo:hi]]
            blocks = _runs(begins[at[lo:hi]], sizes)
            cells = np.repeat(query[lo:hi] - query[lo], sizes) * width + tiles[blocks]
            total = np.bincount(cells, weights=np.repeat(weight[lo:hi], sizes) * tops[blocks])
            hit = np.flatnonzero(total)
            made.append(pa.table([held.queries.take(pa.array(query[lo] + hit // width)), pa.array(segment + hit % width), pa.array(total[hit])], names=empty.names))
        return pa.concat_tables(made) if made else empty.empty_table()

    return _met(index, asked, held.by_bucket, "tops").groupBy("segment").applyInArrow(run, schema)


def scored(index: Index, asked: DataFrame, tiles: DataFrame, k: int | None = None, within: Sequence[int] | None = None) -> DataFrame:
    """(query_id, ids..., score) of all texts in ``tiles`` (query_id, tile) that hold a word of the question, or the best ``k`` of each question and segment.

    ``asked`` is one block of questions; ``within`` names all segments of ``tiles`` if they are known to be few.
    """
    held, weights = _Asked(asked), index.weights.first()
    schema = T.StructType([asked.schema["query_id"], *index.item, T.StructField("score", T.DoubleType())])
    empty = _arrow(schema)

    def run(wanted: pa.Table, group: pa.Table) -> pa.Table:
        found = _gathered(group) if wanted.num_rows else None
        if found is None:
            return empty.empty_table()
        numbers, per_term, at_tile, sizes, places, counts = found
        ids, tile, lengths = _text_row(group)
        row = np.repeat(at_tile, sizes) * tile + places
        parts = _part(counts.astype(float), lengths[row].astype(float), weights["mean"], weights["k1"], weights["b"])
        n, n_tiles = len(lengths), -(-len(lengths) // tile)
        order = np.empty(n, np.int64)
        order[pc.sort_indices(ids, [(c, "ascending") for c in ids.column_names], null_placement="at_start").to_numpy(zero_copy_only=False)] = np.arange(n)
        open_ = np.zeros((len(held.queries), n_tiles), bool)
        asks = pc.fill_null(pc.index_in(wanted["query_id"], value_set=held.queries), -1).to_numpy()
        open_[asks[asks >= 0], wanted["tile"].to_numpy()[asks >= 0] - wanted["segment"][0].as_py()] = True
        of_term, of_block = _starts(per_term), _starts(sizes)
        query, weight, at = held.entries(numbers)
        made = []
        for lo, hi in _cuts(query, np.add.reduceat(sizes, of_term)[at], n):
            blocks, per = _runs(of_term[at[lo:hi]], per_term[at[lo:hi]]), per_term[at[lo:hi]]
            q, w = np.repeat(query[lo:hi], per), np.repeat(weight[lo:hi], per)
            wide = open_[q, at_tile[blocks]]
            blocks, q, w = blocks[wide], q[wide] - query[lo], w[wide]
            if not len(blocks):
                continue
            postings, per = _runs(of_block[blocks], sizes[blocks]), sizes[blocks]
            n_queries = int(query[hi - 1] - query[lo]) + 1
            total = np.bincount(np.repeat(q, per) * n + row[postings], weights=np.repeat(w, per) * parts[postings], minlength=n_queries * n)
            scores = np.where(total > 0, np.round(total, SCORE_DIGITS), np.nan).reshape(n_queries, n).T
            rows, columns = _best(scores, order, min(n, k or n))
            key = ids.take(pa.array(rows))
            made.append(pa.table([held.queries.take(pa.array(query[lo] + columns)), *key.columns, pa.array(scores[rows, columns])], names=empty.names))
        return pa.concat_tables(made) if made else empty.empty_table()

    segment = F.shiftleft(F.shiftright("tile", SEGMENT_BITS), SEGMENT_BITS).alias("segment")
    wanted = tiles.select(segment, "query_id", "tile").groupBy("segment")
    return wanted.cogroup(_met(index, asked, held.by_bucket, "postings", within).groupBy("segment")).applyInArrow(run, schema)


def best(rows: DataFrame, order: list[Column], k: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col(name) <= k)


def kept_tiles(index: Index, asked: DataFrame, k: int, first: int = FIRST_TILES) -> tuple[DataFrame, DataFrame]:
    """(all tiles with a bound, the ones that can hold a result among the best ``k``). ``asked`` is one block of questions."""
    found = written(bounds(index, asked), "bounds")
    early = written(best(found, [F.desc("bound"), F.col("tile")], first, "_no"), "early")
    within = [r[0] for r in early.select(F.shiftleft(F.shiftright("tile", SEGMENT_BITS), SEGMENT_BITS)).distinct().collect()]
    reached = best(scored(index, asked, early, k, within), [F.desc("score"), *map(F.col, index.ids)], k, "_no").where(F.col("_no") == k)
    limits = found.join(reached.select("query_id", F.col("score").alias("limit")), "query_id", "left")
    return found, limits.where(F.col("bound") + SLACK >= F.coalesce("limit", F.lit(0.0))).select("query_id", "tile")


def search(index: Index, questions: DataFrame, k: int) -> DataFrame:
    """(query_id, ids..., score, rank): the best ``k`` texts of each question by BM25, ties by id; only texts with a word of the question.

    Questions come in blocks of about ``BLOCK_QUERIES``, whose terms are on the driver one block at a time; of several, each one's
    results are written before the next begins.
    """
    asked = written(asked_terms(index, questions), "asked")
    many = asked.agg(F.count(F.lit(1)).alias("terms"), F.count_distinct("query_id").alias("queries")).first()
    blocks = max(1, math.ceil(many["terms"] / BLOCK_TERMS), math.ceil(many["queries"] / BLOCK_QUERIES))
    every = None
    for i in range(blocks):
        block = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i)
        _, tiles = kept_tiles(index, block, k)
        found = best(scored(index, block, written(tiles, "tiles"), k), [F.desc("score"), *map(F.col, index.ids)], k, "rank").where("score > 0")
        found = found if blocks == 1 else written(found, "found")
        every = found if every is None else every.unionByName(found)
    return every


def occurrences(index: Index, wanted: DataFrame) -> DataFrame:
    """``wanted`` (query_id, ids..., term) with ``n``, how often the text holds the term; rows without an occurrence are left out."""
    terms = written(wanted.select("term").distinct().withColumn("bucket", _bucket(F.col("term"))), "wanted")
    blocks = max(1, math.ceil(terms.count() / BLOCK_TERMS))
    every = None
    for i in range(blocks):
        block = terms if blocks == 1 else terms.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == i)
        found = _counted(index, block)
        every = found if every is None else every.unionByName(found)
    return wanted.join(every, [*index.ids, "term"])


def _counted(index: Index, terms: DataFrame) -> DataFrame:
    """(term, ids..., n) of all texts that hold one of ``terms`` (term, bucket)."""
    rows = terms.where("term IS NOT NULL").toArrow()
    names, buckets = rows["term"].combine_chunks(), rows["bucket"].to_numpy()
    by_bucket = {int(b): (names.take(pa.array(at)), at) for b in np.unique(buckets) for at in [np.flatnonzero(buckets == b)]}
    schema = T.StructType([T.StructField("term", T.StringType()), *index.item, T.StructField("n", T.IntegerType())])
    empty = _arrow(schema)

    def run(group: pa.Table) -> pa.Table:
        found = _gathered(group)
        if found is None:
            return empty.empty_table()
        numbers, per_term, at_tile, sizes, places, counts = found
        ids, tile, _ = _text_row(group)
        key = ids.take(pa.array(np.repeat(at_tile, sizes) * tile + places))
        term = names.take(pa.array(np.repeat(np.repeat(numbers, per_term), sizes)))
        return pa.table([term, *key.columns, pa.array(counts, pa.int32())], names=empty.names)

    return _met(index, terms, by_bucket, "postings").groupBy("segment").applyInArrow(run, schema)
