"""Operator 4: pack token ids into sequences of a fixed length with little padding, in bounded space."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marlstone.llm.texts import slices
from marlstone.llm.tokens import tokenizer
from marlstone.workspace import written

LENGTH = 1024
OPEN_WINDOWS = 64

_FIELDS = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("left", T.BinaryType()),
]


class Packer:
    """A fixed number of open windows; takes one document after the other and gives out the pieces of emitted windows.

    A piece is (key, start, raw ids, tokens of its document); an emitted window is a list of pieces.
    """

    def __init__(self, length: int = LENGTH, open_windows: int = OPEN_WINDOWS):
        self.length, self.limit = length, open_windows
        self.windows: dict[int, list] = {}
        self.free: list[tuple[int, int]] = []  # (places left, window), sorted
        self.made = 0
        self.emitted: list[list] = []

    def add(self, key, raw: bytes) -> None:
        """Whole sequences are cut off first; the rest is placed."""
        total = len(raw) // 4
        whole = total // self.length * self.length
        for start in range(0, whole, self.length):
            self.emitted.append([(key, start, raw[4 * start : 4 * (start + self.length)], total)])
        if whole < total:
            self.place((key, whole, raw[4 * whole :], total))

    def place(self, piece: tuple) -> None:
        """Best fit. When no open window has room, the fullest one is filled with the head of the piece and emitted, and the rest is placed."""
        key, start, raw, total = piece
        while True:
            size = len(raw) // 4
            at = bisect_left(self.free, (size, -1))
            if at < len(self.free):
                room, window = self.free.pop(at)
                self.windows[window].append((key, start, raw, total))
                self._put(window, room - size)
                return
            if len(self.free) < self.limit:
                self.made += 1
                self.windows[self.made] = [(key, start, raw, total)]
                self._put(self.made, self.length - size)
                return
            room, window = self.free.pop(0)
            self.windows[window].append((key, start, raw[: 4 * room], total))
            self._put(window, 0)
            start, raw = start + room, raw[4 * room :]

    def _put(self, window: int, room: int) -> None:
        if room:
            insort(self.free, (room, window))
        else:
            self.emitted.append(self.windows.pop(window))

    def taken(self) -> list[list]:
        out, self.emitted = self.emitted, []
        return out

    def close(self) -> list[tuple]:
        """The pieces left over, at most one open window's worth: the emptiest windows are emptied into the fullest ones."""
        left = [self.windows[w] for _, w in self.free]
        self.windows, self.free = {}, []
        rest: list[tuple] = []
        held = 0
        for key, start, raw, total in (piece for window in left for piece in window):
            while held + len(raw) // 4 >= self.length:
                room = self.length - held
                self.emitted.append([*rest, (key, start, raw[: 4 * room], total)])
                start, raw, rest, held = start + room, raw[4 * room :], [], 0
            if raw:
                rest.append((key, start, raw, total))
                held += len(raw) // 4
        return rest


def pack(df: DataFrame, path: str, keys: list[str], end: int, text: str = "text", length: int = LENGTH, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece of a document's ids (its tokens and the id ``end``): ``keys``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every partition packs online into ``open_windows`` windows where the scan put the rows, without a shuffle. What is left, less
    than one window per partition, is merged: those pieces are laid end to end and cut every ``length`` ids. So only the very
    last sequence can be shorter than ``length``. A null or empty text is the id ``end`` alone; an empty table gives no rows.
    Repeated rows are packed each on its own. The pieces are written once, so the merge does not encode again.
    """
    load = tokenizer(path)
    source = df.select(*[df[c] for c in keys], df[text].cast("string").alias("text to map"))
    schema = T.StructType([df.schema[c] for c in keys] + _FIELDS)
    width = len(keys)
    stop = end.to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        bpe, packer = load(), Packer(length, open_windows)
        part = TaskContext.get().partitionId()
        number = 0

        def rows(windows, left=False):
            nonlocal number
            taken = []  # (key, start, length, crc, total, sequence, offset, left)
            for window in windows:
                offset = 0
                for key, start, raw, total in window:
                    taken.append((key, start, len(raw) // 4, zlib.crc32(raw), total, (part << 40) + number, offset, raw if left else None))
                    offset += len(raw) // 4
                number += 1
            columns = list(zip(*taken, strict=True)) if taken else [()] * 8
            keyed = list(zip(*columns[0], strict=True)) if taken else [()] * width
            arrays = [pa.array(v, type=k) for v, k in zip(keyed, kinds, strict=True)]
            arrays += [pa.array(v, type=pa.binary() if f.name == "left" else pa.int64()) for v, f in zip(columns[1:], _FIELDS, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

        kinds = None
        for batch in batches:
            kinds = [batch.column(i).type for i in range(width)]
            named = list(zip(*[batch.column(i).to_pylist() for i in range(width)], strict=True))
            for start, texts in slices(batch.column(width)):
                for key, raw in zip(named[start : start + len(texts)], bpe.encode(texts), strict=True):
                    packer.add(key, raw + stop)
                yield rows(packer.taken())
        if kinds is not None:
            rest = packer.close()
            yield rows(packer.taken())
            yield rows([rest], left=True)

    pieces = written(source.mapInArrow(run, schema), "packed")
    names = [*keys, *(f.name for f in _FIELDS[:-1])]
    done = pieces.filter("left IS NULL").select(*names)
    return done.unionByName(merge(pieces.filter("left IS NOT NULL"), keys, length).select(*names))


def merge(left: DataFrame, keys: list[str], length: int) -> DataFrame:
    """Lay the leftover pieces end to end and cut every ``length`` ids: less than one window per partition of the packing pass."""
    by_part = Window.partitionBy("part").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    parts = left.withColumn("part", F.shiftright("sequence_id", 40))
    # one row per partition of the pass: a few thousand sums in one task, no ids
    sums = parts.groupBy("part").agg(F.sum("length").alias("size"))
    before = sums.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = parts.join(before, "part").withColumn("at", F.col("before") + F.coalesce(F.sum("length").over(by_part), F.lit(0)))
    schema = T.StructType([left.schema[c] for c in keys] + _FIELDS[:-1])

    def cut(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                ids, at, done = np.frombuffer(row["left"], dtype="<u4"), row["at"], 0
                while done < len(ids):
                    size = min(len(ids) - done, length - (at + done) % length)
                    piece = ids[done : done + size].tobytes()
                    # negative numbers: no sequence of a partition has them
                    out.append(
                        {k: row[k] for k in keys}
                        | {"start": row["start"] + done, "length": size, "ids_crc32": zlib.crc32(piece), "doc_tokens": row["doc_tokens"]}
                        | {"sequence_id": -1 - (at + done) // length, "offset": (at + done) % length}
                    )
                    done += size
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(f.name, batch.schema.field(f.name).type if f.name in keys else pa.int64()) for f in schema]))

    return placed.select(*keys, "start", "left", "doc_tokens", "at").mapInArrow(cut, schema)
