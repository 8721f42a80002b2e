"""Run numpy or Python work over the texts of a table, batch by batch, and small helpers on code points."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text that one call of the work handles, unless a single text is longer.
SLICE_BYTES = 300_000


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of an Arrow column of texts with at most ``limit`` bytes, or one text each beyond that: (first row, texts).

    Only one run at a time becomes Python strings.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, texts.slice(start, stop - start).to_pylist()
        start = stop


def map_texts(df: DataFrame, keep: list[str], text: str, fields: list[T.StructField], factory: Callable, also: Sequence[str] = ()) -> DataFrame:
    """``df``'s columns ``keep`` and the columns ``fields`` that ``factory()(texts)`` makes of the column ``text``.

    ``factory`` runs once per task. Its function gets a list of texts (None for null), and a list of values for each column
    of ``also``, and returns one sequence per field. Rows stay where the scan put them: no shuffle. Other columns of
    ``df`` are not read. What a slice of texts gives is handed on before the next one is looked at.
    """
    # these travel under names of their own, so kept columns may have any names
    extra = [df[c].alias(f"column {i} to map") for i, c in enumerate(also)]
    source = df.select(*[df[c] for c in keep], *extra, df[text].cast("string").alias("text to map"))
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in schema]
    width, last = len(keep), len(keep) + len(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for batch in batches:
            for start, texts in slices(batch.column(last)):
                part = batch.slice(start, len(texts))
                made = work(texts, *[part.column(i).to_pylist() for i in range(width, last)])
                columns = [pa.array(values, type=kind, from_pandas=False) for values, kind in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *columns], names=names)

    return source.mapInArrow(run, schema)


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and where each text starts (one entry more than texts)."""
    ends = np.cumsum([0] + [len(t) if t else 0 for t in texts])
    joined = "".join(t for t in texts if t)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), ends


def per_process(key: tuple, make: Callable):
    """``make()``, or what an earlier task of this Python worker made for ``key``. Functions travel by value, so module globals do not last.

    One entry per kind (the first part of ``key``): a worker that serves stage after stage does not gather their tables.
    """
    store = sys.modules.setdefault("marlstone_per_process", ModuleType("marlstone_per_process")).__dict__
    kind = f"kept {key[0]}"
    if kind not in store or store[kind][0] != key:
        store.pop(kind, None)
        store[kind] = key, make()
    return store[kind][1]


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finishing steps of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def held_out(doc_id):
    """True for the quarter of documents that no model learns from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2
