"""Arrow columns in runs of bounded size, so that a batch of ten thousand long texts never becomes Python objects or work arrays at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of Arrow data that Python works on at a time, unless a single row is larger.
SLICE_BYTES = 300_000


def row_slices(columns: Sequence[pa.Array], limit: int = SLICE_BYTES) -> Iterator[Sequence[pa.Array]]:
    """The rows of ``columns``, in order, in runs of at most ``limit`` bytes, or of one row each beyond that."""
    n = len(columns[0])
    if n > 1 and sum(c.nbytes for c in columns) > limit:
        yield from row_slices([c.slice(0, n // 2) for c in columns], limit)
        yield from row_slices([c.slice(n // 2) for c in columns], limit)
    elif n:
        yield columns


def by_slices(factory: Callable[[], Callable[[pa.Array], pa.Array]], kind: T.DataType):
    """Iterator UDF of one column. ``factory()`` runs once per task; its function gets a run of rows and gives one value per row."""

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = factory()
        for batch in batches:
            for (part,) in row_slices([batch]):
                yield work(part)

    return run


def listed(make: Callable[[object], object], kind: T.DataType):
    """Iterator UDF of one column: ``make`` of every value, as Python objects of one run at a time."""
    arrow = to_arrow_type(kind)
    return by_slices(lambda: lambda part: pa.array([make(v) for v in part.to_pylist()], type=arrow), kind)
