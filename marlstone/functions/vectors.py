"""Vector expressions over array columns, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY_NORM = 1e-10


def _doubles(v: Column) -> Column:
    return v.cast("array<double>")


def _total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """Divide by the norm; a vector whose norm is about zero stays as it is."""
    length = norm(v)
    return F.when(length < TINY_NORM, _doubles(v)).otherwise(F.transform(_doubles(v), lambda x: x / length))


def cosine(a: Column, b: Column) -> Column:
    """0 for different lengths and for a norm of about zero."""
    both = norm(a) * norm(b)
    usable = (F.size(a) == F.size(b)) & (norm(a) >= TINY_NORM) & (norm(b) >= TINY_NORM)
    return F.when(usable, dot(a, b) / F.greatest(both, F.lit(TINY_NORM * TINY_NORM))).otherwise(F.lit(0.0))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))))
