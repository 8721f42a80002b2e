"""Hash embeddings of text as Arrow-batched UDFs, a bounded run of texts at a time.

Counting slots with array functions costs (slots x characters) per text; numpy does it in one pass
over the characters of a run of texts. Words are split by the JVM expression in ``functions.text``, so
both sides agree on what a word is. A real model plugs in by ``embed_with``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.slices import by_slices
from marlstone.functions.text import words

_SPACE = 32


def _points(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """All code points, the text of each, and where each text starts; and the number of texts."""
    listed = [t or "" for t in texts]
    codes = np.frombuffer("".join(listed).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    sizes = np.array([len(t) for t in listed], dtype=np.int64)
    return codes, np.repeat(np.arange(len(listed)), sizes), np.cumsum(sizes) - sizes, len(listed)


def _unit_counts(rows: np.ndarray, slots: np.ndarray, n: int, dim: int) -> np.ndarray:
    counts = np.bincount(rows * dim + slots, minlength=n * dim).reshape(n, dim).astype(float)
    lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return counts / np.where(lengths > 0, lengths, 1)


def word_hash(texts: Iterable[str | None], dim: int) -> np.ndarray:
    """One row per text. Slot of a character: (code x (word number + 1) + place in word) mod dim, words parted by one space."""
    codes, rows, starts, n = _points(texts)
    gaps, at = codes == _SPACE, np.arange(len(codes))
    seen = np.concatenate([[0], np.cumsum(gaps)])
    word = seen[1:] - seen[starts[rows]]
    begin = np.maximum(np.maximum.accumulate(np.where(gaps, at + 1, 0)), starts[rows]) if len(codes) else at
    slots = (codes * (word + 1) + (at - begin)) % dim
    return _unit_counts(rows[~gaps], slots[~gaps], n, dim)


def char_hash(texts: Iterable[str | None], dim: int) -> np.ndarray:
    """One row per text. Slot of a character: (code + place in text) mod dim."""
    codes, rows, starts, n = _points(texts)
    return _unit_counts(rows, (codes + np.arange(len(codes)) - starts[rows]) % dim, n, dim)


def spaced_words(text: Column, lower: bool = True) -> Column:
    """The words of the text parted by one space, the form ``word_hash`` takes."""
    return F.array_join(words(text, lower), " ")


def embed_with(embed: Callable[[Iterable[str | None], int], np.ndarray], dim: int):
    """Iterator UDF text -> array<double>. ``embed`` gets a run of texts and returns a matrix; set-up of a model belongs into the factory.

    The work arrays of a hash take over a hundred bytes a character, so a run is a few hundred KB of text.
    """

    def factory():
        def work(texts: pa.Array) -> pa.Array:
            found = np.asarray(embed(texts.to_pylist(), dim), dtype=float)
            ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            return pa.ListArray.from_arrays(ends, found.ravel())

        return work

    return by_slices(factory, T.ArrayType(T.DoubleType()))


def word_embedding(text: Column, dim: int, lower: bool = True) -> Column:
    return embed_with(word_hash, dim)(spaced_words(text, lower))


def char_embedding(text: Column, dim: int) -> Column:
    return embed_with(char_hash, dim)(text)
