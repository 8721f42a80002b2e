"""Cutting documents into chunks. One row per document in, one row per chunk out, no shuffle."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.slices import listed as listed_udf
from marlstone.functions.text import words

_TEXTS = T.ArrayType(T.StringType())
_PLACES = [T.StructField("start_char", T.LongType()), T.StructField("end_char", T.LongType())]
_SOURCED = T.ArrayType(T.StructType([*_PLACES, T.StructField("text", T.StringType())]))


def _check(size: int, overlap: int) -> None:
    if size < 1 or overlap < 0 or overlap >= size:
        raise ValueError(f"need 0 <= overlap < size, got size {size} and overlap {overlap}")


def _starts(length: Column, size: int, overlap: int) -> Column:
    """0, step, 2*step, ... up to the first window that reaches the end; none for an empty text."""
    step = size - overlap
    last = F.greatest(F.ceil((length - size) / step), F.lit(0)) * step
    return F.when(length > 0, F.sequence(F.lit(0).cast("bigint"), last, F.lit(step).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )


def word_chunks(
    df: DataFrame, doc_id: str, text: str, size: int, overlap: int, lower: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, carry..., chunk_no, chunk_id, first_word, n_words, text): word windows, each sharing ``overlap`` words with the one before."""
    _check(size, overlap)
    listed = df.select(doc_id, *carry, words(F.col(text), lower).alias("_words"))
    cut = listed.select(
        doc_id,
        *carry,
        F.posexplode(
            F.transform(
                _starts(F.size("_words").cast("bigint"), size, overlap),
                lambda s: F.struct(s.alias("first_word"), F.slice("_words", (s + 1).cast("int"), F.lit(size)).alias("words")),
            )
        ).alias("chunk_no", "_c"),
    )
    return cut.select(
        doc_id,
        *carry,
        "chunk_no",
        F.concat(F.col(doc_id).cast("string"), F.lit("-chunk-"), F.col("chunk_no").cast("string")).alias("chunk_id"),
        F.col("_c.first_word").cast("int").alias("first_word"),
        F.size("_c.words").alias("n_words"),
        F.array_join("_c.words", " ").alias("text"),
    )


def char_chunks(df: DataFrame, doc_id: str, text: str, size: int, overlap: int) -> DataFrame:
    """(doc_id, chunk_no, start_char, end_char, text): character windows."""
    _check(size, overlap)
    step = size - overlap

    # a substring of a Spark string is looked for from its beginning, so all chunks of a text are cut in one walk here
    def cut(t: str | None) -> list[dict]:
        return [{"start_char": s, "end_char": min(s + size, len(t)), "text": t[s : s + size]} for s in range(0, max(len(t) - overlap, 1), step)] if t else []

    return df.select(doc_id, F.posexplode(listed_udf(cut, _SOURCED)(F.col(text))).alias("chunk_no", "_c")).select(doc_id, "chunk_no", "_c.start_char", "_c.end_char", "_c.text")


_WORD = re.compile(r"[^ \t\n\x0b\f\r]+")


def word_chunk_offsets(df: DataFrame, doc_id: str, text: str, size: int, overlap: int, carry: Sequence[str] = (), source: bool = False) -> DataFrame:
    """(doc_id, carry..., chunk_no, start_char, end_char): exact places of word chunks in the source text, and that part of it if ``source``.

    Offsets come from where each word really starts, so overlapping chunks overlap here too.
    """
    _check(size, overlap)

    def offsets(t: str | None) -> list[dict]:
        return [{**c, "text": t[c["start_char"] : c["end_char"]] if source else None} for c in _offsets(t or "", size, overlap)]

    cut = df.select(doc_id, *carry, F.posexplode(listed_udf(offsets, _SOURCED)(F.col(text))).alias("chunk_no", "_o"))
    return cut.select(doc_id, *carry, "chunk_no", "_o.start_char", "_o.end_char", *([F.col("_o.text").alias("source")] if source else []))


def _offsets(text: str, size: int, overlap: int) -> list[dict]:
    spans = [m.span() for m in _WORD.finditer(text)]
    found = []
    for first in range(0, len(spans), size - overlap):
        last = min(first + size, len(spans)) - 1
        found.append({"start_char": spans[first][0], "end_char": spans[last][1]})
        if last == len(spans) - 1:
            break
    return found


def _packed(pieces: Sequence[str], separator: str, size: int) -> list[str]:
    """Join pieces until the next one would pass ``size``."""
    chunks: list[str] = []
    held: list[str] = []
    length = 0  # of the held pieces joined
    for piece in pieces:
        if length and length + len(piece) > size:
            chunks.append(separator.join(held).strip())
            held, length = [], 0
        length += len(piece) + (len(separator) if length else 0)
        if length:
            held.append(piece)
    if length:
        chunks.append(separator.join(held).strip())
    return chunks


def packed_chunks(df: DataFrame, doc_id: str, text: str, size: int, separator: str = "\n") -> DataFrame:
    """(doc_id, chunk_no, text): paragraphs packed up to ``size`` characters, trimmed."""

    def pack(t: str | None) -> list[str]:
        return _packed((t or "").split(separator), separator, size)

    return df.select(doc_id, F.posexplode(listed_udf(pack, _TEXTS)(F.col(text))).alias("chunk_no", "text"))


def _merged(pieces: Sequence[str], size: int, overlap: int) -> list[str]:
    """Pieces joined up to ``size``; each chunk begins with the last pieces of the one before, up to ``overlap``."""
    chunks: list[str] = []
    held: list[str] = []
    for piece in pieces:
        if held and len("".join([*held, piece]).strip()) > size:
            chunks.append("".join(held).strip())
            while held and (len("".join(held).strip()) > overlap or len("".join([*held, piece]).strip()) > size):
                held.pop(0)
        held.append(piece)
    if held:
        chunks.append("".join(held).strip())
    return [c for c in chunks if c]


def split_recursively(text: str, separators: Sequence[str], size: int, overlap: int) -> list[str]:
    """Split behind the first separator that occurs, go deeper for pieces over ``size``, merge the rest.

    A separator stays with the piece in front of it, so chunks lose nothing but white space at their ends.
    """
    present = [s for s in separators if s in text]
    if not present:
        return [text.strip()] if text.strip() else []
    separator, deeper = present[0], list(separators)[list(separators).index(present[0]) + 1 :]
    *front, last = text.split(separator)
    chunks: list[str] = []
    small: list[str] = []
    for piece in [*(f + separator for f in front), last]:
        if len(piece.strip()) <= size:
            small.append(piece)
            continue
        chunks += _merged(small, size, overlap)
        small = []
        chunks += split_recursively(piece, deeper, size, overlap)
    return chunks + _merged(small, size, overlap)


# fixed values: paragraph, line, sentence, word
SEPARATORS = ("\n\n", "\n", ". ", " ")


def recursive_chunks(
    df: DataFrame, doc_id: str, text: str, size: int = 200, overlap: int = 50, separators: Sequence[str] = SEPARATORS
) -> DataFrame:
    """(doc_id, chunk_no, text). A word longer than ``size`` stays whole."""
    _check(size, overlap)
    listed = list(separators)

    def split(t: str | None) -> list[str]:
        return split_recursively(t or "", listed, size, overlap)

    return df.select(doc_id, F.posexplode(listed_udf(split, _TEXTS)(F.col(text))).alias("chunk_no", "text"))


def sentences(text: Column) -> Column:
    """Pieces that end in . ! or ?, and the rest."""
    found = F.regexp_extract_all(F.regexp_replace(text, r"\s+", " "), F.lit(r"([^.!?]+[.!?]*|[.!?]+)"), F.lit(1))
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def sentence_chunks(df: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(doc_id, chunk_no, text): whole sentences packed up to ``size`` characters."""

    def pack(found: list[str] | None) -> list[str]:
        return _packed(found or [], " ", size)

    return df.select(doc_id, F.posexplode(listed_udf(pack, _TEXTS)(sentences(F.col(text)))).alias("chunk_no", "text"))
