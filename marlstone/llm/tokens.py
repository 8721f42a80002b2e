"""Operator 1: BPE encoding and decoding of a table of texts."""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marlstone.llm.bpe import REMEMBER, Bpe, Decoder
from marlstone.llm.texts import map_texts, per_process

#: Ids that the decoder takes at a time.
DECODE_BLOCK = 1 << 16


def tokenizer(path: str, remember: int = REMEMBER):
    """A function for tasks that gives the encoder of the tokenizer file at ``path``; the file is read here and travels along."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    key = ("bpe", hashlib.sha256(text.encode()).hexdigest())
    return lambda: per_process(key, lambda: Bpe(text, remember=remember))


def encode(df: DataFrame, path: str, keep: list[str], text: str = "text", name: str = "ids") -> DataFrame:
    """``keep`` and the token ids of every whole text, as the tokenizer file says; special tokens are found in the text, none are added.

    Null and empty texts have no ids. Rows are independent: repeated rows, ties and clashing names change nothing.
    """
    load = tokenizer(path)

    def factory():
        bpe = load()
        return lambda texts: ([np.frombuffer(raw, dtype="<u4").astype(np.int32) for raw in bpe.encode(texts)],)

    return map_texts(df, keep, text, [T.StructField(name, T.ArrayType(T.IntegerType()))], factory)


def decode(df: DataFrame, path: str, keep: list[str], ids: str = "ids", name: str = "text") -> DataFrame:
    """``keep`` and the text of every id list; null ids give a null text, no ids an empty one."""
    load = tokenizer(path)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(name, T.StringType())])
    source = df.select(*[df[c] for c in keep], df[ids].alias("ids to map"))

    def run(batches):
        import pyarrow as pa

        bpe = load()
        for batch in batches:
            lists = batch.column(len(keep)).to_pylist()
            texts = [None if x is None else decoded(bpe, x) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, type=pa.string())], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def decoded(bpe: Bpe, ids: list[int]) -> str:
    decoder = Decoder(bpe)
    return "".join(decoder.feed(ids[i : i + DECODE_BLOCK]) for i in range(0, len(ids), DECODE_BLOCK)) + decoder.close()


def round_trip(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``n_tokens``, and digests of the ids and of the text decoded from them, for every whole text (null: empty)."""
    load = tokenizer(path)

    def factory():
        bpe = load()

        def work(texts):
            counts, id_digests, text_digests = [], [], []
            for raw in bpe.encode(texts):
                ids = np.frombuffer(raw, dtype="<u4")
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(raw).hexdigest())
                decoder, digest = Decoder(bpe), hashlib.sha256()
                for a, b in pairwise([*range(0, len(ids), DECODE_BLOCK), len(ids)]):
                    digest.update(decoder.feed(ids[a:b].tolist()).encode())
                digest.update(decoder.close().encode())
                text_digests.append(digest.hexdigest())
            return counts, id_digests, text_digests

        return work

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_texts(df, keep, text, fields, factory)
