"""Operator 8: rendezvous hashing of record keys over weighted shards. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces that a shard is numbered in. Shards times pieces rows of counts are broadcast, at about 40 bytes each.
PIECES = 256


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """(score, shard): what a shard draws for ``key``."""
    drawn = (F.shiftrightunsigned(F.xxhash64(key, shard), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.struct((weight / -F.log(drawn)).alias("score"), shard.alias("shard"))


def best_draw(key: Column, weights: Sequence[float]) -> Column:
    """The highest (score, shard) for ``key``; shard i wins a share of keys in proportion to ``weights[i]``.

    A draw depends on the key and the shard's number alone, so another shard takes keys only into itself, and a
    changed weight moves keys only to or from its own shard. Equal scores go to the higher number; all null keys share one shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])
    return F.array_max(F.transform(shards, lambda s: draw(key, s["shard"], s["weight"])))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    return best_draw(key, weights)["shard"]


def assign(df: DataFrame, key: str, weights: Sequence[float], order: Sequence[str] = (), pieces: int = PIECES) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: the row's place in its shard, 0, 1, 2 ... without gaps.

    A shard is numbered in ``pieces`` by a hash of the key and ``order``: rows of a piece are ordered by them, and a piece
    starts where the pieces before it end. Only rows that are equal in all of these meet in one piece, so rows of one key do not.
    Columns of ``df`` named shard or slot are replaced. An empty table gives no rows; rows that are equal in key and
    ``order`` get consecutive slots in any order.
    """
    piece = F.pmod(F.xxhash64(F.lit("piece"), F.col(key), *map(F.col, order)), F.lit(pieces)).cast("int")
    found = df.drop("shard", "slot", "shard piece").withColumns({"shard": shard_of(F.col(key), weights), "shard piece": piece})
    counts = df.select(df[key], *[df[c] for c in order]).select(shard_of(F.col(key), weights).alias("shard"), piece.alias("shard piece")).groupBy("shard", "shard piece").count()
    before = Window.partitionBy("shard").orderBy("shard piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "shard piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("piece start"))
    inside = Window.partitionBy("shard", "shard piece").orderBy(key, *order)
    numbered = found.withColumn("slot", F.row_number().over(inside) - 1)
    joined = numbered.join(F.broadcast(starts), ["shard", "shard piece"])
    return joined.withColumn("slot", F.col("slot") + F.col("piece start")).select(*[c for c in df.columns if c not in ("shard", "slot")], "shard", "slot")


def placed_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's size, text checksum, shard, slot, and its shard if there were one more. A null text has no bytes."""
    body = F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")
    slim = docs.select(docs[key].alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    found = assign(slim, "doc_id", [1.0] * shards, ["text_crc32", "size"])
    # one more shard wins where its own draw is above the winner's
    one = F.lit(1.0)
    grown = F.greatest(draw(F.col("doc_id"), F.col("shard"), one), draw(F.col("doc_id"), F.lit(shards), one))["shard"]
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", grown.alias("grown_shard"))
