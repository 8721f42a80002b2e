"""Row changes as DataFrame operators: update, merge, difference of two states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.workspace import written


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: F.when(hit, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()})


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"more than one row for a key of {list(keys)}")


def merge_into(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    set_columns: Sequence[str],
    insert_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert: matched rows take ``set_columns`` from the source, unmatched source rows are added.

    The source is written once, so the check and the merge read the same rows and Spark knows its size. A source that Spark broadcasts merges
    without moving the target: one join for the matched rows, and one of the keys alone for those to add. Any other takes one
    full outer join, which reads the target once.
    """
    source = written(source, "merge_source")
    require_unique(source, on)
    inserted = list(insert_columns or source.columns)
    types = {f.name: f.dataType for f in target.schema}
    incoming = source.select(*[F.col(c).alias(f"_new_{c}") for c in source.columns], F.lit(True).alias("_hit"))
    same = F.lit(True)
    for c in on:
        same = same & (F.col(c) == F.col(f"_new_{c}"))
    added = {c: (F.col(f"_new_{c}") if c in inserted and c in source.columns else F.lit(None)).cast(types[c]) for c in target.columns}
    changed = {c: F.when(F.col("_hit"), F.col(f"_new_{c}").cast(types[c])).otherwise(F.col(c)) if c in set_columns else F.col(c) for c in target.columns}
    if _broadcastable(source):
        updated = target.join(incoming, same, "left").select(*[v.alias(c) for c, v in changed.items()])
        keys = target.select(*on).join(source.select(*on), list(on), "left_semi").distinct()
        fresh = incoming.join(keys, same, "left_anti").select(*[v.alias(c) for c, v in added.items()])
        return updated.unionByName(fresh)
    joined = target.withColumn("_here", F.lit(True)).join(incoming, same, "full_outer")
    return joined.select(*[F.when(F.col("_here"), changed[c]).otherwise(added[c]).alias(c) for c in target.columns])


def _broadcastable(df: DataFrame) -> bool:
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns the state ``old`` of a table into ``new``: (change, all columns), change being insert, delete, update_before or update_after.

    One full outer join on the keys, which are unique and not null in both states. Rows that are equal in every column are no change.
    """
    columns = old.columns
    before = old.select(F.struct(*columns).alias("_old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    after = new.select(F.struct(*columns).alias("_new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"_o_{k}") == F.col(f"_n_{k}"))
    changed = before.join(after, same, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))

    def row(change: str, state: str) -> Column:
        return F.struct(F.lit(change).alias("change"), F.col(state).alias("row"))

    listed = (
        F.when(F.col("_old").isNull(), F.array(row("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(row("delete", "_old")))
        .otherwise(F.array(row("update_before", "_old"), row("update_after", "_new")))
    )
    return changed.select(F.inline(listed)).select("change", "row.*")


def state_before(new: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state that ``change_feed`` led from: what it inserted or updated is taken out, what was there before comes back."""
    gone = feed.where(F.col("change").isin("insert", "update_after")).select(*keys)
    back = feed.where(F.col("change").isin("delete", "update_before")).select(*new.columns)
    return new.join(gone, list(keys), "left_anti").unionByName(back)


def difference(old: DataFrame, new: DataFrame, key: str, value: str, digits: int = 2) -> DataFrame:
    """Keys present in both states whose value differs, with old value, new value and rounded change."""
    before = old.select(key, F.col(value).alias("old_value"))
    after = new.select(key, F.col(value).alias("new_value"))
    return (
        after.join(before, key)
        .where(F.col("old_value") != F.col("new_value"))
        .withColumn("change", F.round(F.col("new_value") - F.col("old_value"), digits))
    )
