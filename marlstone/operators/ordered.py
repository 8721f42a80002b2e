"""Order-dependent operators that never put one key, or the whole table, in one task.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends all rows of a key to one
task, and an unpartitioned window sends the table. Here rows are range-partitioned
on (key, order), so a hot key covers many partitions; each row gets its global
position, and positions are cut into chunks of a fixed number of rows. Windows run
per (key, chunk). What a chunk must know about the rows before it travels
in a small table with one row per (key, chunk), written so that Spark knows its size, or as a few copied rows.

``order`` together with the keys must be a total order (end it with an id).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.workspace import written

CHUNK_ROWS = 1_000_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def positioned(df: DataFrame, order: Sequence[str | Column], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``_pos`` (0-based position in ``order``) and ``_chunk``.

    The sorted rows are written once: row numbers and partition sizes must come from
    the same run, also when an executor is lost. The driver sees one count per range partition.
    """
    by = _columns(order)
    placed = written(
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row_id", F.monotonically_increasing_id()),
        "positions",
    )
    part = F.shiftright("_row_id", _ROW_BITS)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    starts = F.array(*[F.lit(n).cast("bigint") for n in before])  # folded to one literal
    row = F.col("_row_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_pos", F.get(starts, part.cast("int")) + row)
        .withColumn("_chunk", F.expr(f"_pos div {int(chunk_rows)}"))
        .drop("_row_id")
    )


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 1) -> DataFrame:
    """Dense global row numbers."""
    return positioned(df, order).withColumn(name, F.col("_pos") + F.lit(start)).drop("_pos", "_chunk")


def ntile(df: DataFrame, tiles: int, order: Sequence[str | Column], name: str) -> DataFrame:
    """Tile number 1..tiles of each row; the first ``n % tiles`` tiles hold one row more."""
    placed = positioned(df, order)
    n = placed.agg(F.count("*")).scalar()
    return (
        placed.withColumn("_base", F.floor(n / F.lit(tiles)))
        .withColumn("_wide", F.pmod(n, F.lit(tiles)))
        .withColumn("_cut", F.col("_wide") * (F.col("_base") + 1))
        .withColumn(
            name,
            F.when(F.col("_pos") < F.col("_cut"), F.floor(F.col("_pos") / (F.col("_base") + 1)))
            .otherwise(F.col("_wide") + F.floor((F.col("_pos") - F.col("_cut")) / F.greatest(F.col("_base"), F.lit(1))))
            .cast("int")
            + 1,
        )
        .drop("_pos", "_chunk", "_base", "_wide", "_cut")
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    totals: Mapping[str, Column],
    inclusive: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Running sum of each expression per key, up to and with (or before) the row."""
    with_terms = df.withColumns({f"_t_{n}": c for n, c in totals.items()})
    placed = positioned(with_terms, [*keys, *order], chunk_rows)
    per_chunk = placed.groupBy(*keys, "_chunk").agg(*[F.sum(f"_t_{n}").alias(f"_s_{n}") for n in totals])
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # only a key that began in an earlier chunk has something to carry: one row per chunk at most
    carry = (
        per_chunk.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.col("_chunk").alias("_k_chunk"),
            F.count("*").over(earlier).alias("_chunks_before"),
            *[F.sum(f"_s_{n}").over(earlier).alias(f"_c_{n}") for n in totals],
        )
        .where("_chunks_before > 0")
        .drop("_chunks_before")
    )
    same = F.col("_chunk") == F.col("_k_chunk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = placed.join(written(carry, "carry"), same, "left")
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    frame = frame.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    zero = F.lit(0)
    return joined.withColumns(
        {n: F.coalesce(F.sum(f"_t_{n}").over(frame), zero) + F.coalesce(F.col(f"_c_{n}"), zero) for n in totals}
    ).select(*df.columns, *totals)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    size: int,
    measures: Mapping[str, Callable[[Window], Column]],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Measures over the last ``size`` rows of the key, the current row included.

    The last ``size - 1`` rows of a chunk are copied into the next one, so every frame is whole.
    """
    if chunk_rows < size:
        raise ValueError("chunk_rows must be at least the frame size")
    placed = positioned(df, [*keys, *order], chunk_rows)
    near_end = F.pmod("_pos", F.lit(chunk_rows)) > F.lit(chunk_rows - size)
    copies = F.when(near_end, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = placed.withColumn("_copy", F.explode(copies)).withColumn("_chunk", F.col("_chunk") + F.col("_copy"))
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(1 - size, 0)
    return (
        spread.withColumns({n: make(frame) for n, make in measures.items()})
        .where("_copy = 0")
        .select(*df.columns, *measures)
    )


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    columns: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Forward fill: each column takes its last non-null value at or before the row, per key."""
    placed = positioned(df, [*keys, *order], chunk_rows)
    per_chunk = placed.groupBy(*keys, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_l_{c}") for c in columns]
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        per_chunk.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.col("_chunk").alias("_k_chunk"),
            F.count("*").over(earlier).alias("_chunks_before"),
            *[F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_c_{c}") for c in columns],
        )
        .where("_chunks_before > 0")
        .drop("_chunks_before")
    )
    same = F.col("_chunk") == F.col("_k_chunk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(frame), F.col(f"_c_{c}")) for c in columns}
    return placed.join(written(carry, "carry"), same, "left").withColumns(filled).select(*df.columns)


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Exact interpolated quantiles per key, read off running counts of distinct values.

    Equal values are counted before anything is shuffled or sorted, so a value that half of the rows have is one row.
    ``percentile`` would keep every distinct value of a group in one aggregation buffer; this looks up two
    positions per quantile instead. Null values are left out.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    upto = running_totals(counts, keys, [value], {"_upto": F.col("_n")}, chunk_rows=chunk_rows)
    spans = written(upto, "counts").withColumn("_from", F.col("_upto") - F.col("_n")).drop("_n")
    wanted = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probabilities.items()])
    exact = F.col("_q.p") * (F.col("_all") - 1)
    targets = spans.groupBy(*keys).agg(F.max("_upto").alias("_all")).withColumn("_q", F.explode(wanted)).withColumn("_share", exact - F.floor(exact))
    ends = targets.select(*keys, F.col("_q.name").alias("_name"), F.floor(exact).alias("_low"), F.ceil(exact).alias("_high"), "_share")
    # one row per key, written, so that Spark knows its size and broadcasts it when it is small
    low, high = F.struct("_name", F.col("_low").alias("_at"), (1 - F.col("_share")).alias("_weight")), F.struct("_name", F.col("_high").alias("_at"), F.col("_share").alias("_weight"))
    listed = written(ends.groupBy(*keys).agg(F.flatten(F.collect_list(F.array(low, high))).alias("_ends")), "targets")
    same = F.lit(True)
    for k in keys:
        same = same & spans[k].eqNullSafe(listed[k])
    if keys:
        placed = spans.join(listed, same).select(*[spans[k] for k in keys], spans[value], "_from", "_upto", "_ends")
    else:
        placed = spans.withColumn("_ends", listed.select("_ends").scalar())
    hits = placed.withColumn("_hit", F.explode(F.filter("_ends", lambda e: (e["_at"] >= F.col("_from")) & (e["_at"] < F.col("_upto")))))
    return hits.groupBy(*keys).agg(*[F.sum(F.when(F.col("_hit._name") == n, F.col(value) * F.col("_hit._weight"))).alias(n) for n in probabilities])
