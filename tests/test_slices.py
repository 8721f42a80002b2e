"""Python sees a bounded run of rows at a time, whatever the size of an Arrow batch."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlstone.functions import embed
from marlstone.functions.slices import row_slices
from marlstone.operators import blocks, tokens


def test_runs_hold_all_rows_in_order_and_stay_below_the_limit():
    texts = pa.array(["a" * n for n in (10, 2000, 0, 30)] + [None] + ["b" * 90] * 40)
    runs = [part for (part,) in row_slices([texts], 500)]
    assert [t for part in runs for t in part.to_pylist()] == texts.to_pylist()
    assert all(part.nbytes <= 500 or len(part) == 1 for part in runs)
    assert list(row_slices([texts.slice(0, 0)], 500)) == []


def test_an_embedding_gets_a_bounded_run_of_a_batch(spark):
    """Before, all texts of an Arrow batch came at once."""

    def seen(texts, dim):
        import numpy as np

        return np.full((len(texts), dim), float(sum(len(t or "") for t in texts)))

    df = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("word "), 200).alias("text"))
    assert df.select(embed.embed_with(seen, 2)("text").alias("e")).agg(F.max(F.get("e", F.lit(0)))).first()[0] <= 300_000


def test_scored_slices_are_bounded_by_their_text():
    import pandas as pd

    pdf = pd.DataFrame({"id": range(900), "text": ["x" * 1000] * 899 + ["y" * 900_000]})
    parts = list(blocks._slices(iter([pdf]), 1))
    assert pd.concat(parts).equals(pdf)
    assert all(p["text"].str.len().sum() <= blocks.SLICE_CHARS or len(p) == 1 for p in parts)


@pytest.mark.parametrize("default", [1, None])
def test_values_are_put_at_their_places(default):
    values = pa.array([[7, -1, 8, -1], [], [-1], [5]], type=pa.list_(pa.int32())).slice(0, 4)
    places = pa.array([[3, 1], None, [0], None], type=pa.list_(pa.int32()))
    others = pa.array([[40, 20], None, [None], None], type=pa.list_(pa.int32()))
    assert tokens._put(values, places, others, default).to_pylist() == [[7, 20, 8, 40], [], [default], [5]]
    assert tokens._put(values.slice(2), places.slice(2), others.slice(2), default).to_pylist() == [[default], [5]]
