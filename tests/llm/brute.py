"""Helpers of the brute-force checks."""

import pyarrow.parquet as pq


def rows(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\t\n",
    "a",
    "###",
    "日本語 テキスト 😀😀 ́x",
    "nul \0 inside \x1c and \x85",
    "same words " * 40,
    "word " * 3000,
    "x" * 9000,
    "Same line\nSame line\n\nsame line",
]


def odd_documents(spark):
    """Odd texts, repeated rows, a null id, and columns that clash with results."""
    data = [(i, t, "en" if i % 3 else None, "src", i, 0.5, "mine") for i, t in enumerate(ODD_TEXTS)]
    data += [data[6], data[6], (None, "no id here", "de", None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_words long, score double, labels string"
    return spark.createDataFrame(data, schema).repartition(3)


def empty_documents(spark):
    return odd_documents(spark).limit(0)
