"""Time headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores, BENCH_QUERIES=all runs every registered query.
Each query runs twice to the end into the noop sink; the second run counts. Stored tables (embeddings, the inverted index) are built in the first run;
building them is timed by queries of its own (ret_06_ingest, doc_01_postings).

The tables of texts come as one file with one row group, which no reader can split. They are copied once, untimed, into 32 files, so that the queries
on texts use all cores, as they would on tables of a size that matters; the other tables are read where they are.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marlstone.plans import load  # noqa: E402
from marlstone.session import local_session  # noqa: E402
from marlstone.workspace import scope  # noqa: E402

HEADLINE = [
    "src_04_parquet_scan",
    "ver_02_merge",
    "rel_02_derived_columns",
    "rel_09_top_k",
    "join_02_inner_using",
    "join_05_join_aggregate",
    "join_08_as_of",
    "agg_03_revenue_by_category",
    "agg_08_exact_p99",
    "agg_15_feature_statistics",
    "win_01_decile",
    "win_02_rolling_mean",
    "win_04_cumulative_sum",
    "fn_08_cosine",
    "feat_01_standard_scaler",
    "feat_09_fraud_features",
    "feat_10_transform_pipeline",
    "ml_01_linear_regression",
    "ml_03_stump_fit",
    "ml_07_linear_batch",
    "vec_01_word_hash_embedding",
    "vec_04_exact_search",
    "vec_06_batch_search",
    "ret_01_word_chunks",
    "ret_06_ingest",
    "ret_07_hybrid_scan",
    "ret_11_rerank_overlap",
    "doc_01_postings",
    "doc_01_bm25",
    "txt_01_vocabulary",
    "txt_02_encode",
    "txt_11_render",
    "mon_01_stability_index",
    "mon_09_input_guard",
    "mon_16_fixed_window",
    "mon_17_sliding_log",
    "str_03_minute_usage",
]


TEXTS = ("documents", "pages", "conversations")


def spread(spark, folder: str, target: str, files: int = 32) -> str:
    """A folder with the tables of ``folder``, those of texts in many files."""
    for name in os.listdir(folder):
        if name.removesuffix(".parquet") in TEXTS:
            spark.read.parquet(f"{folder}/{name}").repartition(files).write.parquet(f"{target}/{name}")
        else:
            os.symlink(f"{folder}/{name}", f"{target}/{name}")
    return target


def finished(run, spark, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(run, spark, folder: str) -> float:
    finished(run, spark, folder)
    with scope(spark):
        return finished(run, spark, folder)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = load()
    names = list(known) if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE
    seconds = {}
    with scope(spark), tempfile.TemporaryDirectory(prefix="bench-") as target:
        tables = spread(spark, folder, target)
        for name in names:
            seconds[name] = round(timed(known[name].run, spark, tables), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
