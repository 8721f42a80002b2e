"""Shape of the physical plans."""

import re

import pytest

from marlstone.plans import load

QUERIES = load()
# plans that only look at files or that have been run inside the query
PLAIN = [n for n in QUERIES if n.split("_")[0] in {"rel", "join", "agg", "win", "fn", "feat", "vec", "mon", "txt"}]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_cross_join_and_no_row_udf(name, spark, folder):
    plan = plan_of(QUERIES[name].run(spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan


def test_scan_is_pruned(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = plan_of(QUERIES["src_04_parquet_scan"].run(spark, folder))
    assert "GreaterThan(l_quantity,25.0)" in plan
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>", plan)


def test_top_k_prunes_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in plan_of(QUERIES["win_05_result_rank"].run(spark, folder))
    assert "TakeOrderedAndProject" in plan_of(QUERIES["rel_09_top_k"].run(spark, folder))


def test_rolling_windows_split_a_key(spark, folder):
    plan = plan_of(QUERIES["win_02_rolling_mean"].run(spark, folder))
    assert re.search(r"hashpartitioning\(user_id#\d+L, _chunk#\d+L", plan)
