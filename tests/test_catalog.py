"""Every registered query against its SQL twin, and plan properties of all of them."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from lexlake.catalog.registry import callables, oracles

QUERIES = callables()
ORACLES = oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, sf_dir).count() > 0
        return
    assert compare(spark, con, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_entry(spark, sf_dir):
    df = entry.entry(spark)
    assert df.columns[:3] == ["counterparty_id", "counterparty_name", "country_code"]
    assert df.count() > 0


# queries that write files when built are left to test_query
EAGER = {"scan_csv", "retention", "json_encode_sink", "arrival_stream", "stream_dedup_upsert", "upsert_partitioned_table"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_dedupe_is_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["latest_per_key"](spark, sf_dir))
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_revenue_is_summed_before_the_dimension_join(spark, sf_dir):
    plan = plan_of(QUERIES["gold_monthly_revenue"](spark, sf_dir))
    join_at, sum_at = plan.index("Join"), plan.index("partial_sum")
    assert join_at < sum_at  # the plan prints parents first


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["incremental_scan"](spark, sf_dir))
    assert "GreaterThan(ts" in plan
    plan = plan_of(QUERIES["scan_parquet_columns"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    plan = plan_of(QUERIES["count_recent"](spark, sf_dir))
    assert "ReadSchema: struct<l_shipdate" in plan
