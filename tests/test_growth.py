"""Work of loads, refreshes and joins that must not grow faster than their input."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexlake import workspace
from lexlake.catalog.views import Views
from lexlake.operators import partitions, scd2, summaries, tables

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
KEYS = ["k", "p"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, p string, v int")


def state(df):
    return sorted(tuple(r) for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_first_load_and_replaced_partitions_are_written_once(spark, tmp_path, monkeypatch):
    def twice(*_):
        raise AssertionError("rows stored beside the table")

    monkeypatch.setattr(tables, "materialize", twice)
    root, other = str(tmp_path / "t"), str(tmp_path / "o")
    rows = [("a", "x", 1), ("b", "y", 2), ("b", None, 3)]
    assert tables.load(spark, root, batch(spark, [*rows, ("a", "x", 0)]), KEYS, ["v"], "p", F.lit(T0)) == 3
    assert state(tables.read(spark, root).where("p IS NOT NULL").select("k", "p", "v")) == rows[:2]
    tables.replace_partitions(spark, other, batch(spark, rows), "p", set())
    assert tables.read(spark, other).count() == 3


def test_rows_of_new_partitions_meet_no_old_row(spark, tmp_path, monkeypatch):
    root, met = str(tmp_path / "t"), []
    tables.load(spark, root, batch(spark, [("a", "x", 1), ("c", None, 1)]), KEYS, ["v"], "p", F.lit(T0))
    merge = tables.merge
    monkeypatch.setattr(tables, "merge", lambda old, new, *a, **o: met.extend(r.k for r in new.collect()) or merge(old, new, *a, **o), raising=False)
    assert tables.load(spark, root, batch(spark, [("a", "x", 2), ("b", "x", 3), ("c", None, 4), ("d", "new", 5)]), KEYS, ["v"], "p", F.lit(T1)) == 4
    assert sorted(met) == ["a", "b", "c"]
    got = {r.k: (r.p, r.v, r.created_at, r.updated_at) for r in tables.read(spark, root).collect()}
    assert got == {"a": ("x", 2, T0, T1), "b": ("x", 3, T1, T1), "c": (None, 4, T0, T1), "d": ("new", 5, T1, T1)}


def test_a_refresh_compares_keys_only_where_rows_stayed(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.load(spark, root, batch(spark, [("a", "x", 1), ("b", "x", 2), ("c", "y", 3), ("d", "y", 4)]), KEYS, ["v"], "p", F.lit(T0))
    tables.load(spark, root, batch(spark, [("a", "x", 5), ("b", "x", 6)]), KEYS, ["v"], "p", F.lit(T1))
    removed, added = tables.changes(spark, root, KEYS, 1, "p")
    assert "Join" not in plan_of(removed) and "Join" not in plan_of(added)
    assert state(removed.select("k", "v")) == [("a", 1), ("b", 2)] and state(added.select("k", "v")) == [("a", 5), ("b", 6)]
    tables.load(spark, root, batch(spark, [("c", "y", 7)]), KEYS, ["v"], "p", F.lit(T1))
    removed, added = tables.changes(spark, root, KEYS, 2, "p")
    assert state(removed.select("k", "v")) == [("c", 3)] and state(added.select("k", "v")) == [("c", 7)]


def test_a_summary_loses_rows_that_a_replaced_partition_lost(spark, tmp_path):
    root, gold = str(tmp_path / "t"), str(tmp_path / "g")
    tables.replace_partitions(spark, root, batch(spark, [("a", "x", 1), ("b", "x", 2)]), "p", set())
    refresh = lambda: summaries.refresh(spark, root, gold, KEYS, ["p"], "v", "p")
    assert refresh() == 1
    tables.replace_partitions(spark, root, batch(spark, [("a", "x", 5)]), "p", {"x"})
    assert refresh() == 1
    assert state(tables.read(spark, gold).select("p", "n", "total", "least", "most")) == [("x", 1, 5, 5, 5)]


def test_lines_meet_their_orders_before_hashes_are_made(spark, sf_dir):
    plan = plan_of(entry.queries()["stg_transactions"](spark, sf_dir))
    above, below = plan.split("Join", 1)
    assert "sha2" in above and "sha2" not in below and "TXN-" not in below


def exchanges(df):
    """Numbers of partitions of the shuffles of a plan."""
    return [int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())]


def test_partitions_follow_the_bytes_of_a_table(spark, tmp_path, monkeypatch):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(10).write.parquet(one)
    spark.range(0, 200_000, 1, 4).write.parquet(many)
    assert workspace.parts_for(spark, one) == spark.sparkContext.defaultParallelism
    size = sum(os.path.getsize(os.path.join(many, f)) for f in os.listdir(many) if f.endswith(".parquet"))
    monkeypatch.setattr(workspace, "PART_BYTES", 1000)
    assert workspace.parts_for(spark, many) == -(-size // 1000)


@pytest.mark.parametrize("name", ["mv_monthly_revenue", "revenue_by_month", "gold_monthly_revenue"])
def test_shuffles_of_revenue_follow_the_table_and_not_the_session(spark, sf_dir, monkeypatch, name):
    def sorted_rows(df):
        return sorted(map(str, df.collect()))

    build = entry.queries()[name]
    expected = sorted_rows(build(spark, sf_dir))
    monkeypatch.setattr(Views, "parts", lambda self, table: 37)
    for threshold, shuffles in (("10MB", 2), ("-1", 3)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            df = build(spark, sf_dir)
            assert exchanges(df).count(37) >= shuffles and sorted_rows(df) == expected
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_refreshed_gold_table_is_summed_in_partitions_by_the_table(spark, sf_dir, monkeypatch):
    seen, publish = [], partitions.publish
    monkeypatch.setattr(Views, "parts", lambda self, table: 37)
    monkeypatch.setattr(partitions, "publish", lambda df, root: seen.append(exchanges(df).count(37)) or publish(df, root))
    assert entry.queries()["gold_refresh"](spark, sf_dir).count() == entry.queries()["gold_monthly_revenue"](spark, sf_dir).count()
    assert len(seen) == 2 and min(seen) >= 2


def test_history_of_revenue_is_sorted_once_among_its_versions(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(Views, "parts", lambda self, table: 37)
    df = entry.queries()["mv_monthly_revenue_scd2"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # sums by name take no shuffle of their own: lines, their sums per day, and the sort by key
    assert "hashpartitioning(external_id" in plan and "counterparty_name" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan))
    assert exchanges(df).count(37) >= 3


def test_sorted_among_versions_is_the_same_as_joined(spark):
    day = lambda n: dt.date(2024, 1, n)
    facts = spark.createDataFrame(
        [(None, day(5), 1), ("a", None, 2), ("a", day(1), 3), ("a", day(2), 4), ("a", day(2), 4), ("a", day(9), 5), ("a", day(20), 6), ("b", day(3), 7), ("c", day(3), 8)],
        "k string, d date, v int",
    )
    dim = spark.createDataFrame(
        [("a", "x", day(2), day(8)), ("a", None, day(9), day(12)), ("b", "y", day(4), scd2.OPEN_END), (None, "z", day(1), scd2.OPEN_END), ("d", "w", day(1), day(2))],
        "k string, name string, valid_from date, valid_to date",
    )
    joined = scd2.asof_join(facts, dim, "k", "d")
    for parts in (None, 3):
        merged = scd2.asof_merge(facts, dim, "k", "d", parts)
        assert merged.schema == joined.schema
        assert sorted(map(str, merged.collect())) == sorted(map(str, joined.collect()))
    assert sorted(r.v for r in merged.collect()) == [4, 4, 5]
