"""Joins as they run when nothing is small enough to broadcast, with a hot key."""

import datetime as dt

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexlake.operators import joins, scd2
from lexlake.plans import gold

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


JOINS = [
    "join_txn_counterparty",
    "asof_dim_join",
    "mv_monthly_revenue_scd2",
    "gold_monthly_revenue",
    "mv_active_regulations",
    "regulation_left_join",
    "fk_resolve",
    "document_entity_resolve",
    "orphan_rows",
    "staging_processed",
    "latency_percentiles",
    "upsert",
    "scd2_apply",
    "filings_normalize",
]


@pytest.mark.parametrize("name", JOINS)
def test_same_result_without_broadcast(no_broadcast, sf_dir, name):
    con = connect(sf_dir)
    assert compare(no_broadcast, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def hot(n, cold):
    """A third of the rows on one key."""
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % cold)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_counterparty_is_split_in_key_resolution(no_broadcast):
    spark = no_broadcast
    n, cold = 60_000, 500
    txn = spark.range(0, n, 1, 8).select(
        "id",
        F.concat(F.lit("CP-"), hot(n, cold).cast("string")).alias("counterparty_external_id"),
        F.concat(F.lit("CT-"), (F.col("id") % 1000).cast("string")).alias("contract_number"),
    )
    cp = spark.range(cold - 1).select(F.concat(F.lit("CP-"), F.col("id").cast("string")).alias("external_id"), F.col("id").alias("counterparty_id"))
    ct = spark.range(1000).select(F.concat(F.lit("CT-"), F.col("id").cast("string")).alias("contract_number"), F.col("id").alias("contract_id"))
    rows, plan = final_plan(joins.resolve_keys(txn, cp, ct))
    assert "skew=true" in plan
    assert len(rows) == n
    unknown = sum(1 for i in range(n) if i % 3 and i % cold == cold - 1)
    assert sum(not r.resolved for r in rows) == unknown


def test_a_hot_code_is_split_in_the_regulation_join(no_broadcast):
    spark = no_broadcast
    n = 40_000
    docs = spark.range(0, n, 1, 8).select(
        F.col("id").alias("document_id"),
        (F.col("id") % 97).alias("entity_id"),
        F.lit("en").alias("jurisdiction"),
        F.concat(F.lit('{"regulation_code":"R'), hot(n, 200).cast("string"), F.lit('"}')).alias("metadata"),
    )
    regs = spark.range(300).select(
        F.col("id").alias("regulation_id"),
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("code"),
        F.lit("en").alias("jurisdiction"),
        F.lit("c").alias("category"),
        F.lit(dt.date(2000, 1, 1)).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
    )
    rows, plan = final_plan(joins.regulation_documents(regs.select("regulation_id", "code", "jurisdiction"), docs))
    assert "skew=true" in plan
    assert sum(r.document_id is not None for r in rows) == n and sum(r.document_id is None for r in rows) == 100
    row = gold.active_regulations(regs, docs, dt.date(2020, 1, 1)).first()
    assert (row.regulation_count, row.affected_entities) == (300, 97)


def test_revenue_of_a_hot_counterparty_is_whole(no_broadcast):
    spark = no_broadcast
    n, cold = 30_000, 300
    txn = spark.range(0, n, 1, 8).select(
        hot(n, cold).alias("counterparty_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 700).cast("int")).alias("transaction_date"),
        F.lit("USD").alias("currency"),
        F.lit("INVOICE").alias("transaction_type"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
    )
    cp = spark.range(cold).select(
        F.col("id").alias("counterparty_id"),
        F.concat(F.lit("CP-"), F.col("id").cast("string")).alias("external_id"),
        F.lit("n").alias("name"),
        F.lit("US").alias("country_code"),
    )
    table = gold.monthly_revenue(txn, cp)
    hot_total = sum(1 for i in range(n) if i % 3 == 0 or i % cold == 0)
    assert table.agg(F.sum("total_amount")).first()[0] == n
    assert table.where("counterparty_external_id = 'CP-0'").agg(F.sum("transaction_count")).first()[0] == hot_total
    # history: every counterparty renamed once, on the same day
    day = dt.date(2025, 1, 1)
    dim = cp.select("external_id", "name", "country_code", F.explode(F.array(F.lit(0), F.lit(1))).alias("v")).select(
        "external_id",
        F.concat("name", F.col("v").cast("string")).alias("name"),
        "country_code",
        F.when(F.col("v") == 0, F.lit(dt.date(2023, 1, 1))).otherwise(F.lit(day)).alias("valid_from"),
        F.when(F.col("v") == 0, F.lit(day - dt.timedelta(days=1))).otherwise(F.lit(scd2.OPEN_END)).alias("valid_to"),
    )
    asof = gold.monthly_revenue_asof(txn, cp, dim)
    late = sum(1 for i in range(n) if dt.date(2024, 1, 1) + dt.timedelta(days=i % 700) >= day)
    got = {r.counterparty_name: r.n for r in asof.groupBy("counterparty_name").agg(F.sum("transaction_count").alias("n")).collect()}
    assert got == {"n0": n - late, "n1": late}
