"""Gold tables.

Revenue tables add up transactions per key before they meet the dimension: sums
are taken per counterparty, month and currency, so the join sees one row for these
instead of every transaction, and a counterparty that owns a third of all
transactions is spread over its months and small by the time it is joined.

``parts`` is the number of partitions for shuffles of rows that are as many as the
transactions (``workspace.parts_for`` gives it from the size of their table); without
it the session's number holds, and sums combine on the map side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexlake.functions.business import MONEY, REVENUE_TYPES, mean_money, month_start, risk_tier
from lexlake.operators import scd2
from lexlake.operators.joins import document_codes

WIDE = "decimal(38,2)"


def _revenue(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("transaction_type").isin(*REVENUE_TYPES))


def _dealt(rows: DataFrame, keys: list[str], parts: int | None) -> DataFrame:
    """Rows of equal keys in one of ``parts`` partitions. Few rows are alike in a
    revenue table's keys, so rows as they are take less room than sums of them."""
    return rows.repartition(parts, *keys) if parts else rows


def _partial(transactions: DataFrame, keys: list[str], parts: int | None) -> DataFrame:
    amount = F.col("amount")
    return _dealt(transactions.select(*keys, "amount"), keys, parts).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).cast(WIDE).alias("total"),
        F.min(amount).alias("low"),
        F.max(amount).alias("high"),
    )


def monthly_revenue(transactions: DataFrame, counterparties: DataFrame, parts: int | None = None) -> DataFrame:
    """Per counterparty name, month and currency, over the counterparty table."""
    monthly = _revenue(transactions).withColumn("month", month_start("transaction_date"))
    part = _partial(monthly, ["counterparty_id", "month", "currency"], parts).drop("low", "high")
    cp = counterparties.select(
        "counterparty_id",
        F.col("external_id").alias("counterparty_external_id"),
        F.col("name").alias("counterparty_name"),
        "country_code",
    )
    joined = part.join(cp, "counterparty_id")
    keys = ["counterparty_external_id", "counterparty_name", "country_code", "month", "currency"]
    n, total = F.sum("n"), F.sum("total")
    return _dealt(joined, ["counterparty_external_id", "month", "currency"], parts).groupBy(*keys).agg(
        n.alias("transaction_count"),
        total.cast(MONEY).alias("total_amount"),
        mean_money(total, n).alias("avg_amount"),
    )


def monthly_revenue_asof(
    transactions: DataFrame,
    counterparties: DataFrame,
    dim: DataFrame,
    parts: int | None = None,
) -> DataFrame:
    """Same, with name and country as they were on the transaction date.

    A version is valid for whole days, so transactions are added up per day first;
    then at most one row per key, day and currency is sorted among the versions of its
    key. The sums stay in the partitions of that sort.
    """
    part = _partial(_revenue(transactions), ["counterparty_id", "transaction_date", "currency"], parts)
    ids = counterparties.select("counterparty_id", "external_id")
    facts = part.join(ids, "counterparty_id").drop("counterparty_id")
    history = dim.select("external_id", F.col("name").alias("counterparty_name"), "country_code", "valid_from", "valid_to")
    joined = scd2.asof_merge(facts, history, "external_id", "transaction_date", parts)
    n, total = F.sum("n"), F.sum("total")
    return joined.groupBy(
        F.col("external_id").alias("counterparty_external_id"),
        "counterparty_name",
        "country_code",
        month_start("transaction_date").alias("month"),
        "currency",
    ).agg(
        n.alias("transaction_count"),
        total.cast(MONEY).alias("total_amount"),
        mean_money(total, n).alias("avg_amount"),
        F.min("low").cast(MONEY).alias("min_amount"),
        F.max("high").cast(MONEY).alias("max_amount"),
    )


def active_on(as_of: Column | dt.date) -> Column:
    day = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    return (F.col("effective_from") <= day) & (F.col("effective_to").isNull() | (F.col("effective_to") >= day))


def active_regulations(regulations: DataFrame, documents: DataFrame, as_of: dt.date) -> DataFrame:
    """Active regulations and the entities their documents name, per jurisdiction
    and category. Documents are reduced to distinct entities per code before the
    join; regulations are counted on their own, so nothing is counted twice."""
    active = regulations.where(active_on(as_of)).select("regulation_id", "jurisdiction", "code", "category")
    entities = document_codes(documents).select("jurisdiction", "code", "entity_id").distinct()
    keys = ["jurisdiction", "category"]
    counted = active.groupBy(*keys).agg(F.count_distinct("regulation_id").alias("regulation_count"))
    affected = (
        active.join(entities, ["jurisdiction", "code"])
        .groupBy(*keys)
        .agg(F.count_distinct("entity_id").alias("affected_entities"))
    )
    affected = affected.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return counted.join(affected, same, "left").select(
        *keys, "regulation_count", F.coalesce("affected_entities", F.lit(0)).alias("affected_entities")
    )


def gold_monthly_revenue(stg_transactions: DataFrame, stg_counterparties: DataFrame, parts: int | None = None) -> DataFrame:
    """Per counterparty, month and currency, with the amounts split by type; a type
    that does not occur is null."""
    typed = lambda t: F.sum(F.when(F.col("transaction_type") == t, F.col("amount"))).cast(MONEY)
    amount, n = F.col("amount"), F.count(F.lit(1))
    keys = ["counterparty_id", "month", "currency"]
    monthly = _revenue(stg_transactions).withColumn("month", month_start("transaction_date"))
    part = (
        _dealt(monthly.select(*keys, "transaction_type", "amount"), keys, parts)
        .groupBy(*keys)
        .agg(
            n.alias("transaction_count"),
            F.sum(amount).cast(MONEY).alias("total_amount"),
            mean_money(F.sum(amount), n).alias("avg_amount"),
            F.min(amount).cast(MONEY).alias("min_amount"),
            F.max(amount).cast(MONEY).alias("max_amount"),
            typed("INVOICE").alias("invoiced_amount"),
            typed("PAYMENT").alias("paid_amount"),
            typed("REFUND").alias("refunded_amount"),
        )
    )
    cp = stg_counterparties.select(
        "counterparty_id", F.col("name").alias("counterparty_name"), "country_code", "source_origin"
    )
    return part.join(cp, "counterparty_id").select(
        "counterparty_id",
        "counterparty_name",
        "country_code",
        "source_origin",
        "month",
        "currency",
        "transaction_count",
        "total_amount",
        "avg_amount",
        "min_amount",
        "max_amount",
        "invoiced_amount",
        "paid_amount",
        "refunded_amount",
    )


def gold_risk_distribution(stg_counterparties: DataFrame) -> DataFrame:
    score = F.col("risk_score")
    return (
        stg_counterparties.withColumn("risk_tier", risk_tier(score))
        .groupBy("country_code", "source_origin", "risk_tier")
        .agg(
            F.count(F.lit(1)).alias("counterparty_count"),
            mean_money(F.sum(score), F.count(score)).alias("avg_risk_score"),
            F.min(score).alias("min_risk_score"),
            F.max(score).alias("max_risk_score"),
        )
    )


def gold_documents_by_jurisdiction(stg_documents: DataFrame) -> DataFrame:
    """Monthly volume. Rows are counted per source first; the number of sources is
    then a count of rows."""
    per_source = stg_documents.groupBy("jurisdiction", "document_type", "document_month", "source_system").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_sec_edgar").alias("edgar")
    )
    return per_source.groupBy("jurisdiction", "document_type", "document_month").agg(
        F.sum("n").alias("documents"),
        F.sum("edgar").alias("sec_edgar_documents"),
        F.count("source_system").alias("distinct_sources"),
    )
