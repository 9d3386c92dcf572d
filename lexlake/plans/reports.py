"""Analytic reads over Silver and Gold. NULLs sort last in both directions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.functions.business import MONEY, source_origin
from lexlake.functions.text import like_any_case
from lexlake.operators.partitions import recent

PREVIEW_LIMITS = (1, 100)


def overview(documents: DataFrame) -> DataFrame:
    """Totals over all documents. Rows are first counted per combination of the
    three labels; distinct counts are taken over those few rows."""
    combos = documents.groupBy("source_system", "document_type", "jurisdiction").agg(
        F.count(F.lit(1)).alias("n"), F.min("ingested_at").alias("first"), F.max("ingested_at").alias("last")
    )
    return combos.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_documents"),
        F.count_distinct("source_system").alias("distinct_sources"),
        F.count_distinct("document_type").alias("distinct_types"),
        F.count_distinct("jurisdiction").alias("distinct_jurisdictions"),
        F.min("first").alias("first_ingest"),
        F.max("last").alias("last_ingest"),
    )


def distribution(documents: DataFrame, column: str, top: int | None = None) -> DataFrame:
    counted = documents.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("value"))
    ordered = counted.orderBy(F.desc_nulls_last("value"), F.asc_nulls_last("label"))
    return ordered.limit(top) if top else ordered


def volume_by_source_type(documents: DataFrame) -> DataFrame:
    return (
        documents.groupBy("source_system", "document_type")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.min("document_date").alias("earliest"),
            F.max("document_date").alias("latest"),
        )
        .orderBy(F.asc_nulls_last("source_system"), F.desc_nulls_last("documents"))
    )


def origin_counts(counterparties: DataFrame, top: int = 15) -> DataFrame:
    origin = source_origin("external_id", "GLEIF", "seed", "other").alias("origin")
    return (
        counterparties.groupBy(origin, "country_code")
        .agg(F.count(F.lit(1)).alias("counterparties"), F.count("tax_id").alias("with_tax_id"))
        .orderBy(F.desc_nulls_last("counterparties"), F.asc_nulls_last("origin"), F.asc_nulls_last("country_code"))
        .limit(top)
    )


def _recent_invoices(transactions: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return transactions.where(recent("transaction_date", as_of, days) & (F.col("transaction_type") == "INVOICE"))


def top_counterparties(transactions: DataFrame, as_of: dt.date, days: int = 90, top: int = 20) -> DataFrame:
    return (
        _recent_invoices(transactions, as_of, days)
        .groupBy("counterparty_id")
        .agg(F.sum("amount").cast(MONEY).alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("counterparty_id"))
        .limit(top)
    )


def top_counterparties_named(
    transactions: DataFrame, counterparties: DataFrame, as_of: dt.date, days: int = 90, top: int = 10
) -> DataFrame:
    """Adds up per counterparty and joins the sums, not the transactions."""
    sums = (
        _recent_invoices(transactions, as_of, days)
        .groupBy("counterparty_id")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").cast(MONEY).alias("revenue"))
    )
    return (
        sums.join(counterparties.select("counterparty_id", "name", "country_code"), "counterparty_id")
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("counterparty_id"))
        .limit(top)
        .select("counterparty_id", "name", "country_code", "txn_count", "revenue")
    )


def revenue_rollup(gold: DataFrame, currency: str, months: int = 12) -> DataFrame:
    """Last months of one currency over the revenue table."""
    return (
        gold.where(F.col("currency") == currency)
        .groupBy("month")
        .agg(
            F.count_distinct("counterparty_external_id").alias("counterparties"),
            F.sum("transaction_count").alias("total_txns"),
            F.sum("total_amount").cast(MONEY).alias("total_revenue"),
        )
        .orderBy(F.desc_nulls_last("month"))
        .limit(months)
    )


def revenue_by_month(gold: DataFrame, months: int = 12, currency: str | None = None) -> DataFrame:
    if currency:
        gold = gold.where(F.col("currency") == currency)
    return (
        gold.groupBy("month")
        .agg(F.sum("total_amount").cast(MONEY).alias("revenue"))
        .orderBy(F.desc_nulls_last("month"))
        .limit(months)
    )


def filings_by_type(documents: DataFrame, source: str = "sec_edgar") -> DataFrame:
    return (
        documents.where(F.col("source_system") == source)
        .groupBy("document_type")
        .agg(F.count(F.lit(1)).alias("filings"))
        .orderBy(F.desc_nulls_last("filings"), F.asc_nulls_last("document_type"))
    )


def count_recent(transactions: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return transactions.where(recent("transaction_date", as_of, days)).agg(F.count(F.lit(1)).alias("n"))


def search_names(entities: DataFrame, needle: str, top: int = 50) -> DataFrame:
    """Names containing the text in any case; the first ones in name order."""
    return (
        entities.where(like_any_case("legal_name", needle))
        .select("entity_id", "legal_name")
        .orderBy(F.asc_nulls_last("legal_name"), F.asc_nulls_last("entity_id"))
        .limit(top)
    )


def preview(documents: DataFrame, top: int = 20) -> DataFrame:
    """Newest documents with dates as ISO text."""
    low, high = PREVIEW_LIMITS
    if not low <= top <= high:
        raise ValueError(f"limit must be between {low} and {high}")
    return (
        documents.select(
            "source_id", "document_date", "document_type", "title", "jurisdiction", "source_system", "ingested_at"
        )
        .orderBy(F.desc_nulls_last("ingested_at"), F.asc_nulls_last("source_id"))
        .limit(top)
        .withColumn("document_date", F.date_format("document_date", "yyyy-MM-dd"))
        .withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss"))
    )


def open_contracts(contracts: DataFrame, statuses: tuple[str, ...] = ("ACTIVE", "PENDING")) -> DataFrame:
    return contracts.where(F.col("status").isin(*statuses))


def load_ratio(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.coalesce(F.sum("extracted"), F.lit(0)).alias("extracted"), F.coalesce(F.sum("loaded"), F.lit(0)).alias("loaded")
    ).select("extracted", "loaded", F.round(F.col("loaded") / F.greatest("extracted", F.lit(1)), 6).alias("load_ratio"))
