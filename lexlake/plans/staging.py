"""Silver-side projections: column mapping, typed staging views, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexlake.functions.business import MONEY, month_start, risk_tier, source_origin
from lexlake.functions.keys import pipe_hash
from lexlake.functions.text import first_filled

DOCUMENT_COLUMNS = [
    "document_date",
    "source_system",
    "source_id",
    "source_hash",
    "document_type",
    "title",
    "content",
    "jurisdiction",
    "tags",
    "metadata",
    "ingested_at",
]


def map_legal_csv(df: DataFrame, default_source: str = "legal_csv") -> DataFrame:
    """CSV columns to contract names.

    Two kinds of fallback: id, date, type and body take the next column when a
    value is null *or empty*; source system, title and jurisdiction only have a
    default for files that lack the column, and keep a null.
    """
    have = set(df.columns)

    def pick(*names: str) -> Column:
        found = [F.col(n) for n in names if n in have]
        return first_filled(*found) if found else F.lit(None).cast("string")

    def keep(name: str, default: str) -> Column:
        return F.col(name) if name in have else F.lit(default)

    source_id = F.coalesce(pick("doc_id", "source_id"), F.lit(""))
    # the last alternative is taken as it is, empty or not
    day = pick("date")
    if "document_date" in have:
        day = F.coalesce(day, F.col("document_date"))
    content = pick("content")
    if "body" in have:
        content = F.coalesce(content, F.col("body"))
    tags = F.col("tags") if "tags" in have else F.array().cast("array<string>")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    mapped = df.select(
        day.alias("document_date"),
        keep("source_system", default_source).alias("source_system"),
        source_id.alias("source_id"),
        F.coalesce(pick("type", "document_type"), F.lit("NOTICE")).alias("document_type"),
        keep("title", "").alias("title"),
        content.alias("content"),
        keep("jurisdiction", "UNKNOWN").alias("jurisdiction"),
        tags.alias("tags"),
        F.to_json(F.struct(row.alias("original_source_row")), {"ignoreNullFields": "false"}).alias("metadata"),
    )
    return mapped.withColumn("source_hash", pipe_hash("source_system", "source_id", "document_date"))


def load_defaults(df: DataFrame, as_of: Column, columns: list[str] = DOCUMENT_COLUMNS) -> DataFrame:
    """Fill the columns the table requires and fix the column list."""
    fill = {
        "ingested_at": as_of,
        "tags": F.array().cast("array<string>"),
        "metadata": F.lit("{}"),
    }
    out = []
    for c in columns:
        have = F.col(c) if c in df.columns else F.lit(None)
        out.append(F.coalesce(have, fill[c]).alias(c) if c in fill else have.alias(c))
    return df.select(*out)


def stg_transactions(transactions: DataFrame) -> DataFrame:
    typed = transactions.select(
        "transaction_id",
        "transaction_date",
        "contract_id",
        "counterparty_id",
        F.col("amount").cast(MONEY).alias("amount"),
        F.upper("currency").alias("currency"),
        F.upper("transaction_type").alias("transaction_type"),
        "reference",
        "source_system",
        "ingested_at",
    )
    return typed.where(F.col("amount") != 0)


def stg_counterparties(counterparties: DataFrame) -> DataFrame:
    return counterparties.select(
        "counterparty_id",
        "external_id",
        "name",
        "tax_id",
        F.upper("country_code").alias("country_code"),
        "risk_score",
        source_origin("external_id").alias("source_origin"),
        "metadata",
    )


def stg_legal_documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("document_id").alias("document_uuid"),
        "document_date",
        "source_system",
        "source_id",
        "source_hash",
        "document_type",
        "title",
        "jurisdiction",
        "tags",
        "metadata",
        "ingested_at",
        (F.col("source_system") == "sec_edgar").alias("is_sec_edgar"),
        month_start("document_date").alias("document_month"),
    )


def enrich_commercial(df: DataFrame) -> DataFrame:
    """Put the risk tier into the metadata map, if the frame has a score at all."""
    if "risk_score" not in df.columns:
        return df
    tier = F.create_map(F.lit("risk_tier"), risk_tier("risk_score"))
    if "metadata" not in df.columns:
        return df.withColumn("metadata", tier)
    # an older tier in the map is replaced
    kept = F.map_filter(
        F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, _: k != "risk_tier"
    )
    return df.withColumn("metadata", F.map_concat(kept, tier))


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Normalize landed documents and keep one row per content key. Which copy
    stays is fixed by the newest lineage stamp, then by the other columns."""
    from lexlake.operators.keyed import latest_per_key

    normalized = bronze.withColumns(
        {
            "title": F.trim(F.upper("title")),
            "document_type": F.upper("document_type"),
            "jurisdiction": F.trim("jurisdiction"),
            "source_hash": F.sha2(F.concat_ws("|", "source_system", "source_id", "document_date"), 256),
        }
    )
    return latest_per_key(normalized, ["source_hash"], ["ingested_at", "title", "content"])


def unify(*feeds: DataFrame) -> DataFrame:
    """Feeds with different column sets as one table; what a feed lacks is null."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
