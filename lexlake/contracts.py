"""The six row contracts of the Silver layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexlake.operators.validate import Check, Contract, Field

# Allowed statuses.
ENTITY_STATUSES = ("ACTIVE", "INACTIVE", "DISSOLVED", "SUSPENDED")
CONTRACT_STATUSES = ("DRAFT", "ACTIVE", "SUSPENDED", "TERMINATED", "EXPIRED")


def _text(name: str, low: int, high: int, **kw) -> Field:
    return Field(name, min_len=low, max_len=high, **kw)


def _score_range(v: Column) -> list[Check]:
    return [((v < 0) | (v > 100), "value_error", "risk_score must be between 0 and 100")]


def _not_negative(v: Column) -> list[Check]:
    return [(v < 0, "greater_than_equal", "Input should be greater than or equal to 0")]


def _not_zero(v: Column) -> list[Check]:
    return [(v == 0, "value_error", "amount cannot be zero")]


def _ordered(start: str, end: str):
    def checks():
        return [(end, (F.col(end) < F.col(start), "value_error", f"{end} must be >= {start}"))]

    return checks


def _empty_object() -> Column:
    return F.lit("{}")


METADATA = Field("metadata", kind="json", required=False, default=_empty_object)
INGESTED = Field("ingested_at", kind="timestamp", required=False, default=F.current_timestamp)

LEGAL_ENTITY = Contract(
    "LegalEntity",
    (
        _text("tax_id", 5, 50),
        _text("legal_name", 1, 500, upper=True, collapse=True),
        _text("entity_type", 1, 50),
        _text("jurisdiction", 2, 100),
        Field("registration_date", kind="date", required=False),
        Field("status", upper=True, allowed=ENTITY_STATUSES, default=lambda: F.lit("ACTIVE")),
        METADATA,
    ),
    kind="entity",
)

LEGAL_DOCUMENT = Contract(
    "LegalDocument",
    (
        Field("document_date", kind="date"),
        _text("source_system", 1, 50),
        _text("source_id", 1, 200),
        _text("source_hash", 64, 64),
        _text("document_type", 1, 50, upper=True),
        _text("title", 1, 1000),
        Field("content", required=False),
        _text("jurisdiction", 2, 100),
        Field("entity_tax_id", required=False),
        Field("tags", kind="tags", required=False),
        METADATA,
        INGESTED,
    ),
    kind="document",
)

REGULATION = Contract(
    "Regulation",
    (
        _text("code", 1, 100),
        _text("title", 1, 500),
        _text("jurisdiction", 2, 100),
        Field("effective_from", kind="date"),
        Field("effective_to", kind="date", required=False),
        _text("category", 1, 100),
        Field("content", required=False),
        METADATA,
    ),
    cross=_ordered("effective_from", "effective_to"),
    kind="regulation",
)

COUNTERPARTY = Contract(
    "Counterparty",
    (
        _text("external_id", 1, 100),
        _text("name", 1, 500),
        Field("tax_id", required=False),
        _text("country_code", 2, 2, upper=True),
        # read wide so that 100.004 is out of range instead of rounding to 100.00
        Field(
            "risk_score",
            kind="decimal",
            required=False,
            precision=(38, 10),
            store="decimal(5,2)",
            checks=_score_range,
        ),
        METADATA,
    ),
    kind="counterparty",
)

CONTRACT = Contract(
    "Contract",
    (
        _text("contract_number", 1, 100),
        _text("counterparty_external_id", 1, 100),
        Field("start_date", kind="date"),
        Field("end_date", kind="date", required=False),
        Field("total_value", kind="decimal", checks=_not_negative),
        _text("currency", 3, 3, upper=True),
        Field("status", upper=True, allowed=CONTRACT_STATUSES, default=lambda: F.lit("DRAFT")),
        METADATA,
    ),
    cross=_ordered("start_date", "end_date"),
    kind="contract",
)

TRANSACTION = Contract(
    "Transaction",
    (
        Field("transaction_date", kind="date"),
        _text("contract_number", 1, 100),
        _text("counterparty_external_id", 1, 100),
        Field("amount", kind="decimal", checks=_not_zero),
        _text("currency", 3, 3, upper=True),
        _text("transaction_type", 1, 30, upper=True),
        _text("reference", 1, 200),
        _text("source_system", 1, 50),
        INGESTED,
        METADATA,
    ),
    kind="transaction",
)

CONTRACTS = {
    c.kind: c for c in (LEGAL_ENTITY, LEGAL_DOCUMENT, REGULATION, COUNTERPARTY, CONTRACT, TRANSACTION)
}


def contract_for(kind: str) -> Contract:
    if kind not in CONTRACTS:
        raise ValueError(f"Unknown kind: {kind}; expected one of {', '.join(CONTRACTS)}")
    return CONTRACTS[kind]
