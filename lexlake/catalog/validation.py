"""Registered row contracts: every row of a raw feed with its normalized values and
the list of its errors, plus error totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.catalog.registry import query
from lexlake.contracts import CONTRACTS
from lexlake.operators import validate
from lexlake.operators.validate import ERRORS, apply_contract
from lexlake.plans import staging


def _s(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _d(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast({c} AS DATE) END"


def _when(condition: str, loc: str, kind: str) -> str:
    return f"CASE WHEN {condition} THEN '{loc}:{kind}' END"


def _length(c: str, low: int, high: int, raw: str | None = None) -> list[str]:
    raw = raw or c
    return [
        _when(f"{raw} IS NULL", c, "string_type"),
        _when(f"length({_s(raw)}) < {low}", c, "string_too_short"),
        _when(f"length({_s(raw)}) > {high}", c, "string_too_long"),
    ]


def _date(c: str, required: bool = True) -> list[str]:
    need = [_when(f"{c} IS NULL", c, "date_type")] if required else []
    return need + [_when(f"{c} IS NOT NULL AND ({_d(c)}) IS NULL", c, "date_parsing")]


def _joined(errors: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(errors) + ")"


def checked(v, kind: str) -> DataFrame:
    raw = {
        "entity": v.raw_entities,
        "document": lambda: staging.map_legal_csv(v.raw_documents()),
        "regulation": v.raw_regulations,
        "counterparty": v.raw_counterparties,
        "contract": v.raw_contracts,
        "transaction": v.raw_transactions,
    }[kind]()
    return apply_contract(raw, CONTRACTS[kind])


def _listed(df: DataFrame, *columns: str) -> DataFrame:
    found = F.transform(ERRORS, lambda e: F.concat(e["loc"], F.lit(":"), e["type"]))
    return df.select(*columns, F.array_join(found, ",").alias("errors"))


_ENTITY_ERRORS = _joined(
    _length("tax_id", 5, 50)
    + _length("legal_name", 1, 500)
    + _length("entity_type", 1, 50)
    + _length("jurisdiction", 2, 100)
    + _date("registration_date", False)
    + [_when("upper(status) NOT IN ('ACTIVE','INACTIVE','DISSOLVED','SUSPENDED')", "status", "value_error")]
)


@query(
    "validate_legal_entity",
    f"""SELECT {_s('tax_id')} AS tax_id, regexp_replace({_s('upper(legal_name)')}, '\\s+', ' ', 'g') AS legal_name,
               entity_type, jurisdiction, {_d('registration_date')} AS registration_date, upper(status) AS status,
               {_ENTITY_ERRORS} AS errors
        FROM v_raw_entities""",
)
def _(v):
    return _listed(
        checked(v, "entity"), "tax_id", "legal_name", "entity_type", "jurisdiction", "registration_date", "status"
    )


_DOC_SQL = """(SELECT date AS document_date, source_system, coalesce(doc_id, '') AS source_id,
      sha256(coalesce(source_system, 'None') || '|' || coalesce(doc_id, '') || '|' || coalesce(date, 'None')) AS source_hash,
      coalesce(nullif(type, ''), 'NOTICE') AS document_type, title, content, jurisdiction FROM v_raw_documents)"""
_DOC_ERRORS = _joined(
    _date("document_date")
    + _length("source_system", 1, 50)
    + _length("source_id", 1, 200)
    + _length("source_hash", 64, 64)
    + _length("document_type", 1, 50)
    + _length("title", 1, 1000)
    + _length("jurisdiction", 2, 100)
)


@query(
    "validate_legal_document",
    f"""SELECT {_d('document_date')} AS document_date, source_system, source_id, source_hash,
               upper(document_type) AS document_type, {_s('title')} AS title, jurisdiction, 0 AS n_tags,
               {_DOC_ERRORS} AS errors
        FROM {_DOC_SQL}""",
)
def _(v):
    rows = checked(v, "document").withColumn("n_tags", F.size("tags"))
    return _listed(
        rows,
        "document_date",
        "source_system",
        "source_id",
        "source_hash",
        "document_type",
        "title",
        "jurisdiction",
        "n_tags",
    )


_REG_ERRORS = _joined(
    _length("code", 1, 100)
    + _length("title", 1, 500)
    + _length("jurisdiction", 2, 100)
    + _date("effective_from")
    + _date("effective_to", False)
    + _length("category", 1, 100)
    + [_when(f"({_d('effective_to')}) < ({_d('effective_from')})", "effective_to", "value_error")]
)


@query(
    "validate_regulation",
    f"""SELECT code, title, jurisdiction, {_d('effective_from')} AS effective_from, {_d('effective_to')} AS effective_to,
               category, {_REG_ERRORS} AS errors FROM v_raw_regulations""",
)
def _(v):
    return _listed(
        checked(v, "regulation"), "code", "title", "jurisdiction", "effective_from", "effective_to", "category"
    )


_SCORE = "try_cast(risk_score AS DECIMAL(38,10))"
_CP_ERRORS = _joined(
    _length("external_id", 1, 100)
    + _length("name", 1, 500)
    + _length("country_code", 2, 2)
    + [
        _when(f"risk_score IS NOT NULL AND {_SCORE} IS NULL", "risk_score", "decimal_parsing"),
        _when(f"{_SCORE} < 0 OR {_SCORE} > 100", "risk_score", "value_error"),
    ]
)


@query(
    "validate_counterparty",
    f"""SELECT {_s('external_id')} AS external_id, {_s('name')} AS name, tax_id, upper(country_code) AS country_code,
               CASE WHEN {_SCORE} BETWEEN 0 AND 100 THEN CAST({_SCORE} AS DECIMAL(5,2)) END AS risk_score,
               {_CP_ERRORS} AS errors FROM v_raw_counterparties""",
)
def _(v):
    rows = checked(v, "counterparty")
    score = F.when(F.col("risk_score").between(0, 100), F.col("risk_score").cast("decimal(5,2)"))
    return _listed(rows.withColumn("risk_score", score), "external_id", "name", "tax_id", "country_code", "risk_score")


_VALUE = "try_cast(total_value AS DECIMAL(18,2))"
_CONTRACT_ERRORS = _joined(
    _length("contract_number", 1, 100)
    + _length("counterparty_external_id", 1, 100)
    + _date("start_date")
    + _date("end_date", False)
    + [
        _when(f"total_value IS NOT NULL AND {_VALUE} IS NULL", "total_value", "decimal_parsing"),
        _when(f"{_VALUE} < 0", "total_value", "greater_than_equal"),
    ]
    + _length("currency", 3, 3)
    + [
        _when(
            "upper(status) NOT IN ('DRAFT','ACTIVE','SUSPENDED','TERMINATED','EXPIRED')", "status", "value_error"
        ),
        _when(f"({_d('end_date')}) < ({_d('start_date')})", "end_date", "value_error"),
    ]
)


@query(
    "validate_contract",
    f"""SELECT contract_number, counterparty_external_id, {_d('start_date')} AS start_date, {_d('end_date')} AS end_date,
               {_VALUE} AS total_value, upper(currency) AS currency, upper(status) AS status,
               {_CONTRACT_ERRORS} AS errors FROM v_raw_contracts""",
)
def _(v):
    return _listed(
        checked(v, "contract"),
        "contract_number",
        "counterparty_external_id",
        "start_date",
        "end_date",
        "total_value",
        "currency",
        "status",
    )


_AMOUNT = "try_cast(amount AS DECIMAL(18,2))"
_TXN_ERRORS = _joined(
    _date("transaction_date")
    + _length("contract_number", 1, 100)
    + _length("counterparty_external_id", 1, 100)
    + [
        _when(f"amount IS NOT NULL AND {_AMOUNT} IS NULL", "amount", "decimal_parsing"),
        _when(f"{_AMOUNT} = 0", "amount", "value_error"),
    ]
    + _length("currency", 3, 3)
    + _length("transaction_type", 1, 30)
    + _length("reference", 1, 200)
    + _length("source_system", 1, 50)
)
_TXN_SQL = f"""SELECT {_d('transaction_date')} AS transaction_date, contract_number, counterparty_external_id,
               {_AMOUNT} AS amount, upper(currency) AS currency, upper(transaction_type) AS transaction_type,
               {_s('reference')} AS reference, source_system, {_TXN_ERRORS} AS errors FROM v_raw_transactions"""
_TXN_COLUMNS = [
    "transaction_date",
    "contract_number",
    "counterparty_external_id",
    "amount",
    "currency",
    "transaction_type",
    "reference",
    "source_system",
]


@query("validate_transaction", _TXN_SQL)
def _(v):
    return _listed(checked(v, "transaction"), *_TXN_COLUMNS)


@query(
    "split_valid_rejected",
    f"""WITH checked AS ({_TXN_SQL})
        SELECT 'valid' AS side, reference, transaction_date::VARCHAR AS detail FROM checked WHERE errors = ''
        UNION ALL SELECT 'rejected', reference, errors FROM checked WHERE errors <> ''""",
)
def _(v):
    contract = CONTRACTS["transaction"]
    valid, rejected = validate.split(v.raw_transactions(), contract)
    found = F.transform("errors", lambda e: F.concat(e["loc"], F.lit(":"), e["type"]))
    return valid.select(
        F.lit("valid").alias("side"), "reference", F.col("transaction_date").cast("string").alias("detail")
    ).unionByName(
        rejected.select(
            F.lit("rejected").alias("side"),
            F.trim(F.regexp_replace(F.get_json_object("raw", "$.reference"), "\t", " ")).alias("reference"),
            F.array_join(found, ",").alias("detail"),
        )
    )


_EACH = [
    ("entity", "v_raw_entities", _ENTITY_ERRORS),
    ("document", _DOC_SQL, _DOC_ERRORS),
    ("regulation", "v_raw_regulations", _REG_ERRORS),
    ("counterparty", "v_raw_counterparties", _CP_ERRORS),
    ("contract", "v_raw_contracts", _CONTRACT_ERRORS),
    ("transaction", "v_raw_transactions", _TXN_ERRORS),
]


@query(
    "rejection_rate",
    " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, count(*) AS total, count(*) FILTER (WHERE e = '') AS valid,
                   count(*) FILTER (WHERE e <> '') AS rejected,
                   round(count(*) FILTER (WHERE e <> '') / greatest(count(*), 1), 9) AS rejection_rate
            FROM (SELECT {errors} AS e FROM {source} AS s)"""
        for kind, source, errors in _EACH
    ),
)
def _(v):
    parts = [
        validate.outcome_counts(checked(v, kind)).select(
            F.lit(kind).alias("kind"), "total", "valid", "rejected", F.round("rejection_rate", 9).alias("rejection_rate")
        )
        for kind, _, _ in _EACH
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "validation_error_counts",
    " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, split_part(x, ':', 1) AS loc, split_part(x, ':', 2) AS type, count(*) AS errors
            FROM (SELECT unnest(string_split(e, ',')) AS x FROM (SELECT {errors} AS e FROM {source} AS s) WHERE e <> '')
            GROUP BY 1, 2, 3"""
        for kind, source, errors in _EACH
    ),
)
def _(v):
    parts = [
        validate.error_counts(checked(v, kind)).select(F.lit(kind).alias("kind"), "loc", "type", "errors")
        for kind, _, _ in _EACH
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
