"""Registered projections, filters, windows, sorts and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lexlake.catalog.registry import query
from lexlake.catalog.views import AS_OF, REGULATIONS_AS_OF
from lexlake.functions.business import form_category, risk_tier
from lexlake.functions.keys import row_hash
from lexlake.operators import joins, keyed, partitions
from lexlake.operators.scd2 import from_feed
from lexlake.plans import gold, reports, staging

TIER_SQL = """CASE WHEN risk_score IS NULL THEN 'UNKNOWN' WHEN risk_score < 25 THEN 'LOW'
              WHEN risk_score < 50 THEN 'MODERATE' WHEN risk_score < 75 THEN 'HIGH' ELSE 'CRITICAL' END"""
ORIGIN_SQL = """CASE WHEN starts_with(external_id, 'LEI-') THEN 'GLEIF'
                WHEN starts_with(external_id, 'CP-') THEN 'SEED' ELSE 'OTHER' END"""


@query(
    "map_legal_csv",
    """SELECT coalesce(doc_id, '') AS source_id, date AS document_date, source_system,
              coalesce(nullif(type, ''), 'NOTICE') AS document_type, title, content, jurisdiction,
              sha256(coalesce(source_system, 'None') || '|' || coalesce(doc_id, '') || '|' || coalesce(date, 'None')) AS source_hash,
              doc_id AS original_id
       FROM v_raw_documents""",
)
def _(v):
    mapped = staging.map_legal_csv(v.raw_documents())
    return mapped.select(
        "source_id",
        "document_date",
        "source_system",
        "document_type",
        "title",
        "content",
        "jurisdiction",
        "source_hash",
        F.get_json_object("metadata", "$.original_source_row.doc_id").alias("original_id"),
    )


STG_TXN_SQL = """SELECT transaction_id, transaction_date, contract_id, counterparty_id, amount, upper(currency) AS currency,
              upper(transaction_type) AS transaction_type, reference, source_system,
              strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
       FROM v_transactions WHERE amount <> 0"""


@query("stg_transactions", STG_TXN_SQL)
def _(v):
    return staging.stg_transactions(v.transactions()).withColumn(
        "ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "stg_counterparties",
    f"""SELECT counterparty_id, external_id, name, tax_id, upper(country_code) AS country_code, risk_score,
               {ORIGIN_SQL} AS source_origin, segment FROM v_counterparties""",
)
def _(v):
    return staging.stg_counterparties(v.counterparties()).select(
        "*", F.col("metadata")["segment"].alias("segment")
    ).drop("metadata")


@query(
    "stg_legal_documents",
    """SELECT document_id AS document_uuid, document_date, source_system, source_id, source_hash, document_type, title,
              jurisdiction, lang || ',' || source AS tags, regulation_code,
              strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at, source_system = 'sec_edgar' AS is_sec_edgar,
              CAST(date_trunc('month', document_date) AS DATE) AS document_month
       FROM v_legal_documents""",
)
def _(v):
    return (
        staging.stg_legal_documents(v.legal_documents())
        .withColumn("tags", F.array_join("tags", ","))
        .withColumn("regulation_code", F.get_json_object("metadata", "$.regulation_code"))
        .withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))
        .drop("metadata")
    )


@query("risk_tier", f"SELECT counterparty_id, risk_score, {TIER_SQL} AS risk_tier FROM v_counterparties")
def _(v):
    return v.counterparties().select("counterparty_id", "risk_score", risk_tier("risk_score").alias("risk_tier"))


@query(
    "enrich_commercial",
    f"SELECT counterparty_id, segment, {TIER_SQL} AS risk_tier, 2 AS metadata_keys FROM v_counterparties",
)
def _(v):
    return staging.enrich_commercial(v.counterparties()).select(
        "counterparty_id",
        F.col("metadata")["segment"].alias("segment"),
        F.col("metadata")["risk_tier"].alias("risk_tier"),
        F.size("metadata").alias("metadata_keys"),
    )


@query(
    "load_defaults",
    """SELECT document_date, source_id, title, 0 AS n_tags, '{}' AS metadata, '2024-06-01' AS ingested_on,
              11 AS n_columns FROM v_legal_documents""",
)
def _(v):
    bare = v.legal_documents().drop("tags", "metadata", "ingested_at")
    filled = staging.load_defaults(bare, F.lit(dt.datetime(2024, 6, 1)))
    return filled.select(
        "document_date",
        "source_id",
        "title",
        F.size("tags").alias("n_tags"),
        "metadata",
        F.date_format("ingested_at", "yyyy-MM-dd").alias("ingested_on"),
        F.lit(len(filled.columns)).alias("n_columns"),
    )


@query(
    "recent_filter",
    """SELECT transaction_date, reference, amount FROM v_transaction_lines
       WHERE transaction_date >= DATE '2001-06-30' - 90""",
)
def _(v):
    return (
        v.transaction_lines()
        .where(partitions.recent("transaction_date", AS_OF, 90))
        .select("transaction_date", "reference", "amount")
    )


@query(
    "ilike_search",
    """SELECT entity_id, legal_name FROM v_legal_entities WHERE legal_name ILIKE '%MER#00000%'
       ORDER BY legal_name, entity_id LIMIT 50""",
)
def _(v):
    return reports.search_names(v.legal_entities(), "MER#00000")


@query(
    "json_contains",
    """SELECT document_id, regulation_code, true AS has_code, false AS has_other, lang = 'en' AS tagged_en
       FROM v_legal_documents WHERE regulation_code = 'R7' OR lang = 'en'""",
)
def _(v):
    code = F.get_json_object("metadata", "$.regulation_code")
    return (
        v.legal_documents()
        .where((code == "R7") | F.array_contains("tags", "en"))
        .select(
            "document_id",
            code.alias("regulation_code"),
            code.isNotNull().alias("has_code"),
            F.get_json_object("metadata", "$.other").isNotNull().alias("has_other"),
            F.array_contains("tags", "en").alias("tagged_en"),
        )
    )


@query(
    "open_contracts",
    """SELECT contract_number, counterparty_id, end_date, total_value, status FROM v_contracts
       WHERE status IN ('ACTIVE', 'PENDING')""",
)
def _(v):
    return reports.open_contracts(v.contracts()).select(
        "contract_number", "counterparty_id", "end_date", "total_value", "status"
    )


@query(
    "active_regulations_filter",
    """SELECT regulation_id, code, jurisdiction, effective_from, effective_to FROM v_regulations
       WHERE effective_from <= DATE '2003-01-01' AND (effective_to IS NULL OR effective_to >= DATE '2003-01-01')""",
)
def _(v):
    return (
        v.regulations()
        .where(gold.active_on(REGULATIONS_AS_OF))
        .select("regulation_id", "code", "jurisdiction", "effective_from", "effective_to")
    )


@query(
    "data_preview",
    """SELECT source_id, document_date::VARCHAR AS document_date, document_type, title, jurisdiction, source_system,
              strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') AS ingested_at
       FROM v_legal_documents d ORDER BY d.ingested_at DESC NULLS LAST, source_id LIMIT 20""",
)
def _(v):
    return reports.preview(v.legal_documents(), 20)


@query(
    "filing_type_map",
    """SELECT accession, form, CASE
         WHEN form IN ('10-K','10-K/A') THEN 'ANNUAL_REPORT' WHEN form IN ('10-Q','10-Q/A') THEN 'QUARTERLY_REPORT'
         WHEN form IN ('8-K','8-K/A') THEN 'MATERIAL_EVENT' WHEN form = 'DEF 14A' THEN 'PROXY'
         WHEN form IN ('S-1','S-1/A','S-3','S-4') THEN 'REGISTRATION' WHEN form = '20-F' THEN 'FOREIGN_ANNUAL'
         WHEN form = '6-K' THEN 'FOREIGN_INTERIM' WHEN form = '424B' THEN 'PROSPECTUS'
         WHEN form IN ('SC 13D','SC 13G') THEN 'OWNERSHIP_DISCLOSURE' WHEN form IN ('3','4','5') THEN 'INSIDER_TRANSACTION'
         WHEN form = 'N-CSR' THEN 'FUND_REPORT' WHEN form = '13F-HR' THEN 'FUND_HOLDINGS'
         ELSE 'OTHER_FILING' END AS document_type
       FROM v_filings""",
)
def _(v):
    from lexlake.catalog.landing import filings

    return filings(v).select(
        F.col("accessionNumber").alias("accession"), "form", form_category("form").alias("document_type")
    )


@query("source_cap", "SELECT cik, ticker, title FROM v_companies ORDER BY cik LIMIT 50")
def _(v):
    from lexlake.sources.files import first_n

    return first_n(v.companies(), ["cik"], 50)


# --- windows, sorts, sets ---------------------------------------------------------

LATEST_SQL = """SELECT * EXCLUDE (rn) FROM (
         SELECT source_system, reference, transaction_date, amount, transaction_type, k,
                row_number() OVER (PARTITION BY source_system, reference, transaction_date
                                   ORDER BY amount DESC, line_no DESC) AS rn
         FROM v_transaction_lines) WHERE rn = 1"""
TXN_KEY = ["source_system", "reference", "transaction_date"]


@query("latest_per_key", LATEST_SQL)
def _(v):
    rows = v.transaction_lines(heavy=True).select(*TXN_KEY, "amount", "transaction_type", "k", "line_no")
    return keyed.latest_per_key(rows, TXN_KEY, ["amount", "line_no"]).drop("line_no")


@query(
    "scd2_from_feed",
    """SELECT external_id, band, valid_from, valid_to, is_current FROM v_dim_counterparty""",
)
def _(v):
    return v.dim_counterparty().select("external_id", "band", "valid_from", "valid_to", "is_current")


@query(
    "scd2_from_feed_same_day",
    """SELECT user_id, band, effective AS valid_from,
              coalesce(lead(effective) OVER w - 1, DATE '9999-12-31') AS valid_to, lead(effective) OVER w IS NULL AS is_current
       FROM (SELECT *, lag(band) OVER (PARTITION BY user_id ORDER BY effective) AS prev
             FROM (SELECT user_id, ts::DATE AS effective, arg_max(event_type, (ts, event_id)) AS band FROM events GROUP BY 1, 2))
       WHERE prev IS NULL OR prev <> band WINDOW w AS (PARTITION BY user_id ORDER BY effective)""",
)
def _(v):
    out = from_feed(v.activity_feed(), "user_id", ["band"], "effective", ["ts", "seq"])
    return out.select("user_id", "band", "valid_from", "valid_to", "is_current")


@query(
    "topk",
    """SELECT counterparty_id, sum(total_value) AS total_value FROM v_contracts GROUP BY 1
       ORDER BY sum(total_value) DESC, counterparty_id LIMIT 15""",
)
def _(v):
    return (
        v.contracts()
        .groupBy("counterparty_id")
        .agg(F.sum("total_value").cast("decimal(38,2)").alias("total_value"))
        .orderBy(F.desc_nulls_last("total_value"), F.asc_nulls_last("counterparty_id"))
        .limit(15)
    )


@query(
    "sorted_history",
    "SELECT external_id, band, valid_from, valid_to FROM v_dim_counterparty ORDER BY external_id, valid_from",
)
def _(v):
    return v.dim_counterparty().select("external_id", "band", "valid_from", "valid_to").orderBy("external_id", "valid_from")


@query(
    "limit_scan",
    """SELECT external_id, name, risk_score FROM v_counterparties ORDER BY external_id LIMIT 100""",
)
def _(v):
    from lexlake.sources.files import first_n

    return first_n(v.counterparties().select("external_id", "name", "risk_score"), ["external_id"], 100)


@query(
    "unify_sources",
    """SELECT source_system, source_id, jurisdiction, document_date, lang AS language FROM v_legal_documents
       UNION ALL SELECT 'registry', code, jurisdiction, effective_from, NULL FROM v_regulations
       UNION ALL SELECT 'entities', tax_id, jurisdiction, NULL, NULL FROM v_legal_entities""",
)
def _(v):
    docs = v.legal_documents().select(
        "source_system", "source_id", "jurisdiction", "document_date", F.get("tags", F.lit(0)).alias("language")
    )
    regs = v.regulations().select(
        F.lit("registry").alias("source_system"),
        F.col("code").alias("source_id"),
        "jurisdiction",
        F.col("effective_from").alias("document_date"),
    )
    entities = v.legal_entities().select(
        F.lit("entities").alias("source_system"), F.col("tax_id").alias("source_id"), "jurisdiction"
    )
    return staging.unify(docs, regs, entities)


@query(
    "canonical_row_hash",
    """SELECT counterparty_id, sha256('{"country_code":"' || country_code || '","name":"' || name || '","risk_score":'
              || coalesce(risk_score::VARCHAR, 'null') || '}') AS row_hash FROM v_counterparties""",
)
def _(v):
    return v.counterparties().select("counterparty_id", row_hash(["name", "risk_score", "country_code"]).alias("row_hash"))


@query(
    "sample_history",
    """SELECT external_id, band, valid_from, valid_to, is_current FROM v_dim_counterparty
       WHERE external_id = (SELECT min(external_id) FROM v_dim_counterparty) ORDER BY valid_from""",
)
def _(v):
    dim = v.dim_counterparty().select("external_id", "band", "valid_from", "valid_to", "is_current")
    return joins.first_key_history(dim, "external_id")
