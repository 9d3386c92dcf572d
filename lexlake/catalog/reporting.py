"""Registered joins, aggregations and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexlake.catalog.registry import query
from lexlake.catalog.views import AS_OF, REGULATIONS_AS_OF, sql_external_id, sql_mean
from lexlake.operators import joins, keyed, partitions, scd2
from lexlake.operators.percentiles import latency_percentiles
from lexlake.plans import gold, reports, staging
from lexlake.workspace import new_dir

from lexlake.catalog.projections import ORIGIN_SQL, TIER_SQL

REVENUE = "transaction_type IN ('INVOICE', 'PAYMENT', 'REFUND')"
MONTH = "CAST(date_trunc('month', transaction_date) AS DATE)"


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


# --- joins ------------------------------------------------------------------------


@query(
    "join_txn_counterparty",
    """SELECT t.reference, t.transaction_date, t.amount, c.external_id, c.name, c.country_code
       FROM v_transactions t JOIN v_counterparties c USING (counterparty_id)""",
)
def _(v):
    cp = v.counterparties().select("counterparty_id", "external_id", "name", "country_code")
    return (
        v.transactions()
        .select("counterparty_id", "reference", "transaction_date", "amount")
        .join(cp, "counterparty_id")
        .drop("counterparty_id")
    )


@query(
    "asof_dim_join",
    f"""SELECT t.reference, t.transaction_date, t.amount, d.external_id, d.band, d.valid_from
        FROM (SELECT *, {sql_external_id('counterparty_id')} AS external_id FROM v_transactions) t
        JOIN v_dim_counterparty d ON d.external_id = t.external_id AND t.transaction_date BETWEEN d.valid_from AND d.valid_to""",
)
def _(v):
    ids = v.counterparties().select("counterparty_id", "external_id")
    facts = (
        v.transactions(heavy=True)
        .select("counterparty_id", "reference", "transaction_date", "amount")
        .join(ids, "counterparty_id")
        .drop("counterparty_id")
    )
    dim = v.dim_counterparty().select("external_id", "band", "valid_from", "valid_to")
    return scd2.asof_join(facts, dim, "external_id", "transaction_date").drop("valid_to")


@query(
    "point_in_time",
    """SELECT external_id, band, valid_from, valid_to FROM v_dim_counterparty
       WHERE DATE '1998-06-15' BETWEEN valid_from AND valid_to""",
)
def _(v):
    import datetime as dt

    return scd2.point_in_time(v.dim_counterparty(), dt.date(1998, 6, 15)).select(
        "external_id", "band", "valid_from", "valid_to"
    )


@query(
    "fk_resolve",
    f"""WITH cp AS (SELECT * FROM v_counterparties WHERE risk_score IS NULL OR risk_score < 90),
             ct AS (SELECT * FROM v_contracts WHERE status <> 'DRAFT')
        SELECT t.reference, t.amount, cp.counterparty_id, ct.contract_id,
               cp.counterparty_id IS NOT NULL AND ct.contract_id IS NOT NULL AS resolved
        FROM (SELECT reference, amount, {sql_external_id('counterparty_id')} AS external_id,
                     'CT-' || contract_id::VARCHAR AS contract_number FROM v_transactions) t
        LEFT JOIN cp ON cp.external_id = t.external_id LEFT JOIN ct ON ct.contract_number = t.contract_number""",
)
def _(v):
    from lexlake.catalog.views import external_id

    # references not loaded yet: risky counterparties and draft contracts
    cp = v.counterparties().where(F.col("risk_score").isNull() | (F.col("risk_score") < 90))
    ct = v.contracts().where(F.col("status") != "DRAFT")
    txn = v.transactions().select(
        "reference",
        "amount",
        external_id(F.col("counterparty_id")).alias("counterparty_external_id"),
        F.concat(F.lit("CT-"), F.col("contract_id").cast("string")).alias("contract_number"),
    )
    return joins.resolve_keys(txn, cp, ct).select("reference", "amount", "counterparty_id", "contract_id", "resolved")


@query(
    "regulation_left_join",
    """SELECT r.regulation_id, r.code, r.jurisdiction, d.document_id, d.entity_id
       FROM v_regulations r LEFT JOIN v_legal_documents d ON d.jurisdiction = r.jurisdiction AND d.regulation_code = r.code""",
)
def _(v):
    regs = v.regulations().select("regulation_id", "code", "jurisdiction")
    return joins.regulation_documents(regs, v.legal_documents())


@query(
    "scalar_subquery_lookup",
    """SELECT reference, amount, (SELECT external_id FROM v_counterparties c WHERE c.counterparty_id = t.counterparty_id)
              AS external_id FROM v_transactions t""",
)
def _(v):
    ids = v.counterparties().select("counterparty_id", "external_id")
    return v.transactions().select("reference", "amount", "counterparty_id").join(ids, "counterparty_id", "left").drop(
        "counterparty_id"
    )


@query(
    "orphan_rows",
    """SELECT document_id, entity_id FROM v_legal_documents d
       WHERE NOT EXISTS (SELECT 1 FROM v_legal_entities e WHERE e.entity_id = d.entity_id AND e.status = 'ACTIVE')""",
)
def _(v):
    active = v.legal_entities().where("status = 'ACTIVE'")
    return joins.orphans(v.legal_documents().select("document_id", "entity_id"), active, "entity_id", "entity_id")


@query(
    "document_entity_resolve",
    """SELECT d.document_id, d.jurisdiction, e.entity_id FROM v_legal_documents d
       LEFT JOIN v_legal_entities e ON e.tax_id = 'TAX-' || (d.document_id % 200)::VARCHAR AND e.jurisdiction = d.jurisdiction""",
)
def _(v):
    docs = v.legal_documents().select("document_id", "jurisdiction", "entity_tax_id", "entity_id")
    return joins.resolve_entity(docs, v.legal_entities()).select("document_id", "jurisdiction", "entity_id")


# --- Gold ---------------------------------------------------------------------------

MV_SQL = f"""SELECT c.external_id AS counterparty_external_id, c.name AS counterparty_name, c.country_code, {MONTH} AS month,
               t.currency, count(*) AS transaction_count, {_money('sum(t.amount)')} AS total_amount,
               {sql_mean('sum(t.amount)', 'count(*)')} AS avg_amount
        FROM v_transactions t JOIN v_counterparties c USING (counterparty_id) WHERE {REVENUE} GROUP BY ALL"""


def monthly_revenue(v):
    return gold.monthly_revenue(v.transactions(), v.counterparties(), v.parts("lineitem"))


@query("mv_monthly_revenue", MV_SQL)
def _(v):
    return monthly_revenue(v)


@query(
    "mv_monthly_revenue_scd2",
    f"""SELECT d.external_id AS counterparty_external_id, d.name AS counterparty_name, d.country_code, {MONTH} AS month,
               t.currency, count(*) AS transaction_count, {_money('sum(t.amount)')} AS total_amount,
               {sql_mean('sum(t.amount)', 'count(*)')} AS avg_amount,
               {_money('min(t.amount)')} AS min_amount, {_money('max(t.amount)')} AS max_amount
        FROM (SELECT *, {sql_external_id('counterparty_id')} AS external_id FROM v_transactions) t
        JOIN v_dim_counterparty_named d ON d.external_id = t.external_id
             AND t.transaction_date BETWEEN d.valid_from AND d.valid_to
        WHERE {REVENUE} GROUP BY ALL""",
)
def _(v):
    return gold.monthly_revenue_asof(v.transactions(), v.counterparties(), v.dim_counterparty_named(), v.parts("lineitem"))


@query(
    "mv_active_regulations",
    """SELECT r.jurisdiction, r.category, count(DISTINCT r.regulation_id) AS regulation_count,
              count(DISTINCT d.entity_id) FILTER (WHERE d.document_id IS NOT NULL) AS affected_entities
       FROM v_regulations r
       LEFT JOIN v_legal_documents d ON d.jurisdiction = r.jurisdiction AND d.regulation_code = r.code
       WHERE r.effective_from <= DATE '2003-01-01' AND (r.effective_to IS NULL OR r.effective_to >= DATE '2003-01-01')
       GROUP BY 1, 2""",
)
def _(v):
    return gold.active_regulations(v.regulations(), v.legal_documents(), REGULATIONS_AS_OF)


GOLD_SQL = f"""SELECT counterparty_id, c.name AS counterparty_name, c.country_code, {ORIGIN_SQL} AS source_origin,
               {MONTH} AS month, t.currency, count(*) AS transaction_count, {_money('sum(t.amount)')} AS total_amount,
               {sql_mean('sum(t.amount)', 'count(*)')} AS avg_amount,
               {_money('min(t.amount)')} AS min_amount, {_money('max(t.amount)')} AS max_amount,
               {_money("sum(t.amount) FILTER (WHERE t.transaction_type = 'INVOICE')")} AS invoiced_amount,
               {_money("sum(t.amount) FILTER (WHERE t.transaction_type = 'PAYMENT')")} AS paid_amount,
               {_money("sum(t.amount) FILTER (WHERE t.transaction_type = 'REFUND')")} AS refunded_amount
        FROM v_transactions t JOIN v_counterparties c USING (counterparty_id)
        WHERE {REVENUE} AND t.amount <> 0 GROUP BY ALL"""


def gold_revenue(v):
    return gold.gold_monthly_revenue(
        staging.stg_transactions(v.transactions(heavy=True)), staging.stg_counterparties(v.counterparties()), v.parts("lineitem")
    )


@query("gold_monthly_revenue", GOLD_SQL)
def _(v):
    return gold_revenue(v)


@query(
    "gold_risk_distribution",
    f"""SELECT upper(country_code) AS country_code, {ORIGIN_SQL} AS source_origin, {TIER_SQL} AS risk_tier,
               count(*) AS counterparty_count, {sql_mean('sum(risk_score)', 'count(risk_score)')} AS avg_risk_score,
               min(risk_score) AS min_risk_score, max(risk_score) AS max_risk_score
        FROM v_counterparties GROUP BY ALL""",
)
def _(v):
    return gold.gold_risk_distribution(staging.stg_counterparties(v.counterparties()))


@query(
    "gold_docs_by_jurisdiction",
    """SELECT jurisdiction, document_type, CAST(date_trunc('month', document_date) AS DATE) AS document_month,
              count(*) AS documents, count(*) FILTER (WHERE source_system = 'sec_edgar') AS sec_edgar_documents,
              count(DISTINCT source_system) AS distinct_sources
       FROM v_legal_documents GROUP BY ALL""",
)
def _(v):
    return gold.gold_documents_by_jurisdiction(staging.stg_legal_documents(v.legal_documents()))


# --- reports --------------------------------------------------------------------------


@query(
    "overview",
    """SELECT count(*) AS total_documents, count(DISTINCT source_system) AS distinct_sources,
              count(DISTINCT document_type) AS distinct_types, count(DISTINCT jurisdiction) AS distinct_jurisdictions,
              strftime(min(ingested_at), '%Y-%m-%d %H:%M:%S') AS first_ingest,
              strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S') AS last_ingest
       FROM v_legal_documents""",
)
def _(v):
    out = reports.overview(v.legal_documents())
    for c in ("first_ingest", "last_ingest"):
        out = out.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return out


@query(
    "distribution_by_type",
    "SELECT document_type AS label, count(*) AS value FROM v_legal_documents GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _(v):
    return reports.distribution(v.legal_documents(), "document_type")


@query(
    "distribution_by_jurisdiction",
    "SELECT jurisdiction AS label, count(*) AS value FROM v_legal_documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(v):
    return reports.distribution(v.legal_documents(), "jurisdiction", 10)


@query(
    "distribution_by_source",
    "SELECT source_system AS label, count(*) AS value FROM v_legal_documents GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _(v):
    return reports.distribution(v.legal_documents(), "source_system")


@query(
    "volume_by_source_type",
    """SELECT source_system, document_type, count(*) AS documents, min(document_date) AS earliest, max(document_date) AS latest
       FROM v_legal_documents GROUP BY 1, 2""",
)
def _(v):
    return reports.volume_by_source_type(v.legal_documents())


@query(
    "origin_counts",
    """SELECT CASE WHEN external_id LIKE 'LEI-%' THEN 'GLEIF' WHEN external_id LIKE 'CP-%' THEN 'seed' ELSE 'other' END
              AS origin, country_code, count(*) AS counterparties, count(*) FILTER (WHERE tax_id IS NOT NULL) AS with_tax_id
       FROM v_counterparties GROUP BY 1, 2 ORDER BY counterparties DESC, origin, country_code LIMIT 15""",
)
def _(v):
    return reports.origin_counts(v.counterparties())


@query(
    "top_counterparties",
    f"""SELECT counterparty_id, {_money('sum(amount)')} AS revenue FROM v_transactions
        WHERE transaction_date >= DATE '2001-06-30' - 90 AND transaction_type = 'INVOICE'
        GROUP BY 1 ORDER BY revenue DESC, counterparty_id LIMIT 20""",
)
def _(v):
    return reports.top_counterparties(v.transactions(), AS_OF)


@query(
    "top_counterparties_named",
    f"""SELECT counterparty_id, c.name, c.country_code, count(*) AS txn_count, {_money('sum(amount)')} AS revenue
        FROM v_transactions t JOIN v_counterparties c USING (counterparty_id)
        WHERE transaction_date >= DATE '2001-06-30' - 90 AND transaction_type = 'INVOICE'
        GROUP BY ALL ORDER BY revenue DESC, counterparty_id LIMIT 10""",
)
def _(v):
    return reports.top_counterparties_named(v.transactions(), v.counterparties(), AS_OF)


@query(
    "revenue_rollup_by_month",
    f"""SELECT month, count(DISTINCT counterparty_external_id) AS counterparties,
               CAST(sum(transaction_count) AS BIGINT) AS total_txns, {_money('sum(total_amount)')} AS total_revenue
        FROM ({MV_SQL}) WHERE currency = 'USD' GROUP BY month ORDER BY month DESC LIMIT 12""",
)
def _(v):
    return reports.revenue_rollup(monthly_revenue(v), "USD")


@query(
    "revenue_by_month",
    f"SELECT month, {_money('sum(total_amount)')} AS revenue FROM ({MV_SQL}) GROUP BY month ORDER BY month DESC LIMIT 12",
)
def _(v):
    return reports.revenue_by_month(monthly_revenue(v))


@query(
    "monthly_revenue_scan",
    f"""SELECT month, {_money('sum(total_amount)')} AS revenue FROM ({MV_SQL}) WHERE currency = 'EUR'
        GROUP BY month ORDER BY month DESC LIMIT 12""",
)
def _(v):
    return reports.revenue_by_month(monthly_revenue(v), currency="EUR")


@query(
    "filings_by_type",
    """SELECT document_type, count(*) AS filings FROM v_legal_documents WHERE source_system = 'sec_edgar'
       GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def _(v):
    return reports.filings_by_type(v.legal_documents())


@query(
    "count_recent",
    "SELECT count(*) AS n FROM v_transaction_lines WHERE transaction_date >= DATE '2001-06-30' - 30",
)
def _(v):
    return reports.count_recent(v.transaction_lines(), AS_OF)


@query(
    "partition_inventory",
    """SELECT strftime(transaction_date, '%Y_%m') AS partition, count(*) AS rows, true AS has_bytes
       FROM v_transaction_lines GROUP BY 1""",
)
def _(v):
    out = new_dir(v.spark, "months")
    rows = partitions.with_month(
        v.transaction_lines().select("transaction_date", "reference", "amount"), "transaction_date"
    )
    keyed.write_partitioned(rows, out, "month", sort=["transaction_date"])
    stored = v.spark.read.parquet(out)
    return partitions.inventory(stored).select("partition", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "latency_percentiles",
    """SELECT stage, n, (list_sort(l)[(n + 1) // 2] + list_sort(l)[n // 2 + 1]) / 2 AS p50,
              list_sort(l)[greatest(CAST(floor(n * 0.95::DOUBLE) AS BIGINT), 1)] AS p95,
              list_sort(l)[greatest(CAST(floor(n * 0.99::DOUBLE) AS BIGINT), 1)] AS p99,
              list_min(l) AS min_value, list_max(l) AS max_value
       FROM (SELECT stage, count(*) AS n, list(duration) AS l FROM v_audit WHERE duration IS NOT NULL GROUP BY 1)""",
)
def _(v):
    return latency_percentiles(v.audit(), "stage", "duration")


@query(
    "load_ratio",
    """SELECT CAST(sum(extracted) AS BIGINT) AS extracted, CAST(sum(loaded) AS BIGINT) AS loaded,
              round(sum(loaded) / greatest(sum(extracted), 1), 6) AS load_ratio FROM v_audit""",
)
def _(v):
    return reports.load_ratio(v.audit())


@query(
    "gold_refresh",
    f"""SELECT 2 AS version, counterparty_id, month, currency, transaction_count, total_amount FROM ({GOLD_SQL})""",
)
def _(v):
    root = new_dir(v.spark, "gold-revenue")
    partitions.publish(gold_revenue(v).where("currency = 'USD'"), root)
    partitions.publish(gold_revenue(v), root)
    current = partitions.read_current(v.spark, root)
    return current.select(
        F.lit(partitions.current_version(v.spark, root)).alias("version"),
        "counterparty_id",
        "month",
        "currency",
        "transaction_count",
        "total_amount",
    )
