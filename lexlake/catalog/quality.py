"""Registered table rules, expectations, data tests and drift."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lexlake.catalog.registry import query
from lexlake.catalog.reporting import GOLD_SQL, gold_revenue
from lexlake.operators import dq, joins
from lexlake.operators import expectations as ex
from lexlake.operators.dq import Rule
from lexlake.plans import gold, staging

# the feed as it is landed, so that rules have something to find
RAW = "v_raw_transactions"


def raw(v):
    return v.raw_transactions()


def _one(name: str, rule: Rule, failed_sql: str):
    """A single rule over the raw transactions and its count in SQL."""

    @query(
        name,
        f"""SELECT '{rule.name}' AS rule, '{rule.severity}' AS severity, f = 0 AS passed, CAST(f AS BIGINT) AS failed_count
            FROM (SELECT {failed_sql} AS f FROM {RAW})""",
    )
    def build(v):
        return dq.run_suite(raw(v), [rule]).select("rule", "severity", "passed", "failed_count")

    return build


_one("dq_not_null", Rule("currency_present", "not_null", "currency"), "count(*) FILTER (WHERE currency IS NULL)")
_one("dq_unique", Rule("reference_unique", "unique", "reference"), "count(*) - count(DISTINCT reference)")
_one(
    "dq_regex",
    Rule("currency_is_iso_3", "regex", "currency", {"pattern": "^[A-Z]{3}$"}),
    "count(*) FILTER (WHERE NOT regexp_full_match(currency, '[A-Z]{3}'))",
)
_one(
    "dq_in_set",
    Rule("type_known", "in_set", "transaction_type", {"values": ["INVOICE", "PAYMENT", "REFUND"]}, "warning"),
    "count(*) FILTER (WHERE transaction_type IS NULL OR transaction_type NOT IN ('INVOICE','PAYMENT','REFUND'))",
)
_one("dq_row_count", Rule("some_rows", "row_count_range", None, {"min": 1, "max": 50}), "CAST(count(*) > 50 OR count(*) < 1 AS INTEGER)")
_one(
    "dq_expression",
    Rule("dated", "expression", None, {"expr": "transaction_date <> 'not-a-date'"}),
    "count(*) FILTER (WHERE NOT (transaction_date <> 'not-a-date'))",
)


@query(
    "dq_unique_with_nulls",
    """SELECT 'tax_id_unique' AS rule, count(*) - count(DISTINCT tax_id) - max(CAST(tax_id IS NULL AS INTEGER)) AS failed_count
       FROM v_counterparties""",
)
def _(v):
    rule = Rule("tax_id_unique", "unique", "tax_id")
    return dq.run_suite(v.counterparties(), [rule]).select("rule", "failed_count")


@query(
    "dq_in_set_with_nulls",
    """SELECT 'tier_listed' AS rule,
              count(*) FILTER (WHERE tax_id IS NULL OR tax_id NOT IN ('TAX-1', 'TAX-2')) AS failed_count FROM v_counterparties""",
)
def _(v):
    rule = Rule("tier_listed", "in_set", "tax_id", {"values": ["TAX-1", "TAX-2"]})
    return dq.run_suite(v.counterparties(), [rule]).select("rule", "failed_count")


@query(
    "dq_range",
    """SELECT 'score_range' AS rule, count(*) FILTER (WHERE risk_score < 10 OR risk_score > 90) AS failed_count
       FROM v_counterparties""",
)
def _(v):
    rule = Rule("score_range", "range", "risk_score", {"min": 10, "max": 90})
    return dq.run_suite(v.counterparties(), [rule]).select("rule", "failed_count")


SUITE_SQL = """
    WITH t AS (SELECT * FROM v_transaction_lines),
    f AS (SELECT * FROM (
        SELECT 1 AS o, 'transaction_reference_not_null' AS rule, 'not_null' AS type, 'error' AS severity,
               count(*) FILTER (WHERE reference IS NULL) AS f FROM t
        UNION ALL SELECT 2, 'transaction_reference_unique', 'unique', 'error', count(*) - count(DISTINCT reference) FROM t
        UNION ALL SELECT 3, 'amount_not_null', 'not_null', 'error', count(*) FILTER (WHERE amount IS NULL) FROM t
        UNION ALL SELECT 4, 'amount_within_reasonable_range', 'range', 'error',
               count(*) FILTER (WHERE amount < -1000000000 OR amount > 1000000000) FROM t
        UNION ALL SELECT 5, 'currency_is_iso_3', 'regex', 'error',
               count(*) FILTER (WHERE NOT regexp_full_match(currency, '[A-Z]{3}')) FROM t
        UNION ALL SELECT 6, 'transaction_type_known', 'in_set', 'warning', count(*) FILTER (WHERE transaction_type NOT IN
               ('INVOICE','PAYMENT','REFUND','ADJUSTMENT','CHARGEBACK','FEE')) FROM t
        UNION ALL SELECT 7, 'batch_not_empty', 'row_count_range', 'error',
               CAST(count(*) < 1 AS INTEGER) FROM t))"""


@query("dq_suite", f"{SUITE_SQL} SELECT 'transactions' AS suite, rule, type, severity, f = 0 AS passed, f AS failed_count FROM f")
def _(v):
    return dq.run_suite(v.transaction_lines(), dq.builtin_rules("transactions"), "transactions").select(
        "suite", "rule", "type", "severity", "passed", "failed_count"
    )


@query(
    "dq_suite_documents",
    """SELECT rule, f = 0 AS passed, CAST(f AS BIGINT) AS failed_count FROM (
         SELECT 'document_id_not_null' AS rule, count(*) FILTER (WHERE source_id IS NULL) AS f FROM v_legal_documents
         UNION ALL SELECT 'document_hash_not_null', count(*) FILTER (WHERE source_hash IS NULL) FROM v_legal_documents
         UNION ALL SELECT 'document_hash_is_sha256', count(*) FILTER (WHERE NOT regexp_full_match(source_hash, '[a-f0-9]{64}'))
                   FROM v_legal_documents
         UNION ALL SELECT 'document_type_in_taxonomy', count(*) FILTER (WHERE document_type NOT IN
                   ('JUDGMENT','REGULATION','CONTRACT','NOTICE','FILING','DECREE')) FROM v_legal_documents
         UNION ALL SELECT 'document_title_not_null', count(*) FILTER (WHERE title IS NULL) FROM v_legal_documents
         UNION ALL SELECT 'jurisdiction_not_null', count(*) FILTER (WHERE jurisdiction IS NULL) FROM v_legal_documents
         UNION ALL SELECT 'row_count_reasonable', CAST(count(*) < 1 AS INTEGER) FROM v_legal_documents)""",
)
def _(v):
    return dq.run_suite(v.legal_documents(), dq.builtin_rules("legal_documents")).select("rule", "passed", "failed_count")


@query(
    "dq_failure_samples",
    f"""SELECT 'currency_is_iso_3' AS rule, currency AS value FROM (SELECT currency FROM {RAW}
           WHERE NOT regexp_full_match(currency, '[A-Z]{{3}}') ORDER BY currency LIMIT 5)
        UNION ALL SELECT 'transaction_type_known', transaction_type FROM (SELECT transaction_type FROM {RAW}
           WHERE transaction_type NOT IN ('INVOICE','PAYMENT','REFUND','ADJUSTMENT','CHARGEBACK','FEE')
           ORDER BY transaction_type LIMIT 5)""",
)
def _(v):
    return dq.failure_samples(raw(v), dq.builtin_rules("transactions"))


@query(
    "dq_gate",
    f"""{SUITE_SQL} SELECT count(*) FILTER (WHERE f > 0 AND severity = 'error') AS blocking,
             CASE WHEN count(*) FILTER (WHERE f > 0 AND severity = 'error') = 0 THEN (SELECT count(*) FROM t) ELSE 0 END AS passed_rows
        FROM f""",
)
def _(v):
    """Upload mode: rows of a batch with a blocking failure are held back."""
    results = dq.run_suite(v.transaction_lines(), dq.builtin_rules("transactions"), "transactions")
    kept = dq.gate(results, v.transaction_lines(), on_error="drop")
    blocking = results.where("NOT passed AND severity = 'error'").count()
    return kept.agg(F.count(F.lit(1)).alias("passed_rows")).select(
        F.lit(blocking).cast("bigint").alias("blocking"), "passed_rows"
    )


@query(
    "dq_summary",
    f"""{SUITE_SQL} SELECT 'transactions' AS suite, count(*) AS total, count(*) FILTER (WHERE f = 0) AS passed,
            count(*) FILTER (WHERE f > 0 AND severity = 'error') AS blocking,
            count(*) FILTER (WHERE f > 0 AND severity <> 'error') AS warnings FROM f""",
)
def _(v):
    return dq.summarize(dq.run_suite(v.transaction_lines(), dq.builtin_rules("transactions"), "transactions"))


# --- expectations -------------------------------------------------------------------

EXPECTED = {
    "amount": [
        {"type": "expect_column_values_to_not_be_null"},
        {"type": "expect_column_values_to_be_between", "kwargs": {"min_value": -50000, "max_value": 90000}},
    ],
    "currency": [{"type": "expect_column_values_to_be_in_set", "kwargs": {"value_set": ["USD", "EUR", "GBP"]}}],
    "reference": [{"type": "expect_column_values_to_be_unique"}],
}


@query(
    "expect_suite",
    """WITH t AS (SELECT amount, currency, reference FROM v_transaction_lines)
       SELECT 'amount' AS "column", 'expect_column_values_to_not_be_null' AS expectation, 0 AS position,
              count(*) FILTER (WHERE amount IS NULL) = 0 AS success FROM t HAVING count(*) > 0
       UNION ALL SELECT 'amount', 'expect_column_values_to_be_between', 1,
              count(*) FILTER (WHERE amount < -50000 OR amount > 90000) = 0 FROM t HAVING count(*) > 0
       UNION ALL SELECT 'currency', 'expect_column_values_to_be_in_set', 2,
              count(*) FILTER (WHERE currency NOT IN ('USD','EUR','GBP')) = 0 FROM t HAVING count(*) > 0
       UNION ALL SELECT 'reference', 'expect_column_values_to_be_unique', 3,
              count(reference) = count(DISTINCT reference) FROM t HAVING count(*) > 0""",
)
def _(v):
    """The suite as evaluated: expectations in order, each with its verdict."""
    suite = ex.build_suite(EXPECTED)
    order = {e.type: i for i, e in enumerate(suite)}
    done = ex.validate(v.transaction_lines(), suite)
    index = F.create_map(*[F.lit(x) for p in order.items() for x in p])
    return done.select("column", "expectation", index[F.col("expectation")].alias("position"), "success")


def _sql_divergence(column: str, bin_of: str, bins: str) -> str:
    """KL divergence of the rows since the cut from those before, one smoothed count a bin."""
    return f"""SELECT '{column}' AS "column", round(sum(p / pn * ln((p / pn) / (q / qn))), 6) AS observed_value,
                      sum(p / pn * ln((p / pn) / (q / qn))) <= 0.001 AS success
               FROM (SELECT *, sum(p) OVER () AS pn, sum(q) OVER () AS qn FROM (
                 SELECT count(t.late) FILTER (WHERE late) + 1.0::DOUBLE AS p, count(t.late) FILTER (WHERE NOT late) + 1.0::DOUBLE AS q
                 FROM ({bins}) AS b(bin) LEFT JOIN t ON {bin_of} = b.bin GROUP BY b.bin))"""


@query(
    "expect_drift",
    "WITH t AS (SELECT amount, currency, transaction_date >= DATE '1998-01-01' AS late FROM v_transaction_lines), "
    "k AS (SELECT DISTINCT currency FROM t WHERE NOT late AND currency IS NOT NULL) "
    + _sql_divergence(
        "amount",
        "CASE WHEN amount < 10000 THEN 0 WHEN amount < 40000 THEN 1 WHEN amount >= 40000 THEN 2 ELSE 3 END",
        "SELECT * FROM range(4)",
    )
    + " UNION ALL "
    + _sql_divergence(
        "currency",
        "CASE WHEN currency IS NULL THEN '-' WHEN currency IN (SELECT currency FROM k) THEN currency ELSE '+' END",
        "SELECT currency FROM k UNION ALL SELECT '-' UNION ALL SELECT '+'",
    ),
)
def _(v):
    """Drift since a date as expectations, of a number and of a label."""
    rows, cut = v.transaction_lines(), F.lit(dt.date(1998, 1, 1))
    before = rows.where(F.col("transaction_date") < cut)
    suite = [ex.drift_expectation(before, "amount", 0.001, edges=[10000, 40000]), ex.drift_expectation(before, "currency", 0.001)]
    return ex.validate(rows.where(F.col("transaction_date") >= cut), suite).select("column", "observed_value", "success")


@query(
    "expect_validate",
    """WITH t AS (SELECT amount, currency, reference FROM v_transaction_lines),
       d AS (SELECT reference, count(*) AS n FROM t GROUP BY 1),
       r AS (SELECT * FROM (
         SELECT 'expect_column_values_to_not_be_null' AS expectation, 'amount' AS "column", count(*) AS element_count,
                count(*) FILTER (WHERE amount IS NULL) AS missing_count, count(*) FILTER (WHERE amount IS NULL) AS unexpected_count FROM t
         UNION ALL SELECT 'expect_column_values_to_be_between', 'amount', count(*), count(*) FILTER (WHERE amount IS NULL),
                count(*) FILTER (WHERE amount < -50000 OR amount > 90000) FROM t
         UNION ALL SELECT 'expect_column_values_to_be_in_set', 'currency', count(*), count(*) FILTER (WHERE currency IS NULL),
                count(*) FILTER (WHERE currency NOT IN ('USD','EUR','GBP')) FROM t
         UNION ALL SELECT 'expect_column_values_to_be_unique', 'reference', CAST(sum(n) AS BIGINT), 0,
                CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) FROM d))
       SELECT *, unexpected_count = 0 AS success, round(unexpected_count * 100.0::DOUBLE / element_count, 6) AS unexpected_percent FROM r""",
)
def _(v):
    return ex.validate(v.transaction_lines(), ex.build_suite(EXPECTED)).drop("observed_value")


@query(
    "expect_column_stats",
    """SELECT currency, count(*) AS n, count(*) FILTER (WHERE amount IS NULL) AS nulls,
              count(DISTINCT amount) AS distinct_values, min(amount) AS min_value, max(amount) AS max_value,
              round(CAST(sum(amount) AS DOUBLE) / count(amount), 6) AS mean_value
       FROM v_transaction_lines GROUP BY 1""",
)
def _(v):
    return ex.column_stats(v.transaction_lines(), "amount", "currency")


@query(
    "expect_mean_between",
    """SELECT 'expect_column_mean_to_be_between' AS expectation, round(avg(CAST(risk_score AS DOUBLE)), 6) AS observed_value,
              avg(risk_score) BETWEEN 40 AND 60 AS success FROM v_counterparties
       UNION ALL SELECT 'expect_column_proportion_of_unique_values_to_be_between',
              round(count(DISTINCT tax_id)::DOUBLE / count(tax_id), 6), count(DISTINCT tax_id)::DOUBLE / count(tax_id) >= 0.9
       FROM v_counterparties
       UNION ALL SELECT 'expect_table_row_count_to_be_between', count(*), count(*) <= 100 FROM v_counterparties""",
)
def _(v):
    suite = ex.build_suite(
        {
            "risk_score": [{"type": "expect_column_mean_to_be_between", "kwargs": {"min_value": 40, "max_value": 60}}],
            "tax_id": [
                {
                    "type": "expect_column_proportion_of_unique_values_to_be_between",
                    "kwargs": {"min_value": 0.9},
                },
                {"type": "expect_table_row_count_to_be_between", "kwargs": {"max_value": 100}},
            ],
        }
    )
    return ex.validate(v.counterparties(), suite).select("expectation", "observed_value", "success")


@query(
    "distribution_drift",
    """WITH c AS (SELECT event_type AS v, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS p,
                         count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS q FROM events GROUP BY 1),
            s AS (SELECT count(*) AS k, sum(p) AS pn, sum(q) AS qn FROM c)
       SELECT k AS distinct_values, CAST(qn AS BIGINT) AS reference_rows, CAST(pn AS BIGINT) AS current_rows,
              round((SELECT sum((p + 1.0::DOUBLE) * (ln(p + 1.0::DOUBLE) - ln(q + 1.0::DOUBLE))) FROM c) / (pn + k)
                    + ln((qn + k)::DOUBLE) - ln((pn + k)::DOUBLE), 6) AS kl_divergence FROM s""",
)
def _(v):
    events = v.table("events").select("event_type", "ts")
    cut = F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    return ex.drift(events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut), "event_type")


@query("column_profile")
def _(v):
    """Sketch based, so there is no exact SQL twin; the exact parts are checked by
    expect_column_stats and by tests."""
    return ex.profile(v.transaction_lines(), ["transaction_date", "amount", "currency", "transaction_type", "reference"])


@query(
    "column_profile_exact_parts",
    """SELECT 'amount' AS "column", count(*) AS rows, count(*) FILTER (WHERE amount IS NULL) AS nulls,
              min(amount)::VARCHAR AS min_value, max(amount)::VARCHAR AS max_value FROM v_transaction_lines
       UNION ALL SELECT 'currency', count(*), count(*) FILTER (WHERE currency IS NULL), min(currency), max(currency) FROM v_transaction_lines
       UNION ALL SELECT 'transaction_date', count(*), count(*) FILTER (WHERE transaction_date IS NULL),
              min(transaction_date)::VARCHAR, max(transaction_date)::VARCHAR FROM v_transaction_lines""",
)
def _(v):
    out = ex.profile(v.transaction_lines(), ["amount", "currency", "transaction_date"])
    return out.select("column", "rows", "nulls", "min_value", "max_value")


# --- data tests on sources and Gold ---------------------------------------------------


@query(
    "test_not_null_unique",
    """SELECT rule, f AS failed_count FROM (
         SELECT 'transactions.transaction_date' AS rule, count(*) FILTER (WHERE transaction_date IS NULL) AS f FROM v_transaction_lines
         UNION ALL SELECT 'transactions.reference', count(*) FILTER (WHERE reference IS NULL) FROM v_transaction_lines
         UNION ALL SELECT 'transactions.id', count(*) FILTER (WHERE transaction_id IS NULL) FROM v_transaction_lines
         UNION ALL SELECT 'counterparties.external_id', count(*) FILTER (WHERE external_id IS NULL) FROM v_counterparties
         UNION ALL SELECT 'counterparties.external_id.unique', count(*) - count(DISTINCT external_id) FROM v_counterparties
         UNION ALL SELECT 'legal_documents.source_hash', count(*) FILTER (WHERE source_hash IS NULL) FROM v_legal_documents)""",
)
def _(v):
    txn = [
        Rule("transactions.id", "not_null", "transaction_id"),
        Rule("transactions.transaction_date", "not_null", "transaction_date"),
        Rule("transactions.reference", "not_null", "reference"),
    ]
    cp = [
        Rule("counterparties.external_id", "not_null", "external_id"),
        Rule("counterparties.external_id.unique", "unique", "external_id"),
    ]
    docs = [Rule("legal_documents.source_hash", "not_null", "source_hash")]
    out = dq.run_suite(v.transaction_lines(), txn).unionByName(dq.run_suite(v.counterparties(), cp))
    return out.unionByName(dq.run_suite(v.legal_documents(), docs)).select("rule", "failed_count")


@query(
    "test_accepted_values",
    """SELECT risk_tier AS value, count(*) AS n FROM (SELECT DISTINCT upper(country_code) AS c, left(external_id, 1) AS o,
              CASE WHEN risk_score IS NULL THEN 'UNKNOWN' WHEN risk_score < 25 THEN 'LOW'
                   WHEN risk_score < 50 THEN 'MODERATE' WHEN risk_score < 75 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_tier
              FROM v_counterparties) WHERE risk_tier NOT IN ('LOW', 'MODERATE', 'HIGH') GROUP BY 1""",
)
def _(v):
    dist = gold.gold_risk_distribution(staging.stg_counterparties(v.counterparties()))
    # two tiers are left off the list, so the test has findings
    return dq.accepted_values(dist, "risk_tier", ["LOW", "MODERATE", "HIGH"])


@query(
    "test_expression_true",
    f"""WITH g AS ({GOLD_SQL}) SELECT 'currency_length' AS rule, 'warning' AS severity,
              count(*) FILTER (WHERE NOT length(currency) = 3) AS failed_count FROM g
        UNION ALL SELECT 'country_length', 'error', count(*) FILTER (WHERE NOT length(country_code) = 2) FROM g
        UNION ALL SELECT 'has_rows', 'error', count(*) FILTER (WHERE NOT transaction_count > 1) FROM g""",
)
def _(v):
    rules = [
        Rule("currency_length", "expression", None, {"expr": "length(currency) = 3"}, "warning"),
        Rule("country_length", "expression", None, {"expr": "length(country_code) = 2"}),
        Rule("has_rows", "expression", None, {"expr": "transaction_count > 1"}),
    ]
    return dq.run_suite(gold_revenue(v), rules).select("rule", "severity", "failed_count")


@query(
    "test_unique_combination",
    f"SELECT counterparty_id, month, count(*) AS n FROM ({GOLD_SQL}) GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(v):
    # the shorter key without currency is the one that does not hold
    return dq.unique_combination(gold_revenue(v), "counterparty_id", "month")


@query(
    "test_freshness",
    """SELECT 'transactions' AS "table", CAST(epoch(TIMESTAMP '2001-06-30 12:00:00') - epoch(max(ingested_at)) AS BIGINT) AS age_seconds,
              CASE WHEN epoch(TIMESTAMP '2001-06-30 12:00:00') - epoch(max(ingested_at)) > 86400 THEN 'error'
                   WHEN epoch(TIMESTAMP '2001-06-30 12:00:00') - epoch(max(ingested_at)) > 43200 THEN 'warn' ELSE 'ok' END AS status
       FROM v_transaction_lines
       UNION ALL SELECT 'legal_documents', CAST(epoch(TIMESTAMP '2026-06-30 12:00:00') - epoch(max(ingested_at)) AS BIGINT), 'error'
       FROM v_legal_documents""",
)
def _(v):
    at = lambda *a: F.lit(dt.datetime(*a)).cast("timestamp_ntz")
    txn = dq.freshness(v.transaction_lines(), "ingested_at", at(2001, 6, 30, 12))
    docs = dq.freshness(v.legal_documents(), "ingested_at", at(2026, 6, 30, 12))
    return txn.select(F.lit("transactions").alias("table"), "*").unionByName(
        docs.select(F.lit("legal_documents").alias("table"), "*")
    )


@query(
    "constraint_checks",
    """SELECT 'amount_not_zero' AS check_name, count(*) FILTER (WHERE amount = 0) AS violations FROM v_transaction_lines
       UNION ALL SELECT 'risk_score_range', count(*) FILTER (WHERE risk_score < 0 OR risk_score > 100) FROM v_counterparties
       UNION ALL SELECT 'total_value_not_negative', count(*) FILTER (WHERE total_value < 0) FROM v_contracts
       UNION ALL SELECT 'end_not_before_start', count(*) FILTER (WHERE end_date < start_date) FROM v_contracts
       UNION ALL SELECT 'regulation_range', count(*) FILTER (WHERE effective_to < effective_from) FROM v_regulations
       UNION ALL SELECT 'fk_contract_counterparty', count(*) FROM v_contracts c
            WHERE NOT EXISTS (SELECT 1 FROM v_counterparties p WHERE p.counterparty_id = c.counterparty_id)
       UNION ALL SELECT 'unique_transaction_key', count(*) FROM (SELECT 1 FROM v_transaction_lines
            GROUP BY source_system, reference, transaction_date HAVING count(*) > 1)""",
)
def _(v):
    contracts = v.contracts()
    rows = joins.constraint_report(
        {
            "amount_not_zero": (v.transaction_lines(), F.col("amount") != 0),
            "risk_score_range": (v.counterparties(), F.col("risk_score").between(0, 100)),
            "total_value_not_negative": (contracts, F.col("total_value") >= 0),
            "end_not_before_start": (contracts, F.col("end_date") >= F.col("start_date")),
            "regulation_range": (v.regulations(), F.col("effective_to") >= F.col("effective_from")),
        }
    )
    fk = joins.orphans(contracts, v.counterparties(), "counterparty_id", "counterparty_id")
    uniq = dq.unique_combination(v.transaction_lines(), "source_system", "reference", "transaction_date")
    for name, df in (("fk_contract_counterparty", fk), ("unique_transaction_key", uniq)):
        rows = rows.unionByName(df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations"))
    return rows
