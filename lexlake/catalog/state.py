"""Registered state-changing operators. Each shows the state of a table after it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lexlake.catalog.projections import TXN_KEY
from lexlake.catalog.registry import query
from lexlake.catalog.views import text_of
from lexlake.operators import keyed, partitions, scd2, tables
from lexlake.workspace import new_dir

CUT = dt.date(2000, 1, 1)
OVERLAP = dt.date(1999, 7, 1)
LOADED = dt.datetime(2024, 6, 1)

_DEDUPED = """SELECT * EXCLUDE (rn) FROM (SELECT source_system, reference, transaction_date, amount, transaction_type, line_no,
         row_number() OVER (PARTITION BY source_system, reference, transaction_date ORDER BY amount DESC, line_no DESC) AS rn
         FROM v_transaction_lines) WHERE rn = 1"""
# first load up to CUT; then a batch from OVERLAP on with doubled amounts
UPSERT_SQL = f"""SELECT source_system, reference, transaction_date,
       CASE WHEN transaction_date >= DATE '1999-07-01' THEN CAST(amount * 2 AS DECIMAL(18,2)) ELSE amount END AS amount,
       CASE WHEN transaction_date < DATE '1999-07-01' THEN 'first'
            WHEN transaction_date < DATE '2000-01-01' THEN 'updated' ELSE 'inserted' END AS load
       FROM ({_DEDUPED})"""


def _deliveries(v):
    """The rows of the first load and of the batch, keys repeated as they come."""
    rows = v.transaction_lines(heavy=True).select(*TXN_KEY, "amount", "line_no")
    first = rows.where(F.col("transaction_date") < F.lit(CUT))
    batch = rows.where(F.col("transaction_date") >= F.lit(OVERLAP)).withColumn(
        "amount", (F.col("amount") * 2).cast("decimal(18,2)")
    )
    return first, batch


def _loads(v):
    first, batch = _deliveries(v)
    stamp = F.lit(dt.datetime(2024, 5, 1))
    target = keyed.latest_per_key(first, TXN_KEY, ["amount", "line_no"]).withColumns({"created_at": stamp, "updated_at": stamp})
    return target, batch


def _load_label():
    new = F.lit(LOADED)
    return (
        F.when(F.col("updated_at") < new, "first").when(F.col("created_at") < new, "updated").otherwise("inserted")
    ).alias("load")


@query("upsert", UPSERT_SQL)
def _(v):
    target, batch = _loads(v)
    merged = keyed.upsert(target, batch, TXN_KEY, ["amount", "line_no"], F.lit(LOADED))
    return merged.select(*TXN_KEY, "amount", _load_label())


@query("upsert_partitioned_table", UPSERT_SQL)
def _(v):
    """The same on a stored table with month partitions, with the batch applied
    twice: the second run changes nothing."""
    target, batch = _loads(v)
    path = new_dir(v.spark, "transactions")
    keyed.write_partitioned(partitions.with_month(target, "transaction_date"), path, "month", sort=["transaction_date"])
    batch = partitions.with_month(batch, "transaction_date")
    for _ in range(2):
        keyed.upsert_table(v.spark, path, batch, TXN_KEY, ["amount", "line_no"], "month", F.lit(LOADED))
    return v.spark.read.parquet(path).select(*TXN_KEY, "amount", _load_label())


@query(
    "idempotency_key",
    """SELECT source_system, source_id, sha256(source_system || '|' || source_id || '|' || document_date::VARCHAR) AS source_hash,
              CAST(count(DISTINCT document_date) AS BIGINT) AS copies FROM v_legal_documents GROUP BY source_system, source_id, document_date""",
)
def _(v):
    """One batch loaded twice by its key: every document is stored once."""
    docs = v.legal_documents().select("source_hash", "source_system", "source_id")
    once = keyed.upsert(docs.limit(0), docs, ["source_hash"], ["source_id"])
    twice = keyed.upsert(once, docs, ["source_hash"], ["source_id"])
    return twice.groupBy("source_system", "source_id", "source_hash").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "duplicate_keys_dropped",
    f"SELECT (SELECT count(*) FROM v_transaction_lines) - (SELECT count(*) FROM ({_DEDUPED})) AS dropped",
)
def _(v):
    return keyed.duplicate_count(v.transaction_lines(), TXN_KEY)


# history up to the cut, then one batch: the latest band of every key from the cut on
_HISTORY = """
    WITH daily AS (SELECT o_custkey, o_orderdate::DATE AS effective, arg_max(o_orderpriority, o_orderkey) AS band,
                          max(o_orderkey) AS seq FROM orders GROUP BY 1, 2),
    old AS (SELECT *, lag(band) OVER (PARTITION BY o_custkey ORDER BY effective) AS prev FROM daily
            WHERE effective < DATE '2000-01-01'),
    hist AS (SELECT o_custkey, band, effective AS valid_from,
                    coalesce(lead(effective) OVER w - 1, DATE '9999-12-31') AS valid_to, lead(effective) OVER w IS NULL AS is_current
             FROM old WHERE prev IS NULL OR prev <> band WINDOW w AS (PARTITION BY o_custkey ORDER BY effective)),
    batch AS (SELECT o_custkey, arg_max(band, effective) AS band, max(effective) AS effective FROM daily
              WHERE effective >= DATE '2000-01-01' GROUP BY 1),
    pairs AS (SELECT coalesce(h.o_custkey, b.o_custkey) AS k, h.band AS old_band, b.band AS new_band, b.effective, h.valid_from,
                     CASE WHEN b.o_custkey IS NULL THEN 'kept' WHEN h.o_custkey IS NULL THEN 'inserted'
                          WHEN h.band = b.band THEN 'unchanged' ELSE 'changed' END AS action
              FROM (SELECT * FROM hist WHERE is_current) h FULL JOIN batch b ON h.o_custkey = b.o_custkey)"""


def _dim_and_batch(v):
    feed = v.band_feed().drop("counterparty_id")
    cut = F.lit(CUT)
    dim = scd2.from_feed(feed.where(F.col("effective") < cut), "external_id", ["band"], "effective", ["seq"]).drop("seq")
    batch = feed.where(F.col("effective") >= cut)
    return dim, batch


@query(
    "scd2_apply",
    f"""{_HISTORY}
        SELECT ['LEI-', 'CP-', 'X-'][o_custkey % 3 + 1] || o_custkey::VARCHAR AS external_id, band, valid_from, valid_to, is_current
        FROM (SELECT h.o_custkey, h.band, h.valid_from,
                     CASE WHEN h.is_current AND p.action = 'changed' THEN p.effective - 1 ELSE h.valid_to END AS valid_to,
                     h.is_current AND p.action <> 'changed' AS is_current
              FROM hist h JOIN pairs p ON p.k = h.o_custkey
              UNION ALL SELECT k, new_band, effective, DATE '9999-12-31', true FROM pairs WHERE action IN ('inserted', 'changed'))""",
)
def _(v):
    dim, batch = _dim_and_batch(v)
    after = scd2.apply(dim, batch, "external_id", ["band"], ["effective", "seq"])
    return after.select("external_id", "band", "valid_from", "valid_to", "is_current")


@query(
    "scd2_counts",
    f"""{_HISTORY}
        SELECT count(*) FILTER (WHERE action IN ('inserted', 'changed')) AS inserted,
               count(*) FILTER (WHERE action = 'changed') AS expired,
               count(*) FILTER (WHERE action = 'unchanged') AS unchanged, 0::BIGINT AS replaced, 0::BIGINT AS late FROM pairs""",
)
def _(v):
    dim, batch = _dim_and_batch(v)
    return scd2.counts(scd2.classify(dim, batch, "external_id", ["band"], ["effective", "seq"]))


@query(
    "scd1_overwrite",
    """SELECT user_id, arg_max(event_type, (ts, event_id)) AS band FROM events GROUP BY 1""",
)
def _(v):
    feed = v.activity_feed().select("user_id", "band", "ts", "seq")
    cut = F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    old = keyed.latest_per_key(feed.where(F.col("ts") < cut), ["user_id"], ["ts", "seq"])
    return keyed.upsert(old, feed.where(F.col("ts") >= cut), ["user_id"], ["ts", "seq"]).select("user_id", "band")


@query(
    "month_partitioning",
    """SELECT partition, range_start, range_end, is_default, count(*) AS rows FROM (
         SELECT CASE WHEN transaction_date >= DATE '1996-01-01' AND transaction_date < DATE '2001-01-01'
                     THEN 'transactions_' || strftime(transaction_date, '%Y_%m') ELSE 'transactions_default' END AS partition,
                CASE WHEN transaction_date >= DATE '1996-01-01' AND transaction_date < DATE '2001-01-01'
                     THEN CAST(date_trunc('month', transaction_date) AS DATE) END AS range_start,
                CASE WHEN transaction_date >= DATE '1996-01-01' AND transaction_date < DATE '2001-01-01'
                     THEN CAST(date_trunc('month', transaction_date) + INTERVAL 1 MONTH AS DATE) END AS range_end,
                NOT (transaction_date >= DATE '1996-01-01' AND transaction_date < DATE '2001-01-01') AS is_default
         FROM v_transaction_lines) GROUP BY ALL""",
)
def _(v):
    named = partitions.assign_month(
        v.transaction_lines(), "transaction_date", "transactions", dt.date(1996, 1, 1), dt.date(2000, 12, 1)
    )
    return named.groupBy("partition", "range_start", "range_end", "is_default").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "retention",
    """SELECT strftime(transaction_date, '%Y_%m') AS month, count(*) AS rows FROM v_transaction_lines
       WHERE transaction_date >= DATE '1998-01-01' GROUP BY 1""",
)
def _(v):
    """A stored table by month; old months leave the version without being read."""
    rows = partitions.with_month(v.transaction_lines(), "transaction_date").select(*TXN_KEY, "amount", "month")
    root = new_dir(v.spark, "retention")
    tables.replace_partitions(v.spark, root, rows, "month", set())
    tables.drop_partitions(v.spark, root, lambda m: m is not None and m < "1998_01")
    return tables.read(v.spark, root).groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "staging_processed",
    """SELECT doc_id, 'b' || (doc_id % 8)::VARCHAR AS batch_id FROM documents
       WHERE 'b' || (doc_id % 8)::VARCHAR NOT IN (SELECT DISTINCT 'b' || (doc_id % 5)::VARCHAR FROM labels)""",
)
def _(v):
    staged = v.table("documents").select(
        "doc_id", F.concat(F.lit("b"), text_of(F.col("doc_id") % 8)).alias("batch_id")
    )
    done = v.table("labels").select(F.concat(F.lit("b"), text_of(F.col("doc_id") % 5)).alias("batch_id"))
    return keyed.unprocessed(staged, done).select("doc_id", "batch_id")
