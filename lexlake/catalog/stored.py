"""Registered flows over versioned tables. Each shows a table after several loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lexlake.catalog.projections import TXN_KEY
from lexlake.catalog.landing import MARK
from lexlake.catalog.registry import query
from lexlake.catalog.state import LOADED, UPSERT_SQL, _deliveries, _load_label
from lexlake.operators import partitions, summaries, tables
from lexlake.plans import incremental
from lexlake.streaming import arrival
from lexlake.workspace import new_dir


@query("upsert_versioned_table", UPSERT_SQL)
def _(v):
    """Two loads, the second twice, by partitions whose values look like numbers."""
    first, batch = _deliveries(v)
    root = new_dir(v.spark, "versioned")
    part = F.date_format("transaction_date", "MM")
    order = ["amount", "line_no"]
    tables.load(v.spark, root, first.withColumn("part", part), TXN_KEY, order, "part", F.lit(dt.datetime(2024, 5, 1)))
    for _ in range(2):
        tables.load(v.spark, root, batch.withColumn("part", part), TXN_KEY, order, "part", F.lit(LOADED))
    return tables.read(v.spark, root).select(*TXN_KEY, "amount", _load_label())


@query(
    "idempotent_load",
    """SELECT source_system, source_id, document_date, title, 1::BIGINT AS copies FROM v_legal_documents""",
)
def _(v):
    """Every document loaded twice, in two loads, under its key: one row of it is there."""
    docs = v.legal_documents().select("source_system", "source_id", "document_date", "title")
    root, keys = new_dir(v.spark, "idempotent"), ["source_system", "source_id", "document_date"]
    for _ in range(2):
        tables.load(v.spark, root, partitions.with_month(docs, "document_date"), keys, ["title"], "month")
    return tables.read(v.spark, root).groupBy(*keys, "title").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "incremental_flow",
    """SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
              (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events) AS mark FROM events""",
)
def _(v):
    """What a source holds up to a day, then all of it, then again: read beyond the stored mark."""
    events = partitions.with_month(v.table("events"), "ts")
    root = new_dir(v.spark, "incremental")
    early = events.where(F.col("ts") <= F.lit(MARK).cast("timestamp_ntz"))
    for source in (early, events, events):
        incremental.incremental_load(v.spark, source, root, "ts", ["event_id", "month"], ["ts"], "month", F.expr("interval 1 day"))
    mark = incremental.stored_mark(v.spark, root, "timestamp_ntz")
    seconds = "yyyy-MM-dd HH:mm:ss"
    return tables.read(v.spark, root).select(
        "event_id", "user_id", "event_type", F.date_format("ts", seconds).alias("ts"), F.date_format(mark, seconds).alias("mark")
    )


@query("stream_delta_upsert", "SELECT event_id, user_id, event_type, strftime(ts, '%Y_%m') AS month FROM events")
def _(v):
    """Events delivered twice, each delivery loaded as a delta and merged when read."""
    schema, keys = v.table("events").schema, ["event_id", "month"]
    root, state = new_dir(v.spark, "deltas"), new_dir(v.spark, "deltas-state")
    for k in range(2):
        stream = arrival.arrivals(v.spark, f"{v.sf_dir}/events.parque[t]", schema).drop("_source_file")
        load = arrival.append_batches(f"{root}/t", keys, ["ts"], "month")
        # a delivery of its own each time, its batches numbered on
        arrival.ingest(partitions.with_month(stream, "ts"), f"{state}-{k}", lambda b, i, k=k: load(b, f"{k}-{i}")).awaitTermination()
    return tables.read(v.spark, f"{root}/t", keys).select("event_id", "user_id", "event_type", "month")


@query(
    "retention_stored",
    """SELECT strftime(transaction_date, '%Y_%m') AS month, count(*) AS rows,
              (SELECT count(DISTINCT strftime(transaction_date, '%Y_%m')) FROM v_transaction_lines WHERE transaction_date < DATE '1998-01-01') AS dropped
       FROM v_transaction_lines WHERE transaction_date >= DATE '1998-01-01' GROUP BY 1""",
)
def _(v):
    """Months dropped from a stored table and their folders deleted, no row of them read."""
    rows = partitions.with_month(v.transaction_lines(), "transaction_date")
    root = new_dir(v.spark, "retained")
    tables.replace_partitions(v.spark, root, rows, "month", set())
    gone = tables.drop_partitions(v.spark, root, lambda m: m is not None and m < "1998_01")
    tables.sweep(v.spark, root, versions=1)
    kept = tables.read(v.spark, root).groupBy("month").agg(F.count(F.lit(1)).alias("rows"))
    return kept.withColumn("dropped", F.lit(len(gone)).cast("long"))


@query(
    "gold_by_difference",
    f"""SELECT strftime(transaction_date, '%Y_%m') AS month, load, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS total,
               min(amount) AS least, max(amount) AS most FROM ({UPSERT_SQL}) GROUP BY ALL""",
)
def _(v):
    """A summary by month and kind of load, brought up to date after each of three loads."""
    first, batch = _deliveries(v)
    root, gold = new_dir(v.spark, "silver"), new_dir(v.spark, "gold")
    order, early = ["amount", "line_no"], F.lit(dt.datetime(2024, 5, 1))
    first, batch = (partitions.with_month(rows, "transaction_date") for rows in (first, batch))
    for rows, stamp in ((first, early), (batch, F.lit(LOADED)), (batch, F.lit(LOADED))):
        tables.load(v.spark, root, rows, TXN_KEY, order, "month", stamp)
        summaries.refresh(v.spark, root, gold, TXN_KEY, ["month", "load"], "amount", "month", lambda r: r.withColumn("load", _load_label()))
    done = tables.read(v.spark, gold)
    return done.select("month", "load", "n", F.col("total").cast("decimal(28,2)").alias("total"), "least", "most")
