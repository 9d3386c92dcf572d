"""Registered health figures. They run the windows of the streaming jobs as batch;
tests run the streams and compare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.catalog.registry import query
from lexlake.operators.partitions import with_month
from lexlake.plans import monitoring
from lexlake.streaming import arrival
from lexlake.streaming.monitors import event_time
from lexlake.workspace import new_dir


def _window(minutes: int) -> str:
    return f"strftime(time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S')"


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "quarantine_rate_alert",
    f"""SELECT window_start, ingested, quarantined, round(quarantined / ingested, 6) AS rate, quarantined / ingested > 0.05 AS alert
        FROM (SELECT {_window(10)} AS window_start, count(*) AS ingested, count(*) FILTER (WHERE quarantined) AS quarantined
              FROM v_audit GROUP BY 1)""",
)
def _(v):
    return _shown(monitoring.quarantine_rate(v.audit()))


@query(
    "quarantine_by_rule",
    f"""SELECT window_start, rule, rows, round(rows / 600, 6) AS per_second FROM (
          SELECT {_window(10)} AS window_start, rule, count(*) AS rows FROM v_audit WHERE quarantined GROUP BY 1, 2)""",
)
def _(v):
    return _shown(monitoring.quarantine_by_rule(v.audit()))


@query(
    "dq_failure_rate",
    """SELECT window_start, checks, failed, round(failed * 60.0::DOUBLE / 300, 6) AS failed_per_minute,
              failed * 60.0::DOUBLE / 300 > 1 AS alert
       FROM (SELECT strftime(time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') - to_minutes(i), '%Y-%m-%d %H:%M:%S')
                    AS window_start, count(*) AS checks, count(*) FILTER (WHERE failed) AS failed
             FROM v_audit, range(0, 5) AS r(i) GROUP BY 1)""",
)
def _(v):
    return _shown(monitoring.failure_rate(v.audit()))


@query(
    "throughput_by_source",
    f"""SELECT window_start, pipeline, source, CAST(rows AS BIGINT) AS rows, round(rows / 300, 6) AS per_second FROM (
          SELECT {_window(5)} AS window_start, pipeline, source, sum(rows) AS rows FROM v_audit GROUP BY 1, 2, 3)""",
)
def _(v):
    return _shown(monitoring.throughput(v.audit()))


_LE = ", ".join(f"count(*) FILTER (WHERE duration <= {b}) AS le_{b}" for b in monitoring.DURATION_BOUNDS)


def _quantile_sql() -> str:
    out, below, low = "CASE", "0", 0
    for b in monitoring.DURATION_BOUNDS:
        out += (
            f" WHEN le_{b} >= r THEN {float(low)}::DOUBLE + {float(b - low)}::DOUBLE * (r - {below})"
            f" / nullif(le_{b} - {below}, 0)"
        )
        below, low = f"le_{b}", b
    return out + f" ELSE {float(low)}::DOUBLE END"


@query(
    "stage_latency_p95",
    f"""SELECT window_start, pipeline, stage, runs, round({_quantile_sql()}, 6) AS p95 FROM (
          SELECT *, CAST(runs AS DOUBLE) * 0.95::DOUBLE AS r FROM (
            SELECT {_window(5)} AS window_start, pipeline, stage, {_LE}, count(duration) AS runs FROM v_audit GROUP BY 1, 2, 3))""",
)
def _(v):
    return _shown(monitoring.stage_latency(v.audit()))


@query(
    "error_count",
    f"""SELECT {_window(5)} AS window_start, pipeline, stage, error_type, count(*) AS errors FROM v_audit
        WHERE error_type IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def _(v):
    return _shown(monitoring.error_count(v.audit()))


@query(
    "stream_dedup_upsert",
    "SELECT event_id, user_id, event_type, strftime(ts, '%Y_%m') AS month FROM events",
)
def _(v):
    """Events delivered twice: repeats are dropped on the stream and the rest loaded
    by key, once."""
    schema = v.table("events").schema
    source = lambda: arrival.arrivals(v.spark, f"{v.sf_dir}/events.parque[t]", schema).drop("_source_file")
    twice = event_time(source().union(source()))
    out, state = new_dir(v.spark, "events"), new_dir(v.spark, "events-state")
    unique = with_month(arrival.dedup_stream(twice, ["event_id"], "ts", "1 day"), "ts")
    load = arrival.upsert_batches(out, ["event_id", "month"], ["ts"], "month")
    arrival.ingest(unique, state, load).awaitTermination()
    return v.spark.read.parquet(out).select("event_id", "user_id", "event_type", "month")


@query(
    "run_summary",
    """SELECT pipeline, CAST(sum(extracted) AS BIGINT) AS extracted, count(*) FILTER (WHERE quarantined) AS rejected,
              CAST(sum(loaded) AS BIGINT) AS loaded FROM v_audit GROUP BY 1""",
)
def _(v):
    return (
        v.audit()
        .groupBy("pipeline")
        .agg(
            F.sum("extracted").alias("extracted"),
            F.count_if("quarantined").alias("rejected"),
            F.sum("loaded").alias("loaded"),
        )
    )
