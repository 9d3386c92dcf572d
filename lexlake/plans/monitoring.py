"""Windowed health figures over the run-audit feed.

Each function takes a batch or a streaming frame with an event-time TIMESTAMP
column ``ts``; on a stream it also bounds the state by a watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds in seconds of the stage duration histogram.
DURATION_BOUNDS = (1, 5, 10, 30, 60, 120, 300, 600, 1800, 3600)
QUARANTINE_LIMIT = 0.05
LATENESS = "10 minutes"


def _timed(df: DataFrame, lateness: str) -> DataFrame:
    return df.withWatermark("ts", lateness) if df.isStreaming else df


def _bounds(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), "*").drop("window")


def quarantine_rate(audit: DataFrame, length: str = "10 minutes", lateness: str = LATENESS) -> DataFrame:
    """Share of quarantined rows per window and whether it is over the limit."""
    counted = _timed(audit, lateness).groupBy(F.window("ts", length)).agg(
        F.count(F.lit(1)).alias("ingested"), F.count_if("quarantined").alias("quarantined")
    )
    share = F.col("quarantined").cast("double") / F.col("ingested")
    return _bounds(counted).withColumn("rate", F.round(share, 6)).withColumn("alert", share > QUARANTINE_LIMIT)


def quarantine_by_rule(audit: DataFrame, length: str = "10 minutes", lateness: str = LATENESS) -> DataFrame:
    """Quarantined rows per second, window and rule."""
    seconds = F.col("window.end").cast("long") - F.col("window.start").cast("long")
    counted = (
        _timed(audit, lateness)
        .where("quarantined")
        .groupBy(F.window("ts", length), "rule")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("per_second", F.round(F.col("rows").cast("double") / seconds, 6))
    )
    return _bounds(counted)


def failure_rate(checks: DataFrame, length: str = "5 minutes", slide: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    """Failed checks per minute over a sliding window. Counts are taken per slide
    first and windows built from those, so that no check is copied into every window
    it belongs to. ``length`` has to be a multiple of ``slide``."""
    per_slide = (
        _timed(checks, lateness)
        .groupBy(F.window("ts", slide).alias("part"))
        .agg(F.count(F.lit(1)).alias("checks"), F.count_if("failed").alias("failed"))
    )
    seconds = F.col("window.end").cast("long") - F.col("window.start").cast("long")
    counted = per_slide.groupBy(F.window("part", length, slide)).agg(
        F.sum("checks").alias("checks"), F.sum("failed").alias("failed")
    )
    per_minute = F.col("failed").cast("double") * 60 / seconds
    return _bounds(
        counted.withColumn("failed_per_minute", F.round(per_minute, 6)).withColumn("alert", per_minute > 1.0)
    )


def throughput(audit: DataFrame, length: str = "5 minutes", by: tuple[str, ...] = ("pipeline", "source"), lateness: str = LATENESS) -> DataFrame:
    """Rows per second by label."""
    seconds = F.col("window.end").cast("long") - F.col("window.start").cast("long")
    counted = _timed(audit, lateness).groupBy(F.window("ts", length), *by).agg(F.sum("rows").alias("rows"))
    return _bounds(counted.withColumn("per_second", F.round(F.col("rows").cast("double") / seconds, 6)))


def error_count(audit: DataFrame, length: str = "5 minutes", lateness: str = LATENESS) -> DataFrame:
    """Errors by stage and type."""
    return _bounds(
        _timed(audit, lateness)
        .where(F.col("error_type").isNotNull())
        .groupBy(F.window("ts", length), "pipeline", "stage", "error_type")
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def histogram_quantile(buckets: list[Column], bounds: tuple[int, ...], q: float) -> Column:
    """Quantile from cumulative bucket counts (last one is the total): linear inside
    the bucket the rank falls into, the highest bound beyond it."""
    total = buckets[-1]
    rank = total.cast("double") * q
    value = None
    below, low = F.lit(0), 0
    for n, high in zip(buckets, bounds, strict=False):
        inside = F.lit(float(low)) + (F.lit(float(high - low)) * (rank - below) / F.nullif(n - below, F.lit(0)))
        value = F.when(n >= rank, inside) if value is None else value.when(n >= rank, inside)
        below, low = n, high
    return F.when(total > 0, value.otherwise(F.lit(float(bounds[-1]))))


def stage_latency(audit: DataFrame, length: str = "5 minutes", q: float = 0.95, lateness: str = LATENESS) -> DataFrame:
    """Duration quantile per pipeline and stage from histogram counts, which add up
    across tasks and windows where raw percentiles do not."""
    names = [f"le_{b}" for b in DURATION_BOUNDS] + ["le_inf"]
    counts = [F.count_if(F.col("duration") <= b).alias(n) for b, n in zip(DURATION_BOUNDS, names, strict=False)]
    counts.append(F.count("duration").alias("le_inf"))
    counted = _timed(audit, lateness).groupBy(F.window("ts", length), "pipeline", "stage").agg(*counts)
    quantile = histogram_quantile([F.col(n) for n in names], DURATION_BOUNDS, q)
    return _bounds(counted.withColumn("p95", F.round(quantile, 6))).select(
        "window_start", "pipeline", "stage", F.col("le_inf").alias("runs"), "p95"
    )
