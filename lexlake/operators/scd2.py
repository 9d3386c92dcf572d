"""Dated history (slowly changing dimension, type 2) and joins against it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexlake.functions.keys import row_hash
from lexlake.operators.keyed import latest_per_key

OPEN_END = dt.date(9999, 12, 31)
META = ["valid_from", "valid_to", "is_current", "row_hash"]


def from_feed(feed: DataFrame, key: str, tracked: list[str], effective: str, order: list[str]) -> DataFrame:
    """Whole history from a change feed.

    The last change of a day wins. Reducing to one row per key and day first
    bounds the per-key window by the calendar, however many changes a key has.
    """
    daily = latest_per_key(feed, [key, effective], order)
    w = W.partitionBy(key).orderBy(effective)
    hashed = daily.withColumn("row_hash", row_hash(tracked))
    changed = hashed.withColumn("_prev", F.lag("row_hash").over(w)).where(
        F.col("_prev").isNull() | (F.col("_prev") != F.col("row_hash"))
    )
    following = F.lead(effective).over(w)
    return (
        changed.withColumn("_next", following)
        .withColumn("valid_from", F.col(effective))
        .withColumn("valid_to", F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END)))
        .withColumn("is_current", F.col("_next").isNull())
        .drop("_prev", "_next", effective)
    )


def classify(dim: DataFrame, batch: DataFrame, key: str, tracked: list[str], order: list[str]) -> DataFrame:
    """Current versions against the batch: one row per key with both sides and the
    action. ``batch`` carries its ``effective`` date.

    Actions: kept (no batch row), inserted, unchanged, changed, replaced (change on
    the day the version began), late (change before it began; goes to quarantine).
    """
    body = [c for c in dim.columns if c not in META]
    new = latest_per_key(batch, [key], order).select(
        F.col(key),
        F.struct(*[F.col(c) for c in body], F.col("effective"), row_hash(tracked).alias("row_hash")).alias("_new"),
    )
    old = dim.where("is_current").select(F.col(key), F.struct(*[F.col(c) for c in dim.columns]).alias("_old"))
    action = (
        F.when(F.col("_new").isNull(), "kept")
        .when(F.col("_old").isNull(), "inserted")
        .when(F.col("_old.row_hash") == F.col("_new.row_hash"), "unchanged")
        .when(F.col("_new.effective") > F.col("_old.valid_from"), "changed")
        .when(F.col("_new.effective") == F.col("_old.valid_from"), "replaced")
        .otherwise("late")
    )
    return old.join(new, key, "full_outer").withColumn("action", action)


def _version(columns: list[str], side: str, **fixed: Column) -> Column:
    return F.struct(*[fixed.get(c, F.col(f"{side}.{c}")).alias(c) for c in columns])


def apply(dim: DataFrame, batch: DataFrame, key: str, tracked: list[str], order: list[str]) -> DataFrame:
    """Dimension after the batch. Closed versions are passed through unshuffled;
    only current versions meet the batch."""
    cols = dim.columns
    pairs = classify(dim, batch, key, tracked, order)
    as_is = _version(cols, "_old")
    closed = _version(
        cols, "_old", valid_to=F.date_sub(F.col("_new.effective"), 1), is_current=F.lit(False)
    )
    opened = _version(
        cols,
        "_new",
        valid_from=F.col("_new.effective"),
        valid_to=F.lit(OPEN_END),
        is_current=F.lit(True),
    )
    versions = (
        F.when(F.col("action").isin("kept", "unchanged", "late"), F.array(as_is))
        .when(F.col("action").isin("inserted", "replaced"), F.array(opened))
        .otherwise(F.array(closed, opened))
    )
    touched = pairs.select(F.explode(versions).alias("v")).select("v.*")
    return dim.where(~F.col("is_current")).unionByName(touched)


def counts(pairs: DataFrame) -> DataFrame:
    """One row: inserted, expired, unchanged, replaced, late."""
    n = lambda *names: F.count_if(F.col("action").isin(*names))
    return pairs.agg(
        n("inserted", "changed").alias("inserted"),
        n("changed").alias("expired"),
        n("unchanged").alias("unchanged"),
        n("replaced").alias("replaced"),
        n("late").alias("late"),
    )


def late_rows(pairs: DataFrame) -> DataFrame:
    """Batch rows that start before the current version, for quarantine."""
    return pairs.where(F.col("action") == "late").select(
        F.to_json("_new").alias("raw"), F.lit("effective date precedes the current version").alias("reason")
    )


def point_in_time(dim: DataFrame, day: Column | dt.date) -> DataFrame:
    day = F.lit(day) if isinstance(day, dt.date) else day
    return dim.where(day.between(F.col("valid_from"), F.col("valid_to")))


def asof_join(facts: DataFrame, dim: DataFrame, key: str, day: str, how: str = "inner") -> DataFrame:
    """Each fact with the version valid on its day; ``how`` is inner or left.

    The facts are reduced to their distinct (key, day) and merged with the starts of
    the versions; the last start up to a day is that day's version, if it has not
    ended. A key has at most one such row for a day of the calendar, however many
    facts it has. The facts then join on plain (key, day), so a hot key is spread over
    its days. Versions of a key must not overlap, as the history keeps them.
    """
    rest = [c for c in dim.columns if c != key]
    as_date = facts.schema[day].dataType
    version = F.struct(*[F.col(c) for c in rest])
    kind = version_type(dim, rest)
    days = facts.select(F.col(key).alias("_key"), F.col(day).alias("_day"), F.lit(1).alias("_asked")).distinct()
    starts = dim.select(F.col(key).alias("_key"), F.col("valid_from").cast(as_date).alias("_day"), F.lit(0).alias("_asked"), version.alias("_version"))
    marks = days.withColumn("_version", F.lit(None).cast(kind)).unionByName(starts)
    w = W.partitionBy("_key").orderBy("_day", "_asked").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = marks.withColumn("_version", F.last("_version", ignorenulls=True).over(w)).where("_asked = 1")
    found = found.where(F.col("_day") <= F.col("_version.valid_to")).drop("_asked")
    joined = facts.join(found, (facts[key] == found["_key"]) & (facts[day] == found["_day"]), how)
    return joined.select(*[facts[c] for c in facts.columns], *[F.col("_version")[c].alias(c) for c in rest])


def asof_merge(facts: DataFrame, dim: DataFrame, key: str, day: str, parts: int | None = None) -> DataFrame:
    """``asof_join`` (inner) for facts that are few for a key and day, such as sums: they
    are sorted among the starts of the versions themselves, in one shuffle by key, and the
    result stays dealt by key, for sums that follow. ``parts`` is that shuffle's number of
    partitions. All facts of a key meet in one task, so a key's rows must be bounded."""
    rest = [c for c in dim.columns if c != key]
    own = [c for c in facts.columns if c != key]
    as_date = facts.schema[day].dataType
    fact, version = F.struct(*[F.col(f"`{c}`") for c in own]), F.struct(*[F.col(f"`{c}`") for c in rest])
    asked = facts.where(F.col(key).isNotNull()).select(
        F.col(key), F.col(day).alias("_day"), F.lit(1).alias("_asked"), fact.alias("_fact"), F.lit(None).cast(version_type(dim, rest)).alias("_version")
    )
    starts = dim.select(
        F.col(key), F.col("valid_from").cast(as_date).alias("_day"), F.lit(0).alias("_asked"), F.lit(None).cast(version_type(facts, own)).alias("_fact"), version.alias("_version")
    )
    marks = asked.unionByName(starts)
    if parts:
        marks = marks.repartition(parts, key)
    w = W.partitionBy(key).orderBy("_day", "_asked").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = marks.withColumn("_version", F.last("_version", ignorenulls=True).over(w)).where("_asked = 1")
    found = found.where(F.col("_day") <= F.col("_version.valid_to"))
    columns = [F.col(key) if c == key else F.col("_fact")[c].alias(c) for c in facts.columns]
    return found.select(*columns, *[F.col("_version")[c].alias(c) for c in rest])


def version_type(dim: DataFrame, columns: list[str]):
    return dim.select(F.struct(*[F.col(c) for c in columns]).alias("v")).schema["v"].dataType
