"""Calendar partitions, retention, and versioned Gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.functions.business import month_label, month_start


def with_month(df: DataFrame, day: str, name: str = "month") -> DataFrame:
    """Add the partition column ``yyyy_MM``."""
    return df.withColumn(name, month_label(day))


def month_bounds(df: DataFrame, day: str, first: dt.date | None = None, last: dt.date | None = None, name: str = "month") -> DataFrame:
    """Filter on the date and, beside it, on the partition column, since the
    optimizer does not derive one from the other."""
    if first is not None:
        df = df.where((F.col(day) >= F.lit(first)) & (F.col(name) >= F.lit(f"{first:%Y_%m}")))
    if last is not None:
        df = df.where((F.col(day) <= F.lit(last)) & (F.col(name) <= F.lit(f"{last:%Y_%m}")))
    return df


def assign_month(df: DataFrame, day: str, table: str, first: dt.date, last: dt.date) -> DataFrame:
    """Partition name, its half-open range, and whether the date falls outside the
    configured months (then the row belongs to the default partition)."""
    start = month_start(day)
    inside = F.col(day).isNotNull() & (start >= F.lit(first.replace(day=1))) & (start <= F.lit(last.replace(day=1)))
    return df.select(
        "*",
        F.when(inside, F.concat(F.lit(table + "_"), month_label(day)))
        .otherwise(F.lit(table + "_default"))
        .alias("partition"),
        F.when(inside, start).alias("range_start"),
        F.when(inside, F.add_months(start, 1)).alias("range_end"),
        (~inside).alias("is_default"),
    )


def retain(df: DataFrame, month_col: str, keep_from: dt.date) -> DataFrame:
    """Rows of months not older than the given one; prunes on the partition column."""
    return df.where(F.col(month_col) >= F.lit(f"{keep_from:%Y_%m}"))


def drop_months(spark: SparkSession, table: str, month_col: str, keep_from: dt.date) -> list[str]:
    """Drop the partitions of a catalog table older than the given month; rows are
    not read. Returns the dropped months."""
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]  # one per month
    months = [n.split(f"{month_col}=")[1].split("/")[0] for n in names]
    old = sorted(m for m in set(months) if m < f"{keep_from:%Y_%m}")
    for m in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({month_col} = '{m}')")
    return old


def inventory(df: DataFrame, month_col: str = "month") -> DataFrame:
    """Rows, files and bytes per partition of a stored table.

    Rows are counted per file first, where the file's size is a constant, so the
    bytes are added once per file.
    """
    files = df.select(
        month_col, F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")
    )
    per_file = files.groupBy(month_col, "p", "s").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(F.col(month_col).alias("partition")).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("s").alias("bytes")
    )


def zone_files(df: DataFrame) -> DataFrame:
    """Files of a zone with size and rows."""
    meta = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return meta.groupBy("path", "bytes").agg(F.count(F.lit(1)).alias("rows"))


# --- versioned tables: readers keep the version they opened ------------------------


def _pointer(root: str) -> str:
    return f"{root.rstrip('/')}/_published"


def current_version(spark: SparkSession, root: str) -> int:
    """Newest published version, 0 if there is none."""
    try:
        marks = spark.read.schema("version int").json(_pointer(root))
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return 0
        raise
    return marks.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def publish(df: DataFrame, root: str, partition: str | None = None) -> int:
    """Write the frame as the next version and make it current. A failed write
    leaves the old version current; the mark is written only after the data."""
    spark = df.sparkSession
    version = current_version(spark, root) + 1
    writer = (df.hint("rebalance", F.col(partition)) if partition else df).write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    writer.option("partitionOverwriteMode", "static").parquet(f"{root.rstrip('/')}/v{version:06d}")
    mark_published(spark, root, version)
    return version


def mark_published(spark: SparkSession, root: str, version: int) -> None:
    """Make a version current: one small file, written last."""
    spark.range(1).coalesce(1).select(F.lit(version).alias("version")).write.mode("append").json(_pointer(root))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version == 0:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v{version:06d}")


def recent(day: Column | str, as_of: dt.date, days: int) -> Column:
    """Within the last ``days`` days up to and including the lower bound."""
    day = F.col(day) if isinstance(day, str) else day
    return day >= F.lit(as_of - dt.timedelta(days=days))
