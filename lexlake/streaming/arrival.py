"""Arrival-driven ingestion: every landed file is processed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexlake.operators import tables
from lexlake.operators.keyed import upsert_table


def arrivals(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    suffix: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of rows from files appearing under the landing folder, each with the
    file it came from."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", suffix)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing).select("*", F.col("_metadata.file_path").alias("_source_file"))


def ingest(
    stream: DataFrame,
    checkpoint: str,
    process: Callable[[DataFrame, str], None],
    continuous: str | None = None,
) -> StreamingQuery:
    """Run ``process(batch, batch_id)`` on every micro-batch. By default takes what
    has arrived and stops; with ``continuous`` keeps running at that interval.

    A failed batch is retried alone with the same id from the checkpoint, so
    ``process`` should replace by batch id or load by key.
    """

    def one(batch: DataFrame, number: int) -> None:
        process(batch, f"{number:010d}")

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def land_by_batch(path: str) -> Callable[[DataFrame, str], None]:
    """Write each micro-batch to a folder of its own; a retry replaces it."""

    def process(batch: DataFrame, batch_id: str) -> None:
        (
            batch.withColumn("_batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch")
            .parquet(path)
        )

    return process


def dedup_stream(stream: DataFrame, keys: list[str], event_time: str, lateness: str) -> DataFrame:
    """Drop repeats of a key seen within the lateness; state older than that is
    forgotten, and the keyed load behind it stays correct for later repeats."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)


def upsert_batches(path: str, keys: list[str], order: list[str], partition: str) -> Callable[[DataFrame, str], None]:
    """Load each micro-batch by key; applying a batch twice changes nothing."""

    def process(batch: DataFrame, batch_id: str) -> None:
        upsert_table(batch.sparkSession, path, batch, keys, order, partition)

    return process


def append_batches(root: str, keys: list[str], order: list[str], partition: str, compact_after: int = 16) -> Callable[[DataFrame, str], None]:
    """Load each micro-batch as a delta of a versioned table (``operators.tables``): what
    is written grows with the batch, a month's deltas are merged from time to time, and
    a batch that is delivered again is left out by its number."""

    def process(batch: DataFrame, batch_id: str) -> None:
        tables.append(batch.sparkSession, root, batch, keys, order, partition, batch_id, compact_after)

    return process
