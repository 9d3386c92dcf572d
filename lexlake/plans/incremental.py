"""Flow that reads a source beyond its stored mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.operators import tables
from lexlake.sources.files import newer_than


def stored_mark(spark: SparkSession, root: str, like: str) -> Column | None:
    """The mark of a table's current version as a column of type ``like``, None before the first load."""
    mark = tables.manifest(spark, root).mark
    return None if mark is None else F.lit(mark).cast(like)


def incremental_load(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    mark_column: str,
    keys: list[str],
    order: list[str],
    partition: str,
    overlap: Column | None = None,
    as_of: Column | None = None,
) -> int:
    """Load the rows of ``source`` beyond the stored mark into the table under ``root``.

    The highest mark read is part of the commit that brings its rows, so a stopped run
    starts again from the old mark and a repeated one finds nothing new. Rows that share
    the mark's own value, or came late by up to ``overlap``, are read again with it and
    loaded by key, which changes nothing for those known. Without a stored mark all is
    read; rows without a mark are read then only. Returns the number of rows loaded.
    """
    like = source.schema[mark_column].dataType.simpleString()
    last = stored_mark(spark, root, like)
    rows = source if last is None else newer_than(source, mark_column, last, overlap)
    top = rows.agg(F.max(f"`{mark_column}`").cast("string").alias("top")).first()["top"]
    if top is None and last is not None:
        return 0
    if last is not None:  # rows of the overlap may all be older
        top = spark.range(1).select(F.greatest(F.lit(top).cast(like), last).cast("string")).first()[0]
    # rows beyond ``top`` that arrive between the two reads wait for the next run
    rows = rows.where(F.col(mark_column).isNull() | (F.col(mark_column) <= F.lit(top).cast(like)))
    return tables.load(spark, root, rows, keys, order, partition, as_of, mark=top)
