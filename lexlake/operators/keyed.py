"""Keyed table operators: latest row per key, upsert, staging, idempotent append."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexlake.workspace import materialize, new_dir


def _ordering(order: list[str]) -> list[Column]:
    return [F.desc_nulls_last(c) for c in order]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the highest ``order`` values per key; of equal ones, always the
    same by a hash of the whole row.

    Spark limits each key to one row per task before the shuffle (the rank filter
    is pushed below the exchange), so a hot key never meets in one task whole.
    """
    hashed = [c for c in df.columns if "map<" not in df.schema[c].dataType.simpleString() and "variant" not in df.schema[c].dataType.simpleString()]
    w = W.partitionBy(*keys).orderBy(*_ordering(order), F.xxhash64(*[F.col(f"`{c}`") for c in hashed]).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows a dedupe on the keys would drop."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("dropped"))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    as_of: Column | None = None,
    update: list[str] | None = None,
    null_keys: bool = False,
) -> DataFrame:
    """Target after insert-or-update of the batch.

    Non-key columns take the batch value, null included; ``created_at`` is kept
    from the first load and ``updated_at`` is set on every touched row, where the
    target has them. Of several batch rows with one key the latest wins. With
    ``null_keys`` a null in a key is a value like others; else it matches nothing.
    """
    return merge(target, latest_per_key(batch, keys, order), keys, as_of, update, null_keys)


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    as_of: Column | None = None,
    update: list[str] | None = None,
    null_keys: bool = False,
) -> DataFrame:
    """``upsert`` of a batch that already has one row per key, which is not sorted again."""
    as_of = F.current_timestamp() if as_of is None else as_of
    stamps = [c for c in ("created_at", "updated_at") if c in target.columns]
    body = [c for c in target.columns if c not in keys and c not in stamps]
    update = body if update is None else [c for c in update if c in body]
    new = batch.select(*keys, F.struct(*[F.col(c) for c in body]).alias("_new"))
    old = target.select(*keys, F.struct(*[F.col(c) for c in body + stamps]).alias("_old"))
    if null_keys:
        new = new.withColumnsRenamed({k: f"_new_{k}" for k in keys})
        alike = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_new_{k}`")) for k in keys])
        merged = old.join(new, alike, "full_outer").withColumns({k: F.coalesce(F.col(f"`{k}`"), F.col(f"`_new_{k}`")) for k in keys})
    else:
        merged = old.join(new, keys, "full_outer")
    is_new, was_there = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c == "created_at":
            out.append(F.when(was_there, F.col("_old.created_at")).otherwise(as_of).alias(c))
        elif c == "updated_at":
            out.append(F.when(is_new, as_of).otherwise(F.col("_old.updated_at")).alias(c))
        elif c in update:
            out.append(F.when(is_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c))
        else:
            out.append(F.when(was_there, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c))
    return merged.select(*out)


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "append", sort: list[str] | None = None) -> None:
    """Write by partition column with files of even size: the rebalance lets
    adaptive execution split a big partition value over tasks and merge small ones."""
    out = df.hint("rebalance", F.col(by))
    if sort:
        out = out.sortWithinPartitions(by, *sort)
    out.write.mode(mode).partitionBy(by).option("partitionOverwriteMode", "dynamic").parquet(path)


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    partition: str,
    as_of: Column | None = None,
    sort: list[str] | None = None,
) -> int:
    """Upsert into a partitioned Parquet table, rewriting only the partitions the
    batch touches. The partition value must follow from the key.

    The merged rows are staged durably before the table is overwritten, and a note of
    them is kept beside the table until that is done: a load that was stopped half-way
    is finished by the next one first. Readers may see part of a load while it is
    written; ``operators.tables`` keeps versions instead. One writer per table. A column
    new to the table is added; read the table with ``mergeSchema``. Returns the number
    of batch rows loaded.
    """
    finish_stopped(spark, path, partition, sort)
    batch = materialize(latest_per_key(batch, keys, order), "upsert-batch")
    # as many values as the table has folders, which the file listing holds anyway
    touched = [r[0] for r in batch.select(partition).distinct().collect()]
    if not touched:
        return 0
    try:
        target = _as_stored(spark, path, batch.schema[partition])
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        first = batch
        now = F.current_timestamp() if as_of is None else as_of
        for c in ("created_at", "updated_at"):
            first = first.withColumn(c, now)
        write_partitioned(first, path, partition, "errorifexists", sort)
        return batch.count()
    for c in batch.columns:
        if c not in target.columns:  # a column the table does not have yet: null for its rows
            target = target.withColumn(c, F.lit(None).cast(batch.schema[c].dataType))
    hit = F.col(partition).isin(*[t for t in touched if t is not None])
    old = target.where(hit | F.col(partition).isNull() if None in touched else hit)
    staged = new_dir(spark, "upsert-merged")
    merged = upsert(old, batch, keys, order, as_of, null_keys=True)
    merged.write.mode("errorifexists").parquet(staged)
    note = spark.createDataFrame([(staged, merged.schema.json())], PENDING)
    note.coalesce(1).write.mode("append").json(f"{path}/_pending")
    finish_stopped(spark, path, partition, sort)
    return batch.count()


PENDING = "staged string, schema string"


def _as_stored(spark: SparkSession, path: str, partition: T.StructField) -> DataFrame:
    """The table with its partition column as it was written: left to itself, the reader
    takes folder names that look like numbers for numbers."""
    found = spark.read.option("mergeSchema", True).parquet(path)
    fields = [partition if f.name == partition.name else f for f in found.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def finish_stopped(spark: SparkSession, path: str, partition: str, sort: list[str] | None = None) -> int:
    """Put staged rows in place whose load has not said that it is done; doing so twice
    changes nothing. Returns how many loads were finished."""
    notes = {}
    for name in ("_pending", "_done"):
        try:
            notes[name] = {(r.staged, r.schema) for r in spark.read.schema(PENDING).json(f"{path}/{name}").collect()}
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            notes[name] = set()
    todo = sorted(notes["_pending"] - notes["_done"])
    for staged, schema in todo:
        rows = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(staged)
        write_partitioned(rows, path, partition, "overwrite", sort)
        done = spark.createDataFrame([(staged, schema)], PENDING)
        done.coalesce(1).write.mode("append").json(f"{path}/_done")
    return len(todo)


def unprocessed(staging: DataFrame, done_batches: DataFrame) -> DataFrame:
    """Staged rows whose batch has not been processed yet."""
    return staging.join(done_batches.select("batch_id").distinct(), "batch_id", "left_anti")


def watermark_rows(state: DataFrame, name: str, default: Column) -> DataFrame:
    """One row with the stored mark of the named feed, or the default."""
    found = state.where(F.col("pipeline_name") == name).agg(F.max("watermark").alias("w"))
    return found.select(F.lit(name).alias("pipeline_name"), F.coalesce("w", default).alias("watermark"))


def advance_watermark(state: DataFrame, marks: DataFrame) -> DataFrame:
    """Marks table after storing new marks; call it after the data is committed."""
    return upsert(state, marks, ["pipeline_name"], ["watermark"])
