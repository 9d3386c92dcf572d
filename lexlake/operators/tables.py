"""Keyed tables that survive a stop: data in folders, one manifest a version, one pointer.

A load writes its rows into a folder of its own, then the manifest of the next version,
then the pointer to it, which is one small file. Readers follow the pointer, so they see
a load whole or not at all, and what a stopped load left behind is named by no version:
the next load goes on from the version before. Beside the folders a manifest holds the
mark up to which the source was read and the last micro-batch taken, so neither can be
stored without the rows it stands for.

The partition column stays inside the files; folder names never carry its values. One
writer a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexlake.operators.keyed import latest_per_key, merge
from lexlake.operators.partitions import current_version, mark_published
from lexlake.workspace import materialize

#: Column of a row in the files: the version that wrote it.
LOAD = "_load"
SLOT = "slot"


@dataclass(frozen=True)
class Part:
    """A folder with rows of one partition value. Deltas lie over the base of their value."""

    value: str | None
    folder: str
    delta: bool = False


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    parts: tuple[Part, ...] = ()
    schema: T.StructType | None = None
    mark: str | None = None
    batch: str | None = None


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_manifests/v{version:08d}"


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """What a version (the current one by default) is made of; empty before the first load.
    Holds one line for each folder, as a file listing would."""
    version = current_version(spark, root) if version is None else version
    if not version:
        return Manifest()
    kept = json.loads(spark.read.text(_manifest_path(root, version)).first()[0])
    return Manifest(version, tuple(Part(*p) for p in kept["parts"]), T.StructType.fromJson(kept["schema"]), kept["mark"], kept["batch"])


def _commit(spark: SparkSession, root: str, after: Manifest) -> int:
    """Make ``after`` the current version. A manifest left by a stopped load is replaced."""
    version = after.version + 1
    line = json.dumps({"parts": [[p.value, p.folder, p.delta] for p in after.parts], "schema": after.schema.jsonValue(), "mark": after.mark, "batch": after.batch})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(_manifest_path(root, version))
    mark_published(spark, root, version)
    return version


def _slot(partition: str) -> Column:
    """A folder name that stands for a partition value, whatever characters that has."""
    value = F.col(f"`{partition}`").cast("string")
    return F.when(value.isNull(), "none").otherwise(F.concat(F.lit("p"), F.sha2(value, 256)))


def _write(rows: DataFrame, root: str, partition: str, sort: list[str] | None) -> dict[str | None, tuple[str, int]]:
    """Write the rows, a folder for each partition value; returns folder and rows of each.
    The rows are worked out once and shuffled without the folder names."""
    folder = f"data/{uuid.uuid4().hex}"
    out = rows.hint("rebalance", F.col(f"`{partition}`")).withColumn(SLOT, _slot(partition))
    if sort:
        out = out.sortWithinPartitions(SLOT, *sort)
    out.write.mode("errorifexists").partitionBy(SLOT).parquet(f"{root.rstrip('/')}/{folder}")
    # as many lines as folders were written
    back = rows.sparkSession.read.schema(T.StructType([*out.schema.fields])).parquet(f"{root.rstrip('/')}/{folder}")
    values = back.groupBy(F.col(f"`{partition}`").cast("string").alias("v"), SLOT).agg(F.count("*").alias("n")).collect()
    return {r["v"]: (f"{folder}/{SLOT}={r[SLOT]}", r["n"]) for r in values}


def _within(partition: str, values: set[str | None]) -> Column:
    """Whether the partition value, as text, is one of these; null is a value."""
    value = F.col(f"`{partition}`").cast("string")
    named = F.coalesce(value.isin(*[v for v in values if v is not None]), F.lit(False))
    return named | value.isNull() if None in values else named


def _rows(spark: SparkSession, root: str, of: Manifest, parts: list[Part]) -> DataFrame:
    schema = T.StructType([*of.schema.fields, T.StructField(LOAD, T.LongType())])
    paths = [f"{root.rstrip('/')}/{p.folder}" for p in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _resolved(spark: SparkSession, root: str, of: Manifest, parts: list[Part], keys: list[str] | None) -> DataFrame:
    """The rows of the parts, of each key the one loaded last where deltas lie over a base."""
    over = {p.value for p in parts if p.delta}
    plain = _rows(spark, root, of, [p for p in parts if p.value not in over])
    if not over:
        return plain
    if not keys:
        raise ValueError("the table has deltas: name its keys")
    return plain.unionByName(latest_per_key(_rows(spark, root, of, [p for p in parts if p.value in over]), keys, [LOAD]))


def read(
    spark: SparkSession, root: str, keys: list[str] | None = None, keep: Callable[[str | None], bool] | None = None, version: int | None = None
) -> DataFrame:
    """The table as of a version (the current one). ``keep`` picks partition values, whose
    folders alone are read; ``keys`` are needed where deltas have not been compacted yet."""
    of = manifest(spark, root, version)
    if not of.version:
        raise FileNotFoundError(f"nothing loaded under {root}")
    parts = [p for p in of.parts if keep is None or keep(p.value)]
    return _resolved(spark, root, of, parts, keys).select(*of.schema.names)


def _merged_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Columns of the table and, behind them, those the batch brings."""
    known = {f.name: f for f in old.fields} if old else {}
    for f in new.fields:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise TypeError(f"column {f.name} is {known[f.name].dataType.simpleString()} in the table, {f.dataType.simpleString()} in the batch")
    fields = [T.StructField(f.name, f.dataType) for f in [*known.values(), *(f for f in new.fields if f.name not in known)]]
    return T.StructType(fields)


def _fitted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    have = set(rows.columns)
    return rows.select(*(F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def load(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    partition: str,
    as_of: Column | None = None,
    sort: list[str] | None = None,
    mark: str | None = None,
    batch_id: str | None = None,
) -> int:
    """Insert or update by key; only the partitions the batch touches are written again.

    The partition value must follow from the key. Of several rows with one key the latest
    by ``order`` wins; created_at and updated_at are kept as in ``keyed.upsert``. A new
    column is null in older rows; a column of another type is refused. ``mark`` and
    ``batch_id`` are stored in the same commit. Returns the number of rows loaded.
    """
    now = F.current_timestamp() if as_of is None else as_of
    before = manifest(spark, root)
    new = latest_per_key(batch, keys, order)
    stamped = lambda rows: rows.withColumns({c: now for c in ("created_at", "updated_at") if c not in rows.columns})
    schema = _merged_schema(before.schema, stamped(new).schema)
    after = replace(before, schema=schema, mark=mark or before.mark, batch=batch_id or before.batch)
    number = F.lit(before.version + 1).cast("long")
    inserted = lambda rows: _fitted(stamped(rows), schema).withColumn(LOAD, number)
    if not before.parts:
        # nothing to meet: the rows go from the dedupe into their folders
        written = _write(inserted(new), root, partition, sort)
        loaded = sum(n for _, n in written.values())
        after = replace(after, parts=tuple(Part(v, f) for v, (f, _) in written.items()))
    else:
        new = materialize(new, "load-batch")
        counts = {r["v"]: r["n"] for r in new.groupBy(F.col(f"`{partition}`").cast("string").alias("v")).agg(F.count("*").alias("n")).collect()}
        loaded = sum(counts.values())
        hit = [p for p in before.parts if p.value in counts]
        held = {p.value for p in hit}
        rows = inserted(new.where(~_within(partition, held)) if hit else new)
        if hit:
            # rows the batch does not hold keep the number of the load that brought them
            numbered = T.StructType([*schema.fields, T.StructField(LOAD, T.LongType())])
            old = _fitted(_resolved(spark, root, before, hit, keys), numbered)
            # the value follows from the key, so only rows of partitions that are there can meet an old one
            met = new.where(_within(partition, held)).withColumn(LOAD, number)
            met = _fitted(met, T.StructType([f for f in numbered.fields if f.name not in ("created_at", "updated_at")]))
            met = merge(old, met, keys, now, null_keys=True)
            rows = met.unionByName(rows) if set(counts) - held else met
        if counts:
            written = _write(rows, root, partition, sort)
            kept = [p for p in before.parts if p.value not in counts]
            after = replace(after, parts=(*kept, *(Part(v, f) for v, (f, _) in written.items())))
    if after != before:
        _commit(spark, root, after)
    return loaded


def append(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    partition: str,
    batch_id: str | None = None,
    compact_after: int = 16,
) -> int:
    """Load a micro-batch as a delta: what is written grows with the batch alone.

    A batch whose id is not beyond the last one taken was loaded before and is left out.
    Once a partition has ``compact_after`` deltas they are merged into a new base. Returns
    the number of rows loaded.
    """
    before = manifest(spark, root)
    if batch_id is not None and before.batch is not None and batch_id <= before.batch:
        return 0
    new = latest_per_key(batch, keys, order)
    schema = _merged_schema(before.schema, new.schema)
    rows = _fitted(new, schema).withColumn(LOAD, F.lit(before.version + 1).cast("long"))
    written = _write(rows, root, partition, None)
    deltas = tuple(Part(v, f, True) for v, (f, _) in written.items())
    _commit(spark, root, replace(before, schema=schema, parts=before.parts + deltas, batch=batch_id or before.batch))
    compact(spark, root, keys, partition, compact_after)
    return sum(n for _, n in written.values())


def compact(spark: SparkSession, root: str, keys: list[str], partition: str, after: int = 1) -> int:
    """Merge the deltas of partitions that have at least ``after`` of them; returns how many were."""
    before = manifest(spark, root)
    counts: dict[str | None, int] = {}
    for p in before.parts:
        counts[p.value] = counts.get(p.value, 0) + p.delta
    due = {v for v, n in counts.items() if n >= max(after, 1)}
    if due:
        rows = _resolved(spark, root, before, [p for p in before.parts if p.value in due], keys)
        written = _write(rows, root, partition, None)
        kept = tuple(p for p in before.parts if p.value not in due)
        _commit(spark, root, replace(before, parts=(*kept, *(Part(v, f) for v, (f, _) in written.items()))))
    return len(due)


def changes(spark: SparkSession, root: str, keys: list[str], since: int, partition: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows as they were, rows as they are) of the keys that loads after version ``since``
    brought or that retention dropped. Only partitions with other folders than then are read.

    With the ``partition`` column named, a partition whose rows were all brought since needs
    no look at its keys: all it had was replaced."""
    old, new = manifest(spark, root, since), manifest(spark, root)
    other = {p.value for p in set(old.parts) ^ set(new.parts)}
    there = {p.value for p in new.parts}
    changed = [p for p in new.parts if p.value in other]
    now = _resolved(spark, root, new, changed, keys)
    if any(p.delta for p in changed):
        now = materialize(now, "changed-rows")  # merged once
    brought = now.where(F.col(LOAD) > since)
    added = brought.drop(LOAD)
    if not old.version:
        return added.limit(0), added
    wide = replace(old, schema=new.schema)
    was = lambda values: _resolved(spark, root, wide, [p for p in old.parts if p.value in values], keys)
    partly = other & there
    if partition:
        stayed = now.where(F.col(LOAD) <= since).select(F.col(f"`{partition}`").cast("string").alias("v"))
        partly = {r["v"] for r in stayed.distinct().collect()}  # at most one line a folder
    removed = was(other - partly)
    if partly:
        named = brought.where(_within(partition, partly)) if partition else brought
        named = named.select(*(F.col(f"`{k}`").alias(f"_c_{k}") for k in keys))
        alike = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_c_{k}`")) for k in keys])
        removed = removed.unionByName(was(partly).join(named, alike, "left_semi"))
    return removed.drop(LOAD), added


def replace_partitions(spark: SparkSession, root: str, rows: DataFrame, partition: str, values: set[str | None], mark: str | None = None) -> None:
    """Put the rows in the place of these partitions; one that has no row is gone. Others
    keep their files."""
    before = manifest(spark, root)
    schema = _merged_schema(before.schema, rows.schema)
    written = _write(_fitted(rows, schema).withColumn(LOAD, F.lit(before.version + 1).cast("long")), root, partition, None)
    kept = tuple(p for p in before.parts if p.value not in values)
    _commit(spark, root, replace(before, schema=schema, parts=(*kept, *(Part(v, f) for v, (f, _) in written.items())), mark=mark or before.mark))


def drop_partitions(spark: SparkSession, root: str, drop: Callable[[str | None], bool]) -> list[str | None]:
    """Leave the partitions with such a value out of the next version; no row is read."""
    before = manifest(spark, root)
    gone = {p.value for p in before.parts if drop(p.value)}
    if gone:
        _commit(spark, root, replace(before, parts=tuple(p for p in before.parts if p.value not in gone)))
    return sorted(gone, key=lambda v: (v is not None, v))


def sweep(spark: SparkSession, root: str, versions: int = 2) -> int:
    """Delete data folders that none of the last ``versions`` versions names: of dropped
    partitions, merged deltas and stopped loads. Not while a load runs, nor under readers
    of older versions. Returns the number of folders deleted."""
    newest = current_version(spark, root)
    named = {p.folder for v in range(max(1, newest - versions + 1), newest + 1) for p in manifest(spark, root, v).parts}
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/data")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    deleted = 0
    for load_dir in fs.listStatus(base) if fs.exists(base) else []:
        inner = [s for s in fs.listStatus(load_dir.getPath()) if s.isDirectory()]
        stale = [s for s in inner if f"data/{load_dir.getPath().getName()}/{s.getPath().getName()}" not in named]
        for s in stale:
            fs.delete(s.getPath(), True)
        deleted += len(stale)
        if len(stale) == len(inner):
            fs.delete(load_dir.getPath(), True)
    return deleted
