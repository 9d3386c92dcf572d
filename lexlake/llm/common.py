"""Helpers the document operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows in one Arrow batch; with long documents the bytes count first.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column is called so (in any case of letters)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts end to end, and where each begins (one entry more than texts)."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    begins = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[begins[0] : begins[-1]], begins - begins[0]


def map_texts(rows: DataFrame, make: Callable[[], Callable], schema: StructType | str) -> DataFrame:
    """Run a function over Arrow batches of whole rows.

    ``make`` is called once per task (models and automata are built there) and returns
    a function from a batch's columns, as a dict of Arrow arrays, to the columns of the
    result; if that has a method ``close``, it is called at the end of the task. Sets the
    size of Arrow batches for the session, as batches of whole texts must stay small.
    """
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                out = apply(dict(zip(batch.schema.names, batch.columns, strict=True)))
                # one batch, or several for a function that gives its result in parts
                for part in [out] if isinstance(out, dict) else out:
                    arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in ((part[f.name], f) for f in arrow)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        finally:
            getattr(apply, "close", lambda: None)()

    return rows.mapInArrow(run, schema)


def running(rows: DataFrame, group: list[str], order: list[str], size: str, start: str, buckets: int = 1024) -> DataFrame:
    """Add ``start``: the sum of ``size`` over the rows of the same group that come before.

    Two levels: a group's rows are dealt by hash over ``buckets`` buckets, whose sums are
    added up first (at most ``buckets`` rows for a group), then each bucket is walked on
    its own. So no task ever sees a whole group, however hot. The order of a group is
    (bucket, ``order``); rows alike in all of ``order`` take any order among themselves.
    Group columns hold no nulls.
    """
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    keys = [*group, "__bucket"]
    sums = rows.groupBy(*keys).agg(F.sum(size).alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).cast("long").alias("__base"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(sums, keys)
    return joined.withColumn(start, F.col("__base") + F.coalesce(F.sum(size).over(within), F.lit(0)).cast("long")).drop("__base", "__bucket")


def sample_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most ``rows`` labelled documents outside the held-out fold.

    Picked by hash of the id, so that each run takes the same. Of more, each label (0 or
    1) has its share of the places, a rare one a tenth of them if it fills that.
    """
    found = labels.where(F.col(label).cast("int").isin(0, 1) & ~held_out(id_col)).select(id_col, F.col(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    total = max(sum(counts.values()), 1)
    places: dict[int, int] = {}
    for k, n in sorted(counts.items(), key=lambda x: (x[1], x[0])):  # the rarer first, the other fills up
        places[k] = min(n, rows - sum(places.values()) if places else max(rows * n // total, rows // 10))
    picked = [found.where(F.col("label") == k).orderBy(F.xxhash64(id_col), id_col).limit(n) for k, n in sorted(places.items())]
    texts = docs.select(id_col, text_of(text_col).alias("text"))
    if not picked:
        return texts.withColumn("label", F.lit(None).cast("int")).limit(0)
    return texts.join(F.broadcast(reduce(DataFrame.unionByName, picked)), id_col).select(id_col, "text", "label")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
