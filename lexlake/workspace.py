"""Where jobs put intermediate tables.

Intermediate data must outlive any executor, so it goes to the shared folder the
cluster names in ``spark.checkpoint.dir``. Only a local master may fall back to a
folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a stored table for one partition of a shuffle of its rows.
PART_BYTES = 4 << 20

_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    given = spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="lexlake-")
    return _local_root


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder under the shared root."""
    return f"{shared_root(spark)}/lexlake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back, so that several consumers share one computation
    and its lineage ends at durable files."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, path: str) -> int:
    """Partitions for shuffles of a stored table's rows: by the bytes of its files, so that
    what one task sorts or adds up stays the same as the table grows, whatever number the
    session is set to; no fewer than run at a time. Files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = files.agg(F.sum("length")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
