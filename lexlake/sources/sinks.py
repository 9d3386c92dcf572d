"""Zone writers: Bronze, quarantine, append, CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_bronze(df: DataFrame, path: str, ingestion_date: Column, batch_id: str) -> None:
    """Land a batch under (ingestion_date, batch). Only this batch's folder is
    replaced, so a re-run does not add rows twice; other batches stay."""
    if "ingestion_date" not in df.columns:
        df = df.withColumn("ingestion_date", ingestion_date)
    (
        df.withColumn("_batch", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("ingestion_date", "_batch")
        .parquet(path)
    )


def read_bronze(spark: SparkSession, path: str, schema: T.StructType, day: dt.date, batch_id: str) -> DataFrame:
    """One batch as it was landed, with the columns given: other batches may have others.

    The batch id may hold any characters: it is compared as a value, with a stated type,
    since Spark escapes it in the folder's name and takes one like ``007`` for a number.
    The day's folder alone is listed.
    """
    stored = T.StructType([*[f for f in schema.fields if f.name != "_batch"], T.StructField("_batch", T.StringType())])
    return spark.read.schema(stored).parquet(f"{path}/ingestion_date={day.isoformat()}").where(F.col("_batch") == F.lit(batch_id))


def write_quarantine(rejected: DataFrame, path: str, batch_id: str, rejected_at: Column | None = None) -> None:
    """Rejected rows with their errors, one folder per batch."""
    stamped = rejected.withColumn("rejected_at", F.current_timestamp() if rejected_at is None else rejected_at)
    write_bronze(stamped, path, F.to_date("rejected_at"), batch_id)


def append_counted(df: DataFrame, path: str, columns: list[str]) -> int:
    """Append the columns in the given order; rows are counted while writing."""
    seen = Observation()
    out = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("append").parquet(path)
    return seen.get["rows"]


def append_jdbc(df: DataFrame, url: str, table: str, columns: list[str], batch_size: int = 10000, **options: str) -> int:
    """Append to a database table in parallel batches."""
    seen = Observation()
    out = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **options).mode("append").save()
    return seen.get["rows"]


def encode_text(df: DataFrame) -> DataFrame:
    """Every column as load text: nested values as JSON, dates in ISO form,
    booleans as true/false, null as null (an empty field in CSV)."""

    def one(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(c, {"ignoreNullFields": "false"})
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            # fraction only where there is one
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            exact = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            return F.when(exact.endswith(".000000"), whole).otherwise(exact)
        return c.cast("string")

    return df.select(*[one(f).alias(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with quotes only where needed and quotes doubled inside. As in the load
    format, an empty text and a null are both written as an empty field."""
    (
        encode_text(df)
        .write.mode("errorifexists")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("escapeQuotes", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )


def run_audit(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they flow through a later write."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
