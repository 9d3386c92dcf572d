"""File scans, lineage and the incremental read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexlake.sources import quoted

#: Encodings whose text can be cut at line breaks and read as UTF-8.
SPLIT_ENCODINGS = ("UTF-8", "UTF8", "US-ASCII", "ASCII")


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scan_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    whole_files: bool = False,
) -> DataFrame:
    """CSV as text columns; a malformed line fails the read.

    Typing is left to the row contracts: inferring it costs a pass over the file
    and turns numeric-looking identifiers into numbers. Files are split over tasks,
    those with line breaks in quotes too: one pass counts quotes, and only if some
    record spans lines are records put together (``quoted``). Quotes must stand
    around whole fields and be doubled within. With ``whole_files`` a task reads a
    file from its start, for other uses of quotes; encodings in which a quote or a
    line break is not its ASCII byte are always read so. Without ``columns`` only the
    header is read to name them.
    """
    options = {"sep": sep, "mode": "FAILFAST", "quote": '"', "escape": '"'}
    reader = spark.read.options(**options).option("header", header).option("encoding", encoding).option("enforceSchema", False)
    if not whole_files and encoding.upper() in SPLIT_ENCODINGS:
        rows = quoted.lines(spark, path)
        found = quoted.quoting(rows)
        if found.unclosed:
            raise ValueError(f"A quote is not closed in {found.unclosed}")
        if found.spans_lines:
            named = columns or quoted.names(spark, path, sep, header)
            return quoted.parsed(quoted.records(rows, sep), named, options | {"multiLine": "true"}, header)
    reader = reader.option("multiLine", whole_files or encoding.upper() not in SPLIT_ENCODINGS)
    if columns:
        return reader.schema(text_schema(columns)).csv(path)
    return reader.option("inferSchema", False).csv(path)


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def tag_lineage(df: DataFrame, batch_id: str, source_system: str, source_name: str, extracted_at: Column | None = None) -> DataFrame:
    """Stamp where and when the rows came in. Columns read from files also get the
    name of the file they came from."""
    stamped = {
        "_batch_id": F.lit(batch_id),
        "_source_system": F.lit(source_system),
        "_source_name": F.lit(source_name),
        "_extracted_at": F.current_timestamp() if extracted_at is None else extracted_at,
    }
    return df.withColumns(stamped)


def with_source_file(df: DataFrame) -> DataFrame:
    """Add ``_source_file``; only on a frame that reads files."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"))


def newer_than(df: DataFrame, mark_column: str, last: Column, overlap: Column | None = None) -> DataFrame:
    """Rows beyond the stored mark. A row that arrives late with the mark's own
    value is missed by ``>``; pass an ``overlap`` interval and load by key."""
    bound = last - overlap if overlap is not None else last
    return df.where(F.col(mark_column) > bound)


def new_mark(df: DataFrame, mark_column: str, last: Column) -> DataFrame:
    """One row with the mark after this read; unchanged if nothing was read."""
    return df.agg(F.coalesce(F.greatest(F.max(mark_column), last), last).alias("watermark"))


def jdbc_newer_than(
    spark: SparkSession,
    url: str,
    table: str,
    mark_column: str,
    last: str,
    split_column: str,
    bounds: tuple[int, int],
    partitions: int,
    fetch_size: int = 10000,
    **options: str,
) -> DataFrame:
    """Incremental read of a database table in parallel ranges of ``split_column``.
    The mark filter is pushed into the database's own query."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=split_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(partitions),
        fetchsize=str(fetch_size),
        **options,
    )
    return reader.load().where(F.col(mark_column) > F.to_timestamp(F.lit(last)))


def list_files(spark: SparkSession, prefix: str, glob: str = "*") -> DataFrame:
    """Files of any kind below a prefix with size and time; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.load(prefix).select("path", F.col("length").alias("bytes"), "modificationTime")


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First n rows in a stated order (a top-n, no full sort)."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


# --- registry: a source is a function from session and options to a DataFrame ------

SOURCES: dict[str, Callable[..., DataFrame]] = {"csv": scan_csv, "parquet": scan_parquet, "jdbc": jdbc_newer_than}


def register_source(name: str, read: Callable[..., DataFrame]) -> None:
    SOURCES[name] = read


def read_source(spark: SparkSession, name: str, **options) -> DataFrame:
    if name not in SOURCES:
        raise ValueError(f"Unknown source: {name}; expected one of {', '.join(SOURCES)}")
    return SOURCES[name](spark, **options)
