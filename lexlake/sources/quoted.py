"""CSV records that span lines, read in parallel from any place of a file.

A line break is data if an odd number of quotes lies before it in the file. Quotes are
counted per byte range (the piece of a file one task reads), the counts are summed over the
ranges of a file, and each range then knows whether it begins inside a quoted field. Lines
that are whole records go on as they are; only the lines of longer records are gathered.
"""

from __future__ import annotations

import csv
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
RANGE = ["file", "start"]


@dataclass(frozen=True)
class Quoting:
    """What the quotes of the files say: does any record span lines, and a file whose last quote is not closed."""

    spans_lines: bool
    unclosed: str | None


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start of the byte range, n (rising within a range), line, quotes. Carriage
    returns stay in the line, since inside quotes they are data."""
    read = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"),
        F.col("value").alias("line"),
    ).withColumn("quotes", quotes)


def quoting(rows: DataFrame) -> Quoting:
    """One pass over the lines; one row per file comes out of the first sum."""
    odd = F.col("quotes") % 2
    per_file = rows.groupBy("file").agg(F.max(odd).alias("spans"), (F.sum(odd) % 2).alias("open"))
    r = per_file.agg(F.max("spans").alias("spans"), F.min(F.when(F.col("open") == 1, F.col("file"))).alias("file")).first()
    return Quoting(r["spans"] == 1, r["file"])


def names(spark: SparkSession, path: str, sep: str, header: bool) -> list[str]:
    """Column names from the first record of a file; as in Spark's reader, one without name
    is called after its place, and names that occur twice get their place behind them."""
    read = spark.read.option("lineSep", "\n").text(path)
    file = read.where(F.col("_metadata.file_block_start") == 0).select("_metadata.file_path").first()[0]
    of_file = read.where(F.col("_metadata.file_path") == file)
    size = 1
    while True:
        found = [r["value"] for r in of_file.take(size)]
        ends = [i for i in range(len(found)) if "".join(found[: i + 1]).count(QUOTE) % 2 == 0]
        if ends or len(found) < size:
            break
        size *= 4
    first = "\n".join(found[: ends[0] + 1])
    fields = next(csv.reader([first.removesuffix("\r")], delimiter=sep))
    if not header:
        return [f"_c{i}" for i in range(len(fields))]
    often = Counter(f.lower() for f in fields)
    return [f"_c{i}" if not f else f"{f}{i}" if often[f.lower()] > 1 else f for i, f in enumerate(fields)]


def records(rows: DataFrame, sep: str = ",") -> DataFrame:
    """file, record, first (is it the first of its file). Blank lines are no records; a file
    with a header begins with it.

    The text is shuffled once, by byte range, so a partition is bounded by the size of a
    range. A quote that does not begin or end a field makes record borders a guess; such
    a record that spans lines fails the read.
    """
    inside = Window.partitionBy(*RANGE).orderBy("n")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    local = rows.withColumn("before", before)
    # where the last record of a range begins depends on whether the range begins in quotes: keep both
    ranges = local.groupBy(*RANGE).agg(
        (F.sum("quotes") % 2).alias("parity"),
        F.max(F.when(F.col("before") == 0, F.col("n"))).alias("last0"),
        F.max(F.when(F.col("before") == 1, F.col("n"))).alias("last1"),
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    flip = F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2
    last = F.when(F.col("flip") == 0, F.col("last0")).otherwise(F.col("last1"))
    ranges = ranges.withColumn("flip", flip).withColumn("last", F.when(last.isNotNull(), F.struct("start", last.alias("n"))))
    ranges = ranges.withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
    ranges = ranges.withColumn("head", F.row_number().over(Window.partitionBy("file").orderBy("start")) == 1)

    begins = (F.col("before") + F.col("flip")) % 2 == 0
    own = F.max(F.when(F.col("begins"), F.col("n"))).over(inside)
    marked = local.join(ranges.select(*RANGE, "flip", "carried", "head"), RANGE).withColumn("begins", begins)
    marked = marked.withColumn("own", own).withColumn("first", F.col("head") & (F.row_number().over(inside) == 1))
    whole = F.col("begins") & (F.col("quotes") % 2 == 0)
    single = marked.where(whole).select("file", F.col("line").alias("record"), "first")

    record_of = F.when(F.col("own").isNotNull(), F.struct(F.col("start"), F.col("own").alias("n"))).otherwise(F.col("carried"))
    parts = marked.where(~whole).select("file", record_of.alias("at"), F.struct("start", "n", "line").alias("part"), "first")
    gathered = parts.groupBy("file", "at").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.max("first").alias("first"))
    joined = F.array_join(F.transform("parts", lambda p: p["line"]), "\n")
    longer = gathered.select("file", sure_borders(joined, sep).alias("record"), "first")

    end = F.regexp_replace("record", r"\r\z", "")
    return single.unionByName(longer).withColumn("record", end).where(F.length("record") > 0)


def sure_borders(record: Column, sep: str) -> Column:
    """The record, if every quote in it begins or ends a field or is doubled within one."""
    outer = F.regexp_replace(F.regexp_replace(record, r"\r\z", ""), '"[^"]*"', QUOTE)
    s = "".join(f"\\x{{{ord(c):x}}}" for c in sep)
    stray = outer.rlike(f'(?<!^)(?<!{s})(?<!")"|"(?!\\z)(?!{s})(?!")')
    message = F.concat(F.lit("a quote inside an unquoted field, so that record borders are unknown: "), F.substring(record, 1, 80))
    return F.when(stray, F.raise_error(message).cast("string")).otherwise(record)


def parsed(recs: DataFrame, columns: list[str], options: dict[str, str], header: bool) -> DataFrame:
    """Records as text columns. With a header, the first record of each file must name them."""
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    row = F.from_csv("record", schema, options)
    if header:
        places = ", ".join(f"c{i} string" for i in range(len(columns)))
        found = F.from_csv("record", places, options | {"mode": "PERMISSIVE"})
        same = F.lit(True)
        for i, c in enumerate(columns):
            name = F.lower(F.coalesce(found[f"c{i}"], F.lit("")))
            same &= name.isin(c.lower(), c.lower().removesuffix(str(i)), "" if c == f"_c{i}" else c.lower())
        wrong = F.raise_error(F.concat(F.lit("CSV header does not name the columns asked for: "), F.col("record"))).cast("boolean")
        recs = recs.where(F.when(~F.col("first"), True).when(same, False).otherwise(wrong))
    out = recs.select(row.alias("row")).select("row.*")
    return out.to(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
