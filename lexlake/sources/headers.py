"""Tell from their header rows which kind of feed landed files are."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexlake.functions.text import header_key

# Recognized headers per feed, in the order feeds are tried.
VOCABULARY = {
    "legal_documents": (
        "doc_id", "source_id", "document_id", "id",
        "date", "document_date", "filing_date",
        "source_system", "source",
        "type", "document_type", "form",
        "title", "name",
        "content", "body", "description",
        "jurisdiction", "country",
        "tags",
    ),
    "counterparties": (
        "external_id", "counterparty_id", "id",
        "name", "legal_name", "company_name",
        "tax_id", "ein", "vat", "lei",
        "country_code", "country",
        "risk_score", "risk", "score",
    ),
    "transactions": (
        "transaction_date", "date", "txn_date",
        "contract_number", "contract_id",
        "counterparty_external_id", "counterparty_id", "external_id",
        "amount", "value",
        "currency", "ccy",
        "transaction_type", "type", "txn_type",
        "reference", "ref", "txn_ref",
        "source_system", "source",
    ),
}
CONFIDENT = 0.5


def header_rows(lines: DataFrame, file: str = "file", line: str = "header", sep: str = ",") -> DataFrame:
    """(file, headers) from one header line per file. The separator is taken as it is;
    inside double quotes it does not separate."""
    outside = re.escape(sep) + '(?=(?:[^"]*"[^"]*")*[^"]*$)'
    bare = F.transform(F.split(line, outside), lambda h: F.regexp_replace(h, '^\\s*"(.*)"\\s*$', "$1"))
    return lines.select(F.col(file).alias("file"), F.transform(bare, lambda h: F.replace(h, F.lit('""'), F.lit('"'))).alias("headers"))


def detect(headers: DataFrame) -> DataFrame:
    """Best feed per file. The score is the recognized share of the headers; the
    higher one wins, on a tie the feed tried first. Works row by row on the header
    array: the vocabulary is a constant and nothing is shuffled."""
    keys = F.transform("headers", lambda h: header_key(h))
    n = F.size("headers")
    scored = headers.withColumn("keys", keys)
    pairs = F.zip_with("headers", "keys", lambda h, k: F.struct(h.alias("h"), k.alias("k")))
    best = F.struct(F.lit(0.0).alias("score"), F.lit("unknown").alias("schema"), F.array().cast("array<string>").alias("matched"))
    for name, words in VOCABULARY.items():
        known = F.array(*[F.lit(w) for w in words])
        hit = F.transform(
            F.filter(pairs, lambda x: F.array_contains(known, x["k"])),
            lambda x: x["h"],
        )
        score = F.when(n > 0, F.size(hit).cast("double") / n).otherwise(F.lit(0.0))
        candidate = F.struct(score.alias("score"), F.lit(name).alias("schema"), hit.alias("matched"))
        scored = scored.withColumn(f"_{name}", candidate)
        best = F.when(F.col(f"_{name}.score") > best["score"], F.col(f"_{name}")).otherwise(best)
    return scored.withColumn("b", best).select(
        "file",
        F.col("b.schema").alias("schema"),
        F.round("b.score", 6).alias("score"),
        (F.col("b.score") >= CONFIDENT).alias("confident"),
        F.col("b.matched").alias("matched"),
        unknown_headers(F.col("headers"), F.col("b.matched")).alias("unknown"),
    )


def unknown_headers(headers, matched):
    """Headers that were not matched, in file order, repeats kept."""
    return F.filter(headers, lambda h: ~F.array_contains(matched, h))


def detect_by_position(header_table: DataFrame) -> DataFrame:
    """Same answer from a long table (file, position, header), e.g. a catalog of
    millions of landed files: join the vocabulary, count, take the best."""
    spark = header_table.sparkSession
    words = spark.createDataFrame(
        [(i, s, w) for i, (s, ws) in enumerate(VOCABULARY.items()) for w in ws], "rank int, schema string, word string"
    )
    # the vocabulary is a constant of this module, well under a megabyte
    hits = header_table.withColumn("word", header_key("header")).join(F.broadcast(words), "word")
    totals = header_table.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    counted = hits.groupBy("file", "rank", "schema").agg(F.count(F.lit(1)).alias("m"))
    w = W.partitionBy("file").orderBy(F.desc("m"), F.asc("rank"))
    best = counted.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    return totals.join(best, "file", "left").select(
        "file",
        F.coalesce("schema", F.lit("unknown")).alias("schema"),
        F.round(F.coalesce(F.col("m") / F.col("n"), F.lit(0.0)), 6).alias("score"),
    )
