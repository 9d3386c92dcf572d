"""Landed API pages: one JSON document per row, or one per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_pages(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON files holding one page each, with the page's file name."""
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"))


def _at(schema: T.DataType, path: list[str]) -> T.DataType | None:
    for step in path:
        if not isinstance(schema, T.StructType) or step not in schema.names:
            return None
        schema = schema[step].dataType
    return schema


def flatten(pages: DataFrame, data_path: str, keep: list[str] | None = None) -> DataFrame:
    """One row per record under the dotted path, with the kept page columns.
    A page without the path, or a schema without it, gives no rows."""
    keep = keep or []
    steps = data_path.split(".")
    found = _at(pages.schema, steps)
    if not isinstance(found, T.ArrayType):
        nothing = pages.where(F.lit(False))
        return nothing.select(*keep, F.lit(None).cast("string").alias("record"))
    return pages.select(*keep, F.explode(F.col(".".join(f"`{s}`" for s in steps))).alias("record"))


# --- entity registry ----------------------------------------------------------------

REGISTRY_PAGE = (
    "meta struct<pagination: struct<currentPage: bigint, perPage: bigint, total: bigint, lastPage: bigint>>, "
    "data array<struct<id: string, type: string, attributes: struct<lei: string, "
    "entity: struct<legalName: struct<name: string>, legalAddress: struct<country: string, city: string>, "
    "status: string, legalForm: struct<id: string>, jurisdiction: string, bic: array<string>, mic: array<string>>, "
    "registration: struct<initialRegistrationDate: string, lastUpdateDate: string>>>>"
)


def registry_counterparties(pages: DataFrame) -> DataFrame:
    """Registry records as counterparties; records without id, entity, name or
    country are left out."""
    records = flatten(pages, "data").select(
        F.col("record.id").alias("lei"), F.col("record.attributes").alias("a"), F.col("record.attributes.entity").alias("e")
    )
    named = records.select(
        "lei",
        "a",
        "e",
        F.col("e.legalName.name").alias("name"),
        F.col("e.legalAddress.country").alias("country"),
    ).where((F.col("lei") != "") & F.col("e").isNotNull() & (F.col("name") != "") & (F.col("country") != ""))
    digest = F.sha2(F.concat_ws("|", F.lit("gleif"), "lei", "name", "country"), 256)
    return named.select(
        F.concat(F.lit("LEI-"), "lei").alias("external_id"),
        "name",
        F.col("lei").alias("tax_id"),
        F.upper("country").alias("country_code"),
        F.lit(None).cast("decimal(5,2)").alias("risk_score"),
        F.struct(
            F.col("lei"),
            F.col("e.status").alias("status"),
            F.col("e.legalForm.id").alias("legal_form"),
            F.col("e.jurisdiction").alias("legal_jurisdiction"),
            F.col("a.registration.initialRegistrationDate").alias("registration_initial_date"),
            F.col("a.registration.lastUpdateDate").alias("registration_last_update"),
            F.col("e.bic").alias("bic"),
            F.col("e.mic").alias("mic"),
            digest.alias("source_hash"),
        ).alias("metadata"),
    )


def keep_pages(pages: DataFrame, number: str, max_pages: int | None) -> DataFrame:
    """The first pages in page order; None keeps all."""
    if not max_pages:
        return pages
    return pages.orderBy(F.asc_nulls_last(number)).limit(max_pages)


# --- company filings ----------------------------------------------------------------

SUBMISSION = (
    "cik bigint, name string, filings struct<recent: struct<accessionNumber: array<string>, filingDate: array<string>, "
    "reportDate: array<string>, form: array<string>, primaryDocument: array<string>, "
    "primaryDocDescription: array<string>, size: array<bigint>>>"
)
FILING_COLUMNS = [
    "accessionNumber",
    "filingDate",
    "reportDate",
    "form",
    "primaryDocument",
    "primaryDocDescription",
    "size",
]
ARCHIVE = "https://www.sec.gov/Archives/edgar/data/"


def filings_flatten(submissions: DataFrame) -> DataFrame:
    """Parallel arrays to one row per filing. The accession list sets the number
    of rows; a column that is missing or short gives nulls."""
    recent = F.col("filings.recent")
    have = _at(submissions.schema, ["filings", "recent"])
    n = F.size("filings.recent.accessionNumber")
    types = {"size": "bigint"}
    named = []
    for c in FILING_COLUMNS:
        values = recent[c] if c in have.names else F.lit(None).cast(f"array<{types.get(c, 'string')}>")
        named.append(F.coalesce(values, F.array().cast(f"array<{types.get(c, 'string')}>")).alias(c))
    zipped = F.slice(F.arrays_zip(*named), F.lit(1), F.greatest(n, F.lit(0)))
    return submissions.select("cik", F.coalesce("name", F.lit("")).alias("company_name"), F.explode(zipped).alias("f")).select(
        "cik", "company_name", *[F.col(f"f.{c}").alias(c) for c in FILING_COLUMNS]
    )


def filings_normalize(filings: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """Filings as legal documents. ``companies`` (cik, ticker, title) adds the ticker
    and stands in for a missing company name."""
    from lexlake.functions.business import form_category
    from lexlake.functions.text import parse_date

    if companies is not None:
        filings = filings.join(companies.select("cik", "ticker", "title"), "cik", "left")
    else:
        filings = filings.withColumns({"ticker": F.lit(None).cast("string"), "title": F.lit(None).cast("string")})
    rows = filings.select(
        "*",
        parse_date("filingDate").alias("d"),
        F.coalesce("ticker", F.lit("")).alias("t"),
        F.coalesce(F.nullif("company_name", F.lit("")), "title", F.lit("")).alias("company"),
    ).where((F.col("form") != "") & (F.col("accessionNumber") != "") & F.col("d").isNotNull())
    day = F.date_format("d", "yyyy-MM-dd")
    url = F.concat(
        F.lit(ARCHIVE),
        F.col("cik").cast("string"),
        F.lit("/"),
        F.replace("accessionNumber", F.lit("-"), F.lit("")),
        F.lit("/"),
        F.coalesce("primaryDocument", F.lit("")),
    )
    return rows.select(
        F.col("d").alias("document_date"),
        F.lit("sec_edgar").alias("source_system"),
        F.col("accessionNumber").alias("source_id"),
        F.sha2(F.concat_ws("|", F.lit("sec_edgar"), "accessionNumber", day), 256).alias("source_hash"),
        form_category("form").alias("document_type"),
        F.concat("company", F.lit(" ("), "t", F.lit(") — "), "form", F.lit(" filing "), day).alias("title"),
        F.col("primaryDocDescription").alias("content"),
        F.lit("US-SEC").alias("jurisdiction"),
        F.array(F.lower("form"), F.when(F.col("t") != "", F.lower("t")).otherwise(F.lit("unknown"))).alias("tags"),
        F.struct(
            F.col("cik"),
            F.col("t").alias("ticker"),
            F.col("company").alias("company_name"),
            F.col("form"),
            F.col("accessionNumber").alias("accession_number"),
            F.col("reportDate").alias("report_date"),
            F.col("size").alias("filing_size_bytes"),
            url.alias("filing_url"),
        ).alias("metadata"),
    )


def filings_filter(documents: DataFrame, since: Column | None = None, forms: list[str] | None = None) -> DataFrame:
    """Filings on or after a date and of the listed forms."""
    if since is not None:
        documents = documents.where(F.col("document_date") >= since)
    if forms:
        documents = documents.where(F.col("metadata.form").isin(*forms))
    return documents
