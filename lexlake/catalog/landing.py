"""Registered scans, landed pages, sinks and arrival-driven ingestion.

Sinks write to a fresh folder under the shared root and are read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.catalog.registry import query
from lexlake.catalog.views import Views, text_of
from lexlake.contracts import TRANSACTION
from lexlake.operators import keyed, partitions
from lexlake.operators.validate import apply_contract, rejected_rows
from lexlake.plans import staging
from lexlake.sources import files, headers, pages, sinks
from lexlake.streaming import arrival
from lexlake.workspace import new_dir

MARK = dt.datetime(2024, 1, 15)


def filings(v: Views) -> DataFrame:
    parsed = v.submission_pages().select("page", F.from_json("body", pages.SUBMISSION).alias("b")).select("page", "b.*")
    return pages.filings_flatten(parsed)


@query(
    "scan_csv",
    """SELECT contract_number, counterparty_external_id, start_date, end_date, total_value, nullif(currency, '') AS currency,
              status, 'as "' || status || '",' || chr(10) || chr(13) || chr(10) || contract_number || ' "' AS note
       FROM v_raw_contracts""",
)
def _(v):
    out = new_dir(v.spark, "csv")
    note = F.concat(F.lit('as "'), "status", F.lit('",\n\r\n'), "contract_number", F.lit(' "'))
    rows = v.raw_contracts().withColumn("note", note)
    sinks.write_csv(rows, out)
    return files.scan_csv(v.spark, out, rows.columns)


@query("scan_parquet_columns", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(v):
    return files.scan_parquet(v.spark, f"{v.sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query(
    "incremental_scan",
    """SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
       WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
)
def _(v):
    fresh = files.newer_than(v.table("events"), "ts", F.lit(MARK).cast("timestamp_ntz"))
    return fresh.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query(
    "watermark_state",
    """WITH marks AS (SELECT 'p' || (user_id % 4)::VARCHAR AS pipeline_name, max(ts) AS watermark FROM events GROUP BY 1)
       SELECT pipeline_name, strftime(watermark, '%Y-%m-%d %H:%M:%S.%f') AS watermark FROM marks
       UNION ALL SELECT 'idle', '2020-01-01 00:00:00.000000'""",
)
def _(v):
    events = v.table("events").select(
        F.concat(F.lit("p"), text_of(F.col("user_id") % 4)).alias("pipeline_name"), F.col("ts").alias("watermark")
    )
    early = events.where(F.col("watermark") <= F.lit(MARK).cast("timestamp_ntz"))
    state = early.groupBy("pipeline_name").agg(F.max("watermark").alias("watermark"))
    marks = events.groupBy("pipeline_name").agg(F.max("watermark").alias("watermark"))
    state = keyed.advance_watermark(state, marks)
    default = F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")
    rows = state.unionByName(keyed.watermark_rows(state, "idle", default))
    return rows.select("pipeline_name", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("watermark"))


@query(
    "json_pages_flatten",
    """SELECT event_id AS page, event_id * 10 + i AS id, event_type || '-' || i::VARCHAR AS label
       FROM (SELECT event_id, event_type, unnest(range(0, event_id % 4 + 1)) AS i FROM events) WHERE event_id % 10 <> 0""",
)
def _(v):
    shape = "result struct<items: array<struct<id: bigint, label: string>>>"
    parsed = v.api_pages().select("page", F.from_json("body", shape).alias("b")).select("page", "b.*")
    return pages.flatten(parsed, "result.items", ["page"]).select("page", "record.*")


@query(
    "lei_records_flatten",
    """SELECT 'LEI-' || lei AS external_id, name, lei AS tax_id, upper(country) AS country_code, 'ACTIVE' AS status,
              legal_form, '2012-06-06' AS registered,
              sha256('gleif|' || lei || '|' || name || '|' || country) AS source_hash
       FROM v_registry WHERE lei <> '' AND has_entity AND name <> '' AND country <> ''""",
)
def _(v):
    parsed = v.registry_pages().select("page", F.from_json("body", pages.REGISTRY_PAGE).alias("b")).select("page", "b.*")
    return pages.registry_counterparties(parsed).select(
        "external_id",
        "name",
        "tax_id",
        "country_code",
        F.col("metadata.status").alias("status"),
        F.col("metadata.legal_form").alias("legal_form"),
        F.col("metadata.registration_initial_date").alias("registered"),
        F.col("metadata.source_hash").alias("source_hash"),
    )


@query(
    "filings_flatten",
    """SELECT cik, company_name, accession, filing_date, report_date, form, document, description, size FROM v_filings""",
)
def _(v):
    return filings(v).select(
        "cik",
        "company_name",
        F.col("accessionNumber").alias("accession"),
        F.col("filingDate").alias("filing_date"),
        F.col("reportDate").alias("report_date"),
        "form",
        F.col("primaryDocument").alias("document"),
        F.col("primaryDocDescription").alias("description"),
        "size",
    )


NORMALIZED_SQL = """
    SELECT filing_date::DATE AS document_date, accession AS source_id,
           sha256('sec_edgar|' || accession || '|' || filing_date) AS source_hash,
           coalesce(nullif(company_name, ''), title) || ' (' || coalesce(ticker, '') || ') — ' || form || ' filing '
             || filing_date AS title,
           description AS content, 'US-SEC' AS jurisdiction,
           lower(form) || ',' || coalesce(lower(ticker), 'unknown') AS tags, form, size AS filing_size_bytes,
           'https://www.sec.gov/Archives/edgar/data/' || cik::VARCHAR || '/' || replace(accession, '-', '') || '/'
             || document AS filing_url
    FROM v_filings JOIN v_companies USING (cik)
    WHERE form <> '' AND filing_date <> 'pending'"""


def normalized(v: Views) -> DataFrame:
    return pages.filings_normalize(filings(v), v.companies())


def _flat(documents: DataFrame) -> DataFrame:
    return documents.select(
        "document_date",
        "source_id",
        "source_hash",
        "title",
        "content",
        "jurisdiction",
        F.array_join("tags", ",").alias("tags"),
        F.col("metadata.form").alias("form"),
        F.col("metadata.filing_size_bytes").alias("filing_size_bytes"),
        F.col("metadata.filing_url").alias("filing_url"),
    )


@query("filings_normalize", NORMALIZED_SQL)
def _(v):
    return _flat(normalized(v))


@query(
    "filings_filter",
    f"""SELECT document_date, source_id, form FROM ({NORMALIZED_SQL})
        WHERE document_date >= DATE '1998-01-01' AND form IN ('10-K', '10-Q')""",
)
def _(v):
    kept = pages.filings_filter(normalized(v), F.lit(dt.date(1998, 1, 1)), ["10-K", "10-Q"])
    return kept.select("document_date", "source_id", F.col("metadata.form").alias("form"))


@query(
    "lineage_tag",
    """SELECT doc_id, lang, 'batch-1' AS _batch_id, 'documents' AS _source_system, 'sample' AS _source_name,
              '2024-06-01' AS extracted_on, true AS has_file FROM documents""",
)
def _(v):
    read = files.with_source_file(v.table("documents"))
    tagged = files.tag_lineage(read, "batch-1", "documents", "sample", F.lit(dt.datetime(2024, 6, 1)))
    return tagged.select(
        "doc_id",
        "lang",
        "_batch_id",
        "_source_system",
        "_source_name",
        F.date_format("_extracted_at", "yyyy-MM-dd").alias("extracted_on"),
        F.col("_source_file").isNotNull().alias("has_file"),
    )


@query(
    "bronze_write",
    """SELECT source_id, title, DATE '2024-06-01' AS ingestion_date, b AS _batch
       FROM v_legal_documents, (VALUES ('a'), ('b')) AS t(b)""",
)
def _(v):
    out = new_dir(v.spark, "bronze")
    rows = v.legal_documents().select("source_id", "title")
    day = F.lit(dt.date(2024, 6, 1))
    # the second write of batch a replaces the first; batch b is added
    for batch in ("a", "a", "b"):
        sinks.write_bronze(rows, out, day, batch)
    return v.spark.read.parquet(out).select("source_id", "title", "ingestion_date", "_batch")


@query(
    "quarantine_write",
    """SELECT transaction_date, amount, currency, reference, 'Transaction' AS schema, '2024-06-01' AS rejected_on,
              CAST((transaction_date = 'not-a-date') AS INTEGER) + CAST((amount = '0') AS INTEGER)
                + CAST((currency = '') AS INTEGER) AS n_errors
       FROM v_raw_transactions WHERE transaction_date = 'not-a-date' OR amount = '0' OR currency = ''""",
)
def _(v):
    out = new_dir(v.spark, "quarantine")
    bad = rejected_rows(apply_contract(v.raw_transactions(), TRANSACTION), TRANSACTION)
    sinks.write_quarantine(bad, out, "run-1", F.lit(dt.datetime(2024, 6, 1)))
    back = v.spark.read.parquet(out)
    raw = lambda c: F.get_json_object("raw", f"$.{c}").alias(c)
    return back.select(
        raw("transaction_date"),
        raw("amount"),
        raw("currency"),
        raw("reference"),
        "schema",
        F.date_format("rejected_at", "yyyy-MM-dd").alias("rejected_on"),
        F.size("errors").alias("n_errors"),
    )


@query(
    "bulk_append",
    """SELECT contract_number, total_value, (SELECT 2 * count(*) FROM v_contracts) AS rows_written
       FROM v_contracts, (VALUES (1), (2)) AS t(i)""",
)
def _(v):
    out = new_dir(v.spark, "append")
    written = sum(sinks.append_counted(v.contracts(), out, ["contract_number", "total_value"]) for _ in range(2))
    return v.spark.read.parquet(out).select("*", F.lit(written).cast("bigint").alias("rows_written"))


@query(
    "json_encode_sink",
    """SELECT document_id::VARCHAR AS document_id, document_date::VARCHAR AS document_date, content,
              '["' || lang || '","' || source || '"]' AS tags,
              strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') AS ingested_at,
              CASE WHEN document_id % 2 = 0 THEN 'true' ELSE 'false' END AS even,
              CASE WHEN document_id % 5 <> 0 THEN 'a "quoted", text' END AS note
       FROM v_legal_documents""",
)
def _(v):
    out = new_dir(v.spark, "encoded")
    rows = v.legal_documents().select(
        "document_id",
        "document_date",
        "content",
        "tags",
        "ingested_at",
        (F.col("document_id") % 2 == 0).alias("even"),
        F.when(F.col("document_id") % 5 != 0, F.lit('a "quoted", text')).alias("note"),
    )
    sinks.write_csv(rows, out)
    return files.scan_csv(v.spark, out, rows.columns)


@query(
    "bronze_to_silver_job",
    """SELECT upper(document_type) AS document_type, trim(jurisdiction) AS jurisdiction, source_system, source_id,
              document_date, sha256(source_system || '|' || source_id || '|' || document_date::VARCHAR) AS source_hash,
              replace(trim(upper(title)), 'ẞ', 'SS') AS title
       FROM v_legal_documents""",
)
def _(v):
    docs = v.legal_documents().select(
        "source_system", "source_id", "document_date", "document_type", "title", "jurisdiction", "content", "ingested_at"
    )
    # every document landed twice, the second time in other spelling
    again = docs.withColumn("document_type", F.lower("document_type")).withColumn(
        "jurisdiction", F.concat(F.lit(" "), "jurisdiction")
    )
    silver = staging.bronze_to_silver(docs.unionByName(again))
    out = new_dir(v.spark, "silver")
    keyed.write_partitioned(partitions.with_month(silver, "document_date"), out, "month", sort=["document_date"])
    return v.spark.read.parquet(out).select(
        "document_type", "jurisdiction", "source_system", "source_id", "document_date", "source_hash", "title"
    )


@query(
    "arrival_stream",
    "SELECT event_id, user_id, event_type, value, true AS has_file FROM events",
)
def _(v):
    schema = v.table("events").schema
    out, state = new_dir(v.spark, "arrived"), new_dir(v.spark, "arrival-state")
    # the glob matches the table whether it is one file or a folder of files
    stream = arrival.arrivals(v.spark, f"{v.sf_dir}/events.parque[t]", schema)
    for _ in range(2):  # the second run finds nothing new
        arrival.ingest(stream, state, arrival.land_by_batch(out)).awaitTermination()
    return v.spark.read.parquet(out).select(
        "event_id", "user_id", "event_type", "value", F.col("_source_file").isNotNull().alias("has_file")
    )


@query("zone_inventory", "SELECT count(*) AS rows, true AS has_bytes FROM lineitem")
def _(v):
    listed = partitions.zone_files(v.table("lineitem"))
    return listed.agg(
        F.sum("rows").alias("rows"), (F.min("bytes") > 0).alias("has_bytes")
    )


HEADER_SQL = """
    vocabulary AS (SELECT * FROM (VALUES %s) AS t(rank, schema, word)),
    words AS (SELECT file, header, pos, h, replace(replace(lower(trim(h)), ' ', '_'), '-', '_') AS word
              FROM (SELECT file, header, unnest(string_split(header, ',')) AS h,
                           unnest(range(0, len(string_split(header, ',')))) AS pos FROM v_header_lines)),
    totals AS (SELECT file, count(*) AS n FROM words GROUP BY 1),
    hits AS (SELECT file, rank, schema, count(*) AS m FROM words JOIN vocabulary USING (word) GROUP BY 1, 2, 3),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY m DESC, rank) AS rn FROM hits)
             WHERE rn = 1)""" % ", ".join(
    f"({i}, '{s}', '{w}')" for i, (s, ws) in enumerate(headers.VOCABULARY.items()) for w in ws
)


@query(
    "csv_schema_detect",
    f"""WITH {HEADER_SQL},
        marked AS (SELECT w.file, w.pos, w.h, EXISTS (SELECT 1 FROM vocabulary x WHERE x.word = w.word AND x.rank = b.rank) AS ok
                   FROM words w LEFT JOIN best b ON b.file = w.file)
        SELECT t.file, coalesce(b.schema, 'unknown') AS schema, round(coalesce(m, 0) / n, 6) AS score,
               coalesce(m, 0) / n >= 0.5 AS confident,
               coalesce(string_agg(k.h, '|' ORDER BY k.pos) FILTER (WHERE k.ok), '') AS matched,
               coalesce(string_agg(k.h, '|' ORDER BY k.pos) FILTER (WHERE NOT k.ok), '') AS unknown
        FROM totals t LEFT JOIN best b USING (file) JOIN marked k ON k.file = t.file
        GROUP BY t.file, b.schema, m, n""",
)
def _(v):
    found = headers.detect(headers.header_rows(v.header_lines()))
    return found.withColumn("matched", F.array_join("matched", "|")).withColumn("unknown", F.array_join("unknown", "|"))


@query(
    "csv_schema_detect_long",
    f"""WITH {HEADER_SQL}
        SELECT t.file, coalesce(b.schema, 'unknown') AS schema, round(coalesce(m, 0) / n, 6) AS score
        FROM totals t LEFT JOIN best b USING (file)""",
)
def _(v):
    long = v.header_lines().select("file", F.posexplode(F.split("header", ",")).alias("position", "header"))
    return headers.detect_by_position(long)


@query(
    "unknown_headers",
    f"""WITH {HEADER_SQL}
        SELECT file, string_agg(h, '|' ORDER BY pos) AS unknown FROM words
        WHERE word NOT IN (SELECT word FROM vocabulary) GROUP BY file""",
)
def _(v):
    """Headers no feed knows at all."""
    every = F.array(*[F.lit(w) for w in sorted({w for ws in headers.VOCABULARY.values() for w in ws})])
    names = F.split("header", ",")
    known = F.filter(names, lambda h: F.array_contains(every, headers.header_key(h)))
    return (
        v.header_lines()
        .select("file", headers.unknown_headers(names, known).alias("u"))
        .where(F.size("u") > 0)
        .select("file", F.array_join("u", "|").alias("unknown"))
    )
