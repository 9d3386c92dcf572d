"""Domain views over the benchmark tables, in Spark and in SQL.

Each view is defined twice, as a DataFrame and as the SQL text the checks use, so
both sides of a comparison start from the same rows. Modulo terms below assign
attribute values; no view leaves rows out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.functions.keys import pipe_hash
from lexlake.workspace import parts_for

AS_OF = dt.date(2001, 6, 30)
REGULATIONS_AS_OF = dt.date(2003, 1, 1)

CURRENCIES = ["USD", "EUR", "GBP", "BRL", "MXN"]
LANGS = ["en", "de", "es", "fr"]
DOC_TYPES = ["JUDGMENT", "REGULATION", "CONTRACT", "NOTICE", "FILING", "DECREE"]
TXN_SOURCES = ["erp:sap", "erp:oracle", "bank:wire"]
PREFIXES = ["LEI-", "CP-", "X-"]
ENTITY_STATUS = ["ACTIVE", "INACTIVE", "DISSOLVED", "SUSPENDED", "ACTIVE"]
FORMS = ["10-K", "10-Q", "8-K", "DEF 14A", "S-1", "4", "13F-HR", "20-F", "SC 13D", "ARS", "10-K/A"]
HEADER_LINES = [
    "doc_id,date,source_system,type,title,content,jurisdiction",
    "External ID,Name,Tax-ID,country_code,risk_score",
    "transaction_date,contract_number,counterparty_external_id,amount,currency,transaction_type,reference,source_system",
    "id,name,date,colour,shape,weight,height",
    "alpha,beta,gamma",
    " ID ,Country,Value,Type",
]


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_pick(values: list[str], index: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{listed}])[({index}) + 1]"


def text_of(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Views:
    """Views over one data folder; every method builds a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")
        self._parts: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def parts(self, name: str) -> int:
        """Partitions for shuffles of a table's rows."""
        if name not in self._parts:
            self._parts[name] = parts_for(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._parts[name]

    def rows(self, name: str) -> DataFrame:
        """A table in front of costly row work."""
        return self.table(name)

    # --- parties ----------------------------------------------------------------

    def counterparties(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("counterparty_id"),
            external_id(k).alias("external_id"),
            F.col("c_name").alias("name"),
            F.when(k % 10 != 0, F.concat(F.lit("TAX-"), text_of(k))).alias("tax_id"),
            F.concat(F.lit("N"), F.char(F.lit(65) + F.col("c_nationkey"))).alias("country_code"),
            F.when(k % 7 != 0, risk_score(F.col("c_acctbal"))).alias("risk_score"),
            F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("metadata"),
        )

    def legal_entities(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("entity_id"),
            F.concat(F.lit("TAX-"), text_of(k)).alias("tax_id"),
            F.col("c_name").alias("legal_name"),
            F.col("c_mktsegment").alias("entity_type"),
            pick(LANGS, k % 4).alias("jurisdiction"),
            F.date_add(F.lit(dt.date(2000, 1, 1)), (k % 5000).cast("int")).alias("registration_date"),
            pick(ENTITY_STATUS, k % 5).alias("status"),
        )

    def contracts(self) -> DataFrame:
        k = F.col("o_orderkey")
        start = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            k.alias("contract_id"),
            F.concat(F.lit("CT-"), text_of(k)).alias("contract_number"),
            F.col("o_custkey").alias("counterparty_id"),
            external_id(F.col("o_custkey")).alias("counterparty_external_id"),
            start.alias("start_date"),
            F.date_add(start, (k % 1095).cast("int")).alias("end_date"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("total_value"),
            pick(CURRENCIES, k % 5).alias("currency"),
            F.when(F.col("o_orderstatus") == "F", "EXPIRED")
            .when(F.col("o_orderstatus") == "O", "ACTIVE")
            .otherwise("DRAFT")
            .alias("status"),
        )

    # --- transactions -----------------------------------------------------------

    def transaction_lines(self, heavy: bool = False) -> DataFrame:
        """Transactions without the counterparty: no join needed. ``heavy`` says that
        costly row work follows."""
        return self._lines(self.rows("lineitem") if heavy else self.table("lineitem"))

    def _lines(self, lines: DataFrame, *more: str) -> DataFrame:
        flag, status, k = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_orderkey")
        day = F.col("l_shipdate").cast("date")
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        reference = F.concat(F.lit("TXN-"), text_of(k), F.lit("-"), text_of("l_linenumber"))
        source = pick(TXN_SOURCES, F.col("l_suppkey") % 3)
        return lines.select(
            F.sha2(F.concat_ws("|", source, reference, text_of(day)), 256).alias("transaction_id"),
            day.alias("transaction_date"),
            k.alias("contract_id"),
            F.when(flag == "R", (-price).cast("decimal(18,2)")).otherwise(price).alias("amount"),
            pick(CURRENCIES, k % 5).alias("currency"),
            F.when(flag == "A", "INVOICE")
            .when(flag == "N", "PAYMENT")
            .when(status == "F", "REFUND")
            .otherwise("FEE")
            .alias("transaction_type"),
            reference.alias("reference"),
            source.alias("source_system"),
            (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"),
            F.col("l_partkey").alias("line_no"),
            (k * 10 + F.col("l_linenumber")).alias("k"),
            *more,
        )

    def transactions(self, heavy: bool = False) -> DataFrame:
        """Lines meet their orders as they are stored: hashes, references and labels are
        worked out behind the join, so its shuffle does not carry them. Its partitions
        follow the size of the table, so that a task sorts no more of a larger one."""
        lines = self.rows("lineitem") if heavy else self.table("lineitem")
        owner = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("counterparty_id"))
        parts = self.parts("lineitem")
        joined = lines.repartition(parts, "l_orderkey").join(owner.repartition(parts, "l_orderkey"), "l_orderkey")
        rows = self._lines(joined, "counterparty_id")
        return rows.select("contract_id", *[c for c in rows.columns if c != "contract_id"])

    # --- documents and regulations ------------------------------------------------

    def legal_documents(self) -> DataFrame:
        k = F.col("doc_id")
        named = self.table("documents").select(
            k.alias("document_id"),
            F.date_add(F.lit(dt.date(2022, 1, 1)), (k % 1000).cast("int")).alias("document_date"),
            F.when(F.col("source") == "src0", "sec_edgar").otherwise(F.col("source")).alias("source_system"),
            F.concat(F.lit("DOC-"), text_of(k)).alias("source_id"),
            pick(DOC_TYPES, k % 6).alias("document_type"),
            F.substring_index("text", "\n", 1).alias("title"),
            F.col("text").alias("content"),
            F.col("lang").alias("jurisdiction"),
            F.array("lang", "source").alias("tags"),
            F.concat(F.lit('{"regulation_code":"R'), text_of(k % 50), F.lit('"}')).alias("metadata"),
            (k % 200).alias("entity_id"),
            F.concat(F.lit(" TAX-"), text_of(k % 200)).alias("entity_tax_id"),
        )
        stamp = F.col("document_date").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("document_id") % 86400))
        return named.withColumns(
            {"source_hash": pipe_hash("source_system", "source_id", "document_date"), "ingested_at": stamp}
        )

    def regulations(self) -> DataFrame:
        """The part with the smallest key per code and jurisdiction."""
        k = F.col("p_partkey")
        keyed = self.table("part").select(
            F.concat(F.lit("R"), text_of(k % 50)).alias("code"),
            pick(LANGS, k % 4).alias("jurisdiction"),
            F.struct(k.alias("k"), F.col("p_brand").alias("b"), F.col("p_size").alias("s"), F.col("p_name").alias("n")).alias("p"),
        )
        first = keyed.groupBy("code", "jurisdiction").agg(F.min("p").alias("p"))
        start = F.date_add(F.lit(dt.date(1995, 1, 1)), F.col("p.s") * 30)
        return first.select(
            F.col("p.k").alias("regulation_id"),
            "code",
            F.col("p.n").alias("title"),
            "jurisdiction",
            start.alias("effective_from"),
            F.when(F.col("p.k") % 3 != 0, F.date_add(start, 2000)).alias("effective_to"),
            F.col("p.b").alias("category"),
        )

    # --- dated history -----------------------------------------------------------

    def band_feed(self) -> DataFrame:
        """Change feed: the priority band of a counterparty on each order day."""
        return self.table("orders").select(
            external_id(F.col("o_custkey")).alias("external_id"),
            F.col("o_custkey").alias("counterparty_id"),
            F.col("o_orderpriority").alias("band"),
            F.col("o_orderdate").cast("date").alias("effective"),
            F.col("o_orderkey").alias("seq"),
        )

    def activity_feed(self) -> DataFrame:
        """Change feed with several changes of a key within a day."""
        return self.table("events").select(
            F.col("user_id"),
            F.col("event_type").alias("band"),
            F.col("ts").cast("date").alias("effective"),
            F.col("ts"),
            F.col("event_id").alias("seq"),
        )

    def dim_counterparty(self) -> DataFrame:
        from lexlake.operators.scd2 import from_feed

        return from_feed(self.band_feed(), "external_id", ["band"], "effective", ["seq"]).drop("seq")

    def dim_counterparty_named(self) -> DataFrame:
        """History with the name as of the version: the band is part of the name."""
        cp = self.counterparties().select("counterparty_id", F.col("name").alias("base"), "country_code")
        return (
            self.dim_counterparty()
            .join(cp, "counterparty_id")
            .withColumn("name", F.concat("base", F.lit(" / "), "band"))
            .drop("base", "counterparty_id")
        )

    # --- raw feeds with deterministic faults -----------------------------------------

    def raw_transactions(self) -> DataFrame:
        k = F.col("k")
        ref = F.col("reference")
        return self.transactions(heavy=True).select(
            F.when(k % 83 == 0, "not-a-date").otherwise(text_of("transaction_date")).alias("transaction_date"),
            F.concat(F.lit("CT-"), text_of("contract_id")).alias("contract_number"),
            external_id(F.col("counterparty_id")).alias("counterparty_external_id"),
            F.when(k % 89 == 0, "0").otherwise(text_of("amount")).alias("amount"),
            F.when(k % 97 == 0, "").when(k % 5 == 0, F.lower("currency")).otherwise(F.col("currency")).alias("currency"),
            F.when(k % 2 == 0, F.lower("transaction_type")).otherwise(F.col("transaction_type")).alias("transaction_type"),
            F.when(k % 3 == 0, F.concat(F.lit(" \t"), ref, F.lit("  "))).otherwise(ref).alias("reference"),
            "source_system",
        )

    def raw_documents(self) -> DataFrame:
        k = F.col("document_id")
        blank = k % 20 == 0
        value = lambda c: F.when(~blank, c)
        title = F.col("title")
        return self.legal_documents().select(
            value(F.col("source_id")).alias("doc_id"),
            value(text_of("document_date")).alias("date"),
            value(F.col("source_system")).alias("source_system"),
            value(F.when(k % 2 == 0, F.lower("document_type")).otherwise(F.col("document_type"))).alias("type"),
            value(F.when(k % 3 == 0, F.concat(F.lit("  "), title, F.lit(" "))).otherwise(title)).alias("title"),
            value(F.col("content")).alias("content"),
            value(F.col("jurisdiction")).alias("jurisdiction"),
        )

    def raw_counterparties(self) -> DataFrame:
        k = F.col("counterparty_id")
        return self.counterparties().select(
            F.when(k % 3 == 0, F.concat(F.lit(" "), "external_id")).otherwise(F.col("external_id")).alias("external_id"),
            F.when(k % 47 == 0, "   ").otherwise(F.col("name")).alias("name"),
            "tax_id",
            F.when(k % 31 == 0, "N").when(k % 2 == 0, F.lower("country_code")).otherwise(F.col("country_code")).alias("country_code"),
            F.when(k % 53 == 0, "150").when(k % 59 == 0, "abc").otherwise(text_of("risk_score")).alias("risk_score"),
        )

    def raw_contracts(self) -> DataFrame:
        k = F.col("contract_id")
        return self.contracts().select(
            "contract_number",
            "counterparty_external_id",
            F.when(k % 73 == 0, "2001-13-45").otherwise(text_of("start_date")).alias("start_date"),
            F.when(k % 61 == 0, text_of(F.date_sub("start_date", 1))).otherwise(text_of("end_date")).alias("end_date"),
            F.when(k % 71 == 0, "-1").otherwise(text_of("total_value")).alias("total_value"),
            F.when(k % 79 == 0, "US").otherwise(F.col("currency")).alias("currency"),
            F.when(k % 67 == 0, "PENDING").when(k % 2 == 0, F.lower("status")).otherwise(F.col("status")).alias("status"),
        )

    def raw_entities(self) -> DataFrame:
        k = F.col("entity_id")
        spaced = F.concat(F.lit("  "), F.replace(F.lower("legal_name"), F.lit("#"), F.lit("  \t ")), F.lit(" "))
        return self.legal_entities().select(
            F.when(k % 43 == 0, " T1 ").otherwise(F.col("tax_id")).alias("tax_id"),
            F.when(k % 2 == 0, spaced).otherwise(F.col("legal_name")).alias("legal_name"),
            "entity_type",
            "jurisdiction",
            F.when(k % 37 == 0, "01/02/2003").otherwise(text_of("registration_date")).alias("registration_date"),
            F.when(k % 41 == 0, "FROZEN").when(k % 3 == 0, F.lower("status")).otherwise(F.col("status")).alias("status"),
        )

    def raw_regulations(self) -> DataFrame:
        """Every part as one regulation row."""
        k = F.col("p_partkey")
        start = F.date_add(F.lit(dt.date(1995, 1, 1)), F.col("p_size") * 30)
        return self.table("part").select(
            F.concat(F.lit("R"), text_of(k)).alias("code"),
            F.col("p_name").alias("title"),
            pick(LANGS, k % 4).alias("jurisdiction"),
            F.when(k % 41 == 0, "soon").otherwise(text_of(start)).alias("effective_from"),
            F.when(k % 37 == 0, text_of(F.date_sub(start, 10)))
            .when(k % 3 != 0, text_of(F.date_add(start, 2000)))
            .alias("effective_to"),
            F.when(k % 29 == 0, "").otherwise(F.col("p_brand")).alias("category"),
        )

    # --- landed pages ------------------------------------------------------------

    def companies(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("cik"),
            F.when(k % 10 != 0, F.concat(F.lit("T"), text_of(k))).alias("ticker"),
            F.col("c_name").alias("title"),
        )

    def submission_pages(self) -> DataFrame:
        """One JSON page per order, holding one to three filings."""
        k = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date")
        index = F.sequence(F.lit(0), (k % 3).cast("int"))
        each = lambda f: F.transform(index, f)
        recent = F.struct(
            each(lambda i: accession(k, i)).alias("accessionNumber"),
            each(lambda i: F.when((k + i) % 101 == 0, "pending").otherwise(text_of(F.date_add(day, i)))).alias("filingDate"),
            each(lambda i: text_of(F.date_sub(day, 30))).alias("reportDate"),
            each(lambda i: F.when((k + i) % 103 == 0, "").otherwise(pick(FORMS, (k + i) % len(FORMS)))).alias("form"),
            each(lambda i: F.concat(F.lit("doc"), text_of(i), F.lit(".htm"))).alias("primaryDocument"),
            # one entry only: the array is short where there is more than one filing
            F.array(F.col("o_orderpriority")).alias("primaryDocDescription"),
            each(lambda i: (k * 100 + i).cast("bigint")).alias("size"),
        )
        page = F.struct(
            F.col("o_custkey").alias("cik"),
            F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("Company "), text_of("o_custkey"))).alias("name"),
            F.struct(recent.alias("recent")).alias("filings"),
        )
        return self.rows("orders").select(k.alias("page"), F.to_json(page).alias("body"))

    def registry_pages(self) -> DataFrame:
        """One JSON page per customer, holding one or two registry records."""
        k = F.col("c_custkey")
        index = F.sequence(F.lit(0), (k % 2).cast("int"))

        def record(i: Column) -> Column:
            entity = F.struct(
                F.struct(F.when(k % 13 != 0, F.col("c_name")).alias("name")).alias("legalName"),
                F.struct(
                    F.when(k % 17 == 0, "").otherwise(F.lower(F.concat(F.lit("N"), F.char(F.lit(65) + F.col("c_nationkey"))))).alias("country"),
                    F.lit("Town").alias("city"),
                ).alias("legalAddress"),
                F.lit("ACTIVE").alias("status"),
                F.struct(F.col("c_mktsegment").alias("id")).alias("legalForm"),
                F.lit("XX").alias("jurisdiction"),
            )
            attributes = F.struct(
                F.when((k + i) % 19 != 0, entity).alias("entity"),
                F.struct(F.lit("2012-06-06").alias("initialRegistrationDate")).alias("registration"),
            )
            return F.struct(
                F.when((k + i) % 23 != 0, F.concat(F.lit("L"), text_of(k), F.lit("X"), text_of(i))).alias("id"),
                F.lit("lei-records").alias("type"),
                attributes.alias("attributes"),
            )

        page = F.struct(F.transform(index, record).alias("data"))
        return self.table("customer").select(k.alias("page"), F.to_json(page).alias("body"))

    def api_pages(self) -> DataFrame:
        """One JSON page per event; some pages lack the record list."""
        k = F.col("event_id")
        items = F.transform(
            F.sequence(F.lit(0), (k % 4).cast("int")),
            lambda i: F.struct((k * 10 + i).alias("id"), F.concat(F.col("event_type"), F.lit("-"), text_of(i)).alias("label")),
        )
        result = F.when(k % 10 != 0, F.struct(items.alias("items")))
        return self.table("events").select(k.alias("page"), F.to_json(F.struct(result.alias("result"))).alias("body"))

    def header_lines(self) -> DataFrame:
        """One landed file per document: its header line."""
        k = F.col("doc_id")
        extra = F.when(k % 7 == 0, F.concat(F.lit(",extra_"), "lang")).otherwise(F.lit(""))
        return self.table("documents").select(
            F.concat(F.lit("file-"), text_of(k)).alias("file"),
            F.concat(pick(HEADER_LINES, k % len(HEADER_LINES)), extra).alias("header"),
        )

    # --- run audit ----------------------------------------------------------------

    def audit(self) -> DataFrame:
        return audit_columns(self.table("events"))


def audit_columns(events: DataFrame) -> DataFrame:
    """Run-audit rows from events; also used on a stream of events."""
    k, failed = F.col("event_id"), F.col("event_type") == "error"
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("p"), text_of(F.col("user_id") % 4)).alias("pipeline"),
        F.concat(F.lit("s"), text_of(F.col("user_id") % 3)).alias("source"),
        F.concat(F.lit("rule_"), text_of(F.col("user_id") % 5)).alias("rule"),
        F.col("event_type").alias("stage"),
        F.col("value").alias("duration"),
        failed.alias("quarantined"),
        failed.alias("failed"),
        F.when(failed, F.concat(F.lit("E"), text_of(k % 3))).alias("error_type"),
        (k % 100 + 1).alias("rows"),
        (k % 100 + 1).alias("extracted"),
        F.when(failed, F.lit(0)).otherwise(k % 100 + 1).alias("loaded"),
    )


def external_id(k: Column) -> Column:
    return F.concat(pick(PREFIXES, k % 3), text_of(k))


def risk_score(balance: Column) -> Column:
    """(balance + 1000) / 110 to two digits, computed on whole cents so that ties
    round the same everywhere."""
    cents = F.round(balance * 100).cast("bigint") + 100000
    hundredths = F.floor((cents * 2 + 110) / F.lit(220).cast("decimal(10,0)"))
    return (hundredths.cast("decimal(10,0)") / F.lit(100).cast("decimal(10,0)")).cast("decimal(5,2)")


def accession(k: Column, i: Column) -> Column:
    return F.concat(F.lpad(text_of(k), 10, "0"), F.lit("-24-"), F.lpad(text_of(i), 6, "0"))


# --- the same views in SQL -----------------------------------------------------------


def sql_external_id(k: str) -> str:
    return f"{sql_pick(PREFIXES, k + ' % 3')} || {k}::VARCHAR"


def sql_mean(total: str, n: str) -> str:
    """total / n to cents, half away from zero, in integers."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    rounded = f"(sign({cents}) * ((2 * abs({cents}) + ({n})) // (2 * ({n}))))"
    return f"CASE WHEN ({n}) > 0 THEN CAST(CAST({rounded} AS DOUBLE) / 100 AS DECIMAL(18,2)) END"


VIEW_SQL = {
    "v_counterparties": f"""
        SELECT c_custkey AS counterparty_id, {sql_external_id('c_custkey')} AS external_id, c_name AS name,
               CASE WHEN c_custkey % 10 <> 0 THEN 'TAX-' || c_custkey::VARCHAR END AS tax_id,
               'N' || chr(65 + c_nationkey) AS country_code,
               CASE WHEN c_custkey % 7 <> 0 THEN CAST((2 * (CAST(round(c_acctbal * 100) AS BIGINT) + 100000) + 110) // 220 / 100 AS DECIMAL(5,2)) END AS risk_score,
               c_mktsegment AS segment
        FROM customer""",
    "v_legal_entities": f"""
        SELECT c_custkey AS entity_id, 'TAX-' || c_custkey::VARCHAR AS tax_id, c_name AS legal_name,
               c_mktsegment AS entity_type, {sql_pick(LANGS, 'c_custkey % 4')} AS jurisdiction,
               DATE '2000-01-01' + CAST(c_custkey % 5000 AS INTEGER) AS registration_date,
               {sql_pick(ENTITY_STATUS, 'c_custkey % 5')} AS status
        FROM customer""",
    "v_contracts": f"""
        SELECT o_orderkey AS contract_id, 'CT-' || o_orderkey::VARCHAR AS contract_number,
               o_custkey AS counterparty_id, {sql_external_id('o_custkey')} AS counterparty_external_id,
               o_orderdate::DATE AS start_date, o_orderdate::DATE + CAST(o_orderkey % 1095 AS INTEGER) AS end_date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_value, {sql_pick(CURRENCIES, 'o_orderkey % 5')} AS currency,
               CASE o_orderstatus WHEN 'F' THEN 'EXPIRED' WHEN 'O' THEN 'ACTIVE' ELSE 'DRAFT' END AS status
        FROM orders""",
    "v_transaction_lines": f"""
        SELECT sha256(concat_ws('|', source_system, reference, transaction_date::VARCHAR)) AS transaction_id, *
        FROM (SELECT l_shipdate::DATE AS transaction_date, l_orderkey AS contract_id,
                     CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
                          ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
                     {sql_pick(CURRENCIES, 'l_orderkey % 5')} AS currency,
                     CASE WHEN l_returnflag = 'A' THEN 'INVOICE' WHEN l_returnflag = 'N' THEN 'PAYMENT'
                          WHEN l_linestatus = 'F' THEN 'REFUND' ELSE 'FEE' END AS transaction_type,
                     'TXN-' || l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS reference,
                     {sql_pick(TXN_SOURCES, 'l_suppkey % 3')} AS source_system,
                     l_shipdate + INTERVAL 1 DAY AS ingested_at, l_partkey AS line_no,
                     l_orderkey * 10 + l_linenumber AS k
              FROM lineitem)""",
    "v_transactions": """
        SELECT t.*, o.o_custkey AS counterparty_id
        FROM v_transaction_lines t JOIN orders o ON o.o_orderkey = t.contract_id""",
    "v_legal_documents": f"""
        SELECT *, sha256(source_system || '|' || source_id || '|' || document_date::VARCHAR) AS source_hash,
               document_date::TIMESTAMP + to_seconds(document_id % 86400) AS ingested_at
        FROM (SELECT doc_id AS document_id, DATE '2022-01-01' + CAST(doc_id % 1000 AS INTEGER) AS document_date,
                     CASE WHEN source = 'src0' THEN 'sec_edgar' ELSE source END AS source_system,
                     'DOC-' || doc_id::VARCHAR AS source_id, {sql_pick(DOC_TYPES, 'doc_id % 6')} AS document_type,
                     split_part(text, chr(10), 1) AS title, text AS content, lang AS jurisdiction, lang, source,
                     'R' || (doc_id % 50)::VARCHAR AS regulation_code, doc_id % 200 AS entity_id
              FROM documents)""",
    "v_regulations": f"""
        SELECT regulation_id, code, title, jurisdiction, effective_from,
               CASE WHEN regulation_id % 3 <> 0 THEN effective_from + 2000 END AS effective_to, category
        FROM (SELECT p_partkey AS regulation_id, 'R' || (p_partkey % 50)::VARCHAR AS code, p_name AS title,
                     {sql_pick(LANGS, 'p_partkey % 4')} AS jurisdiction,
                     DATE '1995-01-01' + p_size * 30 AS effective_from, p_brand AS category,
                     row_number() OVER (PARTITION BY p_partkey % 50, p_partkey % 4 ORDER BY p_partkey) AS rn
              FROM part) WHERE rn = 1""",
    "v_dim_counterparty": f"""
        SELECT {sql_external_id('o_custkey')} AS external_id, o_custkey AS counterparty_id, band,
               effective AS valid_from,
               coalesce(lead(effective) OVER w - 1, DATE '9999-12-31') AS valid_to,
               lead(effective) OVER w IS NULL AS is_current
        FROM (SELECT *, lag(band) OVER (PARTITION BY o_custkey ORDER BY effective) AS prev
              FROM (SELECT o_custkey, o_orderdate::DATE AS effective, arg_max(o_orderpriority, o_orderkey) AS band
                    FROM orders GROUP BY 1, 2))
        WHERE prev IS NULL OR prev <> band
        WINDOW w AS (PARTITION BY o_custkey ORDER BY effective)""",
    "v_dim_counterparty_named": """
        SELECT d.external_id, c.name || ' / ' || d.band AS name, c.country_code, d.band,
               d.valid_from, d.valid_to, d.is_current
        FROM v_dim_counterparty d JOIN v_counterparties c USING (counterparty_id)""",
    "v_raw_transactions": f"""
        SELECT CASE WHEN k % 83 = 0 THEN 'not-a-date' ELSE transaction_date::VARCHAR END AS transaction_date,
               'CT-' || contract_id::VARCHAR AS contract_number,
               {sql_external_id('counterparty_id')} AS counterparty_external_id,
               CASE WHEN k % 89 = 0 THEN '0' ELSE amount::VARCHAR END AS amount,
               CASE WHEN k % 97 = 0 THEN '' WHEN k % 5 = 0 THEN lower(currency) ELSE currency END AS currency,
               CASE WHEN k % 2 = 0 THEN lower(transaction_type) ELSE transaction_type END AS transaction_type,
               CASE WHEN k % 3 = 0 THEN ' ' || chr(9) || reference || '  ' ELSE reference END AS reference,
               source_system
        FROM v_transactions""",
    "v_raw_documents": """
        SELECT CASE WHEN NOT blank THEN source_id END AS doc_id,
               CASE WHEN NOT blank THEN document_date::VARCHAR END AS date,
               CASE WHEN NOT blank THEN source_system END AS source_system,
               CASE WHEN NOT blank THEN CASE WHEN document_id % 2 = 0 THEN lower(document_type) ELSE document_type END END AS type,
               CASE WHEN NOT blank THEN CASE WHEN document_id % 3 = 0 THEN '  ' || title || ' ' ELSE title END END AS title,
               CASE WHEN NOT blank THEN content END AS content,
               CASE WHEN NOT blank THEN jurisdiction END AS jurisdiction
        FROM (SELECT *, document_id % 20 = 0 AS blank FROM v_legal_documents)""",
    "v_raw_counterparties": """
        SELECT CASE WHEN counterparty_id % 3 = 0 THEN ' ' || external_id ELSE external_id END AS external_id,
               CASE WHEN counterparty_id % 47 = 0 THEN '   ' ELSE name END AS name, tax_id,
               CASE WHEN counterparty_id % 31 = 0 THEN 'N' WHEN counterparty_id % 2 = 0 THEN lower(country_code)
                    ELSE country_code END AS country_code,
               CASE WHEN counterparty_id % 53 = 0 THEN '150' WHEN counterparty_id % 59 = 0 THEN 'abc'
                    ELSE risk_score::VARCHAR END AS risk_score
        FROM v_counterparties""",
    "v_raw_contracts": """
        SELECT contract_number, counterparty_external_id,
               CASE WHEN contract_id % 73 = 0 THEN '2001-13-45' ELSE start_date::VARCHAR END AS start_date,
               CASE WHEN contract_id % 61 = 0 THEN (start_date - 1)::VARCHAR ELSE end_date::VARCHAR END AS end_date,
               CASE WHEN contract_id % 71 = 0 THEN '-1' ELSE total_value::VARCHAR END AS total_value,
               CASE WHEN contract_id % 79 = 0 THEN 'US' ELSE currency END AS currency,
               CASE WHEN contract_id % 67 = 0 THEN 'PENDING' WHEN contract_id % 2 = 0 THEN lower(status)
                    ELSE status END AS status
        FROM v_contracts""",
    "v_raw_entities": """
        SELECT CASE WHEN entity_id % 43 = 0 THEN ' T1 ' ELSE tax_id END AS tax_id,
               CASE WHEN entity_id % 2 = 0 THEN '  ' || replace(lower(legal_name), '#', '  ' || chr(9) || ' ') || ' '
                    ELSE legal_name END AS legal_name,
               entity_type, jurisdiction,
               CASE WHEN entity_id % 37 = 0 THEN '01/02/2003' ELSE registration_date::VARCHAR END AS registration_date,
               CASE WHEN entity_id % 41 = 0 THEN 'FROZEN' WHEN entity_id % 3 = 0 THEN lower(status)
                    ELSE status END AS status
        FROM v_legal_entities""",
    "v_raw_regulations": f"""
        SELECT 'R' || p_partkey::VARCHAR AS code, p_name AS title, {sql_pick(LANGS, 'p_partkey % 4')} AS jurisdiction,
               CASE WHEN p_partkey % 41 = 0 THEN 'soon' ELSE start::VARCHAR END AS effective_from,
               CASE WHEN p_partkey % 37 = 0 THEN (start - 10)::VARCHAR
                    WHEN p_partkey % 3 <> 0 THEN (start + 2000)::VARCHAR END AS effective_to,
               CASE WHEN p_partkey % 29 = 0 THEN '' ELSE p_brand END AS category
        FROM (SELECT *, DATE '1995-01-01' + p_size * 30 AS start FROM part)""",
    "v_companies": """
        SELECT c_custkey AS cik, CASE WHEN c_custkey % 10 <> 0 THEN 'T' || c_custkey::VARCHAR END AS ticker,
               c_name AS title
        FROM customer""",
    "v_filings": f"""
        SELECT o_custkey AS cik,
               CASE WHEN k % 11 = 0 THEN '' ELSE 'Company ' || o_custkey::VARCHAR END AS company_name,
               lpad(k::VARCHAR, 10, '0') || '-24-' || lpad(i::VARCHAR, 6, '0') AS accession,
               CASE WHEN (k + i) % 101 = 0 THEN 'pending' ELSE (day + i)::VARCHAR END AS filing_date,
               (day - 30)::VARCHAR AS report_date,
               CASE WHEN (k + i) % 103 = 0 THEN '' ELSE {sql_pick(FORMS, f'(k + i) % {len(FORMS)}')} END AS form,
               'doc' || i::VARCHAR || '.htm' AS document,
               CASE WHEN i = 0 THEN o_orderpriority END AS description,
               k * 100 + i AS size
        FROM (SELECT o_orderkey AS k, o_custkey, o_orderpriority, o_orderdate::DATE AS day,
                     CAST(unnest(range(0, o_orderkey % 3 + 1)) AS INTEGER) AS i
              FROM orders)""",
    "v_registry": """
        SELECT CASE WHEN (k + i) % 23 <> 0 THEN 'L' || k::VARCHAR || 'X' || i::VARCHAR END AS lei,
               (k + i) % 19 <> 0 AS has_entity,
               CASE WHEN k % 13 <> 0 THEN c_name END AS name,
               CASE WHEN k % 17 = 0 THEN '' ELSE lower('N' || chr(65 + c_nationkey)) END AS country,
               c_mktsegment AS legal_form
        FROM (SELECT c_custkey AS k, *, CAST(unnest(range(0, c_custkey % 2 + 1)) AS INTEGER) AS i FROM customer)""",
    "v_header_lines": f"""
        SELECT 'file-' || doc_id::VARCHAR AS file,
               {sql_pick(HEADER_LINES, f'doc_id % {len(HEADER_LINES)}')}
               || CASE WHEN doc_id % 7 = 0 THEN ',extra_' || lang ELSE '' END AS header
        FROM documents""",
    "v_audit": """
        SELECT ts, 'p' || (user_id % 4)::VARCHAR AS pipeline, 's' || (user_id % 3)::VARCHAR AS source,
               'rule_' || (user_id % 5)::VARCHAR AS rule, event_type AS stage, value AS duration,
               event_type = 'error' AS quarantined, event_type = 'error' AS failed,
               CASE WHEN event_type = 'error' THEN 'E' || (event_id % 3)::VARCHAR END AS error_type,
               event_id % 100 + 1 AS rows, event_id % 100 + 1 AS extracted,
               CASE WHEN event_type = 'error' THEN 0 ELSE event_id % 100 + 1 END AS loaded
        FROM events""",
}
