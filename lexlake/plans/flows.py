"""End-to-end ingestion: land, validate, quarantine, check, load, refresh.

Order of effects: Bronze first, then quarantine, then the quality gate, then the
keyed load, Gold last. A stopped run can be started again with the same batch id:
Bronze and quarantine replace the batch, the load is by key. Every run leaves one
audit row per stage and one row per quality rule, also when it fails.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexlake.contracts import contract_for
from lexlake.functions.business import MONEY
from lexlake.operators import dq, joins, keyed, partitions, scd2
from lexlake.operators.validate import ERRORS, Contract, apply_contract, rejected_rows, settle, valid_rows
from lexlake.plans import gold, staging
from lexlake.sources import files, pages, sinks
from lexlake.workspace import materialize, parts_for

DOCUMENT_KEY = ["source_system", "source_id", "document_date"]
TRANSACTION_KEY = ["source_system", "reference", "transaction_date"]
REGULATION_KEY = ["jurisdiction", "code"]
# one list per dimension, so that every feed hashes the same fields
COUNTERPARTY_TRACKED = ["name", "tax_id", "country_code", "risk_score", "attributes"]
LINEAGE = ["_batch_id", "_source_system", "_source_name", "_extracted_at", "ingestion_date", "_batch"]


@dataclass(frozen=True)
class Zones:
    root: str

    def path(self, zone: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{name}"


@dataclass
class Summary:
    extracted: int = 0
    valid: int = 0
    rejected: int = 0
    loaded: int = 0
    skipped: int = 0
    scd2: dict[str, int] = field(default_factory=dict)
    dq_failures: list[str] = field(default_factory=list)
    #: (stage, seconds, class of the error or None), in the order they ended
    stages: list[tuple[str, float, str | None]] = field(default_factory=list)

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began, error = time.monotonic(), None
        try:
            yield
        except Exception as e:
            error = type(e).__name__
            raise
        finally:
            self.stages.append((name, time.monotonic() - began, error))


AUDIT = "batch_id string, pipeline string, source string, stage string, ts timestamp, rows bigint, duration double, error_type string"


@contextmanager
def audited(spark: SparkSession, zones: Zones, pipeline: str, source: str, batch_id: str, as_of: dt.datetime) -> Iterator[Summary]:
    """A summary to fill; its stages are written to the audit table at the end, with
    the error if there was one. A repeated batch replaces its rows."""
    summary = Summary()
    try:
        yield summary
    finally:
        rows = {"land": summary.extracted, "validate": summary.extracted, "quality": summary.valid, "load": summary.loaded}
        done = [(batch_id, pipeline, source, stage, as_of, rows.get(stage, 0), took, error) for stage, took, error in summary.stages]
        sinks.write_bronze(spark.createDataFrame(done, AUDIT), zones.path("audit", "stages"), F.lit(as_of.date()), f"{source}-{batch_id}")


def surrogate(*cols: Column | str) -> Column:
    """Key-derived id: the same business key gives the same id on every run."""
    return F.sha2(F.concat_ws("|", *cols), 256)


def land(df: DataFrame, zones: Zones, name: str, batch_id: str, system: str, as_of: dt.datetime) -> DataFrame:
    """Write the batch to Bronze and return its rows as stored."""
    path = zones.path("bronze", name)
    stamped = files.tag_lineage(df, batch_id, system, name, F.lit(as_of))
    sinks.write_bronze(stamped, path, F.lit(as_of.date()), batch_id)
    return sinks.read_bronze(df.sparkSession, path, stamped.schema, as_of.date(), batch_id).select(*df.columns)


def check(df: DataFrame, contract: Contract, zones: Zones, name: str, batch_id: str, as_of: dt.datetime, summary: Summary) -> DataFrame:
    """Validate once, store the outcome, send rejects to quarantine, return valid
    rows. The counters are taken while the outcome is written."""
    seen = Observation()
    bad = F.size(ERRORS) > 0
    outcome = settle(apply_contract(df, contract)).observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("rejected")
    )
    checked = materialize(outcome, f"checked-{name}")
    n = seen.get
    summary.extracted += n["total"]
    summary.valid += n["total"] - n["rejected"]
    summary.rejected += n["rejected"]
    if n["rejected"]:
        sinks.write_quarantine(rejected_rows(checked, contract), zones.path("quarantine", name), batch_id, F.lit(as_of))
    return valid_rows(checked, contract)


def _gated(
    valid: DataFrame, suite: str, on_error: str, zones: Zones, name: str, batch_id: str, as_of: dt.datetime, summary: Summary
) -> DataFrame:
    """The rows, if the suite has no failed error rule. Results and failing values are
    stored before that is decided."""
    if not summary.valid:
        return valid
    rules = dq.builtin_rules(suite)
    stamp, batch = F.lit(as_of), f"{name}-{batch_id}"
    results = materialize(dq.run_suite(valid, rules, suite), "quality-results")
    stored = results.withColumns({"ts": stamp, "failed": ~F.col("passed")})
    sinks.write_bronze(stored, zones.path("audit", "quality"), F.to_date(stamp), batch)
    failed = results.where("NOT passed").collect()  # at most one row per rule
    if failed:
        names = {r.rule for r in failed}
        samples = dq.failure_samples(valid, [r for r in rules if r.name in names]).withColumn("suite", F.lit(suite))
        sinks.write_bronze(samples, zones.path("audit", "quality_samples"), F.to_date(stamp), batch)
    errors = [r for r in failed if r.severity == "error"]
    summary.dq_failures = [f"{r.rule}: {r.message}" for r in errors]
    if errors and on_error == "drop":
        summary.valid = 0
    return dq.gate(results, valid, on_error)


def upsert_published(
    spark: SparkSession, root: str, batch: DataFrame, keys: list[str], order: list[str], as_of: Column
) -> int:
    """Upsert into a small versioned table; readers of the old version go on."""
    if partitions.current_version(spark, root):
        target = partitions.read_current(spark, root)
    else:
        target = batch.where(F.lit(False)).withColumns({"created_at": as_of, "updated_at": as_of})
    partitions.publish(keyed.upsert(target, batch, keys, order, as_of), root)
    return keyed.latest_per_key(batch, keys, order).count()


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """A table loaded by key, with the columns later batches brought."""
    return spark.read.option("mergeSchema", True).parquet(path)


# --- documents ------------------------------------------------------------------------


def _load_documents(spark: SparkSession, valid: DataFrame, zones: Zones, as_of: dt.datetime, summary: Summary) -> None:
    columns = [*staging.DOCUMENT_COLUMNS, *[c for c in ("entity_tax_id",) if c in valid.columns]]
    rows = staging.load_defaults(valid, F.lit(as_of), columns)
    rows = partitions.with_month(rows.withColumn("document_id", surrogate(*DOCUMENT_KEY)), "document_date")
    path = zones.path("silver", "legal_documents")
    summary.loaded = keyed.upsert_table(
        spark, path, rows, DOCUMENT_KEY, ["ingested_at", "title"], "month", F.lit(as_of), sort=["document_date"]
    )
    if summary.loaded:
        silver = _stored(spark, path)
        by_jurisdiction = gold.gold_documents_by_jurisdiction(staging.stg_legal_documents(silver))
        partitions.publish(by_jurisdiction, zones.path("gold", "legal_documents_by_jurisdiction"))
        refresh_regulations(spark, zones, as_of.date())


def legal_ingestion(
    spark: SparkSession,
    csv_path: str,
    zones: Zones,
    batch_id: str,
    as_of: dt.datetime,
    on_error: str = "raise",
    default_source: str = "legal_csv",
    whole_files: bool = False,
) -> Summary:
    """CSV of legal documents to Silver and Gold. With ``on_error="drop"``, as for
    uploads, a failed quality gate loads nothing and is reported. Texts may hold line
    breaks in quotes; files are split over tasks all the same (``whole_files``: see ``scan_csv``)."""
    name = "legal_documents"
    with audited(spark, zones, "legal", name, batch_id, as_of) as summary:
        with summary.stage("land"):
            raw = land(files.scan_csv(spark, csv_path, whole_files=whole_files), zones, name, batch_id, "legal_csv", as_of)
        with summary.stage("validate"):
            mapped = staging.map_legal_csv(raw, default_source)
            valid = check(mapped, contract_for("document"), zones, name, batch_id, as_of, summary)
        with summary.stage("quality"):
            valid = _gated(valid, "legal_documents", on_error, zones, name, batch_id, as_of, summary)
        with summary.stage("load"):
            _load_documents(spark, valid, zones, as_of, summary)
    return summary


def filings_ingestion(
    spark: SparkSession,
    submissions: DataFrame,
    companies: DataFrame,
    zones: Zones,
    batch_id: str,
    as_of: dt.datetime,
    since: dt.date | None = None,
    forms: list[str] | None = None,
    max_companies: int | None = None,
    on_error: str = "raise",
) -> Summary:
    """Landed submission pages to Silver documents."""
    name = "sec_edgar"
    if max_companies:
        companies = files.first_n(companies, ["position"] if "position" in companies.columns else ["cik"], max_companies)
        submissions = submissions.join(companies.select("cik"), "cik", "left_semi")
    documents = pages.filings_normalize(pages.filings_flatten(submissions), companies)
    documents = pages.filings_filter(documents, F.lit(since) if since else None, forms)
    with audited(spark, zones, "filings", name, batch_id, as_of) as summary:
        with summary.stage("land"):
            raw = land(documents, zones, name, batch_id, "sec_edgar", as_of)
        with summary.stage("validate"):
            valid = check(raw, contract_for("document"), zones, name, batch_id, as_of, summary)
        with summary.stage("quality"):
            valid = _gated(valid, "legal_documents", on_error, zones, name, batch_id, as_of, summary)
        with summary.stage("load"):
            _load_documents(spark, valid, zones, as_of, summary)
    return summary


# --- parties and transactions ---------------------------------------------------------


def _load_counterparties(spark: SparkSession, valid: DataFrame, zones: Zones, as_of: dt.datetime, summary: Summary) -> None:
    stamp = F.lit(as_of)
    rows = valid.withColumn("counterparty_id", surrogate("external_id"))
    root = zones.path("silver", "counterparties")
    summary.loaded += upsert_published(spark, root, rows, ["external_id"], ["name"], stamp)
    if summary.loaded:
        parties = partitions.read_current(spark, root)
        risk = gold.gold_risk_distribution(staging.stg_counterparties(parties))
        partitions.publish(risk, zones.path("gold", "counterparty_risk_distribution"))
    body = valid.withColumnRenamed("metadata", "attributes")
    batch = body.withColumn("effective", F.lit(as_of.date()))
    root = zones.path("silver", "dim_counterparty")
    if partitions.current_version(spark, root):
        dim = partitions.read_current(spark, root)
    else:
        dim = body.where(F.lit(False)).select(
            "*",
            F.lit(scd2.OPEN_END).alias("valid_from"),
            F.lit(scd2.OPEN_END).alias("valid_to"),
            F.lit(True).alias("is_current"),
            F.lit("").alias("row_hash"),
        )
    pairs = scd2.classify(dim, batch, "external_id", COUNTERPARTY_TRACKED, ["effective", "name"])
    counted = scd2.counts(pairs).first().asDict()
    if counted["late"]:
        late = scd2.late_rows(pairs)
        sinks.write_quarantine(late, zones.path("quarantine", "dim_counterparty"), f"{as_of:%Y%m%dT%H%M%S}", stamp)
    if counted["inserted"] or counted["expired"] or counted["replaced"]:
        partitions.publish(scd2.apply(dim, batch, "external_id", COUNTERPARTY_TRACKED, ["effective", "name"]), root)
    summary.scd2 = counted


def registry_ingestion(
    spark: SparkSession,
    registry_pages: DataFrame,
    zones: Zones,
    batch_id: str,
    as_of: dt.datetime,
    max_pages: int | None = None,
) -> Summary:
    """Landed registry pages to counterparties and their history."""
    name = "gleif_lei"
    kept = pages.keep_pages(registry_pages, "meta.pagination.currentPage", max_pages)
    with audited(spark, zones, "registry", name, batch_id, as_of) as summary:
        with summary.stage("land"):
            raw = land(pages.registry_counterparties(kept), zones, name, batch_id, "gleif", as_of)
        with summary.stage("validate"):
            valid = check(raw, contract_for("counterparty"), zones, name, batch_id, as_of, summary)
        with summary.stage("load"):
            _load_counterparties(spark, valid, zones, as_of, summary)
    return summary


def _current(spark: SparkSession, zones: Zones, name: str, empty: str) -> DataFrame:
    root = zones.path("silver", name)
    if partitions.current_version(spark, root):
        return partitions.read_current(spark, root)
    return spark.createDataFrame([], empty)


def commercial_ingestion(
    spark: SparkSession,
    zones: Zones,
    batch_id: str,
    as_of: dt.datetime,
    counterparties_csv: str | None = None,
    contracts_csv: str | None = None,
    transactions_csv: str | None = None,
    on_error: str = "raise",
    whole_files: bool = False,
) -> dict[str, Summary]:
    """Counterparties, contracts and transactions, in the order their keys need. Fields
    may hold line breaks in quotes (``whole_files``: see ``scan_csv``)."""
    done: dict[str, Summary] = {}
    stamp = F.lit(as_of)

    def checked(path: str, name: str, kind: str, s: Summary) -> DataFrame:
        with s.stage("land"):
            raw = land(files.scan_csv(spark, path, whole_files=whole_files), zones, name, batch_id, "commercial_csv", as_of)
        with s.stage("validate"):
            return check(raw, contract_for(kind), zones, name, batch_id, as_of, s)

    if counterparties_csv:
        with audited(spark, zones, "commercial", "counterparties", batch_id, as_of) as s:
            done["counterparties"] = s
            valid = checked(counterparties_csv, "counterparties", "counterparty", s)
            with s.stage("load"):
                _load_counterparties(spark, valid, zones, as_of, s)
    parties = _current(spark, zones, "counterparties", "external_id string, counterparty_id string, name string, country_code string")
    if contracts_csv:
        with audited(spark, zones, "commercial", "contracts", batch_id, as_of) as s:
            done["contracts"] = s
            valid = checked(contracts_csv, "contracts", "contract", s)
            with s.stage("load"):
                rows = valid.withColumn("contract_id", surrogate("contract_number"))
                root = zones.path("silver", "contracts")
                s.loaded = upsert_published(spark, root, rows, ["contract_number"], ["start_date", "total_value"], stamp)
    contracts = _current(spark, zones, "contracts", "contract_number string, contract_id string")
    if transactions_csv:
        with audited(spark, zones, "commercial", "transactions", batch_id, as_of) as s:
            done["transactions"] = s
            valid = checked(transactions_csv, "transactions", "transaction", s)
            with s.stage("quality"):
                valid = _gated(valid, "transactions", on_error, zones, "transactions", batch_id, as_of, s)
            with s.stage("load"):
                _load_transactions(spark, valid, parties, contracts, zones, stamp, s)
            if s.loaded:
                with s.stage("refresh"):
                    refresh_revenue(spark, zones)
    return done


def _load_transactions(
    spark: SparkSession, valid: DataFrame, parties: DataFrame, contracts: DataFrame, zones: Zones, stamp: Column, summary: Summary
) -> None:
    seen = Observation()
    linked = joins.resolve_keys(valid, parties, contracts).observe(seen, F.count_if(~F.col("resolved")).alias("skipped"))
    # counted in the writing stage itself: an earlier stage that is run again
    # after an executor loss would count its rows again
    linked = materialize(linked, "linked")
    summary.skipped = seen.get["skipped"]
    rows = linked.where("resolved").drop("resolved", "contract_number", "counterparty_external_id")
    rows = partitions.with_month(
        rows.withColumns({"transaction_id": surrogate(*TRANSACTION_KEY), "amount": F.col("amount").cast(MONEY)}),
        "transaction_date",
    )
    path = zones.path("silver", "transactions")
    summary.loaded = keyed.upsert_table(
        spark, path, rows, TRANSACTION_KEY, ["ingested_at", "amount"], "month", stamp, sort=["transaction_date"]
    )


def refresh_revenue(spark: SparkSession, zones: Zones) -> None:
    """Rebuild both Gold revenue tables, by today's names and by those of the day, as
    new versions."""
    silver = zones.path("silver", "transactions")
    txn, parts = staging.stg_transactions(_stored(spark, silver)), parts_for(spark, silver)
    parties = partitions.read_current(spark, zones.path("silver", "counterparties"))
    table = gold.gold_monthly_revenue(txn, staging.stg_counterparties(parties), parts)
    partitions.publish(table, zones.path("gold", "monthly_revenue_by_counterparty"))
    history = zones.path("silver", "dim_counterparty")
    if partitions.current_version(spark, history):
        asof = gold.monthly_revenue_asof(txn, parties, partitions.read_current(spark, history), parts)
        partitions.publish(asof, zones.path("gold", "monthly_revenue_asof"))


# --- regulations ----------------------------------------------------------------------


def regulation_ingestion(
    spark: SparkSession, csv_path: str, zones: Zones, batch_id: str, as_of: dt.datetime, whole_files: bool = False
) -> Summary:
    """CSV of regulations to Silver, and the table of active ones."""
    name = "regulations"
    with audited(spark, zones, "regulations", name, batch_id, as_of) as summary:
        with summary.stage("land"):
            raw = land(files.scan_csv(spark, csv_path, whole_files=whole_files), zones, name, batch_id, "legal_csv", as_of)
        with summary.stage("validate"):
            valid = check(raw, contract_for("regulation"), zones, name, batch_id, as_of, summary)
        with summary.stage("load"):
            rows = valid.withColumn("regulation_id", surrogate(*REGULATION_KEY))
            root = zones.path("silver", name)
            summary.loaded = upsert_published(spark, root, rows, REGULATION_KEY, ["effective_from", "title"], F.lit(as_of))
        with summary.stage("refresh"):
            refresh_regulations(spark, zones, as_of.date())
    return summary


def refresh_regulations(spark: SparkSession, zones: Zones, day: dt.date) -> None:
    """Publish the regulations active on the day with the entities their documents name.
    An entity's id follows from its tax id and jurisdiction. Without regulations nothing
    is published; without documents no entity is affected."""
    root, path = zones.path("silver", "regulations"), zones.path("silver", "legal_documents")
    if not partitions.current_version(spark, root):
        return
    try:
        documents = _stored(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        documents = spark.createDataFrame([], "document_id string, jurisdiction string, metadata string, entity_tax_id string")
    if "entity_tax_id" not in documents.columns:
        documents = documents.withColumn("entity_tax_id", F.lit(None).cast("string"))
    entity = F.when(F.col("entity_tax_id").isNotNull(), surrogate("entity_tax_id", "jurisdiction"))
    documents = documents.withColumn("entity_id", entity)
    table = gold.active_regulations(partitions.read_current(spark, root), documents, day)
    partitions.publish(table, zones.path("gold", "active_regulations"))
