import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lexlake.operators import dq, partitions
from lexlake.plans import flows, monitoring
from lexlake.plans.flows import Zones
from lexlake.sources import pages

T1, T2, T3 = (dt.datetime(2025, m, 1) for m in (1, 2, 3))


def lines(path, header, rows):
    path.write_text("\n".join([header] + [",".join(map(str, r)) for r in rows]) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture
def docs_csv(tmp_path):
    good = [
        (f"DOC-{i:04d}", f"2024-{i % 12 + 1:02d}-10", "api:courts", "judgment" if i % 2 else "NOTICE", f"Title {i}", "text", "US-NY")
        for i in range(60)
    ]
    blank = [("",) * 7] * 6
    return lines(tmp_path / "docs.csv", "doc_id,date,source_system,type,title,content,jurisdiction", good + blank)


def test_legal_ingestion(spark, tmp_path, docs_csv):
    zones = Zones(str(tmp_path / "lake"))
    s = flows.legal_ingestion(spark, docs_csv, zones, "b1", T1)
    assert (s.extracted, s.valid, s.rejected, s.loaded) == (66, 60, 6, 60)
    # the same batch again: same rows everywhere
    s = flows.legal_ingestion(spark, docs_csv, zones, "b1", T1)
    assert s.loaded == 60
    assert spark.read.parquet(zones.path("bronze", "legal_documents")).count() == 66
    assert spark.read.parquet(zones.path("quarantine", "legal_documents")).count() == 6
    silver = spark.read.parquet(zones.path("silver", "legal_documents"))
    assert silver.count() == 60 and silver.select("month").distinct().count() == 12
    r = silver.where("source_id = 'DOC-0001'").first()
    assert r.document_type == "JUDGMENT"
    assert json.loads(r.metadata)["original_source_row"]["doc_id"] == "DOC-0001"
    gold = partitions.read_current(spark, zones.path("gold", "legal_documents_by_jurisdiction"))
    assert gold.agg(F.sum("documents")).first()[0] == 60


def test_quality_gate_stops_or_drops(spark, tmp_path):
    zones = Zones(str(tmp_path / "lake"))
    rows = [("2025-01-01", "CT-1", "CP-1", 5, "US1", "INVOICE", "T1", "erp"), ("", "", "", "", "", "", "", "")]
    header = "transaction_date,contract_number,counterparty_external_id,amount,currency,transaction_type,reference,source_system"
    path = lines(tmp_path / "t.csv", header, rows)
    with pytest.raises(dq.QualityError, match="currency_is_iso_3"):
        flows.commercial_ingestion(spark, zones, "b1", T1, transactions_csv=path)
    stages = spark.read.parquet(zones.path("audit", "stages"))
    assert {r.stage: r.error_type for r in stages.collect()} == {"land": None, "validate": None, "quality": "QualityError"}
    rules = spark.read.parquet(zones.path("audit", "quality")).where("failed")
    assert "currency_is_iso_3" in {r.rule for r in rules.collect()}
    samples = spark.read.parquet(zones.path("audit", "quality_samples")).where("rule = 'currency_is_iso_3'")
    assert [r.value for r in samples.collect()] == ["US1"]
    # rejects were written before the gate
    assert spark.read.parquet(zones.path("quarantine", "transactions")).count() == 1
    s = flows.commercial_ingestion(spark, zones, "b1", T1, transactions_csv=path, on_error="drop")["transactions"]
    assert (s.valid, s.rejected, s.loaded) == (0, 1, 0) and s.dq_failures


def test_commercial_ingestion(spark, tmp_path):
    zones = Zones(str(tmp_path / "lake"))
    parties = [(f"CP-{i}", f"Company {i}", f"T{i}", "us", i * 10) for i in range(5)] + [("CP-X", "", "", "usa", 150)]
    contracts = [(f"CT-{i}", f"CP-{i}", "2024-01-01", "2025-01-01", 1000, "USD", "ACTIVE") for i in range(4)]
    txns = [
        (f"2024-{m:02d}-05", f"CT-{i}", f"CP-{i}", 100 + i, "usd", "invoice", f"TXN-{m}-{i}", "erp:sap")
        for m in (1, 2)
        for i in range(5)
    ]
    a = lines(tmp_path / "p.csv", "external_id,name,tax_id,country_code,risk_score", parties)
    b = lines(tmp_path / "c.csv", "contract_number,counterparty_external_id,start_date,end_date,total_value,currency,status", contracts)
    header = "transaction_date,contract_number,counterparty_external_id,amount,currency,transaction_type,reference,source_system"
    c = lines(tmp_path / "t.csv", header, txns)
    done = flows.commercial_ingestion(spark, zones, "b1", T1, a, b, c)
    assert (done["counterparties"].valid, done["counterparties"].rejected) == (5, 1)
    assert done["counterparties"].scd2["inserted"] == 5
    # CT-4 is unknown: its two transactions are skipped
    assert (done["transactions"].loaded, done["transactions"].skipped) == (8, 2)
    gold = partitions.read_current(spark, zones.path("gold", "monthly_revenue_by_counterparty"))
    assert gold.count() == 8 and gold.agg(F.sum("total_amount")).first()[0] == 2 * (100 + 101 + 102 + 103)

    parties[0] = ("CP-0", "Renamed", "T0", "us", 0)
    a = lines(tmp_path / "p2.csv", "external_id,name,tax_id,country_code,risk_score", parties)
    done = flows.commercial_ingestion(spark, zones, "b2", T2, a, b, c)
    s = done["counterparties"].scd2
    assert (s["inserted"], s["expired"], s["unchanged"]) == (1, 1, 4)
    assert done["transactions"].loaded == 8
    silver = spark.read.parquet(zones.path("silver", "transactions"))
    assert silver.count() == 8 and silver.where(F.col("created_at") == F.lit(T1)).count() == 8
    cp = partitions.read_current(spark, zones.path("silver", "counterparties"))
    assert cp.count() == 5 and cp.where("external_id = 'CP-0'").first().name == "Renamed"
    dim = partitions.read_current(spark, zones.path("silver", "dim_counterparty"))
    assert dim.count() == 6 and dim.where("is_current").count() == 5
    # the same feed once more changes no history and publishes no new version
    version = partitions.current_version(spark, zones.path("silver", "dim_counterparty"))
    done = flows.commercial_ingestion(spark, zones, "b3", T3, a)
    assert done["counterparties"].scd2["unchanged"] == 5
    assert partitions.current_version(spark, zones.path("silver", "dim_counterparty")) == version


def test_gold_tables_and_audit(spark, tmp_path, docs_csv):
    zones = Zones(str(tmp_path / "lake"))
    a = lines(tmp_path / "p.csv", "external_id,name,tax_id,country_code,risk_score", [("CP-1", "Company", "T1", "us", 10)])
    header = "contract_number,counterparty_external_id,start_date,end_date,total_value,currency,status"
    b = lines(tmp_path / "c.csv", header, [("CT-1", "CP-1", "2024-01-01", "2025-01-01", 1000, "USD", "ACTIVE")])
    header = "transaction_date,contract_number,counterparty_external_id,amount,currency,transaction_type,reference,source_system"
    # before and after the counterparty's history begins
    rows = [(d, "CT-1", "CP-1", 5, "usd", "invoice", f"R-{d}", "erp") for d in ("2024-01-05", "2025-01-05")]
    c = lines(tmp_path / "t.csv", header, rows)
    flows.commercial_ingestion(spark, zones, "b1", T1, a, b, c)
    regulations = [("R-1", "One", "US-NY", "2020-01-01", "", "tax"), ("R-2", "Two", "US-NY", "2020-01-01", "2021-01-01", "tax")]
    r = lines(tmp_path / "r.csv", "code,title,jurisdiction,effective_from,effective_to,category", regulations)
    s = flows.regulation_ingestion(spark, r, zones, "b1", T1)
    assert (s.valid, s.loaded) == (2, 2)
    flows.legal_ingestion(spark, docs_csv, zones, "b1", T1)
    gold = lambda name: partitions.read_current(spark, zones.path("gold", name))
    assert gold("monthly_revenue_by_counterparty").count() == 2
    assert [x.month for x in gold("monthly_revenue_asof").collect()] == [dt.date(2025, 1, 1)]
    assert gold("counterparty_risk_distribution").first().risk_tier == "LOW"
    active = gold("active_regulations").first()
    assert (active.category, active.regulation_count, active.affected_entities) == ("tax", 1, 0)
    assert gold("legal_documents_by_jurisdiction").count() > 0
    stages = spark.read.parquet(zones.path("audit", "stages"))
    loads = {x.source: x.rows for x in stages.where("stage = 'load'").collect()}
    assert loads == {"counterparties": 1, "contracts": 1, "transactions": 2, "regulations": 2, "legal_documents": 60}
    # the same batch again replaces its rows, and the monitors read the table as it is
    before = stages.count()
    flows.legal_ingestion(spark, docs_csv, zones, "b1", T1)
    stages = spark.read.parquet(zones.path("audit", "stages"))
    assert stages.count() == before
    assert monitoring.throughput(stages).count() == 5 and monitoring.error_count(stages).count() == 0
    assert monitoring.failure_rate(spark.read.parquet(zones.path("audit", "quality"))).agg(F.max("failed")).first()[0] == 0


def test_affected_entities(spark, tmp_path):
    """An entity counts once for all documents that name a regulation; one without tax id does not."""
    zones = Zones(str(tmp_path / "lake"))
    r = lines(tmp_path / "r.csv", "code,title,jurisdiction,effective_from,effective_to,category", [("R-1", "One", "US-NY", "2020-01-01", "", "tax")])
    flows.regulation_ingestion(spark, r, zones, "b1", T1)
    code = json.dumps({"regulation_code": "R-1"})
    rows = [("1", code, "US-NY", "T-1"), ("2", code, "US-NY", "T-1"), ("3", code, "US-NY", None), ("4", code, "US-NJ", "T-2")]
    docs = spark.createDataFrame(rows, "document_id string, metadata string, jurisdiction string, entity_tax_id string")
    docs.write.parquet(zones.path("silver", "legal_documents"))
    flows.refresh_regulations(spark, zones, T1.date())
    active = partitions.read_current(spark, zones.path("gold", "active_regulations")).first()
    assert (active.regulation_count, active.affected_entities) == (1, 1)


def test_filings_ingestion(spark, tmp_path):
    from test_sources import SUBMISSIONS

    zones = Zones(str(tmp_path / "lake"))
    src = tmp_path / "pages"
    src.mkdir()
    for i, s in enumerate(SUBMISSIONS):
        (src / f"{i}.json").write_text(json.dumps(s))
    sub = pages.read_pages(spark, str(src), pages.SUBMISSION)
    rows = [(0, 1900417, "BWTC", "Brightwater Timber Co"), (1, 77012, "OSLK", "OSTLAKE MILLS LTD")]
    companies = spark.createDataFrame(rows, "position int, cik bigint, ticker string, title string")
    for _ in range(2):
        s = flows.filings_ingestion(spark, sub, companies, zones, "b1", T1)
        assert (s.extracted, s.valid, s.loaded) == (4, 4, 4)
    silver = spark.read.parquet(zones.path("silver", "legal_documents"))
    assert silver.count() == 4
    r = silver.where("source_id = '0001900417-23-000017'").first()
    assert r.tags == ["10-k", "bwtc"] and json.loads(r.metadata)["ticker"] == "BWTC"
    other = Zones(str(tmp_path / "lake2"))
    s = flows.filings_ingestion(spark, sub, companies, other, "b1", T1, dt.date(2023, 3, 1), ["10-K", "10-Q"], max_companies=1)
    assert s.loaded == 2


def test_registry_ingestion(spark, tmp_path):
    from test_sources import record, registry

    zones = Zones(str(tmp_path / "lake"))
    src = tmp_path / "pages"
    src.mkdir()
    (src / "1.json").write_text(json.dumps(registry([record("A" * 20, "Alpha", "us"), record("B" * 20, "Beta", "de")], 1)))
    (src / "2.json").write_text(json.dumps(registry([record("C" * 20, "Gamma", "zzz")], 2)))
    df = pages.read_pages(spark, str(src), pages.REGISTRY_PAGE)
    s = flows.registry_ingestion(spark, df, zones, "b1", T1)
    assert (s.extracted, s.valid, s.rejected, s.scd2["inserted"]) == (3, 2, 1, 2)
    s = flows.registry_ingestion(spark, df, zones, "b2", T2, max_pages=1)
    assert (s.extracted, s.scd2["unchanged"]) == (2, 2)
    dim = partitions.read_current(spark, zones.path("silver", "dim_counterparty"))
    assert {r.country_code for r in dim.collect()} == {"US", "DE"}
