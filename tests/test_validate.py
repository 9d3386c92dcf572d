import pytest
from pyspark.sql import functions as F

from lexlake.contracts import CONTRACTS, contract_for
from lexlake.operators import validate
from lexlake.operators.validate import ERRORS, apply_contract


def check(spark, kind, rows, schema):
    return apply_contract(spark.createDataFrame(rows, schema), CONTRACTS[kind])


def errors(row):
    return {(e.loc, e.type) for e in row[ERRORS]}


DOC = (
    "document_date string, source_system string, source_id string, source_hash string, document_type string, "
    "title string, jurisdiction string, tags array<string>"
)


def doc(**kw):
    base = {
        "document_date": "2025-01-15",
        "source_system": "api:courts",
        "source_id": "DOC-1",
        "source_hash": "a" * 64,
        "document_type": "judgment",
        "title": "Ruling",
        "jurisdiction": "US-NY",
        "tags": ["Foo", "foo", " BAR ", "bar", "  "],
    }
    base.update(kw)
    return tuple(base.values())


def test_document(spark):
    ok, short = check(spark, "document", [doc(), doc(source_hash="abc")], DOC).collect()
    assert not ok[ERRORS]
    assert ok.document_type == "JUDGMENT" and ok.tags == ["foo", "bar"]
    assert str(ok.document_date) == "2025-01-15" and ok.metadata == "{}" and ok.ingested_at is not None
    assert errors(short) == {("source_hash", "string_too_short")}


def test_document_collects_every_error(spark):
    row = check(spark, "document", [doc(document_date="2025-1-5", title="  ", jurisdiction=None, source_id="x" * 201)], DOC)
    assert errors(row.first()) == {
        ("document_date", "date_parsing"),
        ("title", "string_too_short"),
        ("jurisdiction", "string_type"),
        ("source_id", "string_too_long"),
    }


@pytest.mark.parametrize(
    "text,ok",
    [
        ("2025-01-15", True),
        ("2025-01-15T00:00:00", True),
        ("2025-01-15T10:00:00", False),
        ("2025", False),
        ("2025-02-30", False),
        ("15/01/2025", False),
        ("", False),
    ],
)
def test_dates(spark, text, ok):
    row = check(spark, "document", [doc(document_date=text)], DOC).first()
    assert (not row[ERRORS]) == ok


ENTITY = "tax_id string, legal_name string, entity_type string, jurisdiction string, status string"


def test_entity(spark):
    rows = [
        ("12345", "  acme  corp  ", "LLC", "US", "active"),
        ("12345", "acme", "LLC", "US", "FROZEN"),
        (" 123 ", " a b\t", "LLC", "U", "ACTIVE"),
    ]
    a, b, c = check(spark, "entity", rows, ENTITY).collect()
    assert a.legal_name == "ACME CORP" and a.status == "ACTIVE" and not a[ERRORS]
    assert errors(b) == {("status", "value_error")}
    assert errors(c) == {("tax_id", "string_too_short"), ("jurisdiction", "string_too_short")}
    assert c.legal_name == "A B"


def test_default_only_for_an_absent_column(spark):
    row = check(spark, "entity", [("12345", "a", "LLC", "US")], ENTITY.rsplit(",", 1)[0]).first()
    assert row.status == "ACTIVE" and not row[ERRORS]
    row = check(spark, "entity", [("12345", "a", "LLC", "US", None)], ENTITY).first()
    assert errors(row) == {("status", "string_type")}


TXN = (
    "transaction_date string, contract_number string, counterparty_external_id string, amount string, currency string, "
    "transaction_type string, reference string, source_system string"
)


def txn(amount="10.5", currency="usd", kind="invoice"):
    return ("2025-01-15", "CT-1", "CP-1", amount, currency, kind, "TXN-1", "erp:sap")


@pytest.mark.parametrize(
    "amount,found",
    [
        ("10.5", set()),
        (" -3.456 ", set()),
        ("0", {("amount", "value_error")}),
        ("0.001", {("amount", "value_error")}),
        ("1e3", set()),
        ("1e20", {("amount", "decimal_parsing")}),
        ("ten", {("amount", "decimal_parsing")}),
        (None, {("amount", "decimal_type")}),
    ],
)
def test_transaction_amount(spark, amount, found):
    row = check(spark, "transaction", [txn(amount)], TXN).first()
    assert errors(row) == found
    assert row.currency == "USD" and row.transaction_type == "INVOICE"


def test_transaction_missing_column(spark):
    row = check(spark, "transaction", [txn()[:-1]], TXN.rsplit(",", 1)[0]).first()
    assert errors(row) == {("source_system", "missing")}


def test_contract(spark):
    schema = (
        "contract_number string, counterparty_external_id string, start_date string, end_date string, total_value string, "
        "currency string, status string"
    )
    rows = [
        ("CT-1", "CP-1", "2025-01-01", None, "100", "usd", "draft"),
        ("CT-1", "CP-1", "2025-01-01", None, "-1", "usd", "draft"),
        ("CT-1", "CP-1", "2025-01-02", "2025-01-01", "1", "usd", "PENDING"),
    ]
    a, b, c = check(spark, "contract", rows, schema).collect()
    assert not a[ERRORS] and a.status == "DRAFT"
    assert errors(b) == {("total_value", "greater_than_equal")}
    assert errors(c) == {("status", "value_error"), ("end_date", "value_error")}


def test_counterparty(spark):
    schema = "external_id string, name string, country_code string, risk_score string"
    rows = [("CP-1", "A", "us", s) for s in ("150", "100", "100.004", "-0.01", "0", None, "1000000")]
    found = [errors(r) for r in check(spark, "counterparty", rows, schema).collect()]
    bad = {("risk_score", "value_error")}
    assert found == [bad, set(), bad, bad, set(), set(), bad]
    valid = validate.valid_rows(check(spark, "counterparty", rows, schema), CONTRACTS["counterparty"])
    assert valid.schema["risk_score"].dataType.simpleString() == "decimal(5,2)"


def test_regulation_range(spark):
    schema = "code string, title string, jurisdiction string, effective_from string, effective_to string, category string"
    rows = [("R1", "T", "EU", "2025-01-01", to, "tax") for to in ("2025-01-01", "2024-12-31", None)]
    rows.append(("R1", "T", "EU", "never", "2024-12-31", "tax"))
    a, b, c, d = check(spark, "regulation", rows, schema).collect()
    assert not a[ERRORS] and not c[ERRORS]
    assert errors(b) == {("effective_to", "value_error")}
    assert errors(d) == {("effective_from", "date_parsing")}


def test_split_and_rate(spark):
    df = spark.createDataFrame([doc(), doc(source_hash="x")], DOC)
    contract = contract_for("document")
    valid, rejected = validate.split(df, contract)
    assert valid.count() == 1 and rejected.count() == 1
    bad = rejected.first()
    assert bad.schema == "LegalDocument" and '"source_hash":"x"' in bad.raw
    n = validate.outcome_counts(apply_contract(df, contract)).first()
    assert (n.total, n.valid, n.rejected) == (2, 1, 1) and 0.4 < n.rejection_rate < 0.6
    assert validate.outcome_counts(apply_contract(df.where("false"), contract)).first().rejection_rate == 0.0


def test_unknown_kind():
    with pytest.raises(ValueError):
        contract_for("invoice")


def test_errors_are_not_worked_out_in_a_pushed_filter(spark):
    df = spark.createDataFrame([txn()], TXN).repartition(2)
    valid = validate.valid_rows(apply_contract(df, CONTRACTS["transaction"]), CONTRACTS["transaction"])
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert not any("Filter" in line and "array_compact" in line for line in plan.splitlines())


def test_unknown_fields_are_dropped(spark):
    df = spark.createDataFrame([txn() + ("zz",)], TXN + ", extra string")
    valid, _ = validate.split(df, CONTRACTS["transaction"])
    assert "extra" not in valid.columns and valid.where(F.col("amount") == 10.5).count() == 1
