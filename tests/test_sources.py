import csv
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from lexlake.functions.business import FORM_CATEGORIES, form_category, mean_money, risk_tier
from lexlake.functions.keys import pipe_hash, row_hash
from lexlake.functions.text import collapse, header_key, like_any_case, strip
from lexlake.plans import staging
from lexlake.sources import files, headers, pages, quoted

SUBMISSIONS = [
    {
        "cik": 1900417,
        "name": "Brightwater Timber Co",
        "filings": {
            "recent": {  # the newest first; shorter lists lack the values of the oldest
                "accessionNumber": ["0001900417-23-000031", "0001900417-23-000017", "0001900417-22-000052"],
                "filingDate": ["2023-05-11", "2023-03-02", "2022-11-09"],
                "form": ["10-Q", "10-K", "8-K"],
                "reportDate": ["2023-03-31"],
                "primaryDocument": ["q1.htm", "annual.htm"],
            }
        },
    },
    {
        "cik": 77012,
        "name": "",
        "filings": {"recent": {"accessionNumber": ["0000077012-23-000004"], "filingDate": ["2023-04-20"], "form": ["10-Q"], "primaryDocument": ["r.htm"]}},
    },
]


@pytest.fixture
def submissions(spark, tmp_path):
    for i, s in enumerate(SUBMISSIONS):
        (tmp_path / f"p{i}.json").write_text(json.dumps(s, indent=1))
    return pages.read_pages(spark, str(tmp_path), pages.SUBMISSION)


@pytest.fixture
def companies(spark):
    rows = [(1900417, "BWTC", "Brightwater Timber Co"), (77012, "OSLK", "OSTLAKE MILLS LTD")]
    return spark.createDataFrame(rows, "cik bigint, ticker string, title string")


def test_filings(submissions, companies):
    docs = pages.filings_normalize(pages.filings_flatten(submissions), companies)
    rows = {r.source_id: r for r in docs.collect()}
    assert len(rows) == 4
    r = rows["0001900417-23-000017"]
    assert r.document_type == "ANNUAL_REPORT" and r.jurisdiction == "US-SEC" and r.tags == ["10-k", "bwtc"]
    assert r.title == "Brightwater Timber Co (BWTC) — 10-K filing 2023-03-02"
    assert r.metadata.filing_url.endswith("/1900417/000190041723000017/annual.htm")
    import hashlib

    assert r.source_hash == hashlib.sha256(b"sec_edgar|0001900417-23-000017|2023-03-02").hexdigest()
    m = rows["0000077012-23-000004"]
    assert m.metadata.company_name == "OSTLAKE MILLS LTD" and m.metadata.report_date is None and m.content is None
    assert rows["0001900417-23-000031"].metadata.report_date is not None
    oldest = rows["0001900417-22-000052"].metadata
    assert oldest.report_date is None and oldest.filing_url.rstrip("/").endswith("/1900417/000190041722000052")
    assert len({r.source_hash for r in rows.values()}) == 4
    assert pages.filings_filter(docs, forms=["10-K"]).count() == 1
    assert pages.filings_filter(docs, since=F.lit(dt.date(2023, 3, 1))).count() == 3
    assert pages.filings_filter(docs, since=F.lit(dt.date(2023, 5, 11))).count() == 1


def test_filings_without_company_list(submissions):
    docs = pages.filings_normalize(pages.filings_flatten(submissions))
    assert {r.tags[1] for r in docs.collect()} == {"unknown"}


def test_incomplete_filings_are_left_out(spark):
    recent = {
        "accessionNumber": ["a", "b", "", "d", "e"],
        "filingDate": ["2024-1-5", "2024-01-05", "2024-01-05", None, "soon"],
        "form": ["10-K", "", "10-K", "10-K", "10-K"],
    }
    body = json.dumps({"cik": 1, "name": "X", "filings": {"recent": recent}})
    parsed = spark.createDataFrame([(body,)], "b string").select(F.from_json("b", pages.SUBMISSION).alias("p")).select("p.*")
    flat = pages.filings_flatten(parsed)
    assert flat.count() == 5
    assert pages.filings_normalize(flat).count() == 0


def registry(records, page=1):
    return {"meta": {"pagination": {"currentPage": page, "perPage": 2, "total": 3, "lastPage": 2}}, "data": records}


def record(lei, name, country, **entity):
    body = {"legalName": {"name": name}, "legalAddress": {"country": country}, "status": "ACTIVE", **entity}
    return {"id": lei, "type": "lei-records", "attributes": {"lei": lei, "entity": body, "registration": {"initialRegistrationDate": "2015-02-17"}}}


def test_registry(spark, tmp_path):
    one = [record("5299000BRIGHTWATER01", "Brightwater Timber", "us", legalForm={"id": "A1B2"}), record("9845000OSTLAKEMILLS2", "Ostlake Mills", "CA")]
    two = [record("2138000NORDKAPFISH33", "Nordkap Fish", "NO")]
    bad = [{"id": "X", "type": "lei-records", "attributes": {}}, record("Y", "", "US"), record("", "A", "US"), record("Z", "A", None)]
    for i, p in enumerate((one, two, bad), 1):
        (tmp_path / f"p{i}.json").write_text(json.dumps(registry(p, i)))
    df = pages.read_pages(spark, str(tmp_path), pages.REGISTRY_PAGE)
    rows = {r.external_id: r for r in pages.registry_counterparties(df).collect()}
    assert len(rows) == 3
    r = rows["LEI-5299000BRIGHTWATER01"]
    assert (r.country_code, r.tax_id, r.risk_score, r.metadata.legal_form) == ("US", "5299000BRIGHTWATER01", None, "A1B2")
    first = pages.keep_pages(df, "meta.pagination.currentPage", 1)
    assert pages.registry_counterparties(first).count() == 2
    assert pages.registry_counterparties(df.where("meta.pagination.currentPage = 3")).count() == 0


def test_flatten_missing_path(spark):
    df = spark.sql("select 1 as page, named_struct('items', array(1, 2)) as result")
    assert pages.flatten(df, "result.items", ["page"]).count() == 2
    assert pages.flatten(df, "result.rows").count() == 0
    assert pages.flatten(df, "nothing.here").count() == 0
    assert pages.flatten(df.where("false"), "result.items").count() == 0


def test_csv(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_bytes("id;name;tax\n1;Müller;007\n2;;\n".encode("latin-1"))
    rows = files.scan_csv(spark, str(path), sep=";", encoding="ISO-8859-1").collect()
    assert [tuple(r) for r in rows] == [("1", "Müller", "007"), ("2", None, None)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.scan_csv(spark, str(tmp_path / "bad.csv"), ["a", "b"]).collect()


def test_source_registry(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a\n1\n")
    assert files.read_source(spark, "csv", path=str(tmp_path / "f.csv")).count() == 1
    files.register_source("range", lambda s, n: s.range(n))
    assert files.read_source(spark, "range", n=3).count() == 3
    with pytest.raises(ValueError):
        files.read_source(spark, "nope")


DETECT = [
    ("doc_id,date,type,title,jurisdiction", "legal_documents", 1.0),
    ("External ID, Name ,tax-id,Country_Code,risk score", "counterparties", 1.0),
    ("transaction_date,amount,currency,reference", "transactions", 1.0),
    ("id,name,x,y", "legal_documents", 0.5),  # tie: the feed tried first
    ("x,y", "unknown", 0.0),
    ("id,x,y", "legal_documents", 1 / 3),
]


def test_header_detection(spark):
    lines = spark.createDataFrame([(str(i), h) for i, (h, _, _) in enumerate(DETECT)], "file string, header string")
    got = {r.file: r for r in headers.detect(headers.header_rows(lines)).collect()}
    for i, (h, schema, score) in enumerate(DETECT):
        r = got[str(i)]
        assert (r.schema, r.confident) == (schema, score >= 0.5) and r.score == pytest.approx(score, abs=1e-6)
        assert sorted(r.matched + r.unknown) == sorted(h.split(","))
    long = lines.select("file", F.posexplode(F.split("header", ",")).alias("position", "header"))
    assert {r.file: r.schema for r in headers.detect_by_position(long).collect()} == {k: r.schema for k, r in got.items()}
    none = spark.createDataFrame([("e", [])], "file string, headers array<string>")
    assert headers.detect(none).first().schema == "unknown"


def test_map_legal_csv_fallbacks(spark):
    rows = [
        ("D1", "S1", "2025-01-01", None, "judgment", "body", None),
        ("", "S2", "", "2025-02-02", "", None, "sys"),
        (None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "doc_id string, source_id string, date string, document_date string, type string, body string, source_system string"
    )
    a, b, c = staging.map_legal_csv(df).collect()
    assert (a.source_id, a.document_date, a.document_type, a.content) == ("D1", "2025-01-01", "judgment", "body")
    assert a.source_system is None and a.title == "" and a.jurisdiction == "UNKNOWN" and a.tags == []
    assert (b.source_id, b.document_date, b.document_type, b.source_system) == ("S2", "2025-02-02", "NOTICE", "sys")
    import hashlib

    assert c.source_hash == hashlib.sha256(b"None||None").hexdigest()
    assert json.loads(b.metadata)["original_source_row"]["source_id"] == "S2"
    bare = staging.map_legal_csv(df.drop("source_system")).first()
    assert bare.source_system == "legal_csv"


def test_enrichment(spark):
    df = spark.sql("select 10 as risk_score, map('a', 'b', 'risk_tier', 'OLD') as metadata")
    assert staging.enrich_commercial(df).first().metadata == {"a": "b", "risk_tier": "LOW"}
    assert staging.enrich_commercial(df.drop("metadata")).first().metadata == {"risk_tier": "LOW"}
    assert staging.enrich_commercial(df.drop("risk_score")).columns == ["metadata"]


@pytest.mark.parametrize(
    "score,tier",
    [(None, "UNKNOWN"), (10, "LOW"), (24.99, "LOW"), (25, "MODERATE"), (30, "MODERATE"), (50, "HIGH"), (60, "HIGH"), (75, "CRITICAL"), (90, "CRITICAL")],
)
def test_risk_tier(spark, score, tier):
    assert spark.range(1).select(risk_tier(F.lit(score).cast("decimal(5,2)"))).first()[0] == tier


def test_forms(spark):
    assert len(FORM_CATEGORIES) == 21
    rows = spark.createDataFrame([("10-K",), ("SC 13G",), ("XYZ",), (None,)], "f string").select(form_category("f")).collect()
    assert [r[0] for r in rows] == ["ANNUAL_REPORT", "OWNERSHIP_DISCLOSURE", "OTHER_FILING", "OTHER_FILING"]


def test_row_hash(spark):
    df = spark.sql("select 'x' as a, cast(null as string) as b, 'x' as c")
    one, other, null_is_not_text = df.select(
        row_hash(["a", "b"]), row_hash(["b", "a"]), row_hash({"a": F.lit("x"), "b": F.lit("null")})
    ).first()
    assert one == other != null_is_not_text
    assert df.select(pipe_hash("a", "b")).first() != df.select(pipe_hash("a", "c")).first()


def test_text(spark):
    odd = "   a  b 　\t"
    df = spark.createDataFrame([(odd, "Document ID-x ", "50%_off")], "a string, h string, p string")
    r = df.select(strip("a"), collapse("a"), header_key("h"), like_any_case("p", "%_O"), like_any_case("p", "5_%")).first()
    assert r[0] == "a  b" and r[1] == "a b" and r[2] == "document_id_x" and r[3] and not r[4]


def test_mean_rounds_half_away_from_zero_once(spark):
    def mean(total, n):
        t = F.lit(total).cast("decimal(38,2)")
        return str(spark.range(1).select(mean_money(t, F.lit(n).cast("bigint"))).first()[0])

    assert mean("0.01", 2) == "0.01" and mean("-0.01", 2) == "-0.01"
    assert mean("1.00", 3) == "0.33" and mean("0.00", 0) == "None"
    # 1.0049999999 must not become 1.01 by way of 1.005
    assert mean("100499999.99", 100000000) == "1.00"


def test_bronze_to_silver_keeps_one_copy(spark):
    schema = "source_system string, source_id string, document_date date, document_type string, title string, jurisdiction string, content string, ingested_at timestamp"
    day = dt.date(2025, 1, 1)
    rows = [
        ("s", "1", day, "notice", " old ", " US ", None, dt.datetime(2025, 1, 1)),
        ("s", "1", day, "notice", " new ", "US", None, dt.datetime(2025, 1, 2)),
        ("s", "2", day, "notice", "x", "US", None, dt.datetime(2025, 1, 1)),
    ]
    out = {r.source_id: r for r in staging.bronze_to_silver(spark.createDataFrame(rows, schema)).collect()}
    assert len(out) == 2 and (out["1"].title, out["1"].document_type, out["1"].jurisdiction) == ("NEW", "NOTICE", "US")


def split_small(spark, size):
    """Byte ranges of a few lines, so that small files are split over many tasks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("last", ["", None])
def test_quoted_csv_is_split(spark, tmp_path, small_ranges, end, last):
    rng = random.Random(7)
    bits = ["plain", "x", '""', ",", "\n", "\r\n", "é世", " ", '""\n""', "\n\n\n"]
    body = ['"id",text,"the ""note""\nof it"']
    for i in range(400):
        field = '"' + "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 3, 30]))) + '"'
        body.append(f"{i},{rng.choice(['', 'word', field])},{field}" + ("" if i % 9 else end))
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.csv").write_text(end.join(body) + (end if last is None else last), newline="")
    (path / "b.csv").write_text(end.join(body[:30]), newline="")
    (path / "empty.csv").write_text("")
    split_small(spark, 1000)
    want = []
    for name in ("a.csv", "b.csv"):
        with open(path / name, newline="") as f:
            head, *rows = [tuple(r) for r in csv.reader(f) if r]
            want += rows
    got = files.scan_csv(spark, str(path))
    assert tuple(got.columns) == head and len(want) == 429
    assert quoted.lines(spark, str(path / "a.csv")).rdd.getNumPartitions() >= 8
    found = [tuple(r) for r in got.collect()]
    assert sorted(tuple(x or "" for x in r) for r in found) == sorted(want)
    if end == "\n":  # nulls and empty texts as in the reader that takes a file whole
        assert sorted(found, key=str) == sorted(map(tuple, files.scan_csv(spark, str(path), whole_files=True).collect()), key=str)


def test_quoted_csv_names(spark, tmp_path):
    (tmp_path / "n.csv").write_text('a,,A,"b\n\nc"\n1,2,3,"x\ny"\n')
    df = files.scan_csv(spark, str(tmp_path / "n.csv"))
    assert df.columns == files.scan_csv(spark, str(tmp_path / "n.csv"), whole_files=True).columns == ["a0", "_c1", "A2", "b\n\nc"]
    assert tuple(df.first()) == ("1", "2", "3", "x\ny")
    plain = files.scan_csv(spark, str(tmp_path / "n.csv"), header=False)
    assert plain.columns == ["_c0", "_c1", "_c2", "_c3"] and plain.count() == 2


def test_quoted_csv_that_is_not(spark, tmp_path, small_ranges):
    split_small(spark, 64)

    def made(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    with pytest.raises(ValueError, match="not closed"):
        files.scan_csv(spark, made("open.csv", 'a,b\n1,"x\n2,y\n'))
    stray = made("stray.csv", 'a,b\n1,5" pipe\n2,y\n3,6" pipe\n')
    with pytest.raises(Exception, match="record borders"):
        files.scan_csv(spark, stray).collect()
    assert files.scan_csv(spark, stray, whole_files=True).count() == 3
    with pytest.raises(Exception, match="header"):
        files.scan_csv(spark, made("header.csv", 'a,b\n1,"x\ny"\n'), ["a", "c"]).collect()
    with pytest.raises(Exception, match="MALFORMED"):
        files.scan_csv(spark, made("short.csv", 'a,b\n1,"x\ny"\n2\n'), ["a", "b"]).collect()
    one = files.scan_csv(spark, made("one.csv", 'a\n"' + "line\n" * 200 + '"\n'))
    assert [r.a for r in one.collect()] == ["line\n" * 200]
    assert files.scan_csv(spark, made("none.csv", '"a\n","b"\n')).count() == 0
