import math

import pytest
from pyspark.sql import functions as F

from lexlake.operators import dq
from lexlake.operators import expectations as ex
from lexlake.operators.dq import Rule


@pytest.fixture(scope="module")
def frame(spark):
    rows = [
        (1, "a@x.com", "ACTIVE", 100),
        (2, "b@x.com", "ACTIVE", 200),
        (3, None, "INACTIVE", -5),
        (4, "bad-email", "ACTIVE", 5_000_000),
        (5, "e@x.com", "UNKNOWN", 300),
    ]
    return spark.createDataFrame(rows, "id int, email string, status string, amount bigint")


def failed(df, rule):
    return dq.run_suite(df, [rule]).first()


@pytest.mark.parametrize(
    "rule,count",
    [
        (Rule("r", "not_null", "id"), 0),
        (Rule("r", "not_null", "email"), 1),
        (Rule("r", "regex", "email", {"pattern": r"^[^@]+@[^@]+$"}), 1),
        (Rule("r", "regex", "email", {"pattern": "@x"}), 4),  # anchored at the start
        (Rule("r", "in_set", "status", {"values": ["ACTIVE", "INACTIVE"]}), 1),
        (Rule("r", "in_set", "email", {"values": ["a@x.com"]}), 4),  # null fails
        (Rule("r", "in_set", "email", {"values": ["a@x.com", None]}), 3),
        (Rule("r", "range", "amount", {"min": 0, "max": 1_000_000}), 2),
        (Rule("r", "row_count_range", None, {"min": 10, "max": 100}), 1),
        (Rule("r", "row_count_range", None, {"min": 5}), 0),
        (Rule("r", "expression", None, {"expr": "amount > 0"}), 1),
        (Rule("r", "expression", None, {"expr": "email like '%x%'"}), 1),  # null passes
    ],
)
def test_counts(frame, rule, count):
    r = failed(frame, rule)
    assert r.failed_count == count and r.passed == (count == 0)
    assert bool(r.message) == (count > 0)


def test_unique_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert failed(df, Rule("u", "unique", "v")).failed_count == 1
    df = spark.createDataFrame([(None,), (None,), (2,)], "v int")
    assert failed(df, Rule("u", "unique", "v")).failed_count == 1
    df = spark.createDataFrame([], "v int")
    assert failed(df, Rule("u", "unique", "v")).failed_count == 0


def test_range_ignores_null(spark):
    df = spark.createDataFrame([(None,), (5,)], "v int")
    assert failed(df, Rule("r", "range", "v", {"min": 0})).failed_count == 0


@pytest.mark.parametrize(
    "rule",
    [
        Rule("r", "nonsense", "id"),
        Rule("r", "not_null", "no_such_column"),
        Rule("r", "range", "email", {"min": 1}),
        Rule("r", "expression", None, {"expr": "no_such_column > 1"}),
        Rule("r", "expression", None, {"expr": "amount + 1"}),
    ],
)
def test_a_rule_that_cannot_run_is_a_failed_rule(frame, rule):
    r = failed(frame, rule)
    assert not r.passed and r.message.startswith("Rule evaluation error")


def test_suite_reads_the_frame_once_besides_unique(frame):
    df = frame.repartition(3)
    rules = [Rule("a", "not_null", "id"), Rule("b", "range", "amount", {"min": 0}), Rule("c", "row_count_range")]
    plan = dq.run_suite(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_gate(frame):
    bad = dq.run_suite(frame, [Rule("email_set", "not_null", "email")])
    with pytest.raises(dq.QualityError, match="email_set: 1 nulls in email"):
        dq.gate(bad, frame)
    assert dq.gate(bad, frame, "drop").count() == 0
    warning = dq.run_suite(frame, [Rule("email_set", "not_null", "email", severity="warning")])
    assert dq.gate(warning, frame).count() == 5


def test_summary_and_samples(frame):
    rules = [
        Rule("a", "not_null", "email"),
        Rule("b", "in_set", "status", {"values": ["ACTIVE"]}, "warning"),
        Rule("c", "row_count_range", None, {"min": 1}),
    ]
    row = dq.summarize(dq.run_suite(frame, rules, "s")).first()
    assert (row.suite, row.total, row.passed, row.blocking, row.warnings) == ("s", 3, 1, 1, 1)
    assert [r.value for r in dq.failure_samples(frame, rules, 1).collect()] == ["INACTIVE"]


def test_builtin_suites_load():
    assert len(dq.builtin_rules("legal_documents")) == 7
    assert len(dq.builtin_rules("transactions")) == 7


def test_yaml_rules(tmp_path, frame):
    pytest.importorskip("yaml")
    path = tmp_path / "r.yaml"
    path.write_text("suite: s\nrules:\n  - {name: a, type: not_null, column: email}\n")
    assert dq.run_suite(frame, dq.load_rules(path)).first().failed_count == 1


def test_registered_rule(frame):
    dq.register_rule("even", lambda c, p: c % 2 != 0)
    try:
        assert failed(frame, Rule("e", "even", "id")).failed_count == 3
    finally:
        del dq.ROW_RULES["even"]


def test_large_frame(spark):
    df = spark.range(50_000).select(
        "id",
        F.concat(F.lit("TXN-"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("reference"),
        F.lit("USD").alias("currency"),
        (F.col("id") * 1.5).alias("amount"),
    )
    rules = [
        Rule("a", "not_null", "reference"),
        Rule("b", "unique", "reference"),
        Rule("c", "regex", "currency", {"pattern": "^[A-Z]{3}$"}),
        Rule("d", "range", "amount", {"min": 0, "max": 1e6}),
        Rule("e", "row_count_range", None, {"min": 1}),
    ]
    assert dq.run_suite(df, rules).where("passed").count() == 5


def test_expectations_leave_nulls_out(frame):
    suite = ex.build_suite(
        {
            "email": [
                {"type": "expect_column_values_to_not_be_null"},
                {"type": "expect_column_values_to_match_regex", "kwargs": {"regex": "@"}},
                {"type": "expect_column_values_to_be_unique"},
            ],
            "status": [{"type": "expect_column_values_to_be_unique"}],
            "amount": [
                {"type": "expect_column_values_to_be_between", "kwargs": {"min_value": 0, "mostly": 0.8}},
                {"type": "expect_column_mean_to_be_between", "kwargs": {"max_value": 10}},
            ],
        }
    )
    got = {(r.column, r.expectation[7:]): r for r in ex.validate(frame, suite).collect()}
    assert got["email", "column_values_to_not_be_null"].unexpected_count == 1
    r = got["email", "column_values_to_match_regex"]
    assert (r.missing_count, r.unexpected_count, r.unexpected_percent) == (1, 1, 25.0)
    assert got["email", "column_values_to_be_unique"].success
    assert got["status", "column_values_to_be_unique"].unexpected_count == 3
    assert got["amount", "column_values_to_be_between"].success
    assert not got["amount", "column_mean_to_be_between"].success


def test_unknown_expectation(frame):
    with pytest.raises(ValueError):
        ex.validate(frame, ex.build_suite({"id": [{"type": "expect_magic"}]}))


def test_drift(spark):
    ref = spark.createDataFrame([("a",)] * 6 + [("b",)] * 4, "v string")
    cur = spark.createDataFrame([("a",)] * 3 + [("c",)] * 7, "v string")
    row = ex.drift(ref, cur, "v").first()
    p = {"a": 4 / 13, "b": 1 / 13, "c": 8 / 13}
    q = {"a": 7 / 13, "b": 5 / 13, "c": 1 / 13}
    want = sum(p[k] * math.log(p[k] / q[k]) for k in p)
    assert row.kl_divergence == pytest.approx(want, abs=1e-6)
    assert ex.drift(ref, ref, "v").first().kl_divergence == pytest.approx(0, abs=1e-9)


def test_profile(frame):
    got = {r.column: r for r in ex.profile(frame).collect()}
    assert got["email"].nulls == 1 and got["id"].min_value == "1" and got["amount"].quantiles is not None
    assert got["status"].approx_distinct == 3


def test_freshness(spark):
    df = spark.sql("select timestamp_ntz'2025-01-01 00:00:00' as t")
    at = lambda h: dq.freshness(df, "t", F.expr(f"timestamp_ntz'2025-01-01 00:00:00' + interval '{h}' hour")).first()
    assert [at(h).status for h in (12, 13, 24, 25)] == ["ok", "warn", "warn", "error"]
    assert dq.freshness(df.where("false"), "t", F.expr("timestamp_ntz'2025-01-01 00:00:00'")).first().status == "error"


def test_drift_expectation(spark):
    base = spark.range(1000).selectExpr("CAST(id AS DECIMAL(12,2)) AS n", "CASE WHEN id % 10 < 7 THEN 'a' WHEN id % 10 < 9 THEN 'b' END AS v")
    for column in ("n", "v"):
        e = ex.drift_expectation(base, column, 0.01, bins=4)
        assert sum(e.kwargs["counts"]) == 1000
        row = ex.validate(base, [e]).first()
        assert row.success and row.observed_value == pytest.approx(0, abs=1e-9)
    moved = spark.range(1000).selectExpr("CAST(CASE WHEN id < 900 THEN id % 100 END AS DECIMAL(12,2)) AS n", "'c' AS v", "id")
    e = ex.drift_expectation(base, "n", 0.01, bins=4)
    edges, stored = [float(x) for x in e.kwargs["edges"]], e.kwargs["counts"]
    assert all(240 <= c <= 260 for c in stored[:-1]) and stored[-1] == 0
    seen = [0] * len(stored)
    for r in moved.collect():
        seen[-1 if r.n is None else sum(float(r.n) >= x for x in edges)] += 1
    p, q = ([(c + 1) / (1000 + len(stored)) for c in side] for side in (seen, stored))
    want = sum(a * math.log(a / b) for a, b in zip(p, q, strict=True))
    row = ex.validate(moved, [e, *ex.build_suite({"id": [{"type": "expect_column_values_to_not_be_null"}]})]).collect()
    assert [r.success for r in row] == [False, True] and row[0].observed_value == pytest.approx(want, abs=1e-6)
    other = ex.validate(moved, [ex.drift_expectation(base, "v", 0.01)]).first()
    assert not other.success
    # a value no baseline row has is infinitely far without smoothing; an empty table is no evidence
    assert ex.validate(moved, [ex.drift_expectation(base, "v", 0.01, smoothing=0)]).first().observed_value == math.inf
    assert not ex.validate(base.limit(0), [e]).first().success
    none = ex.drift_expectation(base.limit(0), "v", 9.0)
    assert none.kwargs["values"] == [] and ex.validate(base, [none]).first().success
