import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lexlake.operators import joins, keyed, partitions
from lexlake.operators.percentiles import latency_percentiles
from lexlake.sources import files, sinks

T0, T1 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
SCHEMA = "external_id string, name string, risk_score decimal(5,2)"


def stamped(df, at):
    return df.withColumns({"created_at": F.lit(at), "updated_at": F.lit(at)})


def test_upsert_inserts_and_updates(spark):
    target = stamped(spark.createDataFrame([("CP-1", "A", Decimal("10.00"))], SCHEMA), T0)
    batch = spark.createDataFrame([("CP-1", "A", Decimal("42.50")), ("CP-2", None, None)], SCHEMA)
    out = {r.external_id: r for r in keyed.upsert(target, batch, ["external_id"], ["name"], F.lit(T1)).collect()}
    assert out["CP-1"].risk_score == Decimal("42.50")
    assert (out["CP-1"].created_at, out["CP-1"].updated_at) == (T0, T1)
    assert (out["CP-2"].created_at, out["CP-2"].name) == (T1, None)


def test_upsert_takes_null_and_limits_columns(spark):
    target = spark.createDataFrame([("CP-1", "A", Decimal("10.00"))], SCHEMA)
    batch = spark.createDataFrame([("CP-1", None, Decimal("1.00"))], SCHEMA)
    row = keyed.upsert(target, batch, ["external_id"], ["risk_score"]).first()
    assert row.name is None and row.risk_score == 1
    row = keyed.upsert(target, batch, ["external_id"], ["risk_score"], update=["risk_score"]).first()
    assert row.name == "A" and row.risk_score == 1


@pytest.mark.parametrize("seed", [3, 4])
def test_upsert_twice_is_upsert_once(spark, seed, tmp_path):
    rnd = random.Random(seed)
    schema = "k int, day date, v int"
    def rows(n):
        return [(rnd.randrange(30), dt.date(2025, rnd.randrange(1, 5), 1), rnd.randrange(100)) for _ in range(n)]

    first, second = rows(40), rows(40)
    path = str(tmp_path / "t")
    state: dict = {}
    for feed in (first, second, second):
        df = partitions.with_month(spark.createDataFrame(feed, schema), "day")
        loaded = keyed.upsert_table(spark, path, df, ["k", "day"], ["v"], "month", F.lit(T1))
        best: dict = {}
        for k, d, v in feed:
            best[k, d] = max(v, best.get((k, d), -1))
        assert loaded == len(best)
        state.update(best)
        got = {(r.k, r.day): r.v for r in spark.read.parquet(path).collect()}
        assert got == state


def test_upsert_leaves_other_months_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.date(2025, 1, 1), 1), (2, dt.date(2025, 2, 1), 1)], "k int, day date, v int")
    keyed.upsert_table(spark, path, partitions.with_month(df, "day"), ["k", "day"], ["v"], "month")
    january = sorted(p.name for p in (tmp_path / "t" / "month=2025_01").iterdir())
    keyed.upsert_table(
        spark, path, partitions.with_month(df.where("k = 2"), "day"), ["k", "day"], ["v"], "month"
    )
    assert sorted(p.name for p in (tmp_path / "t" / "month=2025_01").iterdir()) == january
    assert keyed.upsert_table(spark, path, partitions.with_month(df.where("false"), "day"), ["k", "day"], ["v"], "month") == 0


def test_special_characters_round_trip(spark, tmp_path):
    values = ['say "hi"', "a,b", "line\nbreak", "ünï — 漢字", "back\\slash", " padded ", ""]
    df = spark.createDataFrame(list(enumerate(values)), "id int, text_value string")
    out = str(tmp_path / "csv")
    sinks.write_csv(df, out)
    back = files.scan_csv(spark, out, ["id", "text_value"])
    assert {int(r.id): r.text_value for r in back.collect()} == {i: v or None for i, v in enumerate(values)}


def test_encoding(spark):
    df = spark.sql(
        "select true as b, date'2025-01-02' as d, array('x') as a, named_struct('k', 1) as s, cast(1.50 as decimal(10,2)) as m,"
        " cast(null as string) as n, timestamp_ntz'2025-01-02 03:04:05' as t, timestamp_ntz'2025-01-02 03:04:05.5' as u"
    )
    r = sinks.encode_text(df).first()
    assert (r.b, r.d, r.a, r.s, r.m, r.n) == ("true", "2025-01-02", '["x"]', '{"k":1}', "1.50", None)
    assert (r.t, r.u) == ("2025-01-02T03:04:05", "2025-01-02T03:04:05.500000")


def test_append_counts(spark, tmp_path):
    df = spark.createDataFrame([("a", "n", Decimal("1.00"))] * 3, "id string, name string, amount decimal(10,2)")
    assert sinks.append_counted(df, str(tmp_path / "a"), ["name", "id"]) == 3
    assert spark.read.parquet(str(tmp_path / "a")).columns == ["name", "id"]


def test_json_column(spark):
    df = spark.createDataFrame([("1", '{"key": "value"}'), ("2", "{}")], "id string, data string")
    assert df.where(F.get_json_object("data", "$.key") == "value").count() == 1


def test_month_pruning(spark, tmp_path):
    df = spark.range(0, 400).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("day"), "id")
    path = str(tmp_path / "t")
    keyed.write_partitioned(partitions.with_month(df, "day"), path, "month", sort=["day"])
    stored = spark.read.parquet(path)
    cut = partitions.month_bounds(stored, "day", dt.date(2024, 6, 10), dt.date(2024, 8, 5))
    assert cut.count() == 57
    scan = cut.select("_metadata.file_path").distinct()
    assert {r[0].split("month=")[1][:7] for r in scan.collect()} == {"2024_06", "2024_07", "2024_08"}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    inv = {r.partition: r for r in partitions.inventory(stored).collect()}
    assert inv["2024_02"].rows == 29 and inv["2024_02"].bytes > 0 and sum(r.rows for r in inv.values()) == 400


def test_default_partition(spark):
    df = spark.createDataFrame([(dt.date(2030, 6, 15),), (dt.date(1999, 1, 1),), (None,)], "d date")
    rows = partitions.assign_month(df, "d", "t", dt.date(2030, 1, 1), dt.date(2030, 12, 1)).collect()
    assert (rows[0].partition, rows[0].range_start, rows[0].range_end) == ("t_2030_06", dt.date(2030, 6, 1), dt.date(2030, 7, 1))
    assert [r.partition for r in rows[1:]] == ["t_default"] * 2 and rows[1].is_default and rows[2].is_default


def test_published_versions(spark, tmp_path):
    root = str(tmp_path / "gold")
    assert partitions.current_version(spark, root) == 0
    with pytest.raises(FileNotFoundError):
        partitions.read_current(spark, root)
    assert partitions.publish(spark.range(3), root) == 1
    reader = partitions.read_current(spark, root)
    assert partitions.publish(spark.range(5), root) == 2
    assert (reader.count(), partitions.read_current(spark, root).count()) == (3, 5)


def test_watermark(spark):
    state = spark.createDataFrame([], "pipeline_name string, watermark timestamp")
    default = F.lit(T0)
    assert keyed.watermark_rows(state, "p", default).first().watermark == T0
    state = keyed.advance_watermark(state, spark.createDataFrame([("p", T1)], "pipeline_name string, watermark timestamp"))
    assert keyed.watermark_rows(state, "p", default).first().watermark == T1
    data = spark.createDataFrame([(1, T0), (2, T1)], "id int, updated_at timestamp")
    assert [r.id for r in files.newer_than(data, "updated_at", F.lit(T0)).collect()] == [2]
    assert files.new_mark(data, "updated_at", F.lit(T0)).first().watermark == T1
    assert files.new_mark(data.where("false"), "updated_at", F.lit(T0)).first().watermark == T0
    again = files.newer_than(data, "updated_at", F.lit(T1), F.expr("interval 40 days"))
    assert again.count() == 2


def test_left_join_big_right_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(3, 0), (None, 1)], "k int, r int")
    want = sorted(map(str, left.join(right, ["k"], "left").select("k", "l", "r").collect()))
    got = joins.left_join_big_right(left, right, ["k"]).select("k", "l", "r")
    assert sorted(map(str, got.collect())) == want


def test_resolve_and_orphans(spark):
    txn = spark.createDataFrame(
        [("CP-1", "CT-1", 1), ("CP-9", "CT-1", 2), ("CP-1", "CT-9", 3)],
        "counterparty_external_id string, contract_number string, n int",
    )
    cp = spark.createDataFrame([("CP-1", 11)], "external_id string, counterparty_id int")
    ct = spark.createDataFrame([("CT-1", 21)], "contract_number string, contract_id int")
    out = {r.n: r for r in joins.resolve_keys(txn, cp, ct).collect()}
    assert (out[1].resolved, out[2].resolved, out[3].resolved) == (True, False, False)
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    assert [r.fk for r in joins.orphans(child, spark.createDataFrame([(1,)], "id int"), "fk", "id").collect()] == [2]


@pytest.mark.parametrize("kind", ["spread", "hot", "tiny"])
def test_percentiles_are_exact(spark, kind):
    rnd = random.Random(5)
    groups: dict = {}
    for g in "abc":
        if kind == "tiny":
            groups[g] = [rnd.random() for _ in range({"a": 1, "b": 2, "c": 7}[g])]
        else:
            groups[g] = [rnd.random() * 1000 for _ in range(3000)]
            if kind == "hot":  # one value holds a third of the rows
                groups[g] += [12.5] * 1500
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None)]
    got = {r.g: r for r in latency_percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    import statistics

    for g, vs in groups.items():
        vs.sort()
        n, r = len(vs), got[g]
        assert r.n == n and (r.min_value, r.max_value) == (vs[0], vs[-1])
        assert r.p50 == pytest.approx(statistics.median(vs), abs=1e-12)
        assert r.p95 == vs[max(int(n * 0.95) - 1, 0)] and r.p99 == vs[max(int(n * 0.99) - 1, 0)]


def test_hot_key_dedupe_is_whole(spark):
    """One key holds a third of the rows; every key keeps exactly its newest row."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v")
    )
    got = {r.k: r.v for r in keyed.latest_per_key(df, ["k"], ["v"]).collect()}
    want: dict = {}
    for i in range(9000):
        k = -1 if i % 3 == 0 else i % 1000
        want[k] = i
    assert got == want
    assert keyed.duplicate_count(df, ["k"]).first().dropped == 9000 - len(want)
