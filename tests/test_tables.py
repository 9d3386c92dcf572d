"""Versioned keyed tables: loads that are stopped, repeated, incremental or come in micro-batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lexlake.operators import keyed, partitions, tables
from lexlake.plans import flows, incremental
from lexlake.sources import sinks
from lexlake.streaming import arrival

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
KEYS = ["k", "p"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, p string, v int")


def state(df):
    return sorted(((r.k, r.p, r.v) for r in df.collect()), key=str)


ODD = ["007", "7", None, "a/b=c", "2024-06-01T12:00:00", "", "__HIVE_DEFAULT_PARTITION__", "é %"]


def test_partition_values_of_any_kind(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = [(f"k{i}", p, i) for i, p in enumerate(ODD)]
    assert tables.load(spark, root, batch(spark, rows), KEYS, ["v"], "p", F.lit(T0)) == len(ODD)
    assert state(tables.read(spark, root)) == sorted(rows, key=str)
    again = [(k, p, v + 10) for k, p, v in rows[:3]] + [("new", "7", 1)]
    assert tables.load(spark, root, batch(spark, again), KEYS, ["v"], "p", F.lit(T1)) == 4
    want = sorted(again + rows[3:], key=str)
    assert state(tables.read(spark, root)) == want
    stamps = {(r.k, r.p): (r.created_at, r.updated_at) for r in tables.read(spark, root).collect()}
    assert stamps["k0", "007"] == (T0, T1) and stamps["new", "7"] == (T1, T1) and stamps["k3", "a/b=c"] == (T0, T0)
    assert tables.read(spark, root).schema["p"].dataType.simpleString() == "string"
    # readers keep the version they opened, and a version can be asked for
    assert state(tables.read(spark, root, version=1)) == sorted(rows, key=str)
    assert state(tables.read(spark, root, keep=lambda p: p == "7")) == [("k1", "7", 11), ("new", "7", 1)]


@pytest.mark.parametrize("where", ["_write", "_commit", "mark_published"])
def test_a_stopped_load_changes_nothing_and_runs_again(spark, tmp_path, monkeypatch, where):
    root = str(tmp_path / "t")
    first = [("a", "x", 1), ("b", "y", 2), ("c", None, 3)]
    tables.load(spark, root, batch(spark, first), KEYS, ["v"], "p", F.lit(T0))
    done = getattr(tables, where)

    def stop(*args, **kwargs):
        if where == "_write":
            done(*args, **kwargs)
        raise RuntimeError("stopped")

    change = batch(spark, [("a", "x", 5), ("b", "y", 6), ("d", "z", 7)])
    monkeypatch.setattr(tables, where, stop)
    with pytest.raises(RuntimeError, match="stopped"):
        tables.load(spark, root, change, KEYS, ["v"], "p", F.lit(T1), mark="5")
    assert state(tables.read(spark, root)) == sorted(first, key=str) and tables.manifest(spark, root).mark is None
    monkeypatch.setattr(tables, where, done)
    for _ in range(2):
        tables.load(spark, root, change, KEYS, ["v"], "p", F.lit(T1), mark="5")
        assert state(tables.read(spark, root)) == sorted([("a", "x", 5), ("b", "y", 6), ("c", None, 3), ("d", "z", 7)], key=str)
    assert tables.manifest(spark, root).mark == "5"


def test_only_touched_partitions_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.load(spark, root, batch(spark, [(f"k{i}", f"p{i % 4}", i) for i in range(20)]), KEYS, ["v"], "p")
    before = {p.value: p.folder for p in tables.manifest(spark, root).parts}
    tables.load(spark, root, batch(spark, [("k1", "p1", 99)]), KEYS, ["v"], "p")
    after = {p.value: p.folder for p in tables.manifest(spark, root).parts}
    assert {v for v in after if after[v] != before[v]} == {"p1"}
    assert tables.load(spark, root, batch(spark, []), KEYS, ["v"], "p") == 0
    assert tables.manifest(spark, root).version == 2


def test_columns_come_and_types_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.load(spark, root, batch(spark, [("a", "x", 1), ("b", "y", 2)]), KEYS, ["v"], "p")
    wider = spark.createDataFrame([("a", "x", 3, "note")], "k string, p string, v int, extra string")
    tables.load(spark, root, wider, KEYS, ["v"], "p")
    got = {r.k: (r.v, r.extra) for r in tables.read(spark, root).collect()}
    assert got == {"a": (3, "note"), "b": (2, None)}
    # a batch without the new column leaves it null in the rows it brings
    tables.load(spark, root, batch(spark, [("c", "x", 4)]), KEYS, ["v"], "p")
    assert {r.k: r.extra for r in tables.read(spark, root).collect()} == {"a": "note", "b": None, "c": None}
    with pytest.raises(TypeError, match="column v"):
        tables.load(spark, root, wider.withColumn("v", F.lit("text")), KEYS, ["v"], "p")


def test_deltas_grow_with_the_batch_and_are_compacted(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = {f"k{i}": (f"k{i}", f"p{i % 3}", i) for i in range(300)}
    tables.append(spark, root, batch(spark, list(rows.values())), KEYS, ["v"], "p", "0000", compact_after=3)
    size = lambda n: sum(f.stat().st_size for f in (tmp_path / "t" / "data").rglob("*.parquet")) - n
    whole = size(0)
    for n in range(1, 4):
        one = [("k1", "p1", 1000 + n), (f"new{n}", "p1", n)]
        rows |= {r[0]: r for r in one}
        assert tables.append(spark, root, batch(spark, one), KEYS, ["v"], "p", f"{n:04d}", compact_after=3) == 2
        # the same batch delivered again, as after a lost answer
        assert tables.append(spark, root, batch(spark, one), KEYS, ["v"], "p", f"{n:04d}", compact_after=3) == 0
        if n == 1:
            assert size(whole) < whole
        assert state(tables.read(spark, root, KEYS)) == sorted(rows.values(), key=str)
    parts = tables.manifest(spark, root).parts
    assert sum(p.delta for p in parts if p.value == "p1") < 3
    with pytest.raises(ValueError, match="deltas"):
        tables.read(spark, root).count()
    tables.compact(spark, root, KEYS, "p")
    assert state(tables.read(spark, root)) == sorted(rows.values(), key=str)
    assert tables.sweep(spark, root, versions=1) > 0
    assert state(tables.read(spark, root)) == sorted(rows.values(), key=str)


def test_retention_drops_without_reading(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = [(f"k{i}", f"2024_{1 + i % 6:02d}", i) for i in range(60)]
    tables.load(spark, root, batch(spark, rows), KEYS, ["v"], "p")
    assert tables.drop_partitions(spark, root, lambda m: m < "2024_04") == ["2024_01", "2024_02", "2024_03"]
    assert state(tables.read(spark, root)) == sorted(r for r in rows if r[1] >= "2024_04")
    assert len(list((tmp_path / "t" / "data").glob("*/slot=*"))) == 6
    assert tables.sweep(spark, root, versions=1) == 3
    assert state(tables.read(spark, root)) == sorted(r for r in rows if r[1] >= "2024_04")
    assert tables.drop_partitions(spark, root, lambda m: m < "2024_04") == []


def test_incremental_flow(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    make = lambda rows: spark.createDataFrame([(k, "x", v, day(d)) for k, v, d in rows], "k string, p string, v int, changed timestamp")
    run = lambda rows, **o: incremental.incremental_load(spark, make(rows), root, "changed", KEYS, ["changed", "v"], "p", **o)
    source = [("a", 1, 1), ("b", 2, 2)]
    assert run(source) == 2 and run(source) == 0
    # beyond the mark, on it, and late: the window brings the late ones, known rows change nothing
    source = [("a", 1, 1), ("b", 2, 2), ("c", 3, 3), ("d", 4, 2), ("late", 5, 1)]
    week = F.expr("interval 36 hours")
    real = tables.mark_published

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(tables, "mark_published", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        run(source, overlap=week)
    monkeypatch.setattr(tables, "mark_published", real)
    assert tables.manifest(spark, root).mark.startswith("2024-01-03")
    for _ in range(2):
        run(source, overlap=week)
        assert {r.k: r.v for r in tables.read(spark, root).collect()} == {"a": 1, "b": 2, "c": 3, "d": 4, "late": 5}
        assert tables.manifest(spark, root).mark.startswith("2024-01-04")
    assert incremental.stored_mark(spark, str(tmp_path / "none"), "timestamp") is None


def test_micro_batches_end_in_one_table(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    src, root, check = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "state")
    for _ in range(3):  # the same events delivered again and again
        events.write.mode("append").parquet(src)
        stream = partitions.with_month(arrival.arrivals(spark, src, events.schema, files_per_batch=1).drop("_source_file"), "ts")
        arrival.ingest(stream, check, arrival.append_batches(root, ["event_id", "month"], ["ts"], "month", compact_after=2)).awaitTermination()
    got = tables.read(spark, root, ["event_id", "month"]).drop("month")
    assert got.count() == events.count() and got.exceptAll(events).count() == 0


# --- loads into plain partition folders, and landing --------------------------------------


def test_upsert_table_keeps_values_that_look_like_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([("a", "007", 1)], [("b", "7", 2)], [("a", "007", 3)], [("n", None, 4)], [("n", None, 5)]):
        keyed.upsert_table(spark, path, batch(spark, rows), KEYS, ["v"], "p", F.lit(T0))
    stored = spark.read.schema("k string, v int, p string").parquet(path)
    assert state(stored) == sorted([("a", "007", 3), ("b", "7", 2), ("n", None, 5)], key=str)


def test_upsert_table_finishes_a_stopped_load(spark, tmp_path, monkeypatch):
    """Stopped between two partitions: one is replaced, the other still as before."""
    path = str(tmp_path / "t")
    keyed.upsert_table(spark, path, batch(spark, [("a", "x", 1), ("b", "y", 2), ("c", "z", 3)]), KEYS, ["v"], "p", F.lit(T0))
    change = batch(spark, [("a", "x", 5), ("b", "y", 6)])
    real = keyed.write_partitioned

    def half(df, *args, **kwargs):
        real(df.where("p = 'x'"), *args, **kwargs)
        raise RuntimeError("stopped")

    monkeypatch.setattr(keyed, "write_partitioned", half)
    with pytest.raises(RuntimeError, match="stopped"):
        keyed.upsert_table(spark, path, change, KEYS, ["v"], "p", F.lit(T1))
    assert state(spark.read.parquet(path)) == [("a", "x", 5), ("b", "y", 2), ("c", "z", 3)]
    monkeypatch.setattr(keyed, "write_partitioned", real)
    # an unrelated load comes next: it finishes what was begun
    keyed.upsert_table(spark, path, batch(spark, [("d", "w", 9)]), KEYS, ["v"], "p", F.lit(T1))
    want = [("a", "x", 5), ("b", "y", 6), ("c", "z", 3), ("d", "w", 9)]
    assert state(spark.read.parquet(path)) == sorted(want)
    keyed.upsert_table(spark, path, change, KEYS, ["v"], "p", F.lit(T1))
    assert state(spark.read.parquet(path)) == sorted(want)
    assert keyed.finish_stopped(spark, path, "p") == 0


@pytest.mark.parametrize("batch_id", ["2024-06-01T12:00:00", "a/b=c d%41", "007", "run #7", "é"])
def test_batches_land_under_any_id(spark, tmp_path, batch_id):
    zones = flows.Zones(str(tmp_path))
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, t string")
    other = spark.createDataFrame([("9", "z", "w")], "id string, t string, more string")
    flows.land(other, zones, "docs", "other", "sys", T0)
    for _ in range(2):
        got = flows.land(df, zones, "docs", batch_id, "sys", T0)
        assert got.columns == ["id", "t"] and sorted(r.id for r in got.collect()) == ["1", "2"]
    assert sorted(r.id for r in flows.land(other, zones, "docs", "7", "sys", T0).collect()) == ["9"]
    sinks.write_quarantine(df, str(tmp_path / "q"), batch_id, F.lit(T0))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2
    assert os.path.isdir(tmp_path / "bronze" / "docs")


# --- summaries by difference --------------------------------------------------------------


def summed(rows):
    out = {}
    for _, p, g, v in rows:
        out.setdefault((p, g), []).append(v)
    full = lambda vs: [v for v in vs if v is not None]
    return {k: (len(vs), sum(full(vs)) if full(vs) else None, min(full(vs), default=None), max(full(vs), default=None)) for k, vs in out.items()}


def test_summaries_by_difference(spark, tmp_path):
    from lexlake.operators import summaries

    source, gold = str(tmp_path / "s"), str(tmp_path / "g")
    make = lambda rows: spark.createDataFrame(rows, "k int, p string, g string, v int")
    rows = {i: (i, f"2024_{1 + i % 4:02d}", [None, "a", "b"][i % 3], i * 7 % 50 if i % 11 else None) for i in range(200)}
    refresh = lambda: summaries.refresh(spark, source, gold, ["k", "p"], ["p", "g"], "v", "p")

    def check():
        got = {(r.p, r.g): (r.n, r.total, r.least, r.most) for r in tables.read(spark, gold).collect()}
        assert got == summed(rows.values())

    tables.load(spark, source, make(list(rows.values())), ["k", "p"], ["v"], "p")
    assert refresh() == 4 and refresh() == 0
    check()
    # one month: the largest value goes, the least goes, a row is new, a group changes
    month = [i for i in rows if rows[i][1] == "2024_02"]
    top = max(month, key=lambda i: rows[i][3] or -1)
    low = min(month, key=lambda i: rows[i][3] if rows[i][3] is not None else 99)
    changed = [(top, "2024_02", rows[top][2], 10), (low, "2024_02", rows[low][2], 20), (900, "2024_02", "a", 500), (month[5], "2024_02", "other", 3)]
    rows |= {r[0]: r for r in changed}
    before = {p.value: p.folder for p in tables.manifest(spark, gold).parts}
    tables.load(spark, source, make(changed), ["k", "p"], ["v"], "p")
    assert refresh() == 1
    check()
    after = {p.value: p.folder for p in tables.manifest(spark, gold).parts}
    assert {v for v in after if after[v] != before[v]} == {"2024_02"}
    # deltas, a new month, and a dropped one
    more = [(901, "2024_09", None, 4), (top, "2024_02", rows[top][2], 77)]
    rows |= {r[0]: r for r in more}
    tables.append(spark, source, make(more), ["k", "p"], ["v"], "p", "1")
    tables.drop_partitions(spark, source, lambda v: v == "2024_01")
    rows = {i: r for i, r in rows.items() if r[1] != "2024_01"}
    assert refresh() == 3
    check()
    assert {p.value for p in tables.manifest(spark, gold).parts} == {"2024_02", "2024_03", "2024_04", "2024_09"}
