import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lexlake.operators import scd2

D = dt.date
COLUMNS = "external_id string, name string, risk_score decimal(5,2)"
TRACKED = ["name", "risk_score"]
EMPTY = COLUMNS + ", valid_from date, valid_to date, is_current boolean, row_hash string"


def dec(x):
    from decimal import Decimal

    return None if x is None else Decimal(str(x))


def batch(spark, rows, day):
    df = spark.createDataFrame([(k, n, dec(s)) for k, n, s in rows], COLUMNS)
    return df.withColumn("effective", F.lit(day))


def step(spark, dim, rows, day):
    b = batch(spark, rows, day)
    counted = scd2.counts(scd2.classify(dim, b, "external_id", TRACKED, ["effective"])).first()
    after = scd2.apply(dim, b, "external_id", TRACKED, ["effective"])
    # pin the state between steps
    return spark.createDataFrame(after.collect(), dim.schema), (counted.inserted, counted.expired, counted.unchanged), counted


def test_insert_unchanged_change(spark):
    dim = spark.createDataFrame([], EMPTY)
    dim, n, _ = step(spark, dim, [("CP-1", "A", 30)], D(2025, 1, 1))
    assert n == (1, 0, 0) and dim.where("is_current").count() == 1
    dim, n, _ = step(spark, dim, [("CP-1", "A", 30)], D(2025, 6, 1))
    assert n == (0, 0, 1) and dim.count() == 1
    dim, n, _ = step(spark, dim, [("CP-1", "A", 75)], D(2025, 6, 15))
    assert n == (1, 1, 0)
    old, new = dim.orderBy("valid_from").collect()
    assert (old.valid_to, old.is_current) == (D(2025, 6, 14), False)
    assert (new.valid_from, new.valid_to, new.is_current) == (D(2025, 6, 15), D(9999, 12, 31), True)


def test_point_in_time(spark):
    dim = spark.createDataFrame([], EMPTY)
    for score, day in ((10, D(2025, 1, 1)), (40, D(2025, 6, 1)), (90, D(2025, 11, 1))):
        dim, _, _ = step(spark, dim, [("CP-1", "A", score)], day)
    at = lambda d: scd2.point_in_time(dim, d).first().risk_score
    assert (at(D(2025, 3, 15)), at(D(2025, 7, 20)), at(D(2026, 1, 1))) == (10, 40, 90)
    assert scd2.point_in_time(dim, D(2024, 12, 31)).count() == 0


def test_same_day_and_late_changes(spark):
    dim = spark.createDataFrame([], EMPTY)
    dim, _, _ = step(spark, dim, [("CP-1", "A", 10)], D(2025, 1, 10))
    dim, _, n = step(spark, dim, [("CP-1", "B", 20)], D(2025, 1, 10))
    assert n.replaced == 1 and dim.count() == 1 and dim.first().name == "B"
    pairs = scd2.classify(dim, batch(spark, [("CP-1", "C", 5)], D(2025, 1, 5)), "external_id", TRACKED, ["effective"])
    assert scd2.late_rows(pairs).count() == 1
    dim, _, n = step(spark, dim, [("CP-1", "C", 5)], D(2025, 1, 5))
    assert n.late == 1 and dim.count() == 1 and dim.first().name == "B"


def test_last_row_of_a_key_in_a_batch_wins(spark):
    dim = spark.createDataFrame([], EMPTY)
    b = spark.createDataFrame(
        [("CP-1", "A", dec(1), D(2025, 1, 1)), ("CP-1", "B", dec(2), D(2025, 1, 2))], COLUMNS + ", effective date"
    )
    after = scd2.apply(dim, b, "external_id", TRACKED, ["effective"]).collect()
    assert [(r.name, r.valid_from) for r in after] == [("B", D(2025, 1, 2))]


def test_null_to_value_is_a_change_and_scale_is_not(spark):
    dim = spark.createDataFrame([], EMPTY)
    dim, _, _ = step(spark, dim, [("CP-1", "A", None)], D(2025, 1, 1))
    dim, n, _ = step(spark, dim, [("CP-1", "A", 25)], D(2025, 2, 1))
    assert n == (1, 1, 0)
    dim, n, _ = step(spark, dim, [("CP-1", "A", "25.00")], D(2025, 3, 1))
    assert n == (0, 0, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_feed_equals_repeated_batches(spark, seed):
    rnd = random.Random(seed)
    days = [D(2025, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    feed = [
        (f"K{k}", rnd.choice("ab"), dec(rnd.choice([1, 2])), day, i)
        for day in days
        for i, k in enumerate(rnd.sample(range(8), 5))
    ]
    frame = spark.createDataFrame(feed, COLUMNS + ", effective date, seq int")
    whole = scd2.from_feed(frame, "external_id", TRACKED, "effective", ["seq"])
    dim = spark.createDataFrame([], EMPTY)
    for day in days:
        dim, _, _ = step(spark, dim, [(k, n, s) for k, n, s, d, _ in feed if d == day], day)
    cols = ["external_id", "name", "risk_score", "valid_from", "valid_to", "is_current", "row_hash"]
    want = sorted(map(tuple, dim.select(*cols).collect()))
    assert sorted(map(tuple, whole.select(*cols).collect())) == want
    by_key: dict = {}
    for r in want:
        by_key.setdefault(r[0], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r[3])
        assert [v[5] for v in versions] == [False] * (len(versions) - 1) + [True]
        for a, b in zip(versions, versions[1:], strict=False):
            assert a[4] + dt.timedelta(days=1) == b[3]


def test_asof_join_with_a_hot_key(spark):
    """A third of all facts on one key, versions crossing years, open versions."""
    rnd = random.Random(7)
    start = D(2019, 6, 1)
    versions = []
    for k in range(6):
        cut = sorted(rnd.sample(range(0, 1600), 5))
        for i, c in enumerate(cut):
            end = start + dt.timedelta(days=cut[i + 1] - 1) if i + 1 < len(cut) else D(9999, 12, 31)
            versions.append((f"K{k}", f"v{i}", start + dt.timedelta(days=c), end))
    facts = [
        (i, "K0" if i % 3 == 0 else f"K{rnd.randrange(8)}", start + dt.timedelta(days=rnd.randrange(0, 1700)))
        for i in range(900)
    ]
    dim = spark.createDataFrame(versions, "key string, v string, valid_from date, valid_to date")
    df = spark.createDataFrame(facts, "id int, key string, day date")
    got = scd2.asof_join(df, dim, "key", "day")
    want = sorted((i, k, d, v) for i, k, d in facts for kk, v, a, b in versions if k == kk and a <= d <= b)
    assert sorted((r.id, r.key, r.day, r.v) for r in got.collect()) == want
    left = scd2.asof_join(df, dim, "key", "day", how="left")
    assert left.count() == len(facts)
    assert scd2.asof_join(df.where("false"), dim, "key", "day").count() == 0
