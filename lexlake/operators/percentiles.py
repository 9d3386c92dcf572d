"""Exact rank-based percentiles per group without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexlake.workspace import materialize

BUCKETS = 1000
SEARCH_STEPS = 10  # 2**10 > BUCKETS


def _cuts_below(cuts: Column, v: Column) -> Column:
    """How many entries of the sorted array are below v, by bisection."""

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_ = s["lo"] < s["hi"]
        below = open_ & (F.get(cuts, middle) < v)
        return F.struct(
            F.when(below, middle + 1).otherwise(s["lo"]).alias("lo"),
            F.when(open_ & ~below, middle).otherwise(s["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(SEARCH_STEPS)]), start, step, lambda s: s["lo"])


def _rank_median_low(n: Column) -> Column:
    return F.floor((n + 1) / 2)


def _rank_median_high(n: Column) -> Column:
    return F.floor(n / 2) + 1


def _rank_of(q: float):
    # position int(n*q)-1 counted from zero, not below the first
    return lambda n: F.greatest(F.floor(n * F.lit(q)), F.lit(1))


def latency_percentiles(df: DataFrame, group: str, value: str) -> DataFrame:
    """p50 (mean of the middle pair), p95 and p99 (sorted[int(n*q)-1]), min, max.

    1. Count equal values per group, which shrinks hot values on the map side. The
       counts are stored, as each of the steps below reads them.
    2. Cut each group's values into about 1000 ranges by an approximate quantile
       sketch, and add up the rows per range.
    3. Keep only the ranges a wanted rank falls into, and find the rank there.
    The sketch only decides where to cut; the result is exact.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(group, F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("c")
    )
    counted = materialize(counted, "value-counts")
    cuts = counted.groupBy(group).agg(
        F.percentile_approx("v", [i / BUCKETS for i in range(1, BUCKETS)], 10 * BUCKETS).alias("cuts")
    )
    bucketed = counted.join(cuts, group).select(group, "v", "c", _cuts_below(F.col("cuts"), F.col("v")).alias("b"))
    ranges = bucketed.groupBy(group, "b").agg(F.sum("c").alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    over_group = W.partitionBy(group).orderBy("b")
    placed = ranges.select(
        group,
        "b",
        "rows",
        (F.sum("rows").over(over_group.rowsBetween(W.unboundedPreceding, 0)) - F.col("rows")).alias("before"),
        F.sum("rows").over(W.partitionBy(group)).alias("n"),
        "lo",
        "hi",
        F.min("lo").over(W.partitionBy(group)).alias("lowest"),
        F.max("hi").over(W.partitionBy(group)).alias("highest"),
    )
    ranks = {"m1": _rank_median_low, "m2": _rank_median_high, "p95": _rank_of(0.95), "p99": _rank_of(0.99)}
    each = [F.struct(F.lit(k).alias("k"), f(F.col("n")).cast("bigint").alias("r")) for k, f in ranks.items()]
    wanted = (
        placed.select("*", F.inline(F.array(*each)))
        .where((F.col("r") > F.col("before")) & (F.col("r") <= F.col("before") + F.col("rows")))
        .drop("rows")
    )
    # at most four ranges per group; their rows are found again by value
    spans = wanted.select(group, "b", "lo", "hi").distinct()
    inside = counted.join(spans, group).where(F.col("v").between(F.col("lo"), F.col("hi"))).select(group, "b", "v", "c")
    running = inside.withColumn(
        "upto", F.sum("c").over(W.partitionBy(group, "b").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    )
    hits = wanted.join(running, [group, "b"]).where(
        (F.col("before") + F.col("upto") >= F.col("r")) & (F.col("before") + F.col("upto") - F.col("c") < F.col("r"))
    )
    at = lambda k: F.max(F.when(F.col("k") == k, F.col("v")))
    return hits.groupBy(group).agg(
        F.max("n").alias("n"),
        ((at("m1") + at("m2")) / 2).alias("p50"),
        at("p95").alias("p95"),
        at("p99").alias("p99"),
        F.max("lowest").alias("min_value"),
        F.max("highest").alias("max_value"),
    )
