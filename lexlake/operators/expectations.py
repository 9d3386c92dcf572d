"""Named expectations per column, column statistics, profile and drift."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Expectation:
    type: str
    column: str | None = None
    kwargs: dict[str, Any] = field(default_factory=dict)


def build_suite(columns: dict[str, list[dict[str, Any]]]) -> list[Expectation]:
    """``{column: [{"type": ..., "kwargs": {...}}]}`` to a flat list."""
    return [Expectation(e["type"], c, dict(e.get("kwargs", {}))) for c, es in columns.items() for e in es]


def _between(c: Column, k: dict[str, Any]) -> Column:
    low, high = k.get("min_value"), k.get("max_value")
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c >= F.lit(low))
    if high is not None:
        ok = ok & (c <= F.lit(high))
    return ok


# row expectations: true for an expected value; nulls are left out of the judgement
ROW_EXPECTATIONS = {
    "expect_column_values_to_not_be_null": lambda c, k: c.isNotNull(),
    "expect_column_values_to_be_between": _between,
    "expect_column_values_to_be_in_set": lambda c, k: c.isin(*k["value_set"]),
    "expect_column_values_to_match_regex": lambda c, k: c.cast("string").rlike(k["regex"]),
    "expect_column_value_lengths_to_be_between": lambda c, k: _between(F.length(c), k),
}
def _bins(c: Column, edges: list | None, values: list | None) -> list[Column]:
    """Conditions of which each value meets exactly one; nulls have the last bin. NaN is beyond all edges."""
    if values is not None:
        listed = [c.eqNullSafe(F.lit(v)) for v in values]
        return [*listed, c.isNotNull() & ~c.isin(*values) if values else c.isNotNull(), c.isNull()]
    if not edges:
        return [c.isNotNull(), c.isNull()]
    inner = [(c >= F.lit(a)) & (c < F.lit(b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [c < F.lit(edges[0]), *inner, c >= F.lit(edges[-1]), c.isNull()]


def _divergence(c: Column, k: dict[str, Any]) -> Column:
    """KL divergence of the column's bins from the stored counts; null for an empty table."""
    s, stored = float(k.get("smoothing", 1.0)), k["counts"]
    seen = [F.count_if(b).cast("double") + F.lit(s) for b in _bins(c, k.get("edges"), k.get("values"))]
    if len(seen) != len(stored):
        raise ValueError(f"{len(stored)} stored counts for {len(seen)} bins")
    rows, total = F.count(F.lit(1)).cast("double") + F.lit(s * len(stored)), sum(stored) + s * len(stored)
    terms = []
    for p, n in zip(seen, stored, strict=True):
        ratio = F.log(p / rows) - F.lit(math.log((n + s) / total)) if n + s > 0 else F.lit(float("inf"))
        terms.append(F.when(p > 0, p / rows * ratio).otherwise(0.0))
    return F.when(F.count(F.lit(1)) > 0, reduce(lambda a, b: a + b, terms))


# aggregate expectations: the observed value to hold against min_value / max_value
AGGREGATE_EXPECTATIONS = {
    "expect_column_mean_to_be_between": lambda c, k: F.avg(c.cast("double")),
    "expect_column_min_to_be_between": lambda c, k: F.min(c).cast("double"),
    "expect_column_max_to_be_between": lambda c, k: F.max(c).cast("double"),
    "expect_column_sum_to_be_between": lambda c, k: F.sum(c).cast("double"),
    "expect_column_quantile_values_to_be_between": lambda c, k: F.percentile_approx(c, k["quantile"], 10000).cast(
        "double"
    ),
    "expect_column_kl_divergence_to_be_less_than": _divergence,
    "expect_table_row_count_to_be_between": lambda c, k: F.count(F.lit(1)).cast("double"),
}
# expectations that need a shuffle on the column
UNIQUE = "expect_column_values_to_be_unique"
UNIQUE_SHARE = "expect_column_proportion_of_unique_values_to_be_between"


def _row(e: Expectation, success: Column, elements, missing, unexpected, observed) -> Column:
    checked = elements - missing if e.type != "expect_column_values_to_not_be_null" else elements
    percent = F.when(checked == 0, F.lit(0.0)).otherwise(F.try_divide(unexpected * F.lit(100.0), checked))
    return F.struct(
        F.lit(e.type).alias("expectation"),
        F.lit(e.column).cast("string").alias("column"),
        success.alias("success"),
        elements.cast("bigint").alias("element_count"),
        missing.cast("bigint").alias("missing_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        F.round(percent, 6).alias("unexpected_percent"),
        F.round(observed, 6).alias("observed_value"),
    )


def validate(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation; row and aggregate expectations share one pass."""
    none_bigint, none_double = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    rows: list[Column] = []
    extra: list[DataFrame] = []
    for i, e in enumerate(suite):
        c = F.col(e.column) if e.column else F.lit(1)
        if e.type in ROW_EXPECTATIONS:
            ok = ROW_EXPECTATIONS[e.type](c, e.kwargs)
            aggs += [
                F.coalesce(F.sum((~ok).cast("bigint")), F.lit(0)).alias(f"u{i}"),
                F.count_if(c.isNull()).alias(f"m{i}"),
            ]
            bad, n, missing = F.col(f"u{i}"), F.col("n"), F.col(f"m{i}")
            judged = n if e.type == "expect_column_values_to_not_be_null" else n - missing
            share = F.try_divide((judged - bad).cast("double"), judged)
            good = F.coalesce(share >= F.lit(float(e.kwargs.get("mostly", 1.0))), F.lit(True))
            rows.append(_row(e, good, n, missing, bad, none_double))
        elif e.type in AGGREGATE_EXPECTATIONS:
            aggs.append(AGGREGATE_EXPECTATIONS[e.type](c, e.kwargs).alias(f"o{i}"))
            seen = F.col(f"o{i}")
            ok = F.coalesce(_between(seen, e.kwargs), F.lit(False)) & seen.isNotNull()
            rows.append(_row(e, ok, none_bigint, none_bigint, none_bigint, seen))
        elif e.type in (UNIQUE, UNIQUE_SHARE):
            extra.append(_uniqueness(df, e))
        else:
            raise ValueError(f"unknown expectation {e.type}")
    parts = [df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r"))] if rows else []
    if not suite:
        one = _row(Expectation("none"), F.lit(True), *[F.lit(None).cast("bigint")] * 3, F.lit(None).cast("double"))
        parts = [df.select(one.alias("r")).where(F.lit(False))]
    return reduce(DataFrame.unionByName, parts + extra).select("r.*")


def _uniqueness(df: DataFrame, e: Expectation) -> DataFrame:
    counted = df.groupBy(F.col(e.column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    one = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("m"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull() & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("dup"),
        F.count("v").alias("d"),
    )
    n, m, dup = F.col("n"), F.col("m"), F.col("dup")
    if e.type == UNIQUE:
        return one.select(_row(e, dup == 0, n, m, dup, F.lit(None).cast("double")).alias("r"))
    share = F.try_divide(F.col("d").cast("double"), n - m)
    ok = F.coalesce(_between(share, e.kwargs), F.lit(False))
    nothing = F.lit(None).cast("bigint")
    return one.select(_row(e, ok, nothing, nothing, nothing, share).alias("r"))


def column_stats(df: DataFrame, column: str, group: str | None = None) -> DataFrame:
    """Count, nulls, distinct values, min, max and mean of a numeric column. Values
    are counted first, so the distinct count costs no extra expansion."""
    keys = [group] if group else []
    per_value = df.groupBy(*keys, F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    total = F.sum(F.col("v").cast("decimal(28,6)") * F.col("c").cast("decimal(20,0)")).cast("decimal(38,6)")
    out = per_value.groupBy(*keys).agg(
        F.sum("c").alias("n"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct_values"),
        F.min("v").alias("min_value"),
        F.max("v").alias("max_value"),
        total.alias("total"),
    )
    return out.select(
        *keys,
        "n",
        "nulls",
        "distinct_values",
        "min_value",
        "max_value",
        F.round(F.try_divide(F.col("total").cast("double"), F.col("n") - F.col("nulls")), 6).alias("mean_value"),
    )


def drift(reference: DataFrame, current: DataFrame, column: str, smoothing: float = 1.0) -> DataFrame:
    """KL divergence of the current distribution of a categorical column from the
    reference one, with additive smoothing over the values seen on either side. Without smoothing
    a value only the current side has makes it infinite, one only the reference side
    has adds nothing.

    Both frames are counted together in one shuffle; afterwards there is one row
    per distinct value.
    """
    tagged = reference.select(F.col(column).alias("v"), F.lit(1).alias("is_ref")).unionByName(
        current.select(F.col(column).alias("v"), F.lit(0).alias("is_ref"))
    )
    counts = tagged.groupBy("v").agg(
        F.sum("is_ref").alias("q_n"), F.sum(F.lit(1) - F.col("is_ref")).alias("p_n")
    )
    # with p = (p_n+s)/P and q = (q_n+s)/Q:
    # sum(p ln(p/q)) = sum((p_n+s) * (ln(p_n+s) - ln(q_n+s))) / P + ln(Q) - ln(P)
    p, q = F.col("p_n") + F.lit(smoothing), F.col("q_n") + F.lit(smoothing)
    sums = counts.agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.sum("p_n").alias("current_rows"),
        F.sum("q_n").alias("reference_rows"),
        F.coalesce(F.sum(F.when(p > 0, F.when(q > 0, p * (F.log(p) - F.log(q))).otherwise(float("inf")))), F.lit(0.0)).alias("s"),
    )
    big_p = F.col("current_rows") + F.lit(smoothing) * F.col("distinct_values")
    big_q = F.col("reference_rows") + F.lit(smoothing) * F.col("distinct_values")
    return sums.select(
        "distinct_values",
        "reference_rows",
        "current_rows",
        F.round(F.col("s") / big_p + F.log(big_q) - F.log(big_p), 6).alias("kl_divergence"),
    )


def drift_expectation(
    baseline: DataFrame,
    column: str,
    max_value: float,
    edges: list | None = None,
    bins: int = 10,
    values: int = 50,
    smoothing: float = 1.0,
) -> Expectation:
    """An expectation that later data are distributed as the baseline's column is.

    A numeric column is cut at ``edges``, or else into ``bins`` of about equal depth by a
    quantile sketch; the rows of each bin are then counted exactly. Of other columns the
    ``values`` most frequent ones have a bin each and all others share one. Nulls are a
    bin. Only these counts are kept, and ``validate`` takes its side in the pass it
    makes anyway. An empty baseline gives equal weights.
    """
    c = F.col(f"`{column}`")
    numeric = isinstance(baseline.schema[column].dataType, T.NumericType)
    listed = None
    if numeric and edges is None:
        cuts = baseline.agg(F.percentile_approx(c, [i / bins for i in range(1, bins)], 10000).alias("q")).first()["q"]
        edges = sorted(set(cuts or []))
    elif not numeric:
        often = baseline.where(c.isNotNull()).groupBy(c.alias("v")).count().orderBy(F.desc("count"), "v").limit(values)
        listed = [r["v"] for r in often.collect()]
    counted = baseline.agg(*[F.count_if(b).alias(f"b{i}") for i, b in enumerate(_bins(c, edges, listed))]).first()
    kept = {"edges": edges} if numeric else {"values": listed}
    kwargs = {**kept, "counts": list(counted), "max_value": max_value, "smoothing": smoothing}
    return Expectation("expect_column_kl_divergence_to_be_less_than", column, kwargs)


def profile(df: DataFrame, columns: list[str] | None = None, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column from a single pass with mergeable sketches: rows, nulls,
    approximate distinct values, min, max, mean and approximate quantiles."""
    columns = columns or df.columns
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    rows: list[Column] = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        atomic = not isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        aggs.append(F.count_if(c.isNull()).alias(f"m{i}"))
        aggs.append((F.approx_count_distinct(c) if atomic else F.lit(None).cast("bigint")).alias(f"d{i}"))
        aggs.append((F.min(c).cast("string") if atomic else F.lit(None).cast("string")).alias(f"lo{i}"))
        aggs.append((F.max(c).cast("string") if atomic else F.lit(None).cast("string")).alias(f"hi{i}"))
        aggs.append((F.avg(c.cast("double")) if numeric else F.lit(None).cast("double")).alias(f"a{i}"))
        none = F.lit(None).cast("array<double>")
        q = F.percentile_approx(c.cast("double"), list(quantiles), 1000) if numeric else none
        aggs.append(q.alias(f"q{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col("n").alias("rows"),
                F.col(f"m{i}").alias("nulls"),
                F.col(f"d{i}").alias("approx_distinct"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
                F.round(F.col(f"a{i}"), 6).alias("mean_value"),
                F.col(f"q{i}").alias("quantiles"),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
