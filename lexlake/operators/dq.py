"""Declarative table rules compiled to aggregate passes.

All rules that only count bad rows share one aggregate over the frame, which
combines on the map side to a single row per task. A uniqueness rule needs its
own shuffle, so it runs as a separate pass that reads just its column; mixing
several distinct counts into the first pass would multiply every input row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULES_DIR = Path(__file__).resolve().parent.parent / "rules"
RESULT_COLUMNS = ["rule", "type", "column", "severity", "passed", "failed_count", "message"]


@dataclass(frozen=True)
class Rule:
    name: str
    type: str
    column: str | None = None
    params: dict[str, Any] = field(default_factory=dict)
    severity: str = "error"  # error blocks the load, warning only reports

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> Rule:
        return cls(d["name"], d["type"], d.get("column"), d.get("params") or {}, d.get("severity", "error"))


class QualityError(AssertionError):
    """An error-severity rule failed."""


def load_rules(path: str | Path) -> list[Rule]:
    """Rules from a JSON file, or YAML where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML rules needs PyYAML; use JSON instead") from e
        data = yaml.safe_load(text)
    else:
        data = json.loads(text)
    return [Rule.from_dict(r) for r in data.get("rules", [])]


def builtin_rules(suite: str) -> list[Rule]:
    return load_rules(RULES_DIR / f"{suite}.json")


# --- rule types: each returns the Column that is true for a failing row ----------


def _not_null(c: Column, p: dict) -> Column:
    return c.isNull()


def _regex(c: Column, p: dict) -> Column:
    # anchored at the start only; null passes
    return c.isNotNull() & ~c.cast("string").rlike(f"^(?:{p.get('pattern', '')})")


def _in_set(c: Column, p: dict) -> Column:
    values = list(p.get("values", []))
    listed = [v for v in values if v is not None]
    outside = ~c.isin(*listed) if listed else F.lit(True)
    return F.when(c.isNull(), F.lit(None not in values)).otherwise(outside)


def _range(c: Column, p: dict) -> Column:
    bad = F.lit(False)
    if p.get("min") is not None:
        bad = bad | (c < F.lit(p["min"]))
    if p.get("max") is not None:
        bad = bad | (c > F.lit(p["max"]))
    return F.coalesce(bad, F.lit(False))


ROW_RULES = {"not_null": _not_null, "regex": _regex, "in_set": _in_set, "range": _range}
ORDERED_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def register_rule(kind: str, failing) -> None:
    """Add a row rule type: ``failing(column, params) -> Column``."""
    ROW_RULES[kind] = failing


def _failing(rule: Rule) -> Column:
    if rule.type == "expression":
        # only an explicit false fails; null passes
        return ~F.coalesce(F.expr(rule.params["expr"]), F.lit(True))
    return ROW_RULES[rule.type](F.col(rule.column), rule.params)


def _problem(df: DataFrame, rule: Rule) -> str | None:
    """Why the rule cannot be evaluated on this frame, or None."""
    if rule.type == "row_count_range":
        return None
    if rule.type == "expression":
        try:
            dtype = df.select(F.expr(rule.params["expr"])).schema[0].dataType
        except Exception as e:  # the analyzer's own message tells the user most
            return str(e).splitlines()[0]
        return None if isinstance(dtype, T.BooleanType) else "expression is not boolean"
    if rule.type != "unique" and rule.type not in ROW_RULES:
        return f"Unknown rule type: {rule.type}"
    if rule.column not in df.columns:
        return f"no column {rule.column}"
    if rule.type == "range" and not isinstance(df.schema[rule.column].dataType, ORDERED_TYPES):
        return f"column {rule.column} is not numeric"
    return None


def _result(rule: Rule, failed: Column, message: Column | None = None) -> Column:
    passed = failed == 0
    if message is None:
        wording = {
            "not_null": f"nulls in {rule.column}",
            "unique": "duplicate values",
            "regex": f"values do not match {rule.params.get('pattern', '')}",
            "in_set": "values outside allowed set",
            "range": "values out of range",
        }.get(rule.type, "rows fail")
        message = F.concat_ws(" ", failed.cast("string"), F.lit(wording))
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.type).alias("type"),
        F.lit(rule.column).cast("string").alias("column"),
        F.lit(rule.severity).alias("severity"),
        passed.alias("passed"),
        failed.cast("bigint").alias("failed_count"),
        F.when(passed, F.lit("")).otherwise(message).alias("message"),
    )


def _row_count_result(rule: Rule, n: Column) -> Column:
    low, high = rule.params.get("min", 0), rule.params.get("max")
    ok = n >= low if high is None else n.between(low, high)
    message = F.concat(F.lit("Row count "), n.cast("string"), F.lit(f" outside [{low}, {'inf' if high is None else high}]"))
    return _result(rule, (~ok).cast("bigint"), message)


def _unique_pass(df: DataFrame, rule: Rule) -> DataFrame:
    c = F.col(rule.column)
    # null counts as one value, as it would in a set
    distinct = F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
    return df.agg((F.count(F.lit(1)) - distinct).alias("f")).select(_result(rule, F.col("f")).alias("r"))


RESULT_SCHEMA = (
    "suite string, rule string, type string, column string, severity string, passed boolean, failed_count bigint, message string"
)


def run_suite(df: DataFrame, rules: list[Rule], suite: str = "default") -> DataFrame:
    """One row per rule. A rule that cannot be evaluated is a failed rule."""
    problems = {r.name: _problem(df, r) for r in rules}
    usable = [r for r in rules if problems[r.name] is None]
    shared = [r for r in usable if r.type != "unique"]
    counts = [
        F.coalesce(F.sum(_failing(r).cast("bigint")), F.lit(0)).alias(f"r{i}")
        for i, r in enumerate(shared)
        if r.type != "row_count_range"
    ]
    one = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    rows = [
        _row_count_result(r, F.col("n")) if r.type == "row_count_range" else _result(r, F.col(f"r{i}"))
        for i, r in enumerate(shared)
    ]
    for r in rules:
        if problems[r.name] is not None:
            rows.append(
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.lit(r.type).alias("type"),
                    F.lit(r.column).cast("string").alias("column"),
                    F.lit(r.severity).alias("severity"),
                    F.lit(False).alias("passed"),
                    F.lit(0).cast("bigint").alias("failed_count"),
                    F.lit(f"Rule evaluation error: {problems[r.name]}").alias("message"),
                )
            )
    passes = [one.select(F.explode(F.array(*rows)).alias("r"))] if rows else []
    passes += [_unique_pass(df, r) for r in usable if r.type == "unique"]
    if not passes:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, passes).select(F.lit(suite).alias("suite"), "r.*")


def failure_samples(df: DataFrame, rules: list[Rule], n: int = 5) -> DataFrame:
    """Up to ``n`` failing values per regex / in_set rule, smallest first; a top-n
    per rule never gathers more than n rows per task."""
    wanted = [r for r in rules if r.type in ("regex", "in_set") and _problem(df, r) is None]
    parts = [
        df.where(_failing(r))
        .select(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value"))
        .orderBy(F.asc_nulls_last("value"))
        .limit(n)
        for r in wanted
    ]
    if not parts:
        return df.sparkSession.createDataFrame([], "rule string, value string")
    return reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame) -> DataFrame:
    """Totals per suite from a result table."""
    return results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "error")).alias("blocking"),
        F.count_if(~F.col("passed") & (F.col("severity") != "error")).alias("warnings"),
    )


def gate(results: DataFrame, df: DataFrame, on_error: str = "raise") -> DataFrame:
    """``df`` if no error rule failed. Otherwise raise, or with ``drop`` hand back
    the frame without rows. The result table has one row per rule, so reading it
    on the driver is bounded by the suite."""
    if on_error not in ("raise", "drop"):
        raise ValueError("on_error must be raise or drop")
    failed = results.where(~F.col("passed") & (F.col("severity") == "error")).select("rule", "message").collect()
    if not failed:
        return df
    if on_error == "drop":
        return df.where(F.lit(False))
    raise QualityError("Data Quality failed: " + "; ".join(f"{r.rule}: {r.message}" for r in failed))


# --- stand-alone checks used on Gold and source tables ----------------------------


def unique_combination(df: DataFrame, *cols: str) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list with their row counts; null is not judged here."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    )


def freshness(df: DataFrame, column: str, as_of: Column, warn_hours: int = 12, error_hours: int = 24) -> DataFrame:
    """Age of the newest row against two limits."""
    age = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.max(column).cast("timestamp"))).alias("age_s")
    return df.agg(age).select(
        (F.col("age_s")).alias("age_seconds"),
        F.when(F.col("age_s").isNull() | (F.col("age_s") > error_hours * 3600), "error")
        .when(F.col("age_s") > warn_hours * 3600, "warn")
        .otherwise("ok")
        .alias("status"),
    )
