"""Row contracts: normalize every field, collect every error, split the rows.

A contract compiles to three projections over the input: stripped text, typed
values, error list. Nothing is shuffled and no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexlake.functions.text import ISO_DATE_OR_MIDNIGHT, collapse, parse_date, strip

ERRORS = "_errors"
RAW = "_raw"
ERROR_TYPE = "struct<loc:string,type:string,msg:string>"

# (condition that is true for a bad value, error type, message)
Check = tuple[Column, str, str]


@dataclass(frozen=True)
class Field:
    """One contract field.

    ``default`` fills a column the input does not have at all; a null in a column
    it does have is an error when the field is required, and stays null otherwise.
    """

    name: str
    kind: str = "text"  # text | date | decimal | tags | json | timestamp
    required: bool = True
    min_len: int | None = None
    max_len: int | None = None
    upper: bool = False
    collapse: bool = False
    allowed: tuple[str, ...] = ()
    precision: tuple[int, int] = (18, 2)
    store: str | None = None  # type of the valid row's column, if not the checked one
    default: Callable[[], Column] | None = None
    # extra checks on the typed value: value Column -> list of Check
    checks: Callable[[Column], list[Check]] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    # checks across typed columns, reported at the given field
    cross: Callable[[], list[tuple[str, Check]]] | None = None
    kind: str = field(default="")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


def _raw_name(column: str) -> str:
    return f"_r_{column}".replace("`", "_").replace(".", "_")


def _text_name(field_name: str) -> str:
    return f"_t_{field_name}"


def _error(bad: Column, loc: str, kind: str, msg: str) -> tuple[Column, Column]:
    """(condition that is never null, error to report)"""
    found = F.struct(F.lit(loc).alias("loc"), F.lit(kind).alias("type"), F.lit(msg).alias("msg"))
    return F.coalesce(bad, F.lit(False)), found


def _collect(errors: list[tuple[Column, Column]]) -> Column:
    """All errors that hold. Clean rows are told by one boolean expression and get
    a constant; only faulty rows build and compact the list."""
    none = F.array().cast(f"array<{ERROR_TYPE}>")
    if not errors:
        return none
    # "any of" as the greatest boolean: its code is split into small methods, where a
    # chain of ORs becomes one method too long for the JIT compiler
    flags = [bad for bad, _ in errors]
    any_bad = F.greatest(*flags) if len(flags) > 1 else flags[0]
    listed = F.array_compact(F.array(*[F.when(bad, found) for bad, found in errors]))
    return F.when(any_bad, listed.cast(f"array<{ERROR_TYPE}>")).otherwise(none)


def _text_of(f: Field, have: T.StructType) -> Column:
    """First projection: the field as stripped text, or as it came."""
    if f.name not in have.names:
        return F.lit(None).cast("string")
    source = F.col(_raw_name(f.name))
    dtype = have[f.name].dataType
    if f.kind == "text":
        return strip(source.cast("string"))
    if f.kind == "decimal" and isinstance(dtype, T.StringType):
        return strip(source)
    return source


def _value_of(f: Field, have: T.StructType) -> Column:
    """Second projection: the typed, normalized value."""
    given = F.col(_text_name(f.name))
    present = f.name in have.names
    dtype = have[f.name].dataType if present else None
    if f.kind == "tags":
        if not present or not isinstance(dtype, T.ArrayType):
            return F.array().cast("array<string>")
        cleaned = F.transform(given, lambda t: F.lower(strip(t)))
        return F.coalesce(F.array_distinct(F.filter(cleaned, lambda t: t != "")), F.array().cast("array<string>"))
    if not present:
        return f.default() if f.default else F.lit(None).cast(_spark_type(f))
    if f.kind == "text":
        value = F.upper(given) if f.upper else given
        return collapse(value) if f.collapse else value
    if f.kind == "date":
        return parse_date(given, ISO_DATE_OR_MIDNIGHT) if isinstance(dtype, T.StringType) else given.cast("date")
    if f.kind == "decimal":
        p, s = f.precision
        return given.try_cast(f"decimal({p},{s})")
    if f.kind == "timestamp":
        value = given.try_cast("timestamp")
        return F.coalesce(value, f.default()) if f.default else value
    if f.kind == "json":
        body = given if isinstance(dtype, T.StringType) else F.to_json(given, {"ignoreNullFields": "false"})
        return F.coalesce(body, F.lit("{}"))
    raise ValueError(f"unknown field kind {f.kind}")


def _spark_type(f: Field) -> str:
    return {
        "text": "string",
        "json": "string",
        "date": "date",
        "timestamp": "timestamp",
        "tags": "array<string>",
        "decimal": "decimal(%d,%d)" % f.precision,
    }[f.kind]


def _errors_of(f: Field, have: T.StructType) -> list[tuple[Column, Column]]:
    """Third projection: what is wrong with the field; at most one reading error,
    and the value checks only when the value could be read."""
    present = f.name in have.names
    value = F.col(f.name)
    given = F.col(_text_name(f.name))
    out: list[tuple[Column, Column]] = []
    if not present:
        if f.required and f.default is None:
            out.append(_error(F.lit(True), f.name, "missing", "Field required"))
        return out
    if f.kind == "tags":
        if not isinstance(have[f.name].dataType, T.ArrayType):
            out.append(_error(given.cast("string") != "", f.name, "list_type", "Input should be a valid list"))
        return out
    if f.required:
        kinds = {"text": "string_type", "date": "date_type", "decimal": "decimal_type"}
        if f.kind in kinds:
            out.append(_error(given.isNull(), f.name, kinds[f.kind], f"Input should be a valid {f.kind}"))
    if f.kind == "text":
        if f.min_len is not None:
            out.append(
                _error(F.length(given) < f.min_len, f.name, "string_too_short", f"At least {f.min_len} characters")
            )
        if f.max_len is not None:
            out.append(
                _error(F.length(given) > f.max_len, f.name, "string_too_long", f"At most {f.max_len} characters")
            )
        if f.allowed:
            bad = ~value.isin(*f.allowed)
            out.append(_error(bad, f.name, "value_error", f"Must be one of {', '.join(f.allowed)}"))
    if f.kind in ("date", "decimal"):
        out.append(
            _error(given.isNotNull() & value.isNull(), f.name, f"{f.kind}_parsing", f"Input should be a valid {f.kind}")
        )
    for bad, kind, msg in f.checks(value) if f.checks else []:
        out.append(_error(bad, f.name, kind, msg))
    return out


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns plus the untouched input as ``_raw`` and ``_errors``.

    Each stage keeps its results as plain columns: a value used several times
    downstream is then computed once, where a struct would be taken apart again by
    the optimizer and its fields recomputed at every use.
    """
    have = df.schema
    raws = [_raw_name(c) for c in df.columns]
    raw = df.select(*[F.col(f"`{c}`").alias(r) for c, r in zip(df.columns, raws, strict=True)])
    texts = raw.select(*raws, *[_text_of(f, have).alias(_text_name(f.name)) for f in contract.fields])
    names = [_text_name(f.name) for f in contract.fields]
    typed = texts.select(*raws, *names, *[_value_of(f, have).alias(f.name) for f in contract.fields])
    errors = [e for f in contract.fields for e in _errors_of(f, have)]
    if contract.cross:
        errors += [_error(bad, loc, kind, msg) for loc, (bad, kind, msg) in contract.cross()]
    original = F.struct(*[F.col(r).alias(c) for c, r in zip(df.columns, raws, strict=True)])
    return typed.select(original.alias(RAW), *contract.columns, _collect(errors).alias(ERRORS))


def settle(checked: DataFrame) -> DataFrame:
    """Form to store: the original row only where it was rejected, as JSON, so that
    storing the outcome does not store the input a second time."""
    kept = F.when(F.size(ERRORS) > 0, F.to_json(RAW, {"ignoreNullFields": "false"}))
    return checked.withColumn(RAW, kept)


def _emit(checked: DataFrame, keep: Column, columns: list[Column]) -> DataFrame:
    """Rows where ``keep`` holds. As an emitted row and not as a filter: a filter on
    the error list would be moved below the projection that computes it, and work
    out every error twice, the first time without sharing common parts."""
    return checked.select(F.inline(F.when(keep, F.array(F.struct(*columns)))))


def valid_rows(checked: DataFrame, contract: Contract) -> DataFrame:
    out = [F.col(f.name).cast(f.store).alias(f.name) if f.store else F.col(f.name) for f in contract.fields]
    return _emit(checked, F.size(ERRORS) == 0, out)


def rejected_rows(checked: DataFrame, contract: Contract) -> DataFrame:
    """Quarantine form: original row as JSON, contract name, all errors."""
    settled = isinstance(checked.schema[RAW].dataType, T.StringType)
    return _emit(
        checked,
        F.size(ERRORS) > 0,
        [
            (F.col(RAW) if settled else F.to_json(RAW, {"ignoreNullFields": "false"})).alias("raw"),
            F.lit(contract.name).alias("schema"),
            F.col(ERRORS).alias("errors"),
        ],
    )


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); both read the same plan, so pass a stored input when
    the source is expensive to read twice."""
    checked = apply_contract(df, contract)
    return valid_rows(checked, contract), rejected_rows(checked, contract)


def outcome_counts(checked: DataFrame) -> DataFrame:
    """One row: total, valid, rejected and the rejection rate (0 when empty)."""
    bad = (F.size(ERRORS) > 0).cast("int")
    return checked.agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("rejected")
    ).select(
        "total",
        (F.col("total") - F.col("rejected")).alias("valid"),
        "rejected",
        F.coalesce(F.try_divide(F.col("rejected").cast("double"), F.col("total")), F.lit(0.0)).alias("rejection_rate"),
    )


def error_counts(checked: DataFrame) -> DataFrame:
    """Errors by field and type over the whole input."""
    return (
        checked.select(F.explode(ERRORS).alias("e"))
        .groupBy(F.col("e.loc").alias("loc"), F.col("e.type").alias("type"))
        .agg(F.count(F.lit(1)).alias("errors"))
    )
