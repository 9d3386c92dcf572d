"""Rows of a vector table that can be computed with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType


def finite(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, vec) of the rows whose vector has entries, all of them finite, and their number.

    Rows of another length than the commonest one (of equally common ones, the longest)
    do not take part. Entries stay float or double; other numbers become double. The
    number is 0 if no row is left.
    """
    kind = rows.schema[vec_col].dataType
    vec = F.col(f"`{vec_col}`")
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType))):
        vec = vec.cast("array<double>")
    out = rows.select(F.col(f"`{id_col}`").alias("id"), vec.alias("vec"))
    inf = float("inf")
    bad = F.exists("vec", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == inf))
    out = out.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & ~bad)
    lengths = out.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths["dims"] if lengths else 0
    return out.where(F.size("vec") == dims), dims


def length(vec: str) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double")))


def digest(vec: str) -> Column:
    """A key of the vector's value, equal only for equal ones (SHA-256 of its text)."""
    return F.unhex(F.sha2(F.to_json(vec), 256))
