"""Summaries kept up to date by difference.

A row that changed is taken out of its group as it was and put in as it is. Counts and
sums follow from that alone; the least or greatest value has to be looked up in the
source again only where the row that held it was taken out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.operators import tables
from lexlake.workspace import materialize


def summarize(rows: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Per group: n, total, least, most. A null measure counts in n only."""
    m = F.col(f"`{measure}`")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(m).alias("total"), F.min(m).alias("least"), F.max(m).alias("most"), F.count(m).alias("filled"))


def _alike(keys: list[str], left: str, right: str) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def by_difference(
    table: DataFrame, removed: DataFrame, added: DataFrame, keys: list[str], measure: str, source: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The groups of ``table`` after the rows ``removed`` were taken out and ``added`` put in.

    ``source`` gives the present rows of the groups it is handed (key columns); it is
    asked only for groups whose least or greatest value was taken out and not reached
    by a new one. A group without rows is gone.
    """
    return _moved(table, movement(removed, added, keys, measure), keys, measure, source)


def movement(removed: DataFrame, added: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Per group, summaries of the rows taken out and of the rows put in."""
    names = ["n", "total", "least", "most", "filled"]
    both = summarize(removed, keys, measure).withColumn("_side", F.lit("out")).unionByName(summarize(added, keys, measure).withColumn("_side", F.lit("in")))
    side = lambda s, c: F.max(F.when(F.col("_side") == s, F.col(c))).alias(f"{s}_{c}")
    return both.groupBy(*keys).agg(*(side(s, c) for s in ("out", "in") for c in names))


def _moved(table: DataFrame, moved: DataFrame, keys: list[str], measure: str, source: Callable[[DataFrame], DataFrame]) -> DataFrame:
    met = table.alias("t").join(moved.alias("d"), _alike(keys, "t", "d"), "full_outer")
    had, out, new = (lambda c: F.col(f"t.{c}")), (lambda c: F.col(f"d.out_{c}")), (lambda c: F.col(f"d.in_{c}"))
    zero = F.lit(0)
    kind = table.schema["total"].dataType
    plus = lambda c: F.coalesce(had(c), zero) - F.coalesce(out(c), zero) + F.coalesce(new(c), zero)
    filled = plus("filled").cast("long")
    # the value that was least or greatest left, and no new one is as far out
    lost_least = (out("least") <= had("least")) & F.coalesce(new("least") > had("least"), F.lit(True))
    lost_most = (out("most") >= had("most")) & F.coalesce(new("most") < had("most"), F.lit(True))
    done = met.select(
        *(F.coalesce(had(k), F.col(f"d.{k}")).alias(k) for k in keys),
        plus("n").cast("long").alias("n"),
        F.when(filled > 0, plus("total").cast(kind)).alias("total"),
        F.least(had("least"), new("least")).alias("least"),
        F.greatest(had("most"), new("most")).alias("most"),
        filled.alias("filled"),
        F.coalesce(lost_least | lost_most, F.lit(False)).alias("_again"),
    ).where("n > 0")
    done = materialize(done, "summary-difference")
    again = done.where("_again").select(*keys)
    if again.isEmpty():
        return done.drop("_again")
    fresh = summarize(source(again), keys, measure)
    fresh = fresh.select(*keys, "n", F.col("total").cast(kind).alias("total"), "least", "most", "filled")
    return done.where(~F.col("_again")).drop("_again").unionByName(fresh)


def refresh(
    spark: SparkSession,
    source_root: str,
    root: str,
    row_keys: list[str],
    keys: list[str],
    measure: str,
    partition: str,
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Bring the summary under ``root`` to the current version of a versioned table.

    ``derive`` makes rows with the group's keys and the measure from the table's rows;
    ``partition`` is a column of both tables and one of ``keys``. The version a summary
    stands for is part of its commit, so a stopped refresh is simply done again. Only
    partitions with changed rows are read and written. Returns how many those were.
    """
    now, before = tables.manifest(spark, source_root), tables.manifest(spark, root)
    since = int(before.mark or 0)
    if now.version == since:
        return 0
    removed, added = (derive(rows) for rows in tables.changes(spark, source_root, row_keys, since, partition))
    # changed rows are read once; a few lines for each group are left of them
    moved = materialize(movement(removed, added, keys, measure), "summary-movement")
    values = {r[0] for r in moved.select(partition).distinct().collect()}
    held = {p.value for p in before.parts}
    if values & held:
        table = tables.read(spark, root, keep=lambda v: v in values)
    else:
        table = summarize(added.limit(0), keys, measure)

    def present(groups: DataFrame) -> DataFrame:
        rows = derive(tables.read(spark, source_root, row_keys, keep=lambda v: v in values))
        return rows.alias("l").join(groups.alias("r"), _alike(keys, "l", "r"), "left_semi")

    after = _moved(table, moved, keys, measure, present)
    tables.replace_partitions(spark, root, after, partition, values, str(now.version))
    return len(values)
