"""Compare every registered query with its SQL twin.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

sizes: list[int] = []

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x):
    """One spelling per value; floats to nine digits, everything else exact."""
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return f"b:{x}"
    if isinstance(x, float):
        return f"f:{x:.9g}"
    if isinstance(x, decimal.Decimal):
        return f"d:{x}"
    if isinstance(x, dt.datetime):
        return f"t:{x.isoformat()}"
    if isinstance(x, dt.date):
        return f"D:{x.isoformat()}"
    if isinstance(x, int):
        return f"i:{x}"
    return f"{type(x).__name__}:{x}"


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, build, sql: str) -> str | None:
    """None if equal, else what differs."""
    df = build(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sizes.append(len(got))
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} vs {sorted(rel.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    if got != want:
        i = next(i for i, (a, b) in enumerate(zip(got, want, strict=True)) if a != b)
        n = sum(a != b for a, b in zip(got, want, strict=True))
        return f"{n} rows differ, first:\n   spark {got[i]}\n   sql   {want[i]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    # plain settings, as a session of the driver would have
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.perf_counter()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, build, sqls[name])
            else:
                problem = None if build(spark, sf_dir).collect() else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        took = time.perf_counter() - start
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {sizes[-1:]} {took:.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
