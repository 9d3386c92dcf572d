"""Registered queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lexlake.catalog.views import VIEW_SQL, Views


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Views], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Views], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"query {name} registered twice")
        ENTRIES[name] = Entry(name, build, sql)
        return build

    return register


def _used(sql: str) -> list[str]:
    return [v for v in re.findall(r"\bv_\w+", sql) if v in VIEW_SQL]


def expand(sql: str) -> str:
    """Put the definitions of the views a statement uses in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for v in _used(text):
            if v not in order:
                visit(VIEW_SQL[v])
                if v not in order:
                    order.append(v)

    visit(sql)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(e: Entry):
        return lambda spark, sf_dir: e.build(Views(spark, sf_dir))

    return {n: bind(e) for n, e in ENTRIES.items()}


def oracles() -> dict[str, str]:
    return {n: expand(e.sql) for n, e in ENTRIES.items() if e.sql}
