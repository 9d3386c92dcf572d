"""Hash keys: equal input gives equal key on every run and every executor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexlake.functions.text import col


def pipe_hash(*cols: Column | str) -> Column:
    """SHA-256 of the values joined by '|'; a null is written as the word None,
    so that a missing part keeps its place (``concat_ws`` would drop it)."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("None")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)


def row_hash(fields: dict[str, Column | str] | list[str]) -> Column:
    """Change-detection hash over named fields, independent of their order.

    The canonical form is a JSON object with sorted keys and nulls kept.
    """
    named = fields if isinstance(fields, dict) else {f: f for f in fields}
    body = F.struct(*[col(named[k]).alias(k) for k in sorted(named)])
    return F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)
