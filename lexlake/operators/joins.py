"""Reference lookups and referential checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexlake.functions.text import strip


def resolve_keys(transactions: DataFrame, counterparties: DataFrame, contracts: DataFrame) -> DataFrame:
    """Replace external keys by ids; ``resolved`` is false where either is unknown.

    Both references have unique keys, so rows are neither lost nor multiplied.
    The size of each reference decides between broadcast and merge at run time;
    a hot key on the transaction side is split by adaptive execution.
    """
    cp = counterparties.select(F.col("external_id").alias("counterparty_external_id"), "counterparty_id")
    ct = contracts.select("contract_number", "contract_id")
    return (
        transactions.join(cp, "counterparty_external_id", "left")
        .join(ct, "contract_number", "left")
        .withColumn("resolved", F.col("counterparty_id").isNotNull() & F.col("contract_id").isNotNull())
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a non-null key the parent does not have."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_pk"), "left_anti")


def left_join_big_right(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join where the right side is the large, skewed one.

    Written as matches plus unmatched left rows: in an inner join the large side
    can be streamed past a small one or be split when skewed, which a left outer
    join does not allow. The second part needs only the distinct keys of the right.
    """
    matched = left.join(right, keys, "inner")
    lonely = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def document_codes(documents: DataFrame) -> DataFrame:
    """Documents that name a regulation, with the code taken out of the metadata:
    containment of ``{"regulation_code": code}`` becomes equality of a column."""
    return documents.select(
        "document_id",
        "entity_id",
        "jurisdiction",
        F.get_json_object("metadata", "$.regulation_code").alias("code"),
    ).where(F.col("code").isNotNull())


def regulation_documents(regulations: DataFrame, documents: DataFrame) -> DataFrame:
    """Regulations with the documents of their jurisdiction that name their code."""
    return left_join_big_right(regulations, document_codes(documents), ["jurisdiction", "code"])


def resolve_entity(documents: DataFrame, entities: DataFrame) -> DataFrame:
    """Documents with ``entity_id`` found by tax id and jurisdiction; null if unknown."""
    known = entities.select("tax_id", "jurisdiction", "entity_id")
    wanted = documents.withColumn("_tax", strip("entity_tax_id")).drop("entity_id")
    on = (wanted["_tax"] == known["tax_id"]) & (wanted["jurisdiction"] == known["jurisdiction"])
    return wanted.join(known, on, "left").drop(known["tax_id"]).drop(known["jurisdiction"]).drop("_tax")


def first_key_history(dim: DataFrame, key: str) -> DataFrame:
    """All versions of the smallest key, oldest first."""
    sample = dim.select(key).orderBy(F.asc_nulls_last(key)).limit(1)
    return dim.join(sample, key, "left_semi").orderBy("valid_from")


def constraint_report(checks: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Violations per named row constraint; null satisfies a constraint, as in SQL.

    Checks that are given the same frame share one aggregate, so a table is read once.
    """
    tables: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for name, (df, ok) in checks.items():
        tables.setdefault(id(df), (df, {}))[1][name] = ok
    parts = []
    for df, rules in tables.values():
        counted = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(True))).alias(f"c{i}") for i, ok in enumerate(rules.values())])
        rows = [F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, name in enumerate(rules)]
        parts.append(counted.select(F.inline(F.array(*rows))))
    if not parts:
        raise ValueError("no checks given")
    return reduce(DataFrame.unionByName, parts)
