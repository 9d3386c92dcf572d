"""Exact dedup: a two-pass Bloom filter sends only possibly repeated rows through a shuffle.

Pass one counts how many rows fall on each slot of a bit array, two slots for a row,
and keeps the slots that were hit twice. Pass two probes the array: a row with a slot
that nobody else hit has no copy and passes straight through; the others are grouped
by the SHA-256 of the whole text. The filter only ever sends too many rows, so the
result does not depend on its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexlake.llm.common import text_of
from lexlake.workspace import materialize

#: Bits for each row, and the most bits: the array is broadcast, 64 MB at this bound.
BITS_PER_ROW, MAX_BITS = 16, 1 << 29


def _bit(bitmap: str, slot: str):
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def repeated_slots(slots: DataFrame) -> DataFrame:
    """(bucket, bitmap): the slots that occur at least twice in column ``slot``."""
    twice = slots.groupBy("slot").count().where("count > 1")
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )


def possibly_repeated(rows: DataFrame, hash_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Add ``__maybe``: false only if no other row has the same hash."""
    n = rows.count()
    bits = 1 << 15
    while bits < min(max_bits, BITS_PER_ROW * n):
        bits *= 2
    h = F.col(hash_col)
    slots = [F.lit(1) + F.pmod(h, F.lit(bits)), F.lit(1) + F.pmod(F.shiftrightunsigned(h, 33), F.lit(bits))]
    twice = materialize(repeated_slots(rows.select(F.explode(F.array(*slots)).alias("slot"))), "bloom")
    # at most bits / 32768 rows of 4 KiB: a bound that holds for any input
    for i, slot in enumerate(slots):
        side = F.broadcast(twice.select(F.col("bucket").alias(f"__b{i}"), F.col("bitmap").alias(f"__m{i}")))
        rows = rows.withColumn(f"__s{i}", slot)
        rows = rows.join(side, F.bitmap_bucket_number(f"__s{i}") == F.col(f"__b{i}"), "left")
    rows = rows.withColumn("__maybe", _bit("__m0", "__s0") & _bit("__m1", "__s1"))
    return rows.drop(*(f"__{c}{i}" for c in "bms" for i in (0, 1)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, and the whole
    input row as struct ``row`` if ``carry``.

    Of equal texts the row with the largest id stays; among rows that share that id,
    one. A null text counts as empty; a null id is smaller than any other. An empty
    table gives an empty result. Further columns are not looked at.
    """
    own = [F.col(id_col).alias("id"), F.sha2(text_of(text_col), 256).alias("sha"), F.xxhash64(text_of(text_col)).alias("h")]
    if carry:
        own.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    probed = possibly_repeated(docs.select(*own), "h", max_bits).drop("h")
    end = ["row"] if carry else []
    single = probed.where(~F.col("__maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha", *end
    )
    maybe = materialize(probed.where("__maybe").drop("__maybe"), "maybe-copies")
    per_id = maybe.groupBy("sha", "id").agg(F.count("*").alias("rows"))
    groups = per_id.groupBy("sha").agg(F.max(F.struct("id", "rows")).alias("top"), F.sum("rows").alias("group_size"))
    groups = groups.select("sha", F.col("top.id").alias("keep_id"), F.col("top.rows").alias("__top"), "group_size")
    # written out, so that both sides of the join are dealt anew and a hot text can be split
    groups = materialize(groups, "copy-groups")
    joined = maybe.join(groups, "sha")
    top = F.col("id").eqNullSafe(F.col("keep_id"))
    out = ["id", "keep_id", "group_size", "kept", "sha", *end]
    plain = joined.where(~(top & (F.col("__top") > 1))).withColumn("kept", top).select(*out)
    # the same id several times at the head of a group: one of its rows stays
    tied = maybe.join(groups.where("__top > 1"), "sha").where(top)
    w = Window.partitionBy("sha", "id").orderBy(F.xxhash64(*(end or ["id"])))
    tied = tied.withColumn("kept", F.row_number().over(w) == 1).select(*out)
    result = single.unionByName(plain).unionByName(tied)
    return result.withColumnsRenamed({"id": id_col, "sha": "text_sha256"})


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
