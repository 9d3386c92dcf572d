"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each five-word shingle is hashed once. The top bits of the hash name a bin, the least
hash of a bin represents it; an empty bin borrows from the first filled one along its
own pseudorandom sequence of bins (optimal densification). Four low bits of each bin
are kept as one hexadecimal digit; comparing two fingerprints corrects the share of
equal digits for the one in sixteen that agree by chance.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexlake.llm.common import text_of
from lexlake.workspace import materialize

#: Words in a shingle, bins (a power of two), bits kept of a bin.
SHINGLE, BINS, BITS = 5, 128, 4
SPACE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """Sorted hashes of the shingles of ``width`` words; a shorter text is one shingle."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")

    def hashed(words: Column) -> Column:
        short = F.array(F.xxhash64(F.array_join(words, " ")))
        long = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0))), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width)))
        )
        return F.when(F.size(words) == 0, F.array().cast("array<long>")).when(F.size(words) < width, short).otherwise(F.sort_array(long))

    # bind the words once: a lambda over an array of one
    return F.flatten(F.transform(F.array(words), hashed))


def bin_of(h: Column, bins: int = BINS) -> Column:
    return F.shiftrightunsigned(h, 65 - bins.bit_length()).cast("int")


def minima(hashes: Column, bins: int = BINS) -> Column:
    """The least hash of each filled bin: in sorted hashes, the first of each run."""
    return F.flatten(
        F.transform(
            F.array(hashes),
            lambda hs: F.filter(hs, lambda h, i: (i == 0) | (bin_of(h, bins) != bin_of(F.get(hs, i - 1), bins))),
        )
    )


def probes(bins: int) -> list[list[int]]:
    """For each bin the sequence of other bins it asks when empty; the same for all texts."""
    out = []
    for b in range(bins):
        order = [x for x in range(bins) if x != b]
        random.Random(b * 2654435761 + 97).shuffle(order)
        out.append(order)
    return out


def densified(least: Column, bins: int = BINS) -> Column:
    """The value of each bin, empty ones filled; null for all if there is none."""
    table = F.expr(f"array({', '.join('array(' + ', '.join(map(str, p)) + ')' for p in probes(bins))})")

    def spread(m: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.try_element_at(m, b))

    def fill(own: Column) -> Column:
        def value(v: Column, b: Column) -> Column:
            order = F.get(table, b)
            # the first few asked mostly answer; the rest of the sequence is there for sparse texts
            first = [F.get(own, F.get(order, F.lit(k))) for k in range(4)]
            rest = F.get(F.filter(F.transform(order, lambda o: F.get(own, o)), lambda x: x.isNotNull()), F.lit(0))
            return F.coalesce(v, *first, rest)

        return F.transform(own, value)

    keyed = F.map_from_arrays(F.transform(least, lambda h: bin_of(h, bins)), least)
    return F.flatten(F.transform(F.transform(F.array(keyed), spread), fill))


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """A hexadecimal digit for each bin; empty for a text without words."""
    least = minima(shingle_hashes(text), bins)

    def digits(m: Column) -> Column:
        # salted by the bin: a value lent to many bins shall not agree by chance in all of them
        low = F.transform(densified(m, bins), lambda h, b: F.hex(F.xxhash64(h, b).bitwiseAND((1 << bits) - 1)))
        return F.when(F.size(m) == 0, F.lit("")).otherwise(F.array_join(low, ""))

    return F.get(F.transform(F.array(least), digits), F.lit(0))


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Estimated Jaccard likeness of two fingerprints, 0 to 1; two empty ones are alike."""
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    chance = 1.0 / (1 << bits)
    share = (same / F.greatest(F.length(a), F.lit(1)) - chance) / (1 - chance)
    both = F.when((a == "") & (b == ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
    return both.otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""
    return docs.select(F.col(id_col), fingerprint(text_of(text_col)).alias("fingerprint"))


def next_pairs(keys: DataFrame) -> DataFrame:
    """Pair each (id, h) with the next by descending id, after the last the first.

    The sort is spread over range partitions; only the ends of the partitions, one row
    for each, are looked at together.
    """
    # the rank is made durable at once, so that a repeated task can't shift it
    ranked = keys.repartitionByRange(F.col("id").desc_nulls_last(), F.col("h").desc()).sortWithinPartitions(F.col("id").desc_nulls_last(), F.col("h").desc())
    ranked = materialize(ranked.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")), "ranked")
    ends = ranked.groupBy("part").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    w = Window.orderBy("part")
    following = F.coalesce(F.lead("first").over(w), F.min("first").over(Window.partitionBy()))
    jump = ends.select(F.col("last").alias("pos"), following.alias("to"))
    here = ranked.join(jump, "pos", "left").select("id", "h", "n", F.coalesce("to", F.col("pos") + 1).alias("to"))
    there = ranked.select(F.col("pos").alias("to"), F.col("id").alias("next_id"), F.col("h").alias("next_h"))
    return here.join(there, "to").drop("to")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text, and an edited one: its second half replaced by the
    beginning of the next document in descending order of id.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. Rows that repeat both id and text are one document, given once for each
    row; the next document is then the next different one. With one document, it is its
    own next. Nulls in id sort last. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    source = source.withColumn("h", F.xxhash64("text"))
    prints = materialize(source.select("id", "h", F.length("text").cast("long").alias("n"), fingerprint(F.col("text")).alias("fp")), "prints")
    # a null id joins like a value
    key = F.coalesce(F.col("id").cast("string"), F.lit("-null-")).alias("key")
    unique = prints.groupBy("id", "h").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.count("*").alias("copies"))
    pairs = next_pairs(unique.select("id", "h", "n")).withColumn("next_key", F.coalesce(F.col("next_id").cast("string"), F.lit("-null-"))).withColumn("key", key)
    pairs = materialize(pairs.select("key", "h", "n", "next_key", "next_h"), "next")
    facts = unique.select(key, "h", "id", "n", "fp", "copies")
    texts = source.select(key, "h", "text")
    asked = pairs.select(F.col("next_key").alias("key"), F.col("next_h").alias("h"), F.col("key").alias("for_key"), F.col("h").alias("for_h"), F.col("n").alias("for_n"))
    heads = texts.join(asked, ["key", "h"]).select(
        F.col("for_key").alias("key"), F.col("for_h").alias("h"), F.substring("text", F.lit(1), F.floor(F.col("for_n") / 2).cast("int")).alias("head")
    ).dropDuplicates(["key", "h"])
    next_fp = facts.select(F.col("key").alias("next_key"), F.col("h").alias("next_h"), F.col("fp").alias("next_fp"))
    small = facts.join(pairs.drop("n"), ["key", "h"]).join(next_fp, ["next_key", "next_h"]).select("key", "h", "id", "n", "fp", "next_fp")
    met = texts.join(heads, ["key", "h"]).join(small, ["key", "h"])
    kept = (F.col("n") - F.floor(F.col("n") / 2)).cast("int")
    met = met.withColumn("edited", F.concat(F.substring("text", F.lit(1), kept), "head"))
    met = met.select("id", "n", "fp", "next_fp", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fp"))
    return met.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_chars"),
        "edited_sha256",
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
