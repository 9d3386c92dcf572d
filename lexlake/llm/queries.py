"""The registered queries of the document operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.llm import (
    ann, bpe, exact_dedup, fill_middle, fingerprints, mixing, near_dedup, quality, resharding, secrets, token_counts, toxicity, whitening,
)
from lexlake.llm.common import documents

#: Shards before and after.
OLD_SHARDS, NEW_SHARDS = 16, 24


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score_quality(docs, quality.fit(docs, documents(spark, sf_dir, "labels")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_toxicity(docs, toxicity.learn(docs, documents(spark, sf_dir, "labels")))


def op3_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 16 shards by source, of very unequal size, to 24 of equal bytes; read from the shard files after they were written again."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(OLD_SHARDS))
    done = resharding.reshard_stored(documents(spark, sf_dir), old, NEW_SHARDS)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, with_ids=False)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(documents(spark, sf_dir))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir), width=2)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(documents(spark, sf_dir), digests_only=True)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(documents(spark, sf_dir, "embeddings"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(documents(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_quality, op2_toxicity, op3_resharding, op4_secret_scan, op5_byte_bpe,
        op6_token_counts, op7_source_mixing, op8_near_dedup, op9_exact_dedup, op10_fingerprints,
        op11_fill_in_middle, op12_whitening, op13_nearest_neighbours,
    ]
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    """The others can't be written in SQL: fitted models, regular expressions with positions,
    tokenizers, draws; likeness of all pairs takes SQL too long on whole tables. Tests hold
    those against brute force, exact round trips and held-out labels."""
    return {"op9_exact_dedup": exact_dedup.ORACLE, "op11_fill_in_middle": fill_middle.ORACLE}
