"""A training corpus from raw documents: five stages, each on what the one before kept.

Toxic documents go, of equal texts one stays, of each group of near copies one stays,
sources are mixed to their weights, and the mix is encoded. Stages are written as
Parquet into the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexlake.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from lexlake.llm.common import documents
from lexlake.workspace import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, lexicon)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs, carry=True).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Learned lexicon, tokenizer and draws can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
