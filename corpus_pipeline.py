"""From raw documents to piece ids: filter by quality, drop near duplicates, mix sources, encode.

Each stage works on all that the stage before it kept; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowaudit.llm import minhash, mixing, pieces, rules
from flowaudit.llm.scratch import Scratch
from flowaudit.session import use_utc


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from ``labels``, does not reject."""
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on five-word shingles."""
    return minhash.one_of_each_group(docs, shingle=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and thinned to the target weights of their sources."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, with their number and a digest of the decoded text."""
    return pieces.encode_texts(
        docs, public_tokenizers.path("piece_bpe_32k.model"), columns=("ids", "n_tokens", "decoded_sha256")
    )


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("source_mix", source_mix), ("encode", encode)]

#: Trees, components and merges cannot be written as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder for the next."""
    scratch = Scratch(use_utc(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
