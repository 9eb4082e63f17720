"""A corpus pipeline of five of the numbered operators; every stage works on all rows the one before
kept, and all but the last return the columns of ``documents``.

Rows are read from and written to Parquet between the stages. SQL cannot express language inference
or MinHash, so there is no ORACLE_SQL; tests/llm holds the stages against brute force.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import exact_dedup, lang_id, mixing, near_dup, packing, token_counts
from dirlens.llm.common import written
from dirlens.session import ship_package


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels teach."""
    ship_package(spark)
    return lang_id.keep_identified(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return near_dup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order; a document taken several times is as many rows."""
    return mixing.training_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of token ids. Near copies are gone, so equal texts are the only clusters."""
    ship_package(spark)
    return packing.pack(docs, length=token_counts.token_length(F.col("text")))


STAGES = [("language_id", identify), ("exact_dedup", dedup_exact), ("minhash_near_dedup", dedup_near),
          ("source_mix", mix_sources), ("best_fit_packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
