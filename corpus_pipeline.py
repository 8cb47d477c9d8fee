"""Corpus pipeline: quality rules, near-dedup, passage dedup, mixing, tokens.

STAGES lists the stages; each takes (spark, docs, sf_dir) and returns a DataFrame, and
each works on all that its predecessor kept. The columns of `documents` go through
unchanged up to the last stage. `run` writes every stage's result to the shared
folder and rereads it, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barwright.llm import bpe, mixing, quality_rules, simhash, substring_dedup
from barwright.llm.store import saved, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled cutoff rejects go."""
    ship_package(spark)
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: three-word shingles, two bits."""
    ship_package(spark)
    return simhash.keep_one(docs, shingle=3, distance=2)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat an earlier document's are cut out."""
    ship_package(spark)
    return substring_dedup.cut(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the number of copies that meets the sources' targets."""
    ship_package(spark)
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, encoded and decoded."""
    ship_package(spark)
    return bpe.digests(docs, *bpe.default_vocabulary())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("passages", passages), ("mix", mix), ("tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, f"pipeline-{name}")
    return docs
