"""Registered queries of the operators and the pipeline, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barwright.llm import (
    ann_tree,
    bpe,
    chat_format,
    hard_negatives,
    html_wrapper,
    license_scan,
    lm,
    merkle,
    mixing,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
)
from barwright.llm.store import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.query(_table(spark, sf_dir, "documents"))


def op2_ann(spark, sf_dir):
    return ann_tree.query(_table(spark, sf_dir, "embeddings"))


def op3_html_extract(spark, sf_dir):
    return html_wrapper.query(_table(spark, sf_dir, "pages"))


def op4_license_scan(spark, sf_dir):
    return license_scan.query(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    return quality_rules.query(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_simhash(spark, sf_dir):
    return simhash.query(_table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mixing.query(_table(spark, sf_dir, "documents"))


def op8_sharding(spark, sf_dir):
    return sharding.query(_table(spark, sf_dir, "documents"))


def op9_bpe(spark, sf_dir):
    return bpe.query(_table(spark, sf_dir, "documents"))


def op10_lm(spark, sf_dir):
    return lm.query(_table(spark, sf_dir, "documents"))


def op11_merkle(spark, sf_dir):
    return merkle.query(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.query(_table(spark, sf_dir, "embeddings"))


def op13_chat_format(spark, sf_dir):
    return chat_format.query(_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_ann, op3_html_extract, op4_license_scan, op5_quality_rules, op6_simhash, op7_mixing,
        op8_sharding, op9_bpe, op10_lm, op11_merkle, op12_hard_negatives, op13_chat_format,
    )
}
ORACLES: dict[str, str] = {
    "op4_license_scan": license_scan.oracle(), "op8_sharding": sharding.oracle(), "op11_merkle": merkle.oracle(),
    "op12_hard_negatives": hard_negatives.oracle(), "op13_chat_format": chat_format.oracle(),
}
