"""Registered queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import load, shipped
from ..sources.adapters import POLISHED_CAPTIONS
from . import endings, mojibake, oracles, pairs, repetition, runs, tokens


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.collapse_runs(load(spark, sf_dir, "pass1_progress"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defects(load(spark, sf_dir, "stage2_refined"))


def _captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endings.caption_values(load(spark, sf_dir, "stage2_refined"), load(spark, sf_dir, "stage3_polished", POLISHED_CAPTIONS), load(spark, sf_dir, "pass3_final"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endings.truncated(_captions(spark, sf_dir)).select("field", "run_id", "item_id")


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endings.rates(_captions(spark, sf_dir))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.text_values(load(spark, sf_dir, "pass1_progress"), load(spark, sf_dir, "stage2_refined"), load(spark, sf_dir, "stage3_polished", POLISHED_CAPTIONS))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetitive(_texts(spark, sf_dir))
    return found.where(F.col("share") >= repetition.CASE_SHARE).select("field", "run_id", "item_id")


def p6_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetitive(_texts(spark, sf_dir))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_ids(load(spark, sf_dir, "documents"), tokens.vocabulary_path(spark))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.pack(load(spark, sf_dir, "documents"), tokens.vocabulary_path(spark))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled(load(spark, sf_dir, "documents")).select("doc_id")


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled(load(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = {
        "p1_found": p1_found,
        "p3_found": p3_found,
        "p5_found": p5_found,
        "p5_rates": p5_rates,
        "p6_found": p6_found,
        "p6_outliers": p6_outliers,
        "p7_ids": p7_ids,
        "p8_packed": p8_packed,
        "p9_found": p9_found,
        "p9_restored": p9_restored,
    }
    return {k: shipped(f) for k, f in made.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
