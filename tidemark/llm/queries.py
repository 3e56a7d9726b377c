"""The registered query of each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import contextmix, discriminant, filter_audit, hard_negatives, media, mixing, neardup, packing, quality, repeats, secrets, toxicity, warc
from ._io import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contextmix.digest(table(spark, sf_dir, "documents"))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discriminant.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_secrets, op3_quality, op4_mixing, op5_lm, op6_neardup, op7_packing, op8_warc, op9_media, op10_repeats, op11_filter_audit, op12_hard_negatives, op13_discriminant)
}
ORACLES = {"op4_mixing": mixing.ORACLE, "op11_filter_audit": filter_audit.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE}
