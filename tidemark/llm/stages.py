"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and all but the last return documents.

Every stage keeps the columns of its input, whatever they are called, and works on whole texts of any length.
Null texts count as empty: the quality stage rejects them, as they have too few words; the near-duplicate
stage alone would keep each. Repeated rows are one group of copies for the near-duplicate stage, which
keeps one of them, as it does of copies without an id. A null source is a source. Of equal documents that tie
for a place the one with the least id stays; of rows with one id and text that differ in other columns, that whose JSON comes first.
An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, neardup, packing, quality, secrets
from ._io import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects."""
    return quality.passing(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with live secrets masked; examples that many sources copy stay."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Only ids and sizes are ranked; texts are joined once."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(doc.alias("doc"), "doc_id", "source", "text", F.xxhash64("text").alias("key"))
    narrow = keyed.select("doc_id", "source", "key", mixing.size_of(F.col("text")).alias("words"), mixing.mark_of(F.col("doc_id"), F.col("text")).alias("mark"))
    copies = mixing.sample(narrow, F.col("words"), mark=F.col("mark")).where("copies > 0").groupBy(F.col("doc_id").alias("i"), F.col("key").alias("k")).agg(F.max("copies").cast("int").alias("copies"))
    got = keyed.join(copies, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")))
    return got.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its sequence."""
    return packing.pack(docs)
