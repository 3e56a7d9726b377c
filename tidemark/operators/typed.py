"""Scans, diffs and duplicates over keys of mixed types, by their encoded bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.typed_keys import typed_key
from tidemark.operators.ranges import ranked


def keyed(df: DataFrame, key: str) -> DataFrame:
    """Adds ``kb``, the bytes of the extended JSON in column ``key``: encoded once, before any shuffle."""
    return df.withColumn("kb", typed_key(key))


def in_order(df: DataFrame, key: str) -> DataFrame:
    """``df`` sorted by a key of any types: a range-partitioned sort of bytes."""
    return keyed(df, key).orderBy("kb").drop("kb")


def places(df: DataFrame, key: str) -> DataFrame:
    """Adds ``r``, the place of each row in that order from 1, and ``total``; equal keys are in no particular order."""
    return ranked(keyed(df, key), "kb").drop("kb")


def merge_diff(source: DataFrame, dest: DataFrame, key: str = "k") -> DataFrame:
    """(k, status) of two tables (key, h) whose keys may be of any types; 1 and 1.0 are one key, as are documents with their names in another order.

    A merge of two sides sorted by the bytes. ``k`` is the source's text of a key where it has one.
    """
    side = lambda df, name: keyed(df.select(F.col(key).alias("_text"), "h"), "_text").select(F.col("kb").alias("k"), "h", F.col("_text").alias(name))
    s, d = side(source, "_s"), side(dest, "_d")
    x = s.withColumn("here", F.lit(True)).alias("s").hint("merge").join(d.withColumn("here", F.lit(True)).alias("d"), "k", "full_outer")
    status = F.when(F.col("s.here").isNull(), "dest_only").when(F.col("d.here").isNull(), "source_only").when(F.col("s.h").eqNullSafe(F.col("d.h")), "match").otherwise("mismatch")
    return x.select(F.coalesce("_s", "_d").alias("k"), status.alias("status"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """(k, copies) of keys that occur more than once, whatever form they are written in; counted before the shuffle."""
    x = keyed(df, key).groupBy("kb").agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("k"))
    return x.where("copies > 1").select("k", "copies")
