"""Comparing two copies of a table. Both sides shrink to (key, hash) before the one shuffle that joins them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import row_bytes, row_hash, row_hash_unordered


def hashed(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """(k, h, b): key, hash and bytes of each row."""
    return df.select(F.col(key).alias("k"), row_hash(*cols).alias("h"), row_bytes(*cols).alias("b"))


def marked(df: DataFrame, name: str) -> DataFrame:
    """With a column that tells a row that is there from one that an outer join has made up, whatever its key."""
    return df.withColumn("here", F.lit(True)).alias(name)


def state() -> Column:
    """Three-way state of an outer-joined pair s, d of marked sides."""
    return (
        F.when(F.col("s.here").isNull(), "dest_only").when(F.col("d.here").isNull(), "source_only").when(F.col("s.h").eqNullSafe(F.col("d.h")), "match").otherwise("mismatch")
    )


def full_diff(source: DataFrame, dest: DataFrame) -> DataFrame:
    """(k, status, src_hash, dst_hash) of two (k, h) tables; keys are unique on each side, and a null key equals a null key."""
    x = marked(source, "s").join(marked(dest, "d"), F.col("s.k").eqNullSafe(F.col("d.k")), "full_outer")
    return x.select(F.coalesce("s.k", "d.k").alias("k"), state().alias("status"), F.col("s.h").alias("src_hash"), F.col("d.h").alias("dst_hash"))


def sized_diff(source: DataFrame, dest: DataFrame) -> DataFrame:
    """(k, status, bytes) of two (k, h, b) tables; a row counts with the larger of its two copies."""
    x = marked(source, "s").join(marked(dest, "d"), F.col("s.k").eqNullSafe(F.col("d.k")), "full_outer")
    return x.select(F.coalesce("s.k", "d.k").alias("k"), state().alias("status"), F.greatest("s.b", "d.b").alias("bytes"))


def lookup_diff(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Driven by the source: rows that only the destination has never appear."""
    out = F.when(F.col("d.here").isNull(), "missing").when(F.col("s.h").eqNullSafe(F.col("d.h")), "match").otherwise("mismatch")
    return source.alias("s").join(marked(dest, "d"), F.col("s.k").eqNullSafe(F.col("d.k")), "left").select(F.col("s.k").alias("k"), out.alias("status"))


def id_diff(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Keys of one side only; a null key is a key like any other."""
    x = marked(source.select("k"), "s").join(marked(dest.select("k"), "d"), F.col("s.k").eqNullSafe(F.col("d.k")), "full_outer")
    x = x.where(F.col("s.here").isNull() | F.col("d.here").isNull())
    return x.select(F.coalesce("s.k", "d.k").alias("k"), F.when(F.col("s.here").isNull(), "dest_only").otherwise("source_only").alias("status"))


def three_way(source: DataFrame, dest: DataFrame) -> DataFrame:
    """(k, status) of (k, h, u): equal, equal up to the order of fields, or different."""
    status = F.when(F.col("s.here").isNull(), "dest_only").when(F.col("d.here").isNull(), "source_only").when(F.col("s.h") == F.col("d.h"), "match").when(F.col("s.u") == F.col("d.u"), "misordered").otherwise("mismatch")
    return marked(source, "s").join(marked(dest, "d"), F.col("s.k").eqNullSafe(F.col("d.k")), "full_outer").select(F.coalesce("s.k", "d.k").alias("k"), status.alias("status"))


def with_both_hashes(df: DataFrame, *cols: str, reverse: Column | None = None) -> DataFrame:
    """(k, h, u): the ordered hash, over reversed columns where ``reverse`` holds, and the order-free one."""
    h = row_hash(*cols)
    if reverse is not None:
        h = F.when(reverse, row_hash(*cols[::-1])).otherwise(h)
    return df.select("k", h.alias("h"), row_hash_unordered(*cols).alias("u"))


def changed_diff(source: DataFrame, dest: DataFrame, ids: DataFrame) -> DataFrame:
    """Only keys that the log touched, a null one among them: both sides are reduced by semi join first."""
    ids = ids.select(F.col("k").alias("_id")).distinct()
    touched = lambda x: x.join(ids, F.col("k").eqNullSafe(F.col("_id")), "left_semi")
    return full_diff(touched(source), touched(dest)).select("k", "status")


def summary(diffed: DataFrame, *by: str) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s)
    out = diffed.groupBy(*by).agg(F.count(F.lit(1)).alias("processed"), n("match").alias("matches"), n("mismatch").alias("mismatches"), n("source_only").alias("source_only"), n("dest_only").alias("dest_only"))
    return out.withColumn("pct", F.round(100.0 * F.col("matches") / F.col("processed"), 4))


def totals(diffed: DataFrame, retries: DataFrame, *by: str) -> DataFrame:
    """Per group: ranges processed, failed and retried, documents and bytes compared, and documents that failed."""
    docs = diffed.groupBy(*by).agg(F.count(F.lit(1)).alias("docs"), F.count_if(F.col("status") != "match").alias("failed_docs"), F.sum("bytes").alias("bytes"))
    runs = retries.groupBy(*by).agg(F.count(F.lit(1)).alias("ranges"), F.count_if(F.col("status") == "failed").alias("failed_ranges"), F.count_if(F.col("retry_num") > 1).alias("retried_ranges"))
    return docs.join(runs, list(by), "full_outer").fillna(0)


def recheck(failed: DataFrame, source: DataFrame, dest: DataFrame) -> DataFrame:
    """Failed keys, null ones too, compared anew: gone on both sides or equal on both passes, all else stays."""
    f = failed.select("ns", F.col("k").alias("_k")).alias("f")
    x = f.join(marked(source, "s"), F.col("_k").eqNullSafe(F.col("s.k")), "left").join(marked(dest, "d"), F.col("_k").eqNullSafe(F.col("d.k")), "left")
    same = F.col("s.here").eqNullSafe(F.col("d.here")) & F.col("s.h").eqNullSafe(F.col("d.h"))
    return x.select("ns", F.col("_k").alias("k"), F.when(same, "pass").otherwise("stay").alias("outcome"))


def pull_passed(ranges: DataFrame, rechecked: DataFrame, *by: str) -> DataFrame:
    """Each range's array ``failed`` without the keys that have passed since, in its order."""
    passed = rechecked.where("outcome = 'pass'").groupBy(*by).agg(F.collect_set("k").alias("_gone"))
    left = F.array_except("failed", F.coalesce("_gone", F.array().cast("array<bigint>")))
    return ranges.join(passed, list(by), "left").select(*by, left.alias("failed"))


def upsert_status(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New states replace old ones; from the second try on the old state is kept in ``history``."""
    o = old.select(*key, F.struct("status", "retry_num").alias("_old"), F.col("history").alias("_history"))
    x = new.select(*key, F.struct("status", "retry_num").alias("_new")).join(o, key, "full_outer")
    now = F.coalesce("_new", "_old")
    past = F.coalesce("_history", F.array().cast("array<struct<status:string,retry_num:int>>"))
    past = F.when(F.col("_new.retry_num") > 1, F.concat(past, F.when(F.col("_old").isNotNull(), F.array("_old")).otherwise(F.array().cast("array<struct<status:string,retry_num:int>>")))).otherwise(past)
    return x.select(*key, now["status"].alias("status"), now["retry_num"].alias("retry_num"), past.alias("history"))
