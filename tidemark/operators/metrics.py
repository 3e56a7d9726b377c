"""Counters over time, pivots by shard, connection groups, index usage and size balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deltas(snap: DataFrame, entity: str, counter: str, *order: str) -> DataFrame:
    """Change since the entity's previous snapshot, 0 for the first; a reset gives a negative change."""
    w = Window.partitionBy(entity).orderBy(*order)
    return snap.withColumn("delta", F.coalesce(F.col(counter) - F.lag(counter).over(w), F.lit(0)))


def running(df: DataFrame, entity: str, value: str, *order: str) -> DataFrame:
    return df.withColumn("running", F.sum(value).over(Window.partitionBy(entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def hot_flags(metric: DataFrame) -> DataFrame:
    """(ns, shard, v) with the mean over shards that have any, and whether a shard is warm or hot."""
    avg = F.avg(F.when(F.col("v") > 0, F.col("v"))).over(Window.partitionBy("ns"))
    x = metric.withColumn("_avg", avg)
    some = F.col("v") >= 0.5
    return x.select("ns", "shard", "v", F.round("_avg", 4).alias("avg_nonzero"), (some & (F.col("v") > 1.25 * F.col("_avg"))).alias("warm"), (some & (F.col("v") > 2 * F.col("_avg"))).alias("hot"))


def pivot_score(metric: DataFrame, shard_count: int) -> DataFrame:
    """max * max / mean over all shards; 0 for namespaces without load."""
    g = metric.groupBy("ns").agg(F.max("v").alias("m"), F.sum("v").alias("s"))
    return g.select("ns", F.round(F.when((F.col("s") == 0) | (F.col("m") == 0), 0.0).otherwise(F.col("m") * (F.col("m") / (F.col("s") / shard_count))), 4).alias("score"))


def pivot_metrics(rows: DataFrame, names: list[str], shards: list[str]) -> DataFrame:
    """(ns, metric, one column a shard) from rows (ns, shard, metrics); a shard without a row has 0."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("v")) for n in names]))
    x = rows.select("ns", "shard", pairs.alias("m")).select("ns", "shard", "m.*")
    p = x.groupBy("ns", "metric").pivot("shard", shards).agg(F.sum("v"))
    return p.select("ns", "metric", *[F.round(F.coalesce(s, F.lit(0.0)), 4).alias(s) for s in shards])


#: Metrics of collections that a report can be sorted by, and the columns that they are computed from; all descend but the name.
SORTS = {
    "namespace": "coalesce(ns, '')", "cachemb": "cache_bytes", "dirtymb": "dirty_bytes", "datagb": "data_bytes", "idxgb": "index_bytes", "dirty%": "dirty_bytes / nullif(cache_bytes, 0)",
    "idxdty%": "index_dirty_bytes / nullif(index_cache_bytes, 0)", "readmb": "read_bytes", "writmb": "written_bytes",
}


def sorted_by(stats: DataFrame, name: str) -> list[Column]:
    """The order of a report by one of ``SORTS``, in any case; an unknown name sorts by the cache, missing values count as 0, ties go by ns and shard."""
    kind = name.lower() if name.lower() in SORTS else "cachemb"
    first = F.expr(SORTS[kind]).asc() if kind == "namespace" else F.coalesce(F.expr(f"double({SORTS[kind]})"), F.lit(0.0)).desc()
    return [first, F.col("ns").asc_nulls_first(), F.col("shard").asc_nulls_first()]


def eviction_notes(history_mb: int = 512) -> list[Column]:
    """One expression for each threshold of cache eviction, null where it is not crossed: from pct (dirty share), app, dirty
    and clean (pages evicted by applications, changed, unchanged), blocked and waits (evictions held up), history (MB)."""
    n = F.col
    return [
        F.when(n("pct") >= 20, "a fifth or more is dirty: applications evict").when(n("pct") >= 5, "a twentieth or more is dirty: eviction runs"),
        F.when(n("app") > 0, "applications take part in eviction"),
        F.when((n("dirty") > 0) & (n("clean") == 0), "only changed pages leave"),
        F.when(n("blocked") > 0, "pages in use hold eviction up"),
        F.when(n("waits") > 0, "a checkpoint holds eviction up"),
        F.when(n("history") > history_mb, F.concat(F.lit("old versions take "), n("history").cast("long"), F.lit(" MB"))),
    ]


def connections(sessions: DataFrame, *by: str) -> DataFrame:
    """Totals by group; seconds only of active sessions that have any."""
    secs = F.when(F.col("active"), F.col("secs"))
    return sessions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("active").alias("active"), F.count_if(~F.col("active")).alias("inactive"),
        F.coalesce(F.sum(secs), F.lit(0)).alias("total_secs"), F.round(F.coalesce(F.avg(secs), F.lit(0.0)), 4).alias("avg_secs"), F.coalesce(F.max(secs), F.lit(0)).alias("max_secs"),
    )


def connections_rollup(sessions: DataFrame, key: str) -> DataFrame:
    """The groups and a TOTAL row; its mean comes from sums, not from means."""
    secs = F.when(F.col("active"), F.col("secs"))
    g = sessions.rollup(key).agg(F.count(F.lit(1)).alias("total"), F.count_if("active").alias("active"), F.coalesce(F.sum(secs), F.lit(0)).alias("total_secs"), F.round(F.coalesce(F.avg(secs), F.lit(0.0)), 4).alias("avg_secs"), F.grouping(key).alias("_g"))
    return g.withColumn(key, F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col(key))).drop("_g")


def index_usage(rows: DataFrame) -> DataFrame:
    """Uses of each index summed over nodes by role, and since when the counters of all nodes run."""
    ops = lambda r: F.coalesce(F.sum(F.when(F.col("role") == r, F.col("ops"))), F.lit(0))
    return rows.groupBy("db", "ns", "name").agg(ops("primary").alias("primary_ops"), ops("secondary").alias("secondary_ops"), F.sum("size_bytes").alias("size_bytes"), F.min("since").alias("since"), F.bool_or("shard_key").alias("shard_key"))


def index_health(usage: DataFrame, low: int = 100) -> DataFrame:
    """Unused and little used indexes by namespace, database and in all; shard keys count only in the total."""
    n = F.col("primary_ops") + F.col("secondary_ops")
    free = ~F.col("shard_key")
    g = usage.rollup("db", "ns").agg(F.count(F.lit(1)).alias("total"), F.count_if(free & (n == 0)).alias("unused"), F.count_if(free & (n > 0) & (n < low)).alias("low_usage"))
    return g.select(F.coalesce("db", F.lit("ALL")).alias("db"), F.coalesce("ns", F.lit("ALL")).alias("ns"), "total", "unused", "low_usage")


def size_balance(sizes: DataFrame) -> DataFrame:
    """(shard, size): deviation from the mean and a status from the largest deviation. One row per shard, so one window."""
    all_ = Window.partitionBy()
    x = sizes.withColumn("avg_size", F.avg("size").over(all_)).withColumn("deviation_pct", F.abs(F.col("size") - F.col("avg_size")) / F.col("avg_size") * 100)
    most = F.max("deviation_pct").over(all_)
    status = F.when(F.count(F.lit(1)).over(all_) < 2, None).when(most < 10, "well balanced").when(most < 25, "moderate").otherwise("significant")
    return x.select("shard", "size", F.round("avg_size", 4).alias("avg_size"), F.round("deviation_pct", 4).alias("deviation_pct"), status.alias("status"))
