"""Load of key ranges on shards, and which ranges should move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.small import small

THRESHOLD_PCT, ACTIVE_CHUNKS = 3.0, 10


def shard_load(activity: DataFrame) -> DataFrame:
    return activity.groupBy("ns", "shard").agg(F.sum("cnt").alias("total_ops"), F.count(F.lit(1)).alias("active_chunks"))


def ns_skew(load: DataFrame) -> DataFrame:
    return load.groupBy("ns").agg(F.sum("total_ops").alias("total_ops"), (F.max("total_ops") - F.min("total_ops")).alias("delta_ops"))


def shard_targets(load: DataFrame, shards: DataFrame, threshold: float = THRESHOLD_PCT, active: int = ACTIVE_CHUNKS) -> DataFrame:
    """Each namespace's target per shard over all shards (few), unseen ones with no load and never above."""
    all_ = load.select("ns").distinct().join(small(shards.select("shard").distinct()))
    x = all_.join(load.withColumn("_seen", F.lit(True)), ["ns", "shard"], "left").fillna(0, ["total_ops", "active_chunks"])
    w = Window.partitionBy("ns")
    x = x.withColumn("_t", F.expr("sum(total_ops) over (partition by ns) div count(*) over (partition by ns)"))
    pct = F.when(F.col("_t") == 0, 0.0).otherwise(100.0 * F.col("total_ops") / F.col("_t"))
    above = F.coalesce("_seen", F.lit(False)) & ((F.abs(pct - 100) >= threshold) | (F.col("total_ops") == 0)) & (F.col("active_chunks") > active)
    return x.select("ns", "shard", F.col("total_ops").cast("long").alias("total_ops"), F.col("active_chunks").cast("long").alias("active_chunks"), (F.col("_t") - F.col("total_ops")).cast("long").alias("delta_ops"), F.round(pct, 4).alias("delta_pct"), above.alias("above"))


def hot_ranges(activity: DataFrame, target: int, by: str = "ns") -> DataFrame:
    """The most active ranges until their running sum reaches ``target``; the crossing one and the first are in."""
    w = Window.partitionBy(by).orderBy(F.desc("cnt"), "range_id")
    prev = F.coalesce(F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return activity.withColumn("prev", prev).withColumn("_n", F.row_number().over(w)).where((F.col("prev") < target) | (F.col("_n") == 1)).drop("_n")


def move_pairs(targets: DataFrame, most: int = 2) -> DataFrame:
    """The i-th hottest with the i-th coldest shard of each namespace."""
    hot, cold = Window.partitionBy("ns").orderBy(F.desc("total_ops"), "shard"), Window.partitionBy("ns").orderBy("total_ops", F.desc("shard"))
    x = targets.withColumn("h", F.row_number().over(hot)).withColumn("c", F.row_number().over(cold)).withColumn("n", F.sum(F.col("above").cast("int")).over(Window.partitionBy("ns")))
    a = x.select("ns", F.col("h").alias("pair_no"), F.col("shard").alias("from_shard"), F.col("above").alias("_fa"), "n")
    b = x.select("ns", F.col("c").alias("pair_no"), F.col("shard").alias("to_shard"), F.col("above").alias("_ta"), F.col("total_ops").alias("_to"))
    ok = F.col("_fa") & ~(~F.col("_ta") & (F.col("_to") > 0)) & (F.col("from_shard") != F.col("to_shard")) & (F.col("pair_no") <= F.least(F.lit(most), F.col("n")))
    return a.join(b, ["ns", "pair_no"]).where(ok).select("ns", "pair_no", "from_shard", "to_shard")


def move_target(from_delta, to_delta) -> Column:
    """Operations to move between two shards: a third of the distance from its target of the shard that is nearer to it, with its sign."""
    smaller = F.when(F.abs(F.col(from_delta)) < F.abs(F.col(to_delta)), F.col(from_delta)).otherwise(F.col(to_delta))
    return F.floor(smaller * 0.33 + 0.5).cast("long")


def movable(last_move: str = "minutes_since_move", balanced: str = "balanced", least: int = 60) -> Column:
    """Ranges not marked as balanced and not moved within the hour; those never moved or marked are in."""
    return F.coalesce(F.col(last_move) > least, F.lit(True)) & ~F.coalesce(F.col(balanced), F.lit(False))


def planned_moves(activity: DataFrame, targets: DataFrame, most: int = 2) -> DataFrame:
    """Ranges to move for each pair of a hot and a cold shard: the most active movable ones of the hot shard until their
    sum reaches the pair's target; the crossing one and the first are in."""
    delta = lambda side: targets.select("ns", F.col("shard").alias(f"{side}_shard"), F.col("delta_ops").alias(f"{side}_delta"))
    pairs = move_pairs(targets, most).join(delta("from"), ["ns", "from_shard"]).join(delta("to"), ["ns", "to_shard"])
    pairs = pairs.withColumn("target", move_target("from_delta", "to_delta")).select("ns", "pair_no", F.col("from_shard").alias("shard"), "to_shard", "target")
    x = activity.where(movable()).join(pairs, ["ns", "shard"])
    w = Window.partitionBy("ns", "pair_no").orderBy(F.desc("cnt"), "range_id")
    prev = F.coalesce(F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = x.withColumn("prev", prev).withColumn("_n", F.row_number().over(w)).where((F.col("prev") < F.col("target")) | (F.col("_n") == 1))
    return x.select("ns", "pair_no", "range_id", F.col("shard").alias("from_shard"), "to_shard", "cnt", "target")


def mark_balanced(activity: DataFrame, ids) -> DataFrame:
    """Sets ``balanced`` in the elements of the array ``chunks`` whose id is in ``ids`` (a list or an array column); all others stay."""
    hit = (lambda x: x["id"].isin(ids)) if isinstance(ids, list) else (lambda x: F.array_contains(F.coalesce(F.col(ids), F.array().cast("array<bigint>")), x["id"]))
    return activity.withColumn("chunks", F.transform("chunks", lambda x: x.withField("balanced", F.when(hit(x), True).otherwise(x["balanced"]))))
