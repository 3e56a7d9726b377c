"""Ranges of keys: floor joins, runs of adjacent ranges, equal-depth bounds and plans."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.work import stored

#: Ranges up to which each row may be held against all of them.
FEW = 64


#: Ranges in a bin of a floor join, and bounds of bins that a plan may hold.
BIN, MOST_BOUNDS = 64, 1 << 16


def last_at_most(sorted_values: Column, x: Column, size: int | None = None) -> Column:
    """How many entries of an ascending array are at most ``x``: a binary search of one comparison a halving. A null entry is below all, a null ``x`` below those.

    ``size``: the most entries that the array may have, ``MOST_BOUNDS`` by default.
    """
    halvings = F.array(*[F.lit(1 << i) for i in reversed(range((size or MOST_BOUNDS).bit_length()))])

    def step(at: Column, width: Column) -> Column:
        entry = F.get(sorted_values, at + width - 1)
        return F.when((at + width <= F.size(sorted_values)) & x.isNotNull() & (entry.isNull() | (entry <= x)), at + width).otherwise(at)

    return F.aggregate(halvings, F.lit(0), step)


def place_among(bounds: str, kind: str, key: str) -> Column:
    """How many of the ascending ``bounds``, a JSON list of values of type ``kind``, are at most the key: a binary search, by whole batches for whole numbers."""
    import json

    values = json.loads(bounds)
    if kind not in ("tinyint", "smallint", "int", "bigint") or None in values:
        return last_at_most(F.from_json(F.lit(bounds), f"array<{kind}>"), F.col(key))
    known = np.array(values, np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(known, keys.to_numpy(np.int64), "right").astype(np.int32))

    # without nulls, as those would turn a batch into floating point
    return F.when(F.col(key).isNotNull(), place(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))))


def floor_join(rows: DataFrame, key: str, ranges: DataFrame, few: bool | None = None) -> DataFrame:
    """Each row with the range [lo, hi) that holds its key; ranges are disjoint, a null lo or hi is open, rows with a null key or one in no range are dropped.

    The ranges are counted while the plan is built: up to ``FEW`` are broadcast and every row is held against them. Many are ranked by their lower
    bounds and packed into bins of equal depth, ``BIN`` ranges each. A row finds its bin by binary search among the bounds, both sides are equi-joined on
    the bin, and a second binary search in the bin's sorted array picks the range: a few comparisons a row, however
    wide or narrow ranges are, and no row is paired with a range that does not hold it. The plan holds at most ``MOST_BOUNDS`` bounds; with more bins,
    bins are packed into bins in turn, found in the same way, and the depth of both grows with the square root of what is beyond,
    so that a row carries a short array. ``few`` forces one of the two forms.
    """
    n = ranges.limit(FEW + 1).count() if few is None else 0
    if few or (few is None and n <= FEW):
        inside = (F.col("lo").isNull() | (F.col(key) >= F.col("lo"))) & (F.col("hi").isNull() | (F.col(key) < F.col("hi")))
        return rows.where(F.col(key).isNotNull()).join(F.broadcast(ranges), inside)
    n = ranges.count()
    two = n > BIN * MOST_BOUNDS
    depth = max(BIN, math.isqrt(n // MOST_BOUNDS) + 1) if two else BIN
    binned = ranked(ranges, "lo").withColumn("_bin", F.floor((F.col("r") - 1) / depth).cast("long")).drop("r", "total")
    members = F.sort_array(F.collect_list(F.struct("lo", *[c for c in ranges.columns if c != "lo"]))).alias("_ranges")
    # the bounds of a bin are an array of their own: a row's search reads them in place
    bins = stored(binned.groupBy("_bin").agg(members).withColumn("_los", F.transform("_ranges", lambda r: r["lo"])), "bins")
    kind = dict(ranges.dtypes)["lo"]
    # a list of values would leave a null out, so lower bounds are listed with their bins
    listed = lambda c: F.transform(F.sort_array(F.collect_list(F.struct(c, F.col("_los")[0].alias("lo")))), lambda f: f["lo"])
    tops = stored(bins.groupBy(F.expr(f"_bin div {depth}").alias("_top")).agg(listed("_bin").alias("_los")), "bins") if two else bins.withColumn("_top", F.col("_bin"))
    bounds = tops.agg(F.to_json(listed("_top")).alias("b")).first()["b"]
    # the key of a join is an expression, so each side has an exchange of its own and Spark can split a bin that many rows fall in
    own = lambda c: F.col(c).bitwiseXOR(F.lit(0))
    x = rows.where(F.col(key).isNotNull()).withColumn("_at", (place_among(bounds, kind, key) - 1).cast("long"))
    if two:
        x = x.join(tops.select(own("_top").alias("_top"), F.col("_los").alias("_heads")), F.col("_at") == F.col("_top"))
        x = x.withColumn("_at", F.col("_top") * depth + last_at_most(F.col("_heads"), F.col(key), depth) - 1).drop("_top", "_heads")
    x = x.join(bins.select(own("_bin").alias("_bin"), "_ranges", "_los"), F.col("_at") == F.col("_bin"))
    found = F.get("_ranges", last_at_most(F.col("_los"), F.col(key), depth) - 1)
    x = x.withColumn("_found", found).where(F.col("_found.hi").isNull() | (F.col(key) < F.col("_found.hi")))
    return x.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in ranges.columns])


def merge_runs(ranges: DataFrame) -> DataFrame:
    """Adjacent ranges of one shard become one: ns, grp, shard, lo, hi, mids (inner bounds), n."""
    w = Window.partitionBy("ns").orderBy("lo")
    x = ranges.withColumn("_new", F.when(F.lag("shard").over(w).eqNullSafe(F.col("shard")), 0).otherwise(1)).withColumn("grp", F.sum("_new").over(w))
    g = x.groupBy("ns", "grp").agg(F.first("shard").alias("shard"), F.min("lo").alias("lo"), F.max_by("hi", "lo").alias("hi"), F.array_sort(F.collect_list("lo")).alias("_los"), F.count(F.lit(1)).alias("n"))
    return g.select("ns", "grp", "shard", "lo", "hi", F.expr("slice(_los, 2, greatest(size(_los) - 1, 0))").alias("mids"), "n")


def ranked(rows: DataFrame, key: str, *group: str) -> DataFrame:
    """Adds r, the rank of ``key`` within its group from 1, and total, the group's rows.

    Rows are dealt out by ranges of (group, key) and stored; each part ranks its own and adds the counts of the parts
    before it, so no task sorts a whole group. Equal keys stay in one part: a key that a large share of all rows has
    should be counted before.
    """
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = stored(rows.repartitionByRange(parts, *group, key).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = x.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(*group)
    before = counts.withColumn("_before", F.coalesce(F.sum("c").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("c").over(whole)).drop("c")
    y = x.join(before, [*group, "_part"])
    return y.withColumn("r", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(key)) + F.col("_before")).drop("_part", "_before")


def prefix_sums(rows: DataFrame, key: str, weight: str) -> DataFrame:
    """Adds ``before``, the weight of all rows with smaller keys, ``prev``, that of the row before (null for the first), and ``total``; keys are unique.

    Rows are dealt out by ranges of the key and stored; each part adds up its own rows and the sums of the parts before it,
    so neither a sum nor a sort goes through one task.
    """
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = stored(rows.repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()), "sums")
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    sums = x.groupBy("_part").agg(F.sum(weight).alias("_w"), F.max_by(weight, key).alias("_last"))
    sums = sums.select("_part", F.coalesce(F.sum("_w").over(by_part), F.lit(0)).alias("_before"), F.last("_last").over(by_part).alias("_prev"), F.sum("_w").over(Window.partitionBy()).alias("total"))
    own = Window.partitionBy("_part").orderBy(key)
    inside = F.coalesce(F.sum(weight).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    y = x.join(F.broadcast(sums), "_part")  # as many rows as there are shuffle partitions
    return y.withColumn("before", inside + F.col("_before")).withColumn("prev", F.coalesce(F.lag(weight).over(own), "_prev")).drop("_part", "_before", "_prev")


def equal_depth_bounds(rows: DataFrame, key: str, n: int | Column) -> DataFrame:
    """Exact bounds of n shares of nearly equal size; n may be an expression over ``total``, the number of rows. Rows with a null key are in no share.

    Rows are counted by key first, so a key that a large share of all rows has is one row; it lies in each share that its ranks reach into.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("c"))
    y = prefix_sums(counts, "key", "c").withColumn("_n", F.lit(n) if isinstance(n, int) else n)
    # the first total % n shares hold one row more, as ntile does
    size, more = F.floor(F.col("total") / F.col("_n")), F.col("total") % F.col("_n")
    share = lambda r: F.when(r <= more * (size + 1), F.ceil(r / (size + 1))).otherwise(more + F.ceil((r - more * (size + 1)) / F.greatest(size, F.lit(1)))).cast("int")
    upto = lambda t: t * size + F.least(t, more)  # noqa: E731  the last rank of share t
    y = y.withColumn("tile", F.explode(F.sequence(share(F.col("before") + 1), share(F.col("before") + F.col("c")))))
    held = F.least(F.col("before") + F.col("c"), upto(F.col("tile"))) - F.greatest(F.col("before"), upto(F.col("tile") - 1))
    return y.groupBy("tile").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum(held).cast("long").alias("n"))


def sketched_bounds(rows: DataFrame, key: str, n: int, error: float = 1e-4) -> DataFrame:
    """(bound_no, bound): n - 1 inner bounds of n shares in one pass, from mergeable quantile sketches; no key is shuffled.

    The rank of each bound is at most ``error`` times the number of rows from its place. A key that many rows have is no hot group, as
    each task only sends its sketch, of a size in the order of 1 / error.
    """
    q = F.percentile_approx(key, [i / n for i in range(1, n)], max(1, round(1 / error)))
    return rows.agg(q.alias("q")).select(F.posexplode("q").alias("bound_no", "bound")).withColumn("bound_no", F.col("bound_no") + 1)


def split_keys(rows: DataFrame, key: str, size: str, shards: int, **limits) -> DataFrame:
    """(split_key, bytes_before, split_size): keys at which another split begins, from the true bytes of rows.

    Bytes are added up by key first, then over keys in their order; a split begins at the first key that has another multiple of the
    split's size before it.
    """
    sums = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.sum(size).alias("b"))
    y = prefix_sums(sums, "k", "b").withColumn("s", split_size(F.col("total"), shards, **limits))
    return y.where("prev is not null and before div s > (before - prev) div s").select(F.col("k").alias("split_key"), F.col("before").cast("long").alias("bytes_before"), F.col("s").alias("split_size"))


def partition_count(size, docs, part_size: int = 400 << 20, least_docs: int = 101) -> Column:
    """Partitions of ``part_size`` bytes, the last one begun; small tables are one. Expressions or numbers."""
    size, docs = (F.lit(x) if isinstance(x, int) else x for x in (size, docs))
    return F.when(docs < least_docs, 1).otherwise(F.floor(size / part_size) + 1).cast("long")


def sample_size(docs) -> Column:
    """Keys to draw for bounds: one in a hundred of a small table, a fixed number of a large one."""
    docs = F.lit(docs) if isinstance(docs, int) else docs
    return F.when(docs < 100_000, F.floor(docs * 0.01 + 0.5)).otherwise(25_000).cast("long")


def sampled(rows: DataFrame, key: str, n: int, seed: str = "sample") -> DataFrame:
    """n rows at random, the same on every run: those with the least digests of key and seed."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key).limit(n)


def split_size(size, shards: int, most: int = 16793599, mega: int = 1 << 20) -> Column:
    """Bytes between two split points: a tenth of a shard's share, at most ``most``; below a megabyte, two."""
    size = F.lit(size) if isinstance(size, int) else size
    share = F.floor(F.floor(size / shards) / 10)
    return F.when(share >= most, most).when(share < mega, 2 * mega).otherwise(share).cast("long")


def uber_ids(ranges: DataFrame, key: str, small: int = 100, large: int = 300, many: int = 1000) -> DataFrame:
    """Adds ``uber_id``: neighbouring ranges in the order of ``key`` share one, ``small`` of them each, or ``large`` from ``many`` ranges on."""
    x = ranked(ranges, key)
    step = F.when(F.col("total") >= many, large).otherwise(small)
    return x.withColumn("uber_id", (F.floor((F.col("r") - 1) / step) + 1).cast("long")).drop("r", "total")


def partition_plan(bounds: DataFrame) -> DataFrame:
    """(part_no, lo, hi, est_docs) from (tile, lo, hi, n): the last range is open. One row a partition, so one window."""
    w, whole = Window.orderBy("tile"), Window.partitionBy()
    return bounds.select((F.col("tile") - 1).cast("int").alias("part_no"), "lo", F.lead("lo").over(w).alias("hi"), F.floor(F.sum("n").over(whole) / F.count(F.lit(1)).over(whole)).cast("long").alias("est_docs"))


def neighbours(keys: DataFrame, key: str) -> DataFrame:
    """(lo, hi) of adjacent keys with open tails; for bounds, which are few."""
    w = Window.orderBy(key)
    ends = keys.select(F.lag(key).over(w).alias("lo"), F.col(key).alias("hi"))
    return ends.unionByName(keys.agg(F.max(key).alias("lo")).withColumn("hi", F.lit(None).cast("long")))
