"""Duplicate keys: finding, archiving by copy number, rechecking, deleting and restoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.work import stored


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """Counts are partial sums before the shuffle, so a hot key is no hot task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def archive(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """All copies of duplicated keys, numbered from 1 within each key."""
    dup = df.join(duplicate_ids(df, key).select(key), key, "left_semi")
    return dup.withColumn("copy_no", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def summary(df: DataFrame, key: str) -> DataFrame:
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_docs"), F.count_if(F.col("n") > 1).alias("dupe_ids"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("dupe_docs"))


def paired(archived: DataFrame, key: str, *values: str) -> DataFrame:
    """(key, state, first and second of each value) of two archives, copy 1 and copy 2 of ``archive``: walked side by side in key order, as a merge
    of sorted partitions. A key that one archive lacks shows up as ``first_only`` or ``second_only`` and does not shift the rest, as a walk by position would."""
    side = lambda n, name: archived.where(F.col("copy_no") == n).select(F.col(key).alias(f"_{name}"), F.lit(True).alias(f"in_{name}"), *[F.col(v).alias(f"{name}_{v}") for v in values])
    x = side(1, "first").hint("merge").join(side(2, "second"), F.col("_first").eqNullSafe(F.col("_second")), "full_outer")
    state = F.when(F.col("in_second").isNull(), "first_only").when(F.col("in_first").isNull(), "second_only").otherwise("paired")
    return x.select(F.coalesce("_first", "_second").alias(key), state.alias("state"), *[f"{n}_{v}" for v in values for n in ("first", "second")])


def recheck(archived: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Archived keys counted in the source; keys that it no longer has are neither counted nor removed."""
    ids = archived.select(key).distinct()
    n = source.join(ids, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("src_count"))
    return n.withColumn("is_dup", F.col("src_count") > 1)


def conflicts(placed: DataFrame, key: str) -> DataFrame:
    """Keys with two or more rows on one shard."""
    return placed.groupBy(key, "shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def delete(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_anti")


def restore(df: DataFrame, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Insert rows whose key is free, one per key; the rest is rejected."""
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*rows.columns)))
    taken = df.select(key).distinct().withColumn("_t", F.lit(True))
    x = first.join(taken, key, "left")
    free = F.col("_t").isNull() & (F.col("_n") == 1)
    return df.unionByName(x.where(free).select(*df.columns)), x.where(~free).select(*rows.columns)


def met_inserts(log: DataFrame) -> DataFrame:
    """Inserts and deletions of an ordered log (id, op, ts, seq) with ``met``: whether an insert's id is there already, as the last insert or deletion before was an insert."""
    w = Window.partitionBy("id").orderBy("ts", "seq")
    return log.where(F.col("op").isin("i", "d")).withColumn("met", (F.col("op") == "i") & F.lag("op").over(w).eqNullSafe("i"))


def rejected_inserts(log: DataFrame) -> DataFrame:
    """Inserts of an ordered log whose id is there already."""
    return met_inserts(log).where("met").drop("met")


def bulk_totals(log: DataFrame, batch: Column) -> DataFrame:
    """What bulk writes of a log have done, by batch: rows inserted, modified and deleted, and inserts that met a key and were left out."""
    ops = met_inserts(log).unionByName(log.where("op = 'u'").withColumn("met", F.lit(False)))
    n = lambda cond, name: F.count_if(F.expr(cond)).alias(name)
    return ops.groupBy(batch.alias("batch")).agg(n("op = 'i' and not met", "inserted"), n("op = 'u'", "modified"), n("op = 'd'", "deleted"), n("met", "duplicates"))


def applied(log: DataFrame) -> DataFrame:
    """(id, a, b) after a log (id, ts, seq, value, form): ``whole`` writes a and b, ``set`` writes a of a document that is there,
    ``delete`` removes it. All aggregates combine before the shuffle but the last value since the last whole write."""
    at = F.struct("ts", "seq")
    of = lambda f: F.max(F.when(F.col("form") == f, at))
    marks = log.groupBy("id").agg(of("whole").alias("whole"), of("delete").alias("gone"))
    live = marks.where("whole is not null and (gone is null or whole > gone)").select("id", "whole")
    x = log.join(live, "id").where(at >= F.col("whole"))
    return x.groupBy("id").agg(F.max_by("value", at).alias("a"), F.max_by(F.when(F.col("form") == "whole", F.col("value")), F.when(F.col("form") == "whole", at)).alias("b"))


def scores(keys: DataFrame, placement: DataFrame, shards: list[str]) -> DataFrame:
    """(range_id, shard, here, best): pairs that the copies of each range make with other ranges' on its own shard, and the
    shard (n, to) where they would make fewest. A key adds one row for each range and shard that it is on, never pairs of ranges."""
    now = keys.join(placement, "range_id")
    on = now.groupBy("k", F.col("shard").alias("to")).agg(F.sum("m").alias("c"))
    met = now.join(on, "k").withColumn("n", F.col("m") * (F.col("c") - F.when(F.col("to") == F.col("shard"), F.col("m")).otherwise(0)))
    per = met.groupBy("range_id", "shard", "to").agg(F.sum("n").alias("n"))
    per = per.groupBy("range_id", "shard").agg(F.map_from_entries(F.collect_list(F.struct("to", "n"))).alias("at"))  # a shard an entry
    n = lambda s: F.coalesce(F.try_element_at("at", s), F.lit(0))
    best = F.array_min(F.transform(F.array(*map(F.lit, shards)), lambda s: F.struct(n(s).alias("n"), s.alias("to"))))
    return per.select("range_id", "shard", n(F.col("shard")).alias("here"), best.alias("best"))


def conflict_pairs(keys: DataFrame, placement: DataFrame) -> DataFrame:
    """One row, ``pairs``: how many pairs of copies of a key are on one shard."""
    c = keys.join(placement, "range_id").groupBy("k", "shard").agg(F.sum("m").alias("c"))
    return c.agg(F.coalesce(F.sum(F.expr("c * (c - 1) div 2")), F.lit(0)).cast("long").alias("pairs"))


def resolved(placed: DataFrame, shards: list[str], most: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shards for the ranges of ``placed`` (k, range_id, shard) so that fewer keys have two copies on one shard.

    Returns the keys (k, range_id, m copies), the placement before and the one found, both (range_id, shard). Each round scores
    all ranges and moves every one that gains and gains most among the ranges that it shares a key with: such moves do
    not touch each other's keys, so their gains add up, the pairs left fall in each round, no placement comes again, and the search ends where
    no single move gains. A placement is a stored table; what reaches the driver is the number of moves of a round.
    """
    keys = stored(placed.groupBy("k", "range_id").agg(F.count(F.lit(1)).alias("m")), "keys")
    twice = keys.groupBy("k").agg(F.sum("m").alias("c")).where("c > 1").select(F.col("k").alias("_k"))
    keys = stored(keys.join(twice, F.col("k") == F.col("_k"), "left_semi"), "keys")
    start = stored(placed.groupBy("range_id").agg(F.min("shard").alias("shard")), "placement")
    now = start
    for _ in range(most):
        s = scores(keys, now, shards)
        gains = stored(s.select("range_id", (F.col("here") - F.col("best.n")).alias("gain"), F.col("best.to").alias("to")).where("gain > 0"), "gains")
        here = keys.join(gains, "range_id").select("k", "range_id", F.struct("gain", (-F.col("range_id")).alias("id")).alias("claim"))
        top = here.groupBy("k").agg(F.max("claim").alias("top"))
        free = here.join(top, "k").groupBy("range_id").agg(F.min(F.col("claim") == F.col("top")).alias("free")).where("free").select("range_id")
        moves = stored(gains.join(free, "range_id", "left_semi").select("range_id", "to"), "moves")
        if moves.isEmpty():
            break
        now = stored(now.join(moves, "range_id", "left").select("range_id", F.coalesce("to", "shard").alias("shard")), "placement")
    return keys, start, now
