"""Comparing by a tree of hashes, finding ranges among very many, and planning splits from true sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import diff, merkle, ranges
from tidemark.plans.base import query
from tidemark.plans.diff_queries import pair
from tidemark.sources import derived as d
from tidemark.sources.tables import load


def nulled(spark, sf):
    """The pair of copies with one null key on each side: its rows differ."""
    s, t = pair(spark, sf)
    lost = lambda x, k: x.withColumn("k", F.when(F.col("k") != k, F.col("k")))
    return lost(s, 5), lost(t, 7)


NULLED = """WITH a AS (SELECT nullif(k, 5) AS k, h FROM hsrc), b AS (SELECT nullif(k, 7) AS k, h FROM hdst),
    f AS (SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.h IS NULL THEN 'dest_only' WHEN b.h IS NULL THEN 'source_only' WHEN a.h = b.h THEN 'match' ELSE 'mismatch' END AS status FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k)"""


@query(f"""{NULLED} SELECT 'full' AS how, k, status FROM f UNION ALL SELECT 'ids', k, status FROM f WHERE status LIKE '%only'
    UNION ALL SELECT 'changed', k, status FROM f WHERE k % 10 = 0 OR k IS NULL UNION ALL SELECT 'again', k, 'stay' FROM f WHERE status <> 'match'""")
def diff_null_keys(spark, sf):
    """A null key equals a null key in each comparison: full, by id, of changed keys and of failed ones compared again."""
    s, t = nulled(spark, sf)
    full = diff.full_diff(s, t).select("k", "status")
    changed = diff.changed_diff(s, t, s.where("k % 10 = 0 or k is null").select("k").unionByName(t.where("k % 10 = 0").select("k")))
    again = diff.recheck(full.where("status <> 'match'").withColumn("ns", F.lit("db.orders")), s, t).select("k", F.col("outcome").alias("status"))
    named = [x.select(F.lit(n).alias("how"), "k", "status") for n, x in (("full", full), ("ids", diff.id_diff(s, t)), ("changed", changed), ("again", again))]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


# --- trees of hashes ---


@query("SELECT k, status FROM diffed WHERE status <> 'match'")
def merkle_diff(spark, sf):
    """Rows that differ, found through a tree of hashes over key ranges."""
    s, t = pair(spark, sf)
    return merkle.tree_diff(s, t, fanout=16, leaf_rows=64)[0]


@query("""WITH e AS (SELECT min(k) AS lo, max(k) - min(k) + 1 AS span, greatest(1, count(*) // 2) AS n FROM (SELECT k FROM src UNION ALL SELECT k FROM dst)),
    w AS (SELECT lo, greatest(1, 64 * span // n) AS leaf, span FROM e), l AS (SELECT lo, CAST(leaf * 16 ** i AS BIGINT) AS width, i FROM w, (SELECT unnest(range(12)) AS i) WHERE leaf * 16 ** i < span),
    x AS (SELECT l.i, (d.k - lo) // width AS node, count(*) FILTER (status <> 'dest_only') AS source_rows, count(*) FILTER (status <> 'source_only') AS dest_rows, bool_or(status <> 'match') AS differs FROM diffed d, l GROUP BY ALL)
    SELECT CAST((SELECT max(i) FROM l) - i AS INTEGER) AS level, CAST(node AS BIGINT) AS node, source_rows, dest_rows FROM x WHERE differs""")
def merkle_nodes(spark, sf):
    """The nodes that were opened, by level: only those with rows that differ."""
    s, t = pair(spark, sf)
    return merkle.tree_diff(s, t, fanout=16, leaf_rows=64)[1]


# --- floor joins ---


def many_ranges(spark, sf):
    """Two ranges of very different width for each row of lineitem, gaps between them, and an open one above all."""
    lo = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000
    one = load(spark, sf, "lineitem").select(lo.alias("lo"))
    pieces = F.array(F.struct(F.col("lo"), (F.col("lo") + 3).alias("hi")), F.struct((F.col("lo") + 3).alias("lo"), (F.col("lo") + 900).alias("hi")))
    top = one.agg((F.max("lo") + 1000).alias("lo")).select("lo", F.lit(None).cast("long").alias("hi"))
    return one.select(F.explode(pieces).alias("p")).select("p.*").unionByName(top)


@query("""WITH l AS (SELECT (l_orderkey * 8 + l_linenumber) * 1000 AS lo FROM lineitem), r AS (SELECT lo, lo + 3 AS hi FROM l UNION ALL SELECT lo + 3, lo + 900 FROM l UNION ALL SELECT max(lo) + 1000, NULL FROM l),
    p AS (SELECT l_partkey * 7919 * 1000 % (SELECT max(lo) * 11 // 10 FROM l) + l_suppkey AS key FROM lineitem)
    SELECT r.lo, r.hi, CAST(count(*) AS BIGINT) AS n, CAST(sum(p.key - r.lo) AS BIGINT) AS past FROM p ASOF JOIN r ON p.key >= r.lo WHERE r.hi IS NULL OR p.key < r.hi GROUP BY ALL""")
def floor_join_many(spark, sf):
    """Keys found among more ranges than rows: bins of equal depth, binary search in a bin."""
    r = many_ranges(spark, sf)
    most = r.agg(F.max("lo").alias("top"))  # a thousand above the last closed range
    key = (F.col("l_partkey") * 7919 * 1000 % (((F.col("top") - 1000) * 11 / 10).cast("long")) + F.col("l_suppkey")).alias("key")
    rows = load(spark, sf, "lineitem").join(F.broadcast(most)).select(key)
    return ranges.floor_join(rows, "key", r, few=False).groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("key") - F.col("lo")).alias("past"))


# --- bounds ---


@query("SELECT CAST(tile AS INTEGER) AS tile, min(k) AS lo, max(k) AS hi, CAST(count(*) AS BIGINT) AS n FROM (SELECT k, ntile(12) OVER (ORDER BY k) AS tile FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 4000 ELSE l_suppkey * 37 END AS k FROM lineitem)) GROUP BY tile")
def equal_depth_hot(spark, sf):
    """Bounds of equal shares where one key has a third of all rows and lies in several shares."""
    k = F.when(F.col("l_orderkey") % 3 == 0, F.lit(4000).cast("long")).otherwise(F.col("l_suppkey") * 37)
    return ranges.equal_depth_bounds(load(spark, sf, "lineitem").select(k.alias("k")), "k", 12)


@query("SELECT CAST(i AS INTEGER) AS bound_no, true AS within FROM (SELECT unnest(range(1, 16)) AS i)")
def sketch_bounds(spark, sf):
    """Whether the rank of each bound from sketches is within the stated error of its place: the bounds are held against all rows."""
    x, n, error = load(spark, sf, "lineitem").select((F.col("l_partkey") * 7919 % 100_003).alias("k")), 16, 1e-3
    bounds = ranges.sketched_bounds(x, "k", n, error).collect()  # n - 1 rows
    ranks = x.agg(F.count(F.lit(1)).alias("rows"), F.array(*[F.struct(F.lit(b["bound_no"]).alias("bound_no"), F.count_if(F.col("k") < b["bound"]).alias("less"), F.count_if(F.col("k") <= b["bound"]).alias("upto")) for b in bounds]).alias("b"))
    y = ranks.select("rows", F.explode("b").alias("b")).select("rows", "b.*")
    place, slack = F.col("rows") * F.col("bound_no") / n, F.col("rows") * error + 1
    return y.select("bound_no", ((F.col("less") <= place + slack) & (F.col("upto") >= place - slack)).alias("within"))


# --- conflicts ---


@query("SELECT CAST(coalesce(sum(c * (c - 1) // 2), 0) AS BIGINT) AS pairs_before, true AS fewer_or_equal, CAST(0 AS BIGINT) AS moves_left FROM (SELECT k, shard, count(*) AS c FROM dupx WHERE k IN (SELECT k FROM dup_ids) GROUP BY ALL)")
def resolve_conflicts(spark, sf):
    """Pairs of copies on one shard before ranges are moved, whether there are no more of them after, and moves of one range that would still gain."""
    from tidemark.operators import dupes
    from tidemark.plans.range_queries import dup_placed

    x = dup_placed(spark, sf)
    shards = [r["shard"] for r in d.ranges(spark, sf).select("shard").distinct().orderBy("shard").collect()]
    keys, start, found = dupes.resolved(x.select("k", "range_id", "shard"), shards)
    left = dupes.scores(keys, found, shards).agg(F.count_if(F.col("best.n") < F.col("here")).alias("moves_left"))
    one = dupes.conflict_pairs(keys, start).select(F.col("pairs").alias("pairs_before")).join(dupes.conflict_pairs(keys, found)).join(left)  # three rows of sums
    return one.select("pairs_before", (F.col("pairs") <= F.col("pairs_before")).alias("fewer_or_equal"), "moves_left")


@query()
def resolved_ranges(spark, sf):
    """The shard of each range before and after."""
    from tidemark.operators import dupes
    from tidemark.plans.range_queries import dup_placed

    shards = [r["shard"] for r in d.ranges(spark, sf).select("shard").distinct().orderBy("shard").collect()]
    _, start, found = dupes.resolved(dup_placed(spark, sf).select("k", "range_id", "shard"), shards)
    return start.join(found.withColumnRenamed("shard", "to"), "range_id")


# --- rounds of a stream ---

START = "(SELECT date_trunc('second', min(ts) + (max(ts) - min(ts)) / 4) FROM log)"


@query(f"""SELECT shard, ns, to_timestamp(epoch_us(ts) // 1000000 // 21600 * 21600) AT TIME ZONE 'UTC' AS round_start, CAST(count(*) AS BIGINT) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM log
    WHERE op <> 'n' AND ts > {START} GROUP BY ALL HAVING epoch_ms(min(ts)) // 1000 // 21600 * 21600 + 21600 < (SELECT epoch_us(max(ts)) / 1e6 - 600 FROM log WHERE op <> 'n')""")
def stream_rounds(spark, sf):
    """Rounds of six hours of a stream that starts at a time; rounds that are still open at its end are not written."""
    from tidemark.plans.misc_queries import log_stream
    from tidemark.streaming import streams

    ends = d.change_log(spark, sf).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    at = ends.select(F.date_trunc("second", F.timestamp_micros(F.expr("unix_micros(cast(a as timestamp)) + (unix_micros(cast(b as timestamp)) - unix_micros(cast(a as timestamp))) div 4"))).cast("timestamp_ntz").alias("t")).first()["t"]
    x = streams.since(log_stream(spark, sf).where("op <> 'n'"), at)
    return streams.run_once(streams.rounds(x, 360)).withColumn("round_start", F.col("round_start").cast("timestamp_ntz"))
