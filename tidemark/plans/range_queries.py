"""Change logs, load of ranges, duplicates and range planning."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import bucket5_ceil
from tidemark.operators import balance, dupes, ranges
from tidemark.operators.small import small
from tidemark.plans.base import query
from tidemark.sources import derived as d
from tidemark.sources.tables import in_range, load


def kept_log(spark, sf):
    """Without no-ops, migrations and internal namespaces."""
    return d.change_log(spark, sf).where((F.col("op") != "n") & ~F.col("from_migrate") & ~F.col("ns").startswith("config.") & ~F.col("ns").startswith("admin."))


def activity(spark, sf):
    x = ranges.floor_join(kept_log(spark, sf).drop("shard"), "id", d.user_ranges(spark).withColumnRenamed("id", "range_id"))
    return x.groupBy("ns", "range_id", "shard").agg(F.count(F.lit(1)).alias("cnt"))


# --- change log ---


@query("SELECT seq, ts, id, op, ns, size FROM kept_log")
def log_filter(spark, sf):
    return kept_log(spark, sf).select("seq", "ts", "id", "op", "ns", "size")


@query("SELECT event_id AS seq, date_trunc('minute', ts) + to_minutes((65 - minute(ts)) % 5) AS bucket FROM events")
def bucket5_ceil_(spark, sf):
    return load(spark, sf, "events").select(F.col("event_id").alias("seq"), bucket5_ceil("ts").alias("bucket"))


@query("""SELECT date_trunc('minute', ts) + to_minutes((65 - minute(ts)) % 5) AS bucket, shard, ns, op, CAST(count(*) AS BIGINT) AS count, min(size) AS min_size, max(size) AS max_size, CAST(sum(size) AS BIGINT) AS total_size,
    CAST(sum(size) AS BIGINT) // count(*) AS avg_size FROM log WHERE op <> 'n' AND ns NOT LIKE 'config.%' GROUP BY ALL""")
def oplog_stats(spark, sf):
    x = d.change_log(spark, sf).where((F.col("op") != "n") & ~F.col("ns").startswith("config."))
    g = x.groupBy(bucket5_ceil("ts").alias("bucket"), "shard", "ns", "op").agg(F.count(F.lit(1)).alias("count"), F.min("size").alias("min_size"), F.max("size").alias("max_size"), F.sum("size").alias("total_size"))
    return g.withColumn("avg_size", F.expr("total_size div count"))


@query("""SELECT id, op AS last_op, value FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM log WHERE op IN ('i', 'u', 'd') AND ns NOT LIKE 'config.%' AND ns NOT LIKE 'admin.%') WHERE rn = 1 AND op <> 'd'""")
def log_compact(spark, sf):
    """Last operation per id; deletions remove. ``max_by`` combines before the shuffle."""
    x = d.change_log(spark, sf).where(F.col("op").isin("i", "u", "d") & ~F.col("ns").startswith("config.") & ~F.col("ns").startswith("admin."))
    last = x.groupBy("id").agg(F.max_by(F.struct("op", "value"), F.struct("ts", "seq")).alias("x"))
    return last.select("id", F.col("x.op").alias("last_op"), F.col("x.value").alias("value")).where("last_op <> 'd'")


@query("SELECT shard, max(ts) AS ts, arg_max(seq, (ts, seq)) AS seq FROM log WHERE op <> 'n' GROUP BY shard")
def latest_event(spark, sf):
    return d.change_log(spark, sf).where("op <> 'n'").groupBy("shard").agg(F.max("ts").alias("ts"), F.max_by("seq", F.struct("ts", "seq")).alias("seq"))


@query("SELECT count(*) AS events, round(count(*) / (epoch(max(ts)) - epoch(min(ts))), 6) AS per_second FROM log")
def event_rate(spark, sf):
    e = lambda x: F.unix_micros(x.cast("timestamp")) / 1e6
    return d.change_log(spark, sf).agg(F.count(F.lit(1)).alias("events"), F.round(F.count(F.lit(1)) / (e(F.max("ts")) - e(F.min("ts"))), 6).alias("per_second"))


# --- load of ranges ---


@query("SELECT r.id, r.lo, r.shard, CAST(count(*) AS BIGINT) AS n FROM log l JOIN uranges r ON l.id >= r.lo AND (r.hi IS NULL OR l.id < r.hi) GROUP BY ALL")
def floor_join(spark, sf):
    x = ranges.floor_join(d.change_log(spark, sf).select(F.col("id").alias("key")), "key", d.user_ranges(spark))
    return x.groupBy("id", "lo", "shard").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT r.id, CAST(count(*) AS BIGINT) AS n FROM orders o JOIN ranges r ON o.o_orderkey >= r.lo AND (r.hi IS NULL OR o.o_orderkey < r.hi) GROUP BY ALL")
def floor_join_binned(spark, sf):
    """The form for many ranges: both sides are equi-joined on bins of the key."""
    x = ranges.floor_join(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", d.ranges(spark, sf), few=False)
    return x.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM load")
def shard_load(spark, sf):
    return balance.shard_load(activity(spark, sf))


@query("SELECT ns, CAST(sum(total_ops) AS BIGINT) AS total_ops, max(total_ops) - min(total_ops) AS delta_ops FROM load GROUP BY ns")
def ns_skew(spark, sf):
    return balance.ns_skew(balance.shard_load(activity(spark, sf)))


def targets(spark, sf):
    return balance.shard_targets(balance.shard_load(activity(spark, sf)), d.user_ranges(spark), active=1)


@query("SELECT * FROM targets")
def shard_targets(spark, sf):
    return targets(spark, sf)


@query("""SELECT ns, arg_max(shard, (total_ops, shard)) AS hottest, arg_min(shard, (total_ops, shard)) AS coldest FROM targets GROUP BY ns""")
def hot_cold(spark, sf):
    key = F.struct("total_ops", "shard")
    return targets(spark, sf).groupBy("ns").agg(F.max_by("shard", key).alias("hottest"), F.min_by("shard", key).alias("coldest"))


@query("""SELECT ns, range_id, shard, cnt, prev FROM (SELECT *, CAST(coalesce(sum(cnt) OVER (PARTITION BY ns ORDER BY cnt DESC, range_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prev,
    row_number() OVER (PARTITION BY ns ORDER BY cnt DESC, range_id) AS rn FROM activity) WHERE prev < 100 OR rn = 1""")
def hot_chunks(spark, sf):
    return balance.hot_ranges(activity(spark, sf), 100)


@query("""SELECT a.ns, a.rn AS pair_no, a.shard AS from_shard, b.shard AS to_shard FROM
    (SELECT *, CAST(row_number() OVER (PARTITION BY ns ORDER BY total_ops DESC, shard) AS INTEGER) AS rn, sum(above::INT) OVER (PARTITION BY ns) AS n FROM targets) a
    JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY ns ORDER BY total_ops, shard DESC) AS INTEGER) AS rn FROM targets) b ON a.ns = b.ns AND a.rn = b.rn
    WHERE a.above AND NOT (NOT b.above AND b.total_ops > 0) AND a.shard <> b.shard AND a.rn <= least(2, a.n)""")
def move_pairs(spark, sf):
    return balance.move_pairs(targets(spark, sf))


def marked_activity(spark, sf):
    """Load of ranges with the minutes since each was moved (null: never) and whether it is marked as balanced."""
    i = F.col("range_id")
    return activity(spark, sf).withColumn("minutes_since_move", F.when(i % 3 != 0, i * 37 % 120)).withColumn("balanced", F.when(i == 1, True).when(i % 2 == 0, False))


@query("""WITH x AS (SELECT a.ns, p.pair_no, a.range_id, a.shard AS from_shard, p.to_shard, a.cnt, CAST(floor(0.33::DOUBLE * CASE WHEN abs(f.delta_ops) < abs(t.delta_ops) THEN f.delta_ops ELSE t.delta_ops END + 0.5) AS BIGINT) AS target
      FROM pairs p JOIN targets f ON f.ns = p.ns AND f.shard = p.from_shard JOIN targets t ON t.ns = p.ns AND t.shard = p.to_shard JOIN activity a ON a.ns = p.ns AND a.shard = p.from_shard
      WHERE (a.range_id % 3 = 0 OR a.range_id * 37 % 120 > 60) AND a.range_id <> 1)
    SELECT ns, pair_no, range_id, from_shard, to_shard, cnt, target FROM (SELECT *, coalesce(sum(cnt) OVER w, 0) AS prev, row_number() OVER (PARTITION BY ns, pair_no ORDER BY cnt DESC, range_id) AS rn FROM x
      WINDOW w AS (PARTITION BY ns, pair_no ORDER BY cnt DESC, range_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE prev < target OR rn = 1""")
def planned_moves(spark, sf):
    """What to move between hot and cold shards; ranges just moved or marked as balanced stay."""
    return balance.planned_moves(marked_activity(spark, sf), targets(spark, sf))


@query("""SELECT a.ns, a.shard, array_to_string(list(a.range_id || ':' || (a.range_id = 1 OR m.range_id IS NOT NULL) ORDER BY a.range_id), ',') AS chunks FROM activity a
    LEFT JOIN (SELECT ns, shard, range_id FROM activity QUALIFY row_number() OVER (PARTITION BY ns, shard ORDER BY cnt DESC, range_id) = 1) m USING (ns, shard, range_id) GROUP BY a.ns, a.shard""")
def mark_moved(spark, sf):
    """The hottest range of each shard is marked as balanced inside the checkpoint's array; other marks stay."""
    x = marked_activity(spark, sf)
    top = x.groupBy("ns", "shard").agg(F.array(F.max_by("range_id", F.struct("cnt", -F.col("range_id")))).alias("ids"))
    arrays = x.groupBy("ns", "shard").agg(F.array_sort(F.collect_list(F.struct(F.col("range_id").alias("id"), "cnt", "balanced"))).alias("chunks"))
    done = balance.mark_balanced(arrays.join(top, ["ns", "shard"]), "ids")
    return done.select("ns", "shard", F.array_join(F.transform("chunks", lambda c: F.concat_ws(":", c["id"], F.coalesce(c["balanced"], F.lit(False)))), ",").alias("chunks"))


@query("""SELECT CAST((epoch_us(ts) // 86400000000) % 3 AS BIGINT) AS round, shard, CAST(count(*) AS BIGINT) AS ops FROM log WHERE op <> 'n' GROUP BY 1, 2""")
def activity_rounds(spark, sf):
    """Operations by shard in each of three rounds; counters start at zero in every round."""
    day = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400)
    return d.change_log(spark, sf).where("op <> 'n'").groupBy((day % 3).alias("round"), "shard").agg(F.count(F.lit(1)).alias("ops"))


@query("""SELECT ns, shard, CAST(sum(cnt) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS active_chunks, array_to_string(list(range_id || ':' || cnt ORDER BY range_id), ',') AS chunks FROM activity GROUP BY ns, shard""")
def chunk_checkpoint(spark, sf):
    g = activity(spark, sf).groupBy("ns", "shard").agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("active_chunks"), F.array_sort(F.collect_list(F.struct("range_id", "cnt"))).alias("c"))
    return g.select("ns", "shard", "total", "active_chunks", F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["range_id"], x["cnt"])), ",").alias("chunks"))


@query("SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (jumbo) AS BIGINT) AS jumbo, CAST(count(*) FILTER (NOT jumbo AND id % 5 = 4) AS BIGINT) AS no_balance, CAST(count(*) FILTER (NOT jumbo AND id % 5 <> 4) AS BIGINT) AS kept FROM ranges")
def chunk_filter_counts(spark, sf):
    off = F.col("id") % 5 == 4
    return d.ranges(spark, sf).agg(F.count(F.lit(1)).alias("total"), F.count_if("jumbo").alias("jumbo"), F.count_if(~F.col("jumbo") & off).alias("no_balance"), F.count_if(~F.col("jumbo") & ~off).alias("kept"))


# --- duplicates ---


@query("SELECT k AS id, copies FROM dup_ids")
def dupe_ids(spark, sf):
    return dupes.duplicate_ids(d.duplicated(spark, sf), "k").withColumnRenamed("k", "id")


@query("SELECT CAST(count(*) AS BIGINT) AS total_docs, CAST(count(DISTINCT k) FILTER (n > 1) AS BIGINT) AS dupe_ids, CAST(count(*) FILTER (n > 1) AS BIGINT) AS dupe_docs FROM (SELECT k, count(*) OVER (PARTITION BY k) AS n FROM dup)")
def dupe_summary(spark, sf):
    return dupes.summary(d.duplicated(spark, sf), "k")


@query("SELECT * FROM archive")
def dupe_archive(spark, sf):
    return dupes.archive(d.duplicated(spark, sf), "k", "cents", "part").select("k", "copy_no", "cust", "status", "cents")


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'first_only' WHEN a.k IS NULL THEN 'second_only' ELSE 'paired' END AS state, a.cents AS first_cents, b.cents AS second_cents
    FROM (SELECT * FROM archive WHERE copy_no = 1 AND k % 7 <> 0) a FULL JOIN (SELECT * FROM archive WHERE copy_no = 2 AND k % 11 <> 0) b ON a.k = b.k""")
def paired_archives(spark, sf):
    """The first and second copies of duplicated keys side by side; each archive has lost some keys."""
    x = dupes.archive(d.duplicated(spark, sf), "k", "cents", "part").where("not (copy_no = 1 and k % 7 = 0) and not (copy_no = 2 and k % 11 = 0)")
    return dupes.paired(x, "k", "cents")


@query("SELECT k, l FROM (SELECT l_orderkey AS k, l_linenumber AS l, lag(l_orderkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem) WHERE p = k")
def dupe_lag(spark, sf):
    """Rows whose key repeats the one before in key order."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return load(spark, sf, "lineitem").withColumn("p", F.lag("l_orderkey").over(w)).where("p = l_orderkey").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("l"))


@query("""SELECT k AS id, CAST(count(*) AS BIGINT) AS src_count, count(*) > 1 AS is_dup FROM dup WHERE NOT (part = 2 AND k % 100 = 0) AND k IN (SELECT k FROM archive) GROUP BY k""")
def dupe_recheck(spark, sf):
    """Some copies have been removed from the source since the archive was made."""
    x = d.duplicated(spark, sf)
    return dupes.recheck(dupes.archive(x, "k", "cents", "part"), x.where("not (part = 2 and k % 100 = 0)"), "k").withColumnRenamed("k", "id")


@query("SELECT k, part, cents FROM dup WHERE k NOT IN (SELECT k FROM dup_ids)")
def delete_dupes(spark, sf):
    x = d.duplicated(spark, sf)
    return dupes.delete(x, dupes.duplicate_ids(x, "k"), "k").select("k", "part", "cents")


@query("""SELECT k, cents, 'kept' AS origin FROM dup WHERE k NOT IN (SELECT k FROM dup_ids) OR k % 3 = 0 UNION ALL
    SELECT k, cents, CASE WHEN k % 3 <> 0 AND copy_no = 1 THEN 'restored' ELSE 'rejected' END FROM archive""")
def restore_insert(spark, sf):
    """Archived rows go back where their key is free; both outcomes in one result."""
    x = d.duplicated(spark, sf).select("k", "cents", "part")
    gone = dupes.duplicate_ids(x, "k").where("k % 3 <> 0")
    base = dupes.delete(x, gone, "k").select("k", "cents")
    back = dupes.archive(x, "k", "cents", "part").select("k", "cents")
    whole, rejected = dupes.restore(base.withColumn("origin", F.lit("kept")), back.withColumn("origin", F.lit("restored")), "k")
    return whole.unionByName(rejected.withColumn("origin", F.lit("rejected")))


def placed(spark, sf):
    """Each copy with the range that holds it; second copies stand elsewhere."""
    x = d.duplicated(spark, sf)
    top = load(spark, sf, "orders").agg((F.max("o_orderkey") + 1).alias("m"))
    x = x.join(F.broadcast(top)).withColumn("place", F.when(F.col("part") == 2, F.col("k") * 7 % F.col("m")).otherwise(F.col("k"))).select("k", "part", "place")
    return ranges.floor_join(x, "place", d.ranges(spark, sf).select(F.col("id").alias("range_id"), "lo", "hi", "shard")).select("k", "part", "range_id", "shard")


def dup_placed(spark, sf):
    x = placed(spark, sf)
    return x.join(dupes.duplicate_ids(d.duplicated(spark, sf), "k").select("k"), "k", "left_semi")


@query("SELECT k AS id, shard, n FROM conf")
def dupe_conflicts(spark, sf):
    return dupes.conflicts(dup_placed(spark, sf), "k").withColumnRenamed("k", "id")


@query("SELECT shard, CAST(count(*) AS BIGINT) AS ids, CAST(sum(n) AS BIGINT) AS docs FROM conf GROUP BY shard")
def conflicts_by_shard(spark, sf):
    return dupes.conflicts(dup_placed(spark, sf), "k").groupBy("shard").agg(F.count(F.lit(1)).alias("ids"), F.sum("n").alias("docs"))


IMPACT = "SELECT x.range_id, x.shard, CAST(count(*) AS BIGINT) AS score FROM dupx x JOIN conf c ON x.k = c.k AND x.shard = c.shard GROUP BY ALL ORDER BY score DESC, range_id LIMIT 5"


@query(IMPACT)
def impact_top5(spark, sf):
    x = dup_placed(spark, sf)
    return x.join(dupes.conflicts(x, "k").select("k", "shard"), ["k", "shard"]).groupBy("range_id", "shard").agg(F.count(F.lit(1)).alias("score")).orderBy(F.desc("score"), "range_id").limit(5)


@query("""WITH here AS (SELECT x.k, x.range_id, x.shard, count(*) AS in_range FROM dupx x JOIN conf c ON x.k = c.k AND x.shard = c.shard GROUP BY ALL),
    there AS (SELECT k, shard, count(*) AS n FROM dupx WHERE k IN (SELECT k FROM dup_ids) GROUP BY ALL),
    scores AS (SELECT h.range_id AS chunk, s.shard, CAST(sum(CASE WHEN t.n IS NULL THEN 100 WHEN h.in_range > 1 THEN -50 WHEN t.n > 1 THEN -100 ELSE -25 END) AS BIGINT) AS score
      FROM here h JOIN (SELECT DISTINCT shard FROM ranges) s ON s.shard <> h.shard LEFT JOIN there t ON t.k = h.k AND t.shard = s.shard GROUP BY ALL)
    SELECT chunk, shard, score FROM (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY score DESC, shard) AS rn FROM scores) WHERE rn = 1""")
def best_target(spark, sf):
    """The shard with the best summed score for each range with conflicts; shards are few and broadcast."""
    x = dup_placed(spark, sf)
    here = x.join(dupes.conflicts(x, "k").select("k", "shard"), ["k", "shard"]).groupBy("k", "range_id", "shard").agg(F.count(F.lit(1)).alias("in_range"))
    there = x.groupBy("k", F.col("shard").alias("to")).agg(F.count(F.lit(1)).alias("n"))
    shards = d.ranges(spark, sf).select(F.col("shard").alias("to")).distinct()
    y = here.join(small(shards), F.col("to") != F.col("shard")).join(there, ["k", "to"], "left")
    score = F.when(F.col("n").isNull(), 100).when(F.col("in_range") > 1, -50).when(F.col("n") > 1, -100).otherwise(-25)
    s = y.groupBy("range_id", "to").agg(F.sum(score).alias("score"))
    best = s.groupBy("range_id").agg(F.min_by(F.struct("to", "score"), F.struct(-F.col("score"), F.col("to"))).alias("b"))
    return best.select(F.col("range_id").alias("chunk"), F.col("b.to").alias("shard"), F.col("b.score").alias("score"))


@query("""SELECT ns, k AS split_point FROM (SELECT c.shard AS ns, c.k, row_number() OVER (PARTITION BY c.shard ORDER BY c.k) - 1 AS i, count(*) OVER (PARTITION BY c.shard) AS n FROM conf c) WHERE i > 0 AND n > 1 AND i % greatest(1, n // 3) = 0""")
def split_points(spark, sf):
    """Every third of the sorted conflicting keys of a shard; ranks come from counts of parts."""
    x = ranges.ranked(dupes.conflicts(dup_placed(spark, sf), "k"), "k", "shard").withColumn("i", F.col("r") - 1)
    return x.where("i > 0 and total > 1 and i % greatest(1, total div 3) = 0").select(F.col("shard").alias("ns"), F.col("k").alias("split_point"))


# --- ranges ---


@query("""SELECT ns, grp, any_value(shard) AS shard, min(lo) AS lo, arg_max(coalesce(hi, -1), lo) AS hi, array_to_string(list(CAST(lo AS VARCHAR) ORDER BY lo)[2:], ',') AS mids, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT *, CAST(sum(new) OVER (PARTITION BY ns ORDER BY lo) AS BIGINT) AS grp FROM (SELECT *, CASE WHEN lag(shard) OVER (PARTITION BY ns ORDER BY lo) IS NOT DISTINCT FROM shard THEN 0 ELSE 1 END AS new FROM ranges)) GROUP BY ns, grp""")
def megachunks(spark, sf):
    m = ranges.merge_runs(d.ranges(spark, sf))
    return m.withColumn("hi", F.coalesce("hi", F.lit(-1))).withColumn("mids", F.array_join(F.col("mids").cast("array<string>"), ","))


@query("SELECT CAST(tile AS INTEGER) AS tile, min(k) AS lo, max(k) AS hi, CAST(count(*) AS BIGINT) AS n FROM (SELECT o_orderkey AS k, ntile(10) OVER (ORDER BY o_orderkey) AS tile FROM orders) GROUP BY tile")
def equi_depth_bounds(spark, sf):
    return ranges.equal_depth_bounds(load(spark, sf, "orders"), "o_orderkey", 10)


def sized(spark, sf):
    """Documents by their key and true bytes."""
    return load(spark, sf, "documents").select(F.col("doc_id").alias("k"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))


@query("""WITH total AS (SELECT count(*) AS docs, CASE WHEN count(*) < 101 THEN 1 ELSE CAST(sum(coalesce(strlen(text), 0)) // 65536 + 1 AS BIGINT) END AS n FROM documents)
    SELECT CAST(tile - 1 AS INTEGER) AS part_no, lo, lead(lo) OVER (ORDER BY tile) AS hi, CAST((SELECT docs // n FROM total) AS BIGINT) AS est_docs FROM
    (SELECT tile, min(k) AS lo FROM (SELECT doc_id AS k, ntile((SELECT CAST(n AS BIGINT) FROM total)) OVER (ORDER BY doc_id) AS tile FROM documents) GROUP BY tile)""")
def partition_plan(spark, sf):
    """Partitions of 64 kilobytes: their number follows from the documents' true bytes, which one job adds up while the plan is built, their bounds from the keys."""
    x = sized(spark, sf)
    n = x.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("docs")).select(ranges.partition_count(F.col("size"), F.col("docs"), 1 << 16).alias("n")).first()["n"]
    return ranges.partition_plan(ranges.equal_depth_bounds(x, "k", n))


@query("""SELECT o_orderkey AS k FROM orders QUALIFY row_number() OVER (ORDER BY md5('sample|' || o_orderkey), o_orderkey) <= (SELECT CASE WHEN count(*) < 100000 THEN CAST(floor(count(*) * 0.01 + 0.5) AS BIGINT) ELSE 25000 END FROM orders)""")
def sample_n(spark, sf):
    """As many random keys as a table of this size needs for bounds, the same on every run."""
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    n = o.agg(F.count(F.lit(1)).alias("n")).select(ranges.sample_size(F.col("n")).alias("n")).first()["n"]  # from footers
    return ranges.sampled(o, "k", n)


@query("SELECT lo, hi FROM (SELECT lag(b) OVER (ORDER BY b) AS lo, b AS hi FROM (SELECT lo AS b FROM ranges) UNION ALL SELECT max(lo), NULL FROM ranges)")
def range_pairs(spark, sf):
    return ranges.neighbours(d.ranges(spark, sf).select(F.col("lo").alias("b")), "b")


@query("SELECT p_partkey AS id, CAST((row_number() OVER (ORDER BY p_partkey) - 1) // (SELECT CASE WHEN count(*) >= 1000 THEN 300 ELSE 100 END FROM part) + 1 AS BIGINT) AS uber_id FROM part")
def uber_id(spark, sf):
    """Numbers that neighbouring ranges share: a hundred each, or three hundred from a thousand ranges on."""
    return ranges.uber_ids(load(spark, sf, "part").select(F.col("p_partkey").alias("id")), "id")


@query("SELECT id, 'target' || (id % 5) AS target FROM (SELECT row_number() OVER (ORDER BY lo) - 1 AS rn, id FROM ranges)")
def round_robin_map(spark, sf):
    """Ranges dealt to five targets in turn; ranges are few, so one window numbers them."""
    rn = F.row_number().over(Window.orderBy("lo")) - 1
    return d.ranges(spark, sf).select("id", F.concat(F.lit("target"), rn % 5).alias("target"))


@query("""WITH size AS (SELECT sum(coalesce(strlen(text), 0)) AS bytes FROM documents), split AS (SELECT CAST(CASE WHEN bytes // 3 // 10 >= 16793599 THEN 16793599 WHEN bytes // 3 // 10 < 16384 THEN 32768 ELSE bytes // 3 // 10 END AS BIGINT) AS s FROM size)
    SELECT k AS split_key, before AS bytes_before, s AS split_size FROM (SELECT *, lag(before) OVER (ORDER BY k) AS last FROM
      (SELECT doc_id AS k, CAST(sum(coalesce(strlen(text), 0)) OVER (ORDER BY doc_id) - coalesce(strlen(text), 0) AS BIGINT) AS before FROM documents)), split WHERE before // s > last // s""")
def split_vector(spark, sf):
    """Keys at which another split begins, from the true bytes of documents: a split is a tenth of a shard's share of the table, within bounds."""
    return ranges.split_keys(sized(spark, sf), "k", "bytes", 3, mega=1 << 14)


@query("SELECT user_id AS id, event_id AS seq, array_to_string(list(event_type || '@' || event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), ',') AS last3 FROM events")
def recent_moves(spark, sf):
    """The last three moves of each entity, oldest first."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 0)
    move = F.concat_ws("@", "event_type", "event_id")
    return load(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.array_join(F.collect_list(move).over(w), ",").alias("last3"))


# --- scans ---


@query("SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders")
def key_bounds(spark, sf):
    return load(spark, sf, "orders").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 900")
def scan_range(spark, sf):
    return load(spark, sf, "orders").where(in_range("o_orderkey", 100, 900)).select("o_orderkey", "o_totalprice")


@query("SELECT b FROM (SELECT min(o_orderkey) AS b FROM orders UNION SELECT max(o_orderkey) FROM orders UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 = 0)")
def union_bounds(spark, sf):
    """Least and greatest key and a sample of those between, as a sorted set."""
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("b"))
    ends = o.agg(F.array(F.min("b"), F.max("b")).alias("x")).select(F.explode("x").alias("b"))
    return ends.unionByName(o.where("b % 1000 = 0")).distinct()
