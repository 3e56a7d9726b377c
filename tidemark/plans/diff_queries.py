"""Comparing two copies: full, merge, lookup, id-only, mapped and change-driven diffs; status, recheck, resume."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import diff
from tidemark.plans.base import query
from tidemark.sources import derived as d

PAIR = ("k", "cust", "status", "cents", "day", "prio")


def pair(spark, sf):
    return diff.hashed(d.source(spark, sf), "k", *PAIR), diff.hashed(d.dest(spark, sf), "k", *PAIR)


@query("SELECT d.k, d.status, s.h AS src_hash, x.h AS dst_hash FROM diffed d LEFT JOIN hsrc s ON d.k = s.k LEFT JOIN hdst x ON d.k = x.k")
def diff_full(spark, sf):
    return diff.full_diff(*pair(spark, sf))


@query("SELECT k, status FROM diffed")
def diff_merge(spark, sf):
    """As a merge of two sorted sides, which is what the planner does with the join."""
    s, t = pair(spark, sf)
    return diff.full_diff(s.hint("merge"), t).select("k", "status")


@query("SELECT k, CASE status WHEN 'source_only' THEN 'missing' ELSE status END AS status FROM diffed WHERE status <> 'dest_only'")
def diff_query(spark, sf):
    return diff.lookup_diff(*pair(spark, sf))


@query("""SELECT k, 'source_only' AS status FROM src WHERE k NOT IN (SELECT k FROM dst) UNION ALL SELECT k, 'dest_only' FROM dst WHERE k NOT IN (SELECT k FROM src)""")
def diff_ids(spark, sf):
    return diff.id_diff(*pair(spark, sf))


@query("""SELECT t.ns AS dst_ns, s.k, CASE s.status WHEN 'source_only' THEN 'missing' ELSE s.status END AS status
    FROM (SELECT *, 'db' || (k % 3) || '.orders' AS ns FROM diffed WHERE status <> 'dest_only') s
    JOIN (VALUES ('db0.orders', 'new0.orders'), ('db1.orders', 'new1.orders'), ('db2.orders', 'db2.orders')) t(src, ns) ON s.ns = t.src""")
def mapped_diff(spark, sf):
    """Namespaces are renamed by a map of ``source|dest`` entries first; others keep their name."""
    s, t = pair(spark, sf)
    names = F.create_map(*[F.lit(x) for e in ("db0.orders|new0.orders", "db1.orders|new1.orders") for x in e.split("|")])
    ns = F.concat(F.lit("db"), F.col("k") % 3, F.lit(".orders"))
    return diff.lookup_diff(s, t).select(F.coalesce(F.try_element_at(names, ns), ns).alias("dst_ns"), "k", "status")


@query("""SELECT d.k, d.status FROM diffed d WHERE d.k IN (SELECT id * 100 FROM log WHERE op IN ('i', 'u', 'd'))""")
def diff_changed(spark, sf):
    ids = d.change_log(spark, sf).where(F.col("op").isin("i", "u", "d")).select((F.col("id") * 100).alias("k"))
    return diff.changed_diff(*pair(spark, sf), ids)


@query("""SELECT coalesce(s.k, x.k) AS k, CASE WHEN s.k IS NULL THEN 'dest_only' WHEN x.k IS NULL THEN 'source_only'
    WHEN s.cust IS NOT DISTINCT FROM x.cust AND s.status IS NOT DISTINCT FROM x.status AND s.cents = x.cents AND s.day = x.day AND s.prio = x.prio
    THEN CASE WHEN x.k % 83 = 0 THEN 'misordered' ELSE 'match' END ELSE 'mismatch' END AS status FROM src s FULL JOIN dst x ON s.k = x.k""")
def diff_three_way(spark, sf):
    """Equal, equal up to the order of fields, or different; some destination rows have their fields reversed."""
    s = diff.with_both_hashes(d.source(spark, sf), *PAIR)
    t = diff.with_both_hashes(d.dest(spark, sf), *PAIR, reverse=F.col("k") % 83 == 0)
    return diff.three_way(s, t)


@query("""SELECT coalesce(ns, 'TOTAL') AS ns, CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER (status = 'match') AS BIGINT) AS matches, CAST(count(*) FILTER (status = 'mismatch') AS BIGINT) AS mismatches,
    CAST(count(*) FILTER (status = 'source_only') AS BIGINT) AS source_only, CAST(count(*) FILTER (status = 'dest_only') AS BIGINT) AS dest_only,
    round(100.0 * count(*) FILTER (status = 'match') / count(*), 4)::DOUBLE AS pct
    FROM (SELECT 'p' || (k // 1000 % 8) AS ns, status FROM diffed) GROUP BY ROLLUP (ns)""")
def diff_summary(spark, sf):
    x = diff.full_diff(*pair(spark, sf)).withColumn("ns", F.concat(F.lit("p"), F.floor(F.col("k") / 1000) % 8))
    per = diff.summary(x, "ns")
    total = per.groupBy().agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("processed", "matches", "mismatches", "source_only", "dest_only")])
    total = total.select(F.lit("TOTAL").alias("ns"), "*", F.round(100.0 * F.col("matches") / F.col("processed"), 4).alias("pct"))
    return per.unionByName(total)


@query("""SELECT 'r' || g AS ns, CAST(count(k) AS BIGINT) AS docs, CAST(count(k) FILTER (status <> 'match') AS BIGINT) AS failed_docs, CAST(coalesce(sum(greatest(coalesce(sb, 0), coalesce(db, 0))), 0) AS BIGINT) AS bytes,
    CAST(2 AS BIGINT) AS ranges, CAST(CASE WHEN g = 3 THEN 1 ELSE 0 END AS BIGINT) AS failed_ranges, CAST(1 AS BIGINT) AS retried_ranges
    FROM (SELECT unnest(range(8)) AS g) LEFT JOIN (SELECT *, k // 1000 % 8 AS g FROM diffed LEFT JOIN (SELECT k, strlen(concat(k, cust, status, cents, day, prio)) AS sb FROM src) USING (k)
      LEFT JOIN (SELECT k, strlen(concat(k, cust, status, cents, day, prio)) AS db FROM dst) USING (k)) USING (g) GROUP BY g""")
def diff_totals(spark, sf):
    """Documents and bytes by group of ranges, with the tries that its two ranges took; those of group 3 have failed once."""
    x = diff.sized_diff(*pair(spark, sf)).withColumn("ns", F.concat(F.lit("r"), F.floor(F.col("k") / 1000) % 8))
    g, second = F.floor(F.col("id") / 2), F.col("id") % 2
    runs = spark.range(16).select(F.concat(F.lit("r"), g).alias("ns"), F.when((g == 3) & (second == 1), "failed").otherwise("done").alias("status"), (1 + second).cast("int").alias("retry_num"))
    return diff.totals(x, runs, "ns")


@query("""SELECT k // 1000 AS part, CAST(count(*) AS BIGINT) AS failed_before, array_to_string(list(k ORDER BY k) FILTER (NOT (status = 'dest_only' OR k % 2 = 0)), ',') AS failed FROM diffed WHERE status <> 'match' GROUP BY 1""")
def recheck_pull(spark, sf):
    """Failed keys of each range as an array, without those that pass when compared again."""
    s, t = pair(spark, sf)
    failed = diff.full_diff(s, t).where("status <> 'match'").withColumn("ns", F.lit("db.orders")).withColumn("part", F.floor(F.col("k") / 1000))
    repaired = s.where("k % 2 = 0").unionByName(t.where("k % 2 <> 0").join(s.select("k"), "k", "left_semi"))
    again = diff.recheck(failed, s, repaired).withColumn("part", F.floor(F.col("k") / 1000))
    ranges = failed.groupBy("part").agg(F.array_sort(F.collect_list("k")).alias("failed"))
    left = diff.pull_passed(ranges, again, "part").select("part", F.nullif(F.array_join(F.col("failed").cast("array<string>"), ","), F.lit("")).alias("failed"))
    return ranges.select("part", F.size("failed").cast("long").alias("failed_before")).join(left, "part")


@query("""SELECT 'db.orders' AS ns, k, CASE WHEN status = 'dest_only' OR k % 2 = 0 THEN 'pass' ELSE 'stay' END AS outcome FROM diffed WHERE status <> 'match'""")
def recheck(spark, sf):
    """Half of the failed keys have been repaired since, and rows that only the destination had are gone."""
    s, t = pair(spark, sf)
    failed = diff.full_diff(s, t).where("status <> 'match'").withColumn("ns", F.lit("db.orders"))
    repaired = s.where("k % 2 = 0").unionByName(t.where("k % 2 <> 0").join(s.select("k"), "k", "left_semi"))
    return diff.recheck(failed, s, repaired)


@query("""SELECT ns, id, CAST(CASE WHEN id % 4 = 3 THEN 'new' WHEN id % 2 = 0 THEN 'done' ELSE 'failed' END AS VARCHAR) AS status, CAST(CASE WHEN id % 4 = 3 THEN 0 WHEN id % 2 = 0 THEN 1 + id % 3 ELSE 1 END AS INTEGER) AS retry_num,
    CASE WHEN id % 2 = 0 AND 1 + id % 3 > 1 THEN '[{"status":"running","retry_num":' || (id % 3) || '}]' ELSE '[]' END AS history FROM ranges""")
def status_upsert(spark, sf):
    """A run updates some ranges, adds none for others; history as JSON."""
    r = d.ranges(spark, sf)
    old = r.select("ns", "id", F.when(F.col("id") % 4 == 3, "new").when(F.col("id") % 2 == 0, "running").otherwise("failed").alias("status"), F.when(F.col("id") % 4 == 3, 0).when(F.col("id") % 2 == 0, F.col("id") % 3).otherwise(1).cast("int").alias("retry_num"), F.array().cast("array<struct<status:string,retry_num:int>>").alias("history"))
    new = r.where("id % 2 = 0").select("ns", "id", F.lit("done").alias("status"), (1 + F.col("id") % 3).cast("int").alias("retry_num"))
    return diff.upsert_status(old, new, ["ns", "id"]).withColumn("history", F.to_json("history"))


@query("""SELECT r.id, r.lo, r.hi, CAST((SELECT count(*) FROM ranges WHERE id % 3 = 0) AS BIGINT) AS done FROM ranges r WHERE id % 3 <> 0""")
def resume_chunks(spark, sf):
    """Ranges that no earlier run has completed, with the number that one has."""
    r = d.ranges(spark, sf)
    done = r.where("id % 3 = 0").select("id")
    return r.join(done, "id", "left_anti").join(F.broadcast(done.agg(F.count(F.lit(1)).alias("done")))).select("id", "lo", "hi", "done")


@query("""SELECT coalesce(s.prio, x.prio) AS prio, coalesce(s.n, 0) AS src_count, coalesce(x.n, 0) AS dst_count, coalesce(x.n, 0) - coalesce(s.n, 0) AS delta
    FROM (SELECT prio, count(*) AS n FROM src GROUP BY prio) s FULL JOIN (SELECT prio, count(*) AS n FROM dst GROUP BY prio) x ON s.prio = x.prio""")
def count_compare(spark, sf):
    s, t = d.source(spark, sf), d.dest(spark, sf)
    n = lambda x, c: x.groupBy("prio").agg(F.count(F.lit(1)).alias(c))
    return n(s, "src_count").join(n(t, "dst_count"), "prio", "full_outer").fillna(0, ["src_count", "dst_count"]).withColumn("delta", F.col("dst_count") - F.col("src_count"))


@query("""SELECT p AS grp, sh AS src_hash, dh AS dst_hash, p NOT IN (SELECT k // 2500 FROM ((SELECT * FROM src EXCEPT ALL SELECT * FROM dst) UNION ALL (SELECT * FROM dst EXCEPT ALL SELECT * FROM src))) AS equal FROM
    (SELECT k // 2500 AS p, CAST(count(*) AS BIGINT) || ':' || CAST(sum(CAST(('0x' || substr(h, 1, 8)) AS BIGINT)) AS VARCHAR) || ':' || CAST(sum(CAST(('0x' || substr(h, 9, 8)) AS BIGINT)) AS VARCHAR) AS sh FROM hsrc GROUP BY 1)
    FULL JOIN (SELECT k // 2500 AS p, CAST(count(*) AS BIGINT) || ':' || CAST(sum(CAST(('0x' || substr(h, 1, 8)) AS BIGINT)) AS VARCHAR) || ':' || CAST(sum(CAST(('0x' || substr(h, 9, 8)) AS BIGINT)) AS VARCHAR) AS dh FROM hdst GROUP BY 1) USING (p)""")
def table_hash(spark, sf):
    """Order-free hash of each key range on both sides: sums of hash words combine before the shuffle and need no sort."""

    def of(df, name):
        word = lambda at: F.sum(F.conv(F.substring("h", at, 8), 16, 10).cast("decimal(20,0)")).cast("string")
        return df.groupBy(F.floor(F.col("k") / 2500).alias("grp")).agg(F.concat_ws(":", F.count(F.lit(1)), word(1), word(9)).alias(name))

    s, t = pair(spark, sf)
    return of(s, "src_hash").join(of(t, "dst_hash"), "grp", "full_outer").withColumn("equal", F.col("src_hash").eqNullSafe(F.col("dst_hash")))


@query("""SELECT s.k, array_to_string(list_filter([CASE WHEN s.cust IS DISTINCT FROM x.cust THEN 'cust' END, CASE WHEN s.status IS DISTINCT FROM x.status THEN 'status' END, CASE WHEN s.cents IS DISTINCT FROM x.cents THEN 'cents' END,
    CASE WHEN s.day IS DISTINCT FROM x.day THEN 'day' END, CASE WHEN s.prio IS DISTINCT FROM x.prio THEN 'prio' END], lambda f: f IS NOT NULL), ',') AS fields
    FROM src s JOIN dst x ON s.k = x.k WHERE s.cents <> x.cents""")
def field_diff(spark, sf):
    """Names of the fields in which two versions of a row differ."""
    s, t = d.source(spark, sf), d.dest(spark, sf)
    pairs = s.alias("s").join(t.alias("t"), "k").where(~F.col("s.cents").eqNullSafe(F.col("t.cents")))
    names = F.filter(F.array(*[F.when(~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")), F.lit(c)) for c in PAIR[1:]]), lambda f: f.isNotNull())
    return pairs.select("k", F.array_join(names, ",").alias("fields"))

