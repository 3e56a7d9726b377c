"""Metrics, connections, health and catalog queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import is_system_db, ns_db
from tidemark.operators import catalogs, metrics
from tidemark.operators.small import small
from tidemark.plans.base import query, with_inputs
from tidemark.sources import derived as d
from tidemark.sources.tables import load

# --- counters ---


@query("SELECT entity, ts, seq, CAST(coalesce(counter - lag(counter) OVER (PARTITION BY entity ORDER BY ts, seq), 0) AS BIGINT) AS delta FROM snap")
def counter_delta(spark, sf):
    return metrics.deltas(d.snapshots(spark, sf), "entity", "counter", "ts", "seq").select("entity", "ts", "seq", "delta")


@query("""SELECT entity, ts, seq, CAST(sum(delta) OVER (PARTITION BY entity ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM
    (SELECT *, coalesce(counter - lag(counter) OVER (PARTITION BY entity ORDER BY ts, seq), 0) AS delta FROM snap)""")
def running_total(spark, sf):
    return metrics.running(metrics.deltas(d.snapshots(spark, sf), "entity", "counter", "ts", "seq"), "entity", "delta", "ts", "seq").select("entity", "ts", "seq", "running")


def metric(spark, sf):
    return d.change_log(spark, sf).groupBy("ns", "shard").agg(F.round(F.sum("value"), 2).alias("v"))


SHARDS = [f"shard{i}" for i in range(4)]


@query("""SELECT ns, round(coalesce(sum(v) FILTER (shard = 'shard0'), 0), 2) AS shard0, round(coalesce(sum(v) FILTER (shard = 'shard1'), 0), 2) AS shard1, round(coalesce(sum(v) FILTER (shard = 'shard2'), 0), 2) AS shard2,
    round(coalesce(sum(v) FILTER (shard = 'shard3'), 0), 2) AS shard3 FROM nsmetric GROUP BY ns""")
def shard_pivot(spark, sf):
    p = metric(spark, sf).groupBy("ns").pivot("shard", SHARDS).agg(F.sum("v"))
    return p.select("ns", *[F.round(F.coalesce(s, F.lit(0.0)), 2).alias(s) for s in SHARDS])


@query("""SELECT ns, shard, v, round(a, 4) AS avg_nonzero, v >= 0.5 AND v > 1.25 * a AS warm, v >= 0.5 AND v > 2 * a AS hot FROM (SELECT *, avg(CASE WHEN v > 0 THEN v END) OVER (PARTITION BY ns) AS a FROM nsmetric)""")
def hot_flags(spark, sf):
    return metrics.hot_flags(metric(spark, sf))


@query("SELECT ns, round(CASE WHEN s = 0 OR m = 0 THEN 0.0 ELSE m * (m / (s / 4)) END, 4) AS score FROM (SELECT ns, max(v) AS m, sum(v) AS s FROM nsmetric GROUP BY ns)")
def pivot_score(spark, sf):
    return metrics.pivot_score(metric(spark, sf), 4)


@query("SELECT shard, CAST(count(DISTINCT ns) AS BIGINT) AS namespaces, round(sum(v), 2) AS total, round(max(v), 2) AS largest FROM nsmetric GROUP BY shard")
def shard_rollup(spark, sf):
    return metric(spark, sf).groupBy("shard").agg(F.countDistinct("ns").alias("namespaces"), F.round(F.sum("v"), 2).alias("total"), F.round(F.max("v"), 2).alias("largest"))


@query("SELECT ns, shard, v FROM nsmetric WHERE v >= 0.05 ORDER BY coalesce(v, 0) DESC, ns, shard LIMIT 10")
def topn_metric(spark, sf):
    return metric(spark, sf).where("v >= 0.05").orderBy(F.desc(F.coalesce("v", F.lit(0.0))), "ns", "shard").limit(10)


@query("SELECT ns, shard, v, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY ns ORDER BY v DESC, shard) AS rn FROM nsmetric) WHERE rn <= 2")
def topn_per_group(spark, sf):
    w = Window.partitionBy("ns").orderBy(F.desc("v"), "shard")
    return metric(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 2")


@query("""SELECT entity, concat_ws(', ', CASE WHEN pct >= 20 THEN 'a fifth or more is dirty: applications evict' WHEN pct >= 5 THEN 'a twentieth or more is dirty: eviction runs' END,
    CASE WHEN app > 0 THEN 'applications take part in eviction' END, CASE WHEN dirty > 0 AND clean = 0 THEN 'only changed pages leave' END, CASE WHEN blocked > 0 THEN 'pages in use hold eviction up' END,
    CASE WHEN waits > 0 THEN 'a checkpoint holds eviction up' END, CASE WHEN history > 512 THEN 'old versions take ' || CAST(history AS BIGINT) || ' MB' END) AS notes FROM
    (SELECT user_id AS entity, 100.0 * count(*) FILTER (event_type = 'error') / count(*) AS pct, count(*) FILTER (event_type = 'signup' AND value > 100) AS app, count(*) FILTER (event_type = 'click') AS dirty,
      count(*) FILTER (event_type = 'view' AND value > 60) AS clean, count(*) FILTER (value > 250) AS blocked, count(*) FILTER (event_id % 97 = 0) AS waits, sum(event_id % 64) AS history FROM events GROUP BY user_id)""")
def diagnose(spark, sf):
    """Which of the six thresholds of cache eviction an entity crosses."""
    t, v, i = F.col("event_type"), F.col("value"), F.col("event_id")
    g = load(spark, sf, "events").groupBy(F.col("user_id").alias("entity")).agg(
        (100.0 * F.count_if(t == "error") / F.count(F.lit(1))).alias("pct"), F.count_if((t == "signup") & (v > 100)).alias("app"), F.count_if(t == "click").alias("dirty"),
        F.count_if((t == "view") & (v > 60)).alias("clean"), F.count_if(v > 250).alias("blocked"), F.count_if(i % 97 == 0).alias("waits"), F.sum(i % 64).alias("history"),
    )
    return g.select("entity", F.concat_ws(", ", *metrics.eviction_notes()).alias("notes"))


@query("""SELECT event_type AS series, round(quantile_cont(value, 0.95), 4) AS p95, round(avg(value), 4) AS mean, max(value) AS most FROM events GROUP BY event_type""")
def series_pctl(spark, sf):
    return load(spark, sf, "events").groupBy(F.col("event_type").alias("series")).agg(F.round(F.percentile("value", 0.95), 4).alias("p95"), F.round(F.avg("value"), 4).alias("mean"), F.max("value").alias("most"))


@query("""SELECT ns, '{"ns":"' || ns || '","total":{"ops":' || CAST(sum(n) AS BIGINT) || ',"bytes":' || CAST(sum(b) AS BIGINT) || '},"shards":[' || string_agg('{"shard":"' || shard || '","ops":{"total":' || n || ',"i":' || i || ',"u":' || u || ',"d":' || dl || '},"bytes":{"sum":' || b || ',"max":' || m || '}}', ',' ORDER BY shard) || ']}' AS stat
    FROM (SELECT ns, shard, count(*) AS n, count(*) FILTER (op = 'i') AS i, count(*) FILTER (op = 'u') AS u, count(*) FILTER (op = 'd') AS dl, CAST(sum(size) AS BIGINT) AS b, max(size) AS m FROM log GROUP BY ns, shard) GROUP BY ns""")
def stat_json(spark, sf):
    """A tree of metrics for each namespace: totals, then operations by kind and bytes of each shard."""
    n = lambda o: F.count_if(F.col("op") == o)
    ops = F.struct(F.count(F.lit(1)).alias("total"), n("i").alias("i"), n("u").alias("u"), n("d").alias("d"))
    x = d.change_log(spark, sf).groupBy("ns", "shard").agg(ops.alias("ops"), F.struct(F.sum("size").alias("sum"), F.max("size").alias("max")).alias("bytes"))
    g = x.groupBy("ns").agg(F.struct(F.sum("ops.total").alias("ops"), F.sum("bytes.sum").alias("bytes")).alias("total"), F.array_sort(F.collect_list(F.struct("shard", "ops", "bytes"))).alias("shards"))
    return g.select("ns", F.to_json(F.struct("ns", "total", "shards")).alias("stat"))


@query("""SELECT c.ns, c.shard, CAST(count(l.ns) AS BIGINT) AS ops, CAST(coalesce(sum(l.size), 0) AS BIGINT) AS bytes FROM (SELECT n.ns, s.shard FROM (SELECT DISTINCT ns FROM log WHERE ns NOT LIKE 'config.%' AND ns NOT LIKE 'admin.%') n, (SELECT DISTINCT shard FROM log) s) c
    LEFT JOIN log l ON l.ns = c.ns AND l.shard = c.shard GROUP BY c.ns, c.shard""")
def ns_stats_each(spark, sf):
    """Statistics of each listed collection on each shard, also where it has none; shards are few."""
    x = d.change_log(spark, sf)
    listed = x.where(~is_system_db(ns_db("ns"))).select("ns").distinct().join(small(x.select("shard").distinct()))
    got = x.groupBy("ns", "shard").agg(F.count(F.lit(1)).alias("ops"), F.sum("size").alias("bytes"))
    return listed.join(got, ["ns", "shard"], "left").fillna(0, ["ops", "bytes"])


@query("""SELECT entity, shard, ts, CAST(counter % 50000 AS BIGINT) AS counter, samples FROM (SELECT *, row_number() OVER (PARTITION BY entity, shard ORDER BY ts DESC, seq DESC) AS rn, count(*) OVER (PARTITION BY entity, shard) AS samples FROM snap) WHERE rn = 1""")
def server_counters(spark, sf):
    """Each entity's newest counter, which may be less than older ones as counters start anew with their server, and how often it was read."""
    x = d.snapshots(spark, sf).withColumn("counter", F.col("counter") % 50_000)
    return x.groupBy("entity", "shard").agg(F.max("ts").alias("ts"), F.max_by("counter", F.struct("ts", "seq")).alias("counter"), F.count(F.lit(1)).alias("samples"))


@query("SELECT id, app, usr, op, secs FROM sess WHERE active AND op <> 'command' AND secs >= 100 AND app <> 'MACHINERY'")
def current_ops(spark, sf):
    """Operations that run for long, without those of excluded kinds and applications."""
    return d.sessions(spark, sf).where(F.col("active") & (F.col("op") != "command") & (F.col("secs") >= 100) & ~F.col("app").isin("MACHINERY")).select("id", "app", "usr", "op", "secs")


@query("SELECT md5('n' || n_nationkey) || '.' || n_regionkey || '.bson' AS file, c.ns FROM nation JOIN (SELECT DISTINCT ns, uuid FROM colls) c ON c.uuid = md5('n' || n_nationkey)")
def uuid_files(spark, sf):
    """Dump files by the collection whose identifier begins their name."""
    name = F.concat(F.md5(F.concat(F.lit("n"), "n_nationkey")), F.lit("."), "n_regionkey", F.lit(".bson"))
    files = load(spark, sf, "nation").select(name.alias("file")).withColumn("uuid", F.substring_index("file", ".", 1))
    return files.join(d.collections(spark, sf).select("ns", "uuid").distinct(), "uuid").select("file", "ns")


# --- connections ---

CONN = """SELECT {k} CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (active) AS BIGINT) AS active, CAST(count(*) FILTER (NOT active) AS BIGINT) AS inactive, CAST(coalesce(sum(secs) FILTER (active), 0) AS BIGINT) AS total_secs,
    round(coalesce(avg(secs) FILTER (active), 0.0), 4) AS avg_secs, coalesce(max(secs) FILTER (active), 0) AS max_secs FROM sess GROUP BY {g}"""


def conn(name: str, *by: str) -> None:
    def f(spark, sf):
        return metrics.connections(d.sessions(spark, sf), *by).orderBy(F.desc("total"), *by)

    f.__name__ = name
    query(CONN.format(k=", ".join(by) + ",", g=", ".join(by)))(f)


conn("conn_by_app", "app")
conn("conn_by_user", "usr")
conn("conn_by_driver", "driver")
conn("conn_by_ip", "ip")
conn("conn_by_app_driver", "app", "driver")
conn("conn_by_app_op", "app", "op")


@query("""SELECT CASE WHEN grouping(app) = 1 THEN 'TOTAL' ELSE app END AS app, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (active) AS BIGINT) AS active, CAST(coalesce(sum(secs) FILTER (active), 0) AS BIGINT) AS total_secs,
    round(coalesce(avg(secs) FILTER (active), 0.0), 4) AS avg_secs FROM sess GROUP BY ROLLUP (app)""")
def conn_rollup(spark, sf):
    return metrics.connections_rollup(d.sessions(spark, sf), "app")


@query("SELECT c_custkey AS id FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0)")
def anti_inactive(spark, sf):
    """Entries of one list that the other does not name; lines are split at white space or commas first."""
    listed = load(spark, sf, "supplier").where("s_suppkey % 3 = 0").select(F.concat_ws(" ", F.lit("nation"), "s_nationkey", F.lit("seen")).alias("value"))
    seen = listed.select(F.split("value", r"[\s,]+")[1].cast("int").alias("c_nationkey")).distinct()
    return load(spark, sf, "customer").join(seen, "c_nationkey", "left_anti").select(F.col("c_custkey").alias("id"))


# --- health ---


@query("SELECT * FROM idx")
def index_usage(spark, sf):
    return metrics.index_usage(d.index_stats(spark, sf))


@query("""SELECT coalesce(db, 'ALL') AS db, coalesce(ns, 'ALL') AS ns, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (NOT shard_key AND primary_ops + secondary_ops = 0) AS BIGINT) AS unused,
    CAST(count(*) FILTER (NOT shard_key AND primary_ops + secondary_ops BETWEEN 1 AND 99) AS BIGINT) AS low_usage FROM idx GROUP BY ROLLUP (db, ns)""")
def index_health(spark, sf):
    return metrics.index_health(metrics.index_usage(d.index_stats(spark, sf)))


@query("""SELECT shard, size, round(a, 4) AS avg_size, round(dev, 4) AS deviation_pct, CASE WHEN max(dev) OVER () < 10 THEN 'well balanced' WHEN max(dev) OVER () < 25 THEN 'moderate' ELSE 'significant' END AS status FROM
    (SELECT *, avg(size) OVER () AS a, abs(size - avg(size) OVER ()) / avg(size) OVER () * 100 AS dev FROM (SELECT 'shard' || (l_suppkey % 4) AS shard, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS size FROM lineitem GROUP BY 1))""")
def size_balance(spark, sf):
    return metrics.size_balance(load(spark, sf, "lineitem").groupBy(F.concat(F.lit("shard"), F.col("l_suppkey") % 4).alias("shard")).agg(F.sum(F.col("l_quantity").cast("long")).alias("size")))


# --- catalogs ---


@query("""SELECT a.ns, a.name, CASE WHEN b.ns IS NULL THEN 'missing' WHEN t AND NOT u AND NOT s THEN 'ttl' WHEN u AND NOT t AND NOT s THEN 'unique' WHEN s AND NOT t AND NOT u THEN 'sparse' ELSE 'other' END AS diff_kind FROM
    (SELECT a.*, b.ns AS bns, a.ttl IS DISTINCT FROM b.ttl AS t, a.uniq <> b.uniq AS u, a.sparse <> b.sparse AS s FROM ispec_a a LEFT JOIN ispec_b b USING (ns, name, key)) a LEFT JOIN ispec_b b ON a.ns = b.ns AND a.name = b.name
    WHERE b.ns IS NULL OR t OR u OR s""")
def index_diff(spark, sf):
    return catalogs.index_diff(*d.index_specs(spark, sf))


MAPPED = "CASE {x} WHEN 'shard0' THEN 'new1' WHEN 'shard1' THEN 'new0' WHEN 'shard2' THEN 'new2' ELSE {x} END"


def new_shards(spark):
    """The map of an explicit list of entries; two shards have changed places."""
    old = spark.createDataFrame([(f"shard{i}",) for i in range(3)], "shard string")
    return catalogs.shard_map(old, old, explicit=["shard0|new1", "shard1|new0", "shard2|new2"])


@query(f"""SELECT a.chunk_id, {MAPPED.format(x="a.shard")} AS expected_shard, b.shard AS actual_shard, CASE WHEN b.shard IS NULL THEN 'missing' WHEN b.shard <> {MAPPED.format(x="a.shard")} THEN 'mismatched' ELSE 'ok' END AS status
    FROM chunks_a a LEFT JOIN (SELECT chunk_id, CASE WHEN shard = 'shard1' THEN 'new0' WHEN shard = 'shard0' AND chunk_id NOT LIKE '%00%' THEN 'new1' ELSE 'new2' END AS shard FROM chunks_b) b USING (chunk_id)""")
def chunk_diff(spark, sf):
    """Chunks against a cluster whose shards have other names; one of them holds what it should not."""
    a, b = d.chunk_catalogs(spark, sf)
    moved = F.when(F.col("shard") == "shard1", "new0").when((F.col("shard") == "shard0") & ~F.col("chunk_id").contains("00"), "new1").otherwise("new2")
    return catalogs.chunk_diff(a, b.withColumn("shard", moved), new_shards(spark))


@query("SELECT coalesce(a.shard, b.shard) AS shard, coalesce(a.n, 0) AS src, coalesce(b.n, 0) AS dst FROM (SELECT shard, count(*) AS n FROM chunks_a GROUP BY shard) a FULL JOIN (SELECT shard, count(*) AS n FROM chunks_b GROUP BY shard) b ON a.shard = b.shard")
def chunk_counts(spark, sf):
    a, b = d.chunk_catalogs(spark, sf)
    n = lambda x, c: x.groupBy("shard").agg(F.count(F.lit(1)).alias(c))
    return n(a, "src").join(n(b, "dst"), "shard", "full_outer").fillna(0)


@query("SELECT g.role, g.resource, g.action FROM grants g WHERE g.role <> 'role3' AND g.action = 'remove' AND g.resource LIKE 'db1.%'")
def role_diff(spark, sf):
    g = d.grants(spark, sf)
    return catalogs.role_diff(g, g.where("role <> 'role3' and not (action = 'remove' and resource like 'db1.%')"))


@query("SELECT role, resource, string_agg(DISTINCT action, ',' ORDER BY action) AS actions FROM grants GROUP BY role, resource")
def role_canon(spark, sf):
    return catalogs.canonical_roles(d.grants(spark, sf))


@query("SELECT ns, uuid, string_agg(DISTINCT shard, ',' ORDER BY shard) AS shards, (SELECT count(DISTINCT uuid) FROM colls b WHERE b.ns = a.ns) = 1 AS ok FROM colls a GROUP BY ns, uuid")
def uuid_consistency(spark, sf):
    return catalogs.uuid_consistency(d.collections(spark, sf))


@query(f"""SELECT db, src_primary, mapped, dst_primary, dst_primary IS NOT NULL AND mapped = dst_primary AS ok, CASE WHEN dst_primary IS NULL THEN 'missing' WHEN mapped = dst_primary THEN 'ok' ELSE 'mismatched' END AS status FROM (
    SELECT n_name AS db, 'shard' || (n_regionkey % 3) AS src_primary, {MAPPED.format(x="('shard' || (n_regionkey % 3))")} AS mapped,
      CASE WHEN n_nationkey % 11 = 0 THEN NULL WHEN n_nationkey % 6 = 0 THEN 'new2' ELSE {MAPPED.format(x="('shard' || (n_regionkey % 3))")} END AS dst_primary FROM nation)""")
def mapped_primary(spark, sf):
    """Primary shards of databases against those that the shard map expects; some databases are missing."""
    n, m = load(spark, sf, "nation"), new_shards(spark)
    home = F.concat(F.lit("shard"), F.col("n_regionkey") % 3)
    src = n.select(F.col("n_name").alias("db"), home.alias("src_primary"), home.alias("mapped"))
    dst = catalogs.mapped(n.select(F.col("n_name").alias("db"), "n_nationkey", home.alias("dst_primary")), "dst_primary", m)
    dst = dst.where("n_nationkey % 11 <> 0").select("db", F.when(F.col("n_nationkey") % 6 == 0, "new2").otherwise(F.col("dst_primary")).alias("dst_primary"))
    x = catalogs.mapped(src, "mapped", m).join(dst, "db", "left")
    status = F.when(F.col("dst_primary").isNull(), "missing").when(F.col("mapped") == F.col("dst_primary"), "ok").otherwise("mismatched")
    return x.withColumn("status", status).withColumn("ok", F.col("status") == "ok")


@query("SELECT 'db.n' || n_nationkey AS ns, '{\"k\":1}' AS src_key, CASE WHEN n_nationkey % 4 = 0 THEN '{\"k\":-1}' ELSE '{\"k\":1}' END AS dst_key FROM nation WHERE n_nationkey % 4 = 0")
def shardkey_diff(spark, sf):
    """Shard keys that differ; time-series buckets are compared under the name of their view."""
    from tidemark.functions.scalars import bucket_to_view

    n = load(spark, sf, "nation").select("n_nationkey")
    a = n.select(F.concat(F.lit("db.n"), "n_nationkey").alias("ns"), F.lit('{"k":1}').alias("src_key"))
    name = F.concat(F.when(F.col("n_nationkey") % 2 == 0, "db.system.buckets.n").otherwise("db.n"), "n_nationkey")
    b = n.select(bucket_to_view(name).alias("ns"), F.when(F.col("n_nationkey") % 4 == 0, '{"k":-1}').otherwise('{"k":1}').alias("dst_key"))
    return a.join(b, "ns").where("src_key <> dst_key")


@query("SELECT c.ns, p_partkey AS id, c.uuid, p_size AS lo, 'shard' || (p_partkey % 3) AS shard FROM part JOIN (SELECT DISTINCT ns, uuid FROM colls) c ON c.uuid = md5('n' || (p_partkey % 31)) WHERE p_partkey % 3 <> 2")
def chunk_catalog_join(spark, sf):
    """Chunks of one shard fewer with the namespace of their collection, which is looked up by its identifier; chunks of unknown collections go."""
    p = F.col("p_partkey")
    chunks = load(spark, sf, "part").select(p.alias("id"), F.md5(F.concat(F.lit("n"), p % 31)).alias("uuid"), F.col("p_size").alias("lo"), F.concat(F.lit("shard"), p % 3).alias("shard"))
    colls = d.collections(spark, sf).select("ns", "uuid").distinct()
    return chunks.where("shard <> 'shard2'").join(colls, "uuid").select("ns", "id", "uuid", "lo", "shard").orderBy("ns", "lo", "id")


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS name, CAST(count(*) AS BIGINT) AS count FROM {t}" for t in TABLES)


@query(f"SELECT * FROM ({COUNTS}) UNION ALL SELECT 'TOTAL', CAST(sum(count) AS BIGINT) FROM ({COUNTS})")
def catalog_stats(spark, sf):
    """Rows of each table and in all; counts come from file footers."""
    from functools import reduce

    per = reduce(lambda a, b: a.unionByName(b), [load(spark, sf, t).agg(F.count(F.lit(1)).alias("count")).select(F.lit(t).alias("name"), "count") for t in TABLES])
    return per.unionByName(per.agg(F.sum("count").alias("count")).select(F.lit("TOTAL").alias("name"), "count"))


ENTRIES = """SELECT db || '.' || CASE WHEN p_size % 17 = 0 THEN 'system.' ELSE '' END || p_brand AS ns, CASE WHEN p_brand = 'Brand#2' THEN 'view' ELSE 'collection' END AS type, CAST(count(*) AS BIGINT) AS docs,
    CAST(sum(p_size) * 1024 AS BIGINT) AS bytes, CAST(count(DISTINCT p_type) AS BIGINT) AS indexes, bool_or(p_type = 'SMALL') AS sharded FROM (SELECT *, CASE WHEN p_partkey % 9 = 0 THEN 'config' ELSE 'db' || (p_partkey % 2) END AS db FROM part) GROUP BY 1, 2"""


@query(f"""SELECT coalesce(db, 'ALL') AS db, coalesce(sharded, 'ALL') AS sharded, CAST(count(*) AS BIGINT) AS collections, CAST(sum(docs) AS BIGINT) AS docs, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(indexes) AS BIGINT) AS indexes
    FROM (SELECT docs, bytes, indexes, split_part(ns, '.', 1) AS db, CASE WHEN sharded THEN 'sharded' ELSE 'unsharded' END AS sharded FROM ({ENTRIES}) WHERE type = 'collection' AND ns NOT LIKE '%.system.%' AND ns NOT LIKE 'config.%') GROUP BY ROLLUP (db, sharded)""")
def catalog_totals(spark, sf):
    """A catalog with views, system collections and databases, reduced to users' collections and summed with sizes and indexes."""
    p = load(spark, sf, "part").withColumn("db", F.when(F.col("p_partkey") % 9 == 0, "config").otherwise(F.concat(F.lit("db"), F.col("p_partkey") % 2)))
    ns = F.concat("db", F.lit("."), F.when(F.col("p_size") % 17 == 0, "system.").otherwise(""), "p_brand")
    entries = p.groupBy(ns.alias("ns"), F.when(F.col("p_brand") == "Brand#2", "view").otherwise("collection").alias("type")).agg(
        F.count(F.lit(1)).alias("docs"), (F.sum("p_size") * 1024).alias("bytes"), F.count_distinct("p_type").alias("indexes"), F.bool_or(F.col("p_type") == "SMALL").alias("sharded")
    )
    return catalogs.catalog_totals(entries)


@query("""SELECT DISTINCT 'position' AS mode, 'a' || s_suppkey % 3 AS source, 'b' || s_suppkey % 3 AS target FROM supplier UNION ALL SELECT DISTINCT 'explicit', 'a' || s_suppkey % 3, CASE WHEN s_suppkey % 3 < 2 THEN 'b0' ELSE 'b2' END FROM supplier
    UNION ALL SELECT DISTINCT 'spread', 'c' || s_suppkey % 7, 'b' || (s_suppkey % 7 % 3) FROM supplier""")
def shard_maps(spark, sf):
    """The three ways to map the shards that suppliers lie on: by position, by a list of entries, dealt in turn."""
    names = lambda prefix, n: load(spark, sf, "supplier").select(F.concat(F.lit(prefix), F.col("s_suppkey") % n).alias("shard")).distinct()
    tag = lambda df, mode: df.select(F.lit(mode).alias("mode"), "source", "target")
    a, b, c = names("a", 3), names("b", 3), names("c", 7)
    return tag(catalogs.shard_map(a, b), "position").unionByName(tag(catalogs.shard_map(a, b, explicit=["a0|b0", "a1|b0", "a2|b2"]), "explicit")).unionByName(tag(catalogs.shard_map(c, b, spread=True), "spread"))


@query("""SELECT a.ns, a.name, CASE WHEN b.ns IS NULL THEN 'missing' WHEN a.ttl <> b.ttl AND a.uniq = b.uniq AND a.sparse = b.sparse THEN 'ttl' WHEN a.ttl = b.ttl AND a.uniq <> b.uniq AND a.sparse = b.sparse THEN 'unique'
    WHEN a.ttl = b.ttl AND a.uniq = b.uniq THEN 'sparse' ELSE 'other' END AS diff_kind FROM (SELECT * FROM ispec_a WHERE ttl IS NOT NULL) a LEFT JOIN (SELECT * FROM ispec_b WHERE ttl IS NOT NULL) b USING (ns, name, key)
    WHERE b.ns IS NULL OR a.ttl <> b.ttl OR a.uniq <> b.uniq OR a.sparse <> b.sparse""")
def ttl_diff(spark, sf):
    """Only indexes that expire documents are compared."""
    a, b = (x.where("ttl is not null") for x in d.index_specs(spark, sf))
    return catalogs.index_diff(a, b)


@query("""SELECT p_partkey AS id, '{"a":' || (CASE WHEN p_size % 2 = 0 THEN '1' ELSE '-1' END) || ',"b":"hashed"}' AS key, true AS same FROM part""")
def key_patterns(spark, sf):
    """Key patterns written with whole numbers, decimals and spaces have one form."""
    from tidemark.functions.scalars import key_pattern, normal_key

    k = F.col("p_partkey")
    sign = F.when(F.col("p_size") % 2 == 0, "1").otherwise("-1")
    written = F.concat(F.lit('{ "a" : '), sign, F.when(k % 3 == 0, ".0").when(k % 3 == 1, ".00").otherwise(""), F.lit(' , "b":"hashed" }'))
    rendered = key_pattern(F.array(F.lit("a"), F.lit("b")), F.array(sign, F.lit("hashed")))
    return load(spark, sf, "part").select(k.alias("id"), normal_key(written).alias("key"), (normal_key(written) == normal_key(rendered)).alias("same"))


@query("""SELECT 'db.' || p_partkey AS ns, CASE WHEN p_partkey % 3 = 0 THEN 'ab_1' WHEN p_partkey % 3 = 1 THEN CASE WHEN p_size % 2 = 0 THEN 'a_1' ELSE 'ab_1' END ELSE 'abc_1' END AS name FROM part""")
def hint_index(spark, sf):
    """The index to read chunks by: the one with the fewest fields that holds the shard key; some collections lack the shortest."""
    k = F.col("p_partkey")
    ns = load(spark, sf, "part").select(F.concat(F.lit("db."), k).alias("ns"), "p_partkey", "p_size")
    index = lambda n, f: F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, f)).alias("fields"))
    have = F.explode(F.array(F.when(F.col("p_size") % 2 == 0, index("a_1", "a")), index("ab_1", "ab"), index("abc_1", "abc"), index("zabc_1", "zabc")))
    want = F.when(k % 3 == 0, F.array(F.lit("b"))).when(k % 3 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("c"), F.lit("a")))
    return catalogs.hinted_index(ns.select("ns", have.alias("x")).where("x is not null").select("ns", "x.*"), ns.select("ns", want.alias("key_fields")))


@query("SELECT 'shard' || (s_suppkey % 4) AS shard, coalesce(bool_or(CASE WHEN s_suppkey % 4 = 2 THEN s_acctbal > 0 WHEN s_suppkey % 4 < 2 THEN false END), false) AS draining, (SELECT count(*) > 0 FROM region WHERE r_name LIKE '%E%') AS zones FROM supplier GROUP BY 1")
def draining_shards(spark, sf):
    """Shards of an unfinished removal (unmarked ones are not), and whether any zone is set."""
    k = F.col("s_suppkey") % 4
    mark = F.when(k == 2, F.col("s_acctbal") > 0).when(k < 2, False)
    shards = load(spark, sf, "supplier").groupBy(F.concat(F.lit("shard"), k).alias("shard")).agg(F.coalesce(F.bool_or(mark), F.lit(False)).alias("draining"))
    zones = load(spark, sf, "region").where(F.col("r_name").contains("E")).agg((F.count(F.lit(1)) > 0).alias("zones"))
    return shards.join(F.broadcast(zones))  # one row


@query("SELECT event_id AS seq, CAST(2000 + event_id % 8 AS BIGINT) AS opcode FROM events WHERE 2000 + event_id % 8 = 2004")
def opcode_filter(spark, sf):
    """Recorded messages of queries alone."""
    return load(spark, sf, "events").select(F.col("event_id").alias("seq"), (2000 + F.col("event_id") % 8).alias("opcode")).where("opcode = 2004")


@query("""SELECT db, shard, size, round(avg(size) OVER (PARTITION BY db), 4) AS avg_size, round(100.0 * size / sum(size) OVER (), 4)::DOUBLE AS pct FROM
    (SELECT 'db' || (l_orderkey % 3) AS db, 'shard' || (l_suppkey % 4) AS shard, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS size FROM lineitem GROUP BY 1, 2)""")
def size_by_db(spark, sf):
    """Bytes of each database on each shard, the database's mean and the share of all."""
    g = load(spark, sf, "lineitem").groupBy(F.concat(F.lit("db"), F.col("l_orderkey") % 3).alias("db"), F.concat(F.lit("shard"), F.col("l_suppkey") % 4).alias("shard")).agg(F.sum(F.col("l_quantity").cast("long")).alias("size"))
    return g.withColumn("avg_size", F.round(F.avg("size").over(Window.partitionBy("db")), 4)).withColumn("pct", F.round(100.0 * F.col("size") / F.sum("size").over(Window.partitionBy()), 4))


@query("""SELECT ns, metric, round(coalesce(sum(v) FILTER (shard = 'shard0'), 0), 4) AS shard0, round(coalesce(sum(v) FILTER (shard = 'shard1'), 0), 4) AS shard1, round(coalesce(sum(v) FILTER (shard = 'shard2'), 0), 4) AS shard2, round(coalesce(sum(v) FILTER (shard = 'shard3'), 0), 4) AS shard3 FROM (
    UNPIVOT (SELECT ns, shard, CAST(count(*) AS DOUBLE) AS ops, sum(value) AS amount, sum(size) / 1048576.0::DOUBLE AS mb, CASE WHEN max(epoch_us(ts)) > min(epoch_us(ts)) THEN sum(size * 1048576) / 1073741824.0::DOUBLE / ((max(epoch_us(ts)) - min(epoch_us(ts))) // 1000000 / 3600.0::DOUBLE) ELSE 0 END AS gb_hour FROM log GROUP BY ns, shard)
    ON ops, amount, mb, gb_hour INTO NAME metric VALUE v) GROUP BY ns, metric""")
def metric_pivot(spark, sf):
    """Every metric of each namespace by shard: operations, amounts, megabytes and gigabytes an hour."""
    from tidemark.functions.scalars import per_hour

    us = lambda f: f(F.unix_micros(F.col("ts").cast("timestamp")))
    g = d.change_log(spark, sf).groupBy("ns", "shard").agg(F.count(F.lit(1)).cast("double").alias("ops"), F.sum("value").alias("amount"), F.sum("size").alias("bytes"), F.floor((us(F.max) - us(F.min)) / 1_000_000).alias("seconds"))
    g = g.withColumn("mb", F.col("bytes") / 1048576.0).withColumn("gb_hour", per_hour(F.col("bytes") * 1048576, "seconds"))
    return metrics.pivot_metrics(g, ["ops", "amount", "mb", "gb_hour"], SHARDS)


@query("""SELECT s.prio AS ns, CAST(s.n AS BIGINT) AS total, CAST(coalesce(x.n, 0) AS BIGINT) AS copied, round(100.0 * coalesce(x.n, 0) / s.n, 4)::DOUBLE AS pct, CAST(s.days - coalesce(x.days, 0) AS BIGINT) AS lag_days
    FROM (SELECT prio, count(*) AS n, max(CAST(day AS DATE) - DATE '1970-01-01') AS days FROM src GROUP BY prio) s LEFT JOIN (SELECT prio, count(*) AS n, max(CAST(day AS DATE) - DATE '1970-01-01') AS days FROM dst WHERE k < 100000000 AND cust % 7 <> 0 GROUP BY prio) x USING (prio)""")
def copy_progress(spark, sf):
    """How far each parallel copy has come, and how far its newest row lies behind."""
    of = lambda df: df.groupBy(F.col("prio").alias("ns")).agg(F.count(F.lit(1)).alias("n"), F.max(F.unix_date(F.col("day").cast("date"))).alias("days"))
    s, x = of(d.source(spark, sf)).alias("s"), of(d.dest(spark, sf).where("k < 100000000 and cust % 7 <> 0")).alias("x")
    n = F.coalesce("x.n", F.lit(0))
    return s.join(x, "ns", "left").select("ns", F.col("s.n").alias("total"), n.alias("copied"), F.round(100.0 * n / F.col("s.n"), 4).alias("pct"), (F.col("s.days") - F.coalesce("x.days", F.lit(0))).cast("long").alias("lag_days"))


@query("""SELECT seq // 1000 AS batch, CAST(count(*) FILTER (op = 'i' AND NOT met) AS BIGINT) AS inserted, CAST(count(*) FILTER (op = 'u') AS BIGINT) AS modified, CAST(count(*) FILTER (op = 'd') AS BIGINT) AS deleted, CAST(count(*) FILTER (met) AS BIGINT) AS duplicates
    FROM (SELECT seq, op, op = 'i' AND last_value(CASE WHEN op <> 'u' THEN op END IGNORE NULLS) OVER (PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT DISTINCT FROM 'i' AS met FROM log WHERE op IN ('i', 'u', 'd')) GROUP BY 1""")
def bulk_totals(spark, sf):
    """What bulk writes have done, summed by batch; inserts that met a key are left out and counted as duplicates."""
    from tidemark.operators import dupes

    return dupes.bulk_totals(d.change_log(spark, sf), F.floor(F.col("seq") / 1000))


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def count_exact(spark, sf):
    return load(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT ns, shard FROM colls")
def distinct_shards(spark, sf):
    return d.collections(spark, sf).select("ns", "shard").distinct()


@query("""SELECT ns, day, string_agg(CASE WHEN was THEN '-' ELSE '+' END || op, ',' ORDER BY op) AS changes FROM (
    SELECT coalesce(a.ns, b.ns) AS ns, coalesce(a.day + 1, b.day) AS day, coalesce(a.op, b.op) AS op, b.op IS NULL AS was FROM (SELECT DISTINCT ns, op, CAST(day(ts) AS INTEGER) AS day FROM log) a
    FULL JOIN (SELECT DISTINCT ns, op, CAST(day(ts) AS INTEGER) AS day FROM log) b ON a.ns = b.ns AND a.op = b.op AND b.day = a.day + 1 WHERE a.op IS NULL OR b.op IS NULL) WHERE day BETWEEN 2 AND 30 GROUP BY ns, day""")
def schema_change(spark, sf):
    """What each daily snapshot adds to and lacks of the one before."""
    s = d.change_log(spark, sf).select("ns", "op", F.dayofmonth("ts").alias("day")).distinct()
    old = s.withColumn("day", F.col("day") + 1)
    new_ = s.join(old, ["ns", "op", "day"], "left_anti").select("ns", "day", F.concat(F.lit("+"), "op").alias("c"), "op")
    gone = old.join(s, ["ns", "op", "day"], "left_anti").select("ns", "day", F.concat(F.lit("-"), "op").alias("c"), "op")
    g = new_.unionByName(gone).where("day between 2 and 30").groupBy("ns", "day").agg(F.array_sort(F.collect_list(F.struct("op", "c"))).alias("x"))
    return g.select("ns", "day", F.array_join(F.transform("x", lambda v: v["c"]), ",").alias("changes"))


# --- sets ---


@query("SELECT 'left' AS side, c_nationkey AS k FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal < -950 EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'right', s_nationkey FROM (SELECT DISTINCT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal < -950)")
def except_both(spark, sf):
    a = load(spark, sf, "customer").where("c_acctbal < -950").select(F.col("c_nationkey").alias("k")).distinct()
    b = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")).distinct()
    return a.subtract(b).select(F.lit("left").alias("side"), "k").unionByName(b.subtract(a).select(F.lit("right").alias("side"), "k"))


@query("SELECT ns, name, 'left' AS side FROM (SELECT ns, name, key, uniq, sparse, ttl FROM ispec_a EXCEPT SELECT ns, name, key, uniq, sparse, ttl FROM ispec_b) UNION ALL SELECT ns, name, 'right' FROM (SELECT ns, name, key, uniq, sparse, ttl FROM ispec_b EXCEPT SELECT ns, name, key, uniq, sparse, ttl FROM ispec_a)")
def sym_diff(spark, sf):
    return catalogs.symmetric_difference(*d.index_specs(spark, sf)).select("ns", "name", "side")


@query("SELECT DISTINCT p_type AS name FROM part WHERE p_size > 25 EXCEPT SELECT p_type FROM part WHERE p_brand = 'Brand#1' AND p_size > 48")
def except_new(spark, sf):
    p = load(spark, sf, "part")
    return p.where("p_size > 25").select(F.col("p_type").alias("name")).subtract(p.where("p_brand = 'Brand#1' and p_size > 48").select(F.col("p_type").alias("name")))


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def intersect_persist(spark, sf):
    o = load(spark, sf, "orders")
    of = lambda s: o.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return of("F").intersect(of("P"))


# --- namespaces ---


@query("SELECT seq, ns FROM log WHERE ns NOT LIKE 'config.%' AND ns NOT LIKE 'admin.%' AND (ns = 'db1.c1' OR ns LIKE 'db2.%')")
def ns_include_filter(spark, sf):
    x = d.change_log(spark, sf)
    return x.where(~is_system_db(ns_db("ns")) & (F.col("ns").isin("db1.c1") | ns_db("ns").isin("db2"))).select("seq", "ns")


@query("SELECT DISTINCT ns, ns LIKE 'config.%' OR ns LIKE 'admin.%' AS system FROM log")
def sysdb_filter(spark, sf):
    return d.change_log(spark, sf).select("ns", is_system_db(ns_db("ns")).alias("system")).distinct()


@query("SELECT ns, CAST(count(*) AS BIGINT) AS n FROM log WHERE NOT regexp_matches(ns, '^(admin|config|local)\\.|\\.system\\.') GROUP BY ns")
def ns_regex_filter(spark, sf):
    return d.change_log(spark, sf).where(~F.col("ns").rlike(r"^(admin|config|local)\.|\.system\.")).groupBy("ns").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT ns, shard, uuid FROM colls WHERE split_part(ns, '.', 1) IN ('db1', 'db3')")
def filter_by_db(spark, sf):
    return d.collections(spark, sf).where(F.split("ns", r"\.")[0].isin("db1", "db3"))


# --- totals ---


@query("""SELECT coalesce(x.ns, NULL) AS ns, CAST(count(*) AS BIGINT) AS indexes, CAST(count(*) FILTER (kind IS NULL) AS BIGINT) AS equal, CAST(count(*) FILTER (kind = 'missing') AS BIGINT) AS missing, CAST(count(*) FILTER (kind = 'ttl') AS BIGINT) AS ttl_only,
    CAST(count(*) FILTER (kind = 'other') AS BIGINT) AS other, CAST(count(DISTINCT CASE WHEN NOT there THEN x.ns END) AS BIGINT) AS missing_namespaces FROM
    (SELECT a.ns, a.ns <> 'Brand#2' AS there, CASE WHEN a.ns = 'Brand#2' OR a.ns = 'Brand#6' AND a.name = 'LARGE' THEN 'missing' WHEN a.uniq <> b.uniq OR a.sparse <> b.sparse THEN 'other' WHEN a.ttl IS DISTINCT FROM b.ttl THEN 'ttl' END AS kind
      FROM ispec_a a LEFT JOIN ispec_b b USING (ns, name, key)) x GROUP BY ROLLUP (x.ns)""")
def index_totals(spark, sf):
    """How many indexes of each namespace are equal, missing or differ, namespaces that are missing altogether, and all in all."""
    a, b = d.index_specs(spark, sf)
    b = b.where("ns <> 'Brand#2'")
    return catalogs.index_totals(a, b, b)


NS_COUNTS = """WITH a AS (SELECT CASE k % 7 WHEN 5 THEN 'admin' WHEN 6 THEN 'db6' ELSE 'db' || (k % 7) END || CASE WHEN k % 11 = 0 THEN '.system.views' ELSE '.c' || (k % 3) END AS ns, count(*) AS src FROM src GROUP BY 1),
    b AS (SELECT CASE k % 7 WHEN 5 THEN 'admin' ELSE 'db' || (k % 7) END || CASE WHEN k % 11 = 0 THEN '.system.views' ELSE '.c' || (k % 3) END AS ns, count(*) AS dst FROM dst WHERE k % 7 <> 6 AND NOT (k % 7 = 3 AND k % 3 = 1) GROUP BY 1),
    x AS (SELECT split_part(a.ns, '.', 1) AS db, a.ns, src, CASE WHEN a.ns NOT LIKE 'db6.%' THEN coalesce(dst, 0) END AS dst FROM a LEFT JOIN b ON a.ns = b.ns WHERE a.ns NOT LIKE 'admin.%' AND a.ns NOT LIKE '%.system.%'),
    y AS (SELECT 'collection' AS level, ns AS name, src, dst FROM x WHERE dst IS NOT NULL UNION ALL SELECT 'database', db, sum(src), sum(dst) FROM x GROUP BY db UNION ALL SELECT 'all', 'ALL', sum(src), sum(dst) FROM x WHERE dst IS NOT NULL)
    SELECT level, name, CAST(src AS BIGINT) AS src, CAST(dst AS BIGINT) AS dst, CAST(src - dst AS BIGINT) AS delta, CASE WHEN dst IS NULL THEN 'missing' WHEN src = dst THEN 'match' ELSE 'mismatch' END AS status FROM y"""


@query(NS_COUNTS)
def count_totals(spark, sf):
    """Documents of each collection and database on both sides; one database is missing, one collection too."""
    k = F.col("k")
    ns = F.concat(F.when(k % 7 == 5, "admin").otherwise(F.concat(F.lit("db"), k % 7)), F.when(k % 11 == 0, ".system.views").otherwise(F.concat(F.lit(".c"), k % 3)))
    of = lambda df: df.groupBy(ns.alias("ns")).agg(F.count(F.lit(1)).alias("docs"))
    return catalogs.count_totals(of(d.source(spark, sf)), of(d.dest(spark, sf).where("k % 7 <> 6 and not (k % 7 = 3 and k % 3 = 1)")))


NINE = ("namespace", "cacheMB", "dirtyMB", "dataGB", "idxGB", "dirty%", "idxDty%", "readMB", "writMB", "other")
NINE_SQL = {"namespace": None, "cacheMB": "cache", "dirtyMB": "dirty", "dataGB": "data", "idxGB": "idx", "dirty%": "dirty / nullif(cache, 0)", "idxDty%": "idirty / nullif(icache, 0)", "readMB": "rd", "writMB": "wr", "other": "cache"}
NINE_STATS = """SELECT ns, shard, CAST(sum(size) AS DOUBLE) AS cache, CAST(sum(size) FILTER (seq % 3 = 0) AS DOUBLE) AS dirty, CAST(sum(seq) AS DOUBLE) AS data, CAST(sum(seq) FILTER (seq % 5 = 0) AS DOUBLE) AS idx,
    CAST(sum(size) FILTER (seq % 7 = 0) AS DOUBLE) AS icache, CAST(sum(size) FILTER (seq % 21 = 0) AS DOUBLE) AS idirty, CAST(sum(size) FILTER (op = 'u') AS DOUBLE) AS rd, CAST(sum(size) FILTER (op = 'i') AS DOUBLE) AS wr FROM log GROUP BY ns, shard"""


@query(f"SELECT * FROM (WITH s AS ({with_inputs(NINE_STATS)}) " + " UNION ALL ".join(f"(SELECT '{n}' AS sort, ns, shard, CAST(row_number() OVER (ORDER BY {'ns' if NINE_SQL[n] is None else f'coalesce({NINE_SQL[n]}, 0) DESC'}, ns, shard) AS INTEGER) AS rn FROM s QUALIFY rn <= 4)" for n in NINE) + ")")
def topn_each_metric(spark, sf):
    """The first four collections by each of the nine metrics, and by a name that is none."""
    log, size, seq = d.change_log(spark, sf), F.col("size"), F.col("seq")
    some = lambda x, cond, name: F.sum(F.when(F.expr(cond), x)).alias(name)
    stats = log.groupBy("ns", "shard").agg(
        F.sum(size).alias("cache_bytes"), some(size, "seq % 3 = 0", "dirty_bytes"), F.sum(seq).alias("data_bytes"), some(seq, "seq % 5 = 0", "index_bytes"),
        some(size, "seq % 7 = 0", "index_cache_bytes"), some(size, "seq % 21 = 0", "index_dirty_bytes"), some(size, "op = 'u'", "read_bytes"), some(size, "op = 'i'", "written_bytes"),
    )
    out = None
    for name in NINE:
        top = stats.orderBy(*metrics.sorted_by(stats, name)).limit(4)
        one = top.select(F.lit(name).alias("sort"), "ns", "shard", F.row_number().over(Window.orderBy(*metrics.sorted_by(top, name))).alias("rn"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT ns, name, CAST(CASE WHEN ttl IS NOT NULL THEN 1576800000 END AS BIGINT) AS ttl, CASE WHEN ttl IS NOT NULL THEN 'PT438000H' END AS shown FROM ispec_a WHERE ttl IS NOT NULL")
def ttl_extend(spark, sf):
    """Expiring indexes with the fifty years that they get while data moves."""
    from tidemark.functions import scalars as s

    x = d.index_specs(spark, sf)[0].where("ttl is not null").select("ns", "name", s.extended_ttl("ttl").alias("ttl"))
    return x.withColumn("shown", s.ttl_text("ttl"))
