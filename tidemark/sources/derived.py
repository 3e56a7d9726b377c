"""Inputs of the dataflows, derived from the test tables: pairs, change logs, ranges, catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.small import dealt
from tidemark.sources.tables import load

ROW = ("k", "cust", "status", "cents", "day", "prio")


def source(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("prio"),
    )


def dest(spark: SparkSession, d: str) -> DataFrame:
    """The source without some rows, with some changed and some added."""
    s = source(spark, d)
    changed = s.where("k % 97 <> 0").withColumn("cents", F.col("cents") + F.when(F.col("k") % 89 == 0, 100).otherwise(0))
    return changed.unionByName(s.where("k % 101 = 0").withColumn("k", F.col("k") + 100000000))


def change_log(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    return log_of(e)


def log_of(e: DataFrame) -> DataFrame:
    """Change-log rows of an events table or stream."""
    op = F.when(F.col("event_type") == "signup", "i").when(F.col("event_type").isin("click", "view"), "u").when(F.col("event_type") == "purchase", "d").when(F.col("event_id") % 2 == 0, "n").otherwise("c")
    ns = F.when(F.col("user_id") % 29 == 0, "config.chunks").when(F.col("user_id") % 31 == 0, "admin.users").otherwise(F.concat(F.lit("db"), F.col("user_id") % 3, F.lit(".c"), F.col("user_id") % 5))
    return e.select(
        F.col("event_id").alias("seq"), "ts", F.col("user_id").alias("id"), op.alias("op"), ns.alias("ns"), F.length("props").cast("long").alias("size"),
        F.concat(F.lit("shard"), F.col("user_id") % 4).alias("shard"), (F.col("event_id") % 37 == 0).alias("from_migrate"), "value",
    )


def ranges(spark: SparkSession, d: str, n: int = 16) -> DataFrame:
    """Equal key ranges of orders; the last is open above, neighbours in twos share a shard."""
    width = load(spark, d, "orders").agg(F.ceil((F.max("o_orderkey") + 1) / float(n)).cast("long").alias("w"))
    i = F.col("id")
    return spark.range(n).join(F.broadcast(width)).select(
        "id", F.lit("db.orders").alias("ns"), (i * F.col("w")).alias("lo"), F.when(i < n - 1, (i + 1) * F.col("w")).alias("hi"),
        F.concat(F.lit("shard"), F.floor(i / 2) % 3).alias("shard"), (i == 7).alias("jumbo"),
    )


def user_ranges(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(8).select("id", (i * 20).alias("lo"), F.when(i < 7, (i + 1) * 20).alias("hi"), F.concat(F.lit("shard"), i % 3).alias("shard"))


def duplicated(spark: SparkSession, d: str) -> DataFrame:
    """Orders with injected copies of some keys, in partitions by key whose number grows with the table."""
    s = source(spark, d).select("k", "cust", "status", "cents")
    again = lambda step, part: s.where(F.col("k") % step == 0).withColumn("cents", F.col("cents") + (part - 1)).withColumn("part", F.lit(part))
    return dealt(s.withColumn("part", F.lit(1)).unionByName(again(50, 2)).unionByName(again(200, 3)), load(spark, d, "orders").count(), "k")


def sessions(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer")
    k = F.col("c_custkey")
    app = F.coalesce(F.when(k % 13 != 0, F.col("c_mktsegment")), F.lit("(no appName)"))
    client = F.concat(F.lit("10.0."), k % 7, F.lit("."), k % 11, F.lit(":"), 20000 + k)
    return c.select(
        k.alias("id"), app.alias("app"), F.concat(F.lit("user"), F.col("c_nationkey")).alias("usr"), F.regexp_extract(client, "^(.*):[^:]*$", 1).alias("ip"),
        F.concat(F.when(k % 4 == 0, "java 4.").otherwise("python 3."), k % 3).alias("driver"), F.when(k % 5 == 0, "command").otherwise("query").alias("op"),
        (F.col("c_acctbal") > 0).alias("active"), F.when(k % 17 != 0, F.col("c_acctbal").cast("long")).alias("secs"),
    )


def index_stats(spark: SparkSession, d: str) -> DataFrame:
    """One row per index and node role, as collected from the nodes."""
    p = load(spark, d, "part")
    role = F.when(F.col("p_partkey") % 4 == 0, "primary").when(F.col("p_partkey") % 4 == 1, "secondary")
    ops = F.when(role == "primary", F.col("p_size") % 5).when(role == "secondary", F.col("p_size") % 3).otherwise(0)
    db = F.concat(F.lit("db"), F.col("p_partkey") % 2)
    return p.select(db.alias("db"), F.concat(db, F.lit("."), F.col("p_brand")).alias("ns"), F.col("p_type").alias("name"), role.alias("role"), ops.cast("long").alias("ops"), (F.col("p_size").cast("long") * 1024).alias("size_bytes"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(p_size)").alias("since"), (F.col("p_type") == "SMALL").alias("shard_key"))


def index_specs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = F.col("p_type")
    a = load(spark, d, "part").select(F.col("p_brand").alias("ns"), t.alias("name"), F.concat(t, F.lit("_1")).alias("key"), (t == "PROMO").alias("uniq"), F.lit(False).alias("sparse"), F.when(t == "ECONOMY", 86400).alias("ttl")).distinct()
    b = a.where("not (ns = 'Brand#6' and name = 'LARGE')").select(
        "ns", "name", "key", F.when(F.col("ns") == "Brand#3", ~F.col("uniq")).otherwise(F.col("uniq")).alias("uniq"), (F.col("ns") == "Brand#4").alias("sparse"),
        F.when((F.col("ns") == "Brand#5") & F.col("ttl").isNotNull(), 172800).otherwise(F.col("ttl")).alias("ttl"),
    )
    return a, b


def chunk_catalogs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = ranges(spark, d).select(F.format_string("%s_%d_%s", "ns", "lo", F.coalesce(F.col("hi").cast("string"), F.lit("max"))).alias("chunk_id"), "ns", "shard")
    b = a.where(~F.col("chunk_id").startswith("db.orders_0_")).withColumn("shard", F.when(F.col("chunk_id").endswith("max"), "shard9").otherwise(F.col("shard")))
    return a, b


def grants(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    action = F.when(k == 1, "insert").when(k == 2, "update").when(k == 3, "remove").otherwise("find")
    return load(spark, d, "customer").select(F.concat(F.lit("role"), F.col("c_nationkey")).alias("role"), F.concat(F.lit("db"), F.col("c_custkey") % 2, F.lit("."), F.lower("c_mktsegment")).alias("resource"), action.alias("action")).distinct()


def collections(spark: SparkSession, d: str) -> DataFrame:
    """(ns, shard, uuid) as each shard's catalog has it; some namespaces disagree."""
    n, s = F.col("s_nationkey"), F.col("s_suppkey")
    odd = F.when((n % 7 == 0) & (s % 3 == 1), "x").otherwise("")
    return load(spark, d, "supplier").select(F.concat(F.lit("db"), n % 4, F.lit(".n"), n).alias("ns"), F.concat(F.lit("shard"), s % 3).alias("shard"), F.md5(F.concat(F.lit("n"), n, odd)).alias("uuid"))


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Monotone counters by entity, as sampled over time."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    u = F.col("user_id")
    return load(spark, d, "events").select(
        u.alias("entity"), "ts", F.col("event_id").alias("seq"), F.concat(F.lit("shard"), u % 4).alias("shard"), F.concat(F.lit("db"), u % 3, F.lit(".c"), u % 5).alias("ns"),
        F.sum(F.round(F.col("value") * 100).cast("long")).over(w).alias("counter"),
    )
