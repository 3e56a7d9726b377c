"""Comparing catalogs: indexes, chunks, roles, identifiers, snapshots and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import is_system_db, ns_db
from tidemark.operators.small import dealt, small


def index_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Specs of ``a`` without an equal one in ``b``, and in what the one of the same name and key differs."""
    o = b.select("ns", "name", "key", F.struct("uniq", "sparse", "ttl").alias("o"))
    x = a.join(o, ["ns", "name", "key"], "left")
    ttl, uniq, sparse = ~F.col("ttl").eqNullSafe(F.col("o.ttl")), F.col("uniq") != F.col("o.uniq"), F.col("sparse") != F.col("o.sparse")
    kind = F.when(F.col("o").isNull(), "missing").when(ttl & ~uniq & ~sparse, "ttl").when(uniq & ~ttl & ~sparse, "unique").when(sparse & ~ttl & ~uniq, "sparse").when(ttl | uniq | sparse, "other")
    return x.select("ns", "name", kind.alias("diff_kind")).where("diff_kind is not null")


def index_totals(a: DataFrame, b: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Per namespace of ``a``: its indexes, those that are equal, missing or differ (by expiry alone or otherwise), and whether ``namespaces`` (ns), what the other side has, lacks it; the indexes of such a namespace are all missing. A row without ns sums them up."""
    diffs = index_diff(a, b).withColumnRenamed("diff_kind", "kind")
    there = namespaces.select("ns").distinct().withColumn("_there", F.lit(True))
    n = lambda kind: F.count_if(kind)
    x = a.select("ns", "name").join(diffs, ["ns", "name"], "left").join(there, "ns", "left")
    per = x.groupBy("ns").agg(
        F.count(F.lit(1)).alias("indexes"), n(F.col("kind").isNull()).alias("equal"), n(F.col("kind") == "missing").alias("missing"), n(F.col("kind") == "ttl").alias("ttl_only"),
        n(F.col("kind").isin("unique", "sparse", "other")).alias("other"), F.max(F.col("_there").isNull().cast("int")).cast("long").alias("missing_namespaces"),
    )
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per.columns[1:]]
    return per.unionByName(per.agg(*sums).withColumn("ns", F.lit(None).cast("string")))


def count_totals(a: DataFrame, b: DataFrame) -> DataFrame:
    """(level, name, src, dst, delta, status) from counts (ns, docs): each collection of ``a``, each database of ``a``, and all.

    Driven by the source: what the destination has alone does not appear; a database that it lacks is ``missing``, and its
    collections and documents are in no sum. System databases and collections are left out.
    """
    user = lambda df: df.where(~is_system_db(ns_db("ns")) & ~F.col("ns").rlike(r"^[^.]*\.system\."))
    dst = user(b).groupBy("ns").agg(F.sum("docs").alias("dst"))
    dbs = b.select(ns_db("ns").alias("db")).distinct().withColumn("_there", F.lit(True))
    x = user(a).groupBy("ns").agg(F.sum("docs").alias("src")).join(dst, "ns", "left").withColumn("db", ns_db("ns")).join(dbs, "db", "left")
    here = F.col("_there").isNotNull()
    x = x.select("db", "ns", "src", F.when(here, F.coalesce("dst", F.lit(0))).alias("dst"), here.alias("here"))
    each = x.where("here").select(F.lit("collection").alias("level"), F.col("ns").alias("name"), "src", "dst")
    per = x.groupBy("db").agg(F.sum("src").alias("src"), F.sum("dst").alias("dst")).select(F.lit("database").alias("level"), F.col("db").alias("name"), "src", "dst")
    all_ = per.where("dst is not null").agg(F.coalesce(F.sum("src"), F.lit(0)).alias("src"), F.coalesce(F.sum("dst"), F.lit(0)).alias("dst")).select(F.lit("all").alias("level"), F.lit("ALL").alias("name"), "src", "dst")
    status = F.when(F.col("dst").isNull(), "missing").when(F.col("src") == F.col("dst"), "match").otherwise("mismatch")
    return each.unionByName(per).unionByName(all_).select("level", "name", "src", "dst", (F.col("src") - F.col("dst")).alias("delta"), status.alias("status"))


def chunk_diff(a: DataFrame, b: DataFrame, shard_map: DataFrame) -> DataFrame:
    """Each chunk of ``a`` with the shard that the map expects it on and the one that ``b`` has it on."""
    x = mapped(a.select("chunk_id", F.col("shard").alias("expected_shard")), "expected_shard", shard_map).join(b.select("chunk_id", F.col("shard").alias("actual_shard")), "chunk_id", "left")
    return x.withColumn("status", F.when(F.col("actual_shard").isNull(), "missing").when(F.col("actual_shard") != F.col("expected_shard"), "mismatched").otherwise("ok"))


def role_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Grants of ``a`` that a role present on both sides lacks in ``b``; roles that ``b`` lacks altogether are left out."""
    return a.join(b.select("role").distinct(), "role", "left_semi").join(b, ["role", "resource", "action"], "left_anti")


def canonical_roles(grants: DataFrame) -> DataFrame:
    return grants.groupBy("role", "resource").agg(F.array_join(F.array_sort(F.collect_set("action")), ",").alias("actions"))


def uuid_consistency(colls: DataFrame) -> DataFrame:
    """Every namespace and uuid with its shards; ok where a namespace has one uuid."""
    g = colls.groupBy("ns", "uuid").agg(F.array_join(F.array_sort(F.collect_set("shard")), ",").alias("shards"))
    n = g.groupBy("ns").agg((F.count(F.lit(1)) == 1).alias("ok"))
    return g.join(n, "ns")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def shard_map(sources: DataFrame, targets: DataFrame, explicit: list[str] | None = None, spread: bool = False) -> DataFrame:
    """(source, target) of shards, given as frames of one column ``shard``.

    Explicit entries ``a|b`` decide where they are given. Else shards are matched by position in name order, one to one; with
    ``spread`` sources are dealt to the targets in turn, however many there are. Shards are few, so one window numbers them.
    """
    if explicit is not None:
        pairs = [tuple(x.split("|", 1)) for x in explicit]
        return sources.select(F.col("shard").alias("source")).join(F.broadcast(sources.sparkSession.createDataFrame(pairs, "source string, target string")), "source")
    numbered = lambda df, name: df.select(F.col("shard").alias(name), (F.row_number().over(Window.orderBy("shard")) - 1).alias("_n"))
    s, t = numbered(sources, "source"), numbered(targets, "target")
    if not spread:
        return s.join(t, "_n").select("source", "target")
    size = targets.agg(F.count(F.lit(1)).alias("_size"))
    return s.join(F.broadcast(size)).withColumn("_n", F.col("_n") % F.col("_size")).join(t, "_n").select("source", "target")


def mapped(df: DataFrame, column: str, shard_map: DataFrame) -> DataFrame:
    """``df`` with the shards of ``column`` replaced by those that a map of few rows names; others keep theirs."""
    m = small(shard_map.select(F.col("source").alias("_source"), F.col("target").alias("_target")))
    return df.join(m, F.col(column) == F.col("_source"), "left").withColumn(column, F.coalesce("_target", column)).drop("_source", "_target")


def user_collections(entries: DataFrame) -> DataFrame:
    """Catalog entries (ns, type, ...) without views, system collections and system databases."""
    return entries.where((F.col("type") == "collection") & ~F.col("ns").rlike(r"^[^.]*\.system\.") & ~is_system_db(ns_db("ns")))


def catalog_totals(entries: DataFrame) -> DataFrame:
    """Collections, documents, bytes and indexes of each database, sharded and not, and in all."""
    kept = user_collections(entries).withColumn("db", ns_db("ns")).withColumn("sharded", F.when(F.col("sharded"), "sharded").otherwise("unsharded"))
    g = kept.rollup("db", "sharded").agg(F.count(F.lit(1)).alias("collections"), F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes"), F.sum("indexes").alias("indexes"))
    return g.select(F.coalesce("db", F.lit("ALL")).alias("db"), F.coalesce("sharded", F.lit("ALL")).alias("sharded"), "collections", "docs", "bytes", "indexes")


def hinted_index(indexes: DataFrame, shard_keys: DataFrame) -> DataFrame:
    """For each namespace the index with the fewest fields of those that hold all fields of the shard key (arrays ``fields`` and ``key_fields``).

    Both sides are dealt out by namespace once; neither is broadcast, as a catalog may have millions of collections.
    """
    rows = indexes.count()
    x = dealt(indexes, rows, "ns").join(dealt(shard_keys, rows, "ns").hint("merge"), "ns").where(F.size(F.array_except("key_fields", "fields")) == 0)
    return x.groupBy("ns").agg(F.min_by("name", F.struct(F.size("fields"), F.col("name"))).alias("name"))
