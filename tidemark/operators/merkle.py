"""Comparing two tables by a tree of hashes over key ranges: equal ranges are never opened, so their rows never move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.small import small
from tidemark.sources.work import stored

#: Children of a node and rows of a leaf that are looked at one by one.
FANOUT, LEAF_ROWS = 64, 1000
#: Differing nodes that the driver may hold as a plan's literal; with more, they are joined, 64 a row.
MOST_NODES = 4096


def words(*hashes: str) -> list[Column]:
    """Sums of hashes in words of 24 bits at most: they fit 64 bits up to 2^39 rows and do not depend on the order of rows."""
    return [F.sum(F.shiftrightunsigned(x, at).bitwiseAND(0xFFFFFF)) for x in hashes for at in (0, 24, 48)]


def node_sums(rows: DataFrame, node: Column, name: str) -> DataFrame:
    """One row a node: how many rows it has and the sums of their hashes of 128 bits; partial sums are made before the shuffle.

    The key is part of what is summed, as rows of other keys may have equal values.
    """
    k = F.col("k").cast("string")
    both = rows.select(node.alias("node"), F.xxhash64(k, "h").alias("_x"), F.xxhash64(F.lit(1), k, "h").alias("_y"))
    return both.groupBy("node").agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.array(*words("_x", "_y")).alias(f"{name}_sum"))


def both_sums(source: DataFrame, dest: DataFrame, node: Column) -> DataFrame:
    """(node, source_rows, source_sum, dest_rows, dest_sum) of the nodes of either side; what a side lacks is null."""
    return node_sums(source, node, "source").join(node_sums(dest, node, "dest"), "node", "full_outer")


def parents(leaves: DataFrame, fanout: int) -> DataFrame:
    """The nodes above ``leaves``, ``fanout`` to one: rows and sums add up, so no row of a table is read again."""
    sums = [F.sum(F.col(c)[i]).alias(f"_{c}{i}") for c in ("source_sum", "dest_sum") for i in range(6)]
    x = leaves.groupBy(F.expr(f"node div {fanout}").alias("node")).agg(*[F.sum(c).alias(c) for c in ("source_rows", "dest_rows")], *sums)
    whole = lambda c: F.when(F.col(f"_{c}0").isNotNull(), F.array(*[F.col(f"_{c}{i}") for i in range(6)])).alias(c)
    return x.select("node", "source_rows", whole("source_sum"), "dest_rows", whole("dest_sum"))


def differing(sums: DataFrame) -> DataFrame:
    """(node, source_rows, dest_rows) of the nodes whose hashes differ, or that one side has alone."""
    return sums.where(~F.col("source_sum").eqNullSafe(F.col("dest_sum"))).select("node", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("dest_rows", F.lit(0)).alias("dest_rows"))


def packed(nodes: DataFrame) -> DataFrame:
    """(_word, _bits): 64 neighbouring nodes a row, a bit for each."""
    return nodes.groupBy(F.expr("node div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(node % 64 as int))")).alias("_bits"))


def under(rows: DataFrame, nodes: DataFrame | None, few: list | None, node: Column) -> DataFrame:
    """The rows of some nodes: by a literal list, or by the bits of ``packed`` nodes if there are many; both are applied in the scan's stage."""
    if few is not None:
        return rows.where(node.isin(few))
    x = rows.withColumn("_node", node)
    return x.join(nodes, F.expr("_node div 64 = _word and bit_get(_bits, cast(_node % 64 as int)) = 1"), "left_semi").drop("_node")


def tree_diff(source: DataFrame, dest: DataFrame, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows that differ between two (k, h) tables, and the nodes opened: ((k, status), (level, node, source_rows, dest_rows)).

    A node of level i is a range of keys of width ``fanout`` ** (levels - i); keys that are no whole numbers have their place
    by a hash, which deals them evenly. The sums of the leaves of both sides are made in one pass over each and stored, a row a leaf;
    the sums of the levels above are added up from them, so the rows are not read again for a level. Level by level only nodes under
    one that differs are opened. Then the rows of differing leaves are joined; rows elsewhere are filtered out where they are read.
    Rows with a null key are one leaf that is always opened. A list of at most ``MOST_NODES`` leaves is kept in the driver.
    """
    spark = source.sparkSession
    whole = dict(source.dtypes)["k"] in ("tinyint", "smallint", "int", "bigint")
    place = F.col("k").cast("long") if whole else F.when(F.col("k").isNotNull(), F.shiftrightunsigned(F.xxhash64("k"), 1))
    source, dest = (x.select("k", "h", place.alias("_at")) for x in (source, dest))
    ends = source.select("_at").unionByName(dest.select("_at")).agg(F.min("_at").alias("lo"), F.max("_at").alias("hi"), F.count("_at").alias("n")).first()
    seen = spark.createDataFrame([], "level int, node long, source_rows long, dest_rows long")
    nulls = lambda x: x.where("k is null")
    left, right = source, dest
    if ends["n"]:
        span, rows_a_key = ends["hi"] - ends["lo"] + 1, max(1, ends["n"] // 2)
        leaf = max(1, leaf_rows * span // rows_a_key)  # keys that hold about so many rows if they lie evenly
        widths = []
        while leaf < span:
            widths.append(leaf)
            leaf *= fanout
        node = F.expr(f"(_at - {ends['lo']}) div {(widths or [span])[0]}")
        filled = lambda x: x.where("k is not null")
        leaves = stored(both_sums(filled(left), filled(right), node), "leaves")
        levels = [leaves]
        for _ in widths[1:]:
            levels.append(parents(levels[-1], fanout))
        known = None
        for level, sums in enumerate(reversed(levels)):
            opened = differing(sums)
            if known is not None:
                opened = opened.join(known.select(F.col("node").alias("_parent")), F.expr(f"node div {fanout}") == F.col("_parent"), "left_semi")
            known = opened
            seen = seen.unionByName(known.select(F.lit(level).cast("int").alias("level"), "node", "source_rows", "dest_rows"))
        differ = differing(leaves).select("node")
        found = differ.limit(MOST_NODES + 1).collect()
        few = [r["node"] for r in found] if len(found) <= MOST_NODES else None
        many = None if few is not None else small(stored(packed(differ), "words"))
        left, right = under(filled(left), many, few, node), under(filled(right), many, few, node)
        left, right = left.unionByName(nulls(source)), right.unionByName(nulls(dest))
    from tidemark.operators.diff import full_diff

    return full_diff(left, right).where("status <> 'match'").select("k", "status"), seen
