"""Mixing sources to target weights by Pareto order sampling; DataFrame functions only.

Sources share the corpus's size by weight, no source above ``max_copies`` times its own size. Of each
source every document is taken ``floor(target / size)`` whole times for certain; what is left of the
target is a fixed-size order sample: documents rank by random odds divided by inclusion odds, and the
ranks up to the prefix that comes nearest to what is left are taken once more. Inclusion probabilities fall
with the square root of a document's size class, so that single long documents move a source's total less;
their level is solved for each source so that the expected size is exactly what is left, classes that
would exceed one being certain.

Random numbers come from a digest of the seed and doc_id (of the text where that is null), so reruns and
repartitioned inputs agree. A null text has size 0, a null source is a source, a very long text counts like
any other, an empty table gives an empty result, equal rows rank next to each other, other columns are
carried along unless they are named like a result. One row a source and size class (half octaves) is what is
ordered in one task; sources themselves are ordered in one task too, so they should be millions at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._io import materialize

SPACE = "\\x20\\x09-\\x0D"
WEIGHTS, MAX_COPIES, SEED = (5, 2, 1), 3, "mix-1"
#: Buckets of the rank in which sizes are summed before exact ranking, twice: only rows of one bucket in a bucket are sorted, a sixteen-millionth of a source.
BUCKETS = 4096
RESULTS = ("size", "source_size", "target", "copies")


def size_of(text: Column) -> Column:
    """Words of the whole text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, f"[{SPACE}]+"))).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """Per source: source_size, average size and target. One row per source, so one window holds them all.

    In the order of t = cap * size / weight, the level at a source is what those before it, all full, leave
    for it and the others, divided by their weight. The first source with t above its level sets the level of
    all from there on.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double"))
    by = by.withColumn("limit", (cap * F.col("source_size")).cast("double")).withColumn("t", F.col("limit") / F.col("weight"))
    order = Window.orderBy("t", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by = by.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    by = by.withColumn("before", F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    by = by.withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    by = by.withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
    by = by.withColumn("rank", F.row_number().over(order))
    level = F.min(F.when(F.col("t") > F.col("level"), F.struct("rank", "level"))).over(everything)["level"]
    by = by.withColumn("target", F.when(F.col("t") <= F.coalesce(level, F.lit(float("inf"))), F.col("limit")).otherwise(F.col("weight") * level))
    return by.select("source", "source_size", "n_docs", "target")


def inclusion(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """Per source and size class of what is left to sample: the inclusion probability.

    Classes with the highest weight are certain as long as the level that the others would need gives them one or more.
    """
    per = sized.where("size > 0").groupBy("source", size_class(F.col("size")).alias("class")).agg(F.sum("size").alias("s")).withColumnRenamed("source", "_s")
    per = per.join(goal.where("left > 0").select("source", "left"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    weight = F.pow(F.lit(2.0), -F.col("class") / 4)
    order = Window.partitionBy("source").orderBy("class")
    x = per.withColumn("weight", weight).withColumn("before", F.coalesce(F.sum("s").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    x = x.withColumn("rest", F.sum(F.col("s") * F.col("weight")).over(order.rowsBetween(0, Window.unboundedFollowing)))
    x = x.withColumn("level", (F.col("left") - F.col("before")) / F.col("rest"))
    # the first class (of the highest weight) whose probability is below one sets the level of all from there on
    first = F.min(F.when(F.col("level") * F.col("weight") < 1, F.struct("class", "level"))).over(Window.partitionBy("source"))
    x = x.withColumn("first", first)
    p = F.when(F.col("first").isNull() | (F.col("class") < F.col("first.class")), 1.0).otherwise(F.greatest(F.lit(0.0), F.col("first.level") * F.col("weight")))
    return x.select("source", "class", p.alias("p"))


def size_class(size: Column) -> Column:
    """Half octaves: 0 for 1, 2 for 2 and 3, 3 from 3 on, and so on."""
    return F.floor(2 * F.log2(size)).cast("int")


def edges(rows: DataFrame, bucket: Column) -> DataFrame:
    """Per source the bucket in which the sum of sizes reaches what is left, from sums of buckets, and what comes before it."""
    sums = rows.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("s"), F.max("need").alias("need"))
    run = Window.partitionBy("source").orderBy("b")
    sums = sums.withColumn("upto", F.sum("s").over(run)).withColumn("before", F.col("upto") - F.col("s"))
    return sums.where((F.col("before") < F.col("need")) & (F.col("upto") >= F.col("need"))).select(F.col("source").alias("e"), F.col("b").alias("edge"), "before")


def sample(docs: DataFrame, size: Column, weights=WEIGHTS, cap: int = MAX_COPIES, seed: str = SEED, mark: Column | None = None) -> DataFrame:
    """``docs`` with size, source_size, target and ``copies``, the times that the mix takes each document.

    ``mark`` is the text that a document's random number comes from, doc_id by default. The rows are written once
    to the shared folder, so pass ids and sizes rather than texts.
    """
    mark = F.coalesce(F.col("doc_id").cast("string"), F.lit("")) if mark is None else mark
    u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), mark)), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = materialize(docs.select(doc.alias("doc"), "source", size.alias("size"), u.alias("u")), "sized")
    goal = targets(sized.select("source", "size"), weights, cap)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = materialize(goal.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")), "goal")
    odds = inclusion(sized, goal).withColumnRenamed("source", "o")
    x = sized.join(goal.withColumnRenamed("source", "g"), F.col("source").eqNullSafe(F.col("g"))).drop("g")
    x = x.join(materialize(odds, "odds"), F.col("source").eqNullSafe(F.col("o")) & (size_class(F.col("size")) == F.col("class")), "left").drop("o", "class")
    q = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    x = x.withColumn("q", F.when((F.col("size") > 0) & (F.col("left") > 0) & (F.col("p") > 0), q / (1 + q)))
    x = x.withColumn("spot", F.col("q") * BUCKETS).withColumn("bucket", F.floor("spot").cast("int")).withColumn("fine", F.floor((F.col("spot") - F.col("bucket")) * BUCKETS).cast("int"))
    ranked = x.where("q is not null").withColumn("need", F.col("left"))
    coarse = materialize(edges(ranked, F.col("bucket")).select("e", F.col("edge").alias("coarse"), F.col("before").alias("before_coarse")), "edges")
    at = ranked.join(coarse, F.col("source").eqNullSafe(F.col("e")) & (F.col("bucket") == F.col("coarse"))).withColumn("need", F.col("left") - F.col("before_coarse")).drop("e")
    inner = edges(at, F.col("fine")).withColumnRenamed("before", "before_fine").withColumnRenamed("e", "f")
    # written, so that the planner knows its size: one row a source, which it broadcasts unless sources are very many
    edge = materialize(coarse.join(inner, F.col("e").eqNullSafe(F.col("f")), "left").drop("f"), "edges")
    x = x.join(edge, F.col("source").eqNullSafe(F.col("e")), "left").drop("e")
    # only rows of the fine bucket at the edge are ranked; of all others the buckets tell
    here = F.coalesce((F.col("bucket") == F.col("coarse")) & (F.col("fine") == F.col("edge")), F.lit(False))
    below = F.col("coarse").isNull() | (F.col("bucket") < F.col("coarse")) | ((F.col("bucket") == F.col("coarse")) & (F.col("edge").isNull() | (F.col("fine") < F.col("edge"))))
    outer = x.where(~here).withColumn("more", F.when(F.col("q").isNotNull() & below, 1).otherwise(0))
    run = Window.partitionBy("source").orderBy("q", "doc.doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    near = x.where(here).withColumn("upto", F.col("before_coarse") + F.col("before_fine") + F.sum("size").over(run))
    more = F.when((F.col("upto") <= F.col("left")) | (F.col("upto") - F.col("left") <= F.col("left") - (F.col("upto") - F.col("size"))), 1).otherwise(0)
    got = outer.unionByName(near.withColumn("more", more).drop("upto"))
    names = [c for c in docs.columns if c not in RESULTS]
    return got.select(*[F.col(f"doc.`{c}`").alias(c) for c in names], "size", "source_size", "target", (F.col("whole") + F.col("more")).cast("long").alias("copies"))


def mark_of(doc_id: Column, text: Column) -> Column:
    """What a document's random number comes from: its id, or its text where that is null."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of each document."""
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("words"), mark_of(F.col("doc_id"), F.col("text")).alias("mark"))
    got = sample(rows, F.col("words"), mark=F.col("mark"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, ''))) AS mark,
    CAST(coalesce(len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')), 0) AS BIGINT) AS size FROM documents),
by0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
by1 AS (SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM by0),
by2 AS (SELECT *, CAST(3 * source_size AS DOUBLE) AS lim, CAST(3 * source_size AS DOUBLE) / weight AS t, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM by1),
by3 AS (SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY t, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
  / sum(weight) OVER (ORDER BY t, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER (ORDER BY t, source NULLS LAST) AS rnk FROM by2),
by4 AS (SELECT by3.*, (SELECT arg_min(level, rnk) FROM by3 WHERE t > level) AS lv FROM by3),
by5 AS (SELECT source, source_size, CASE WHEN lv IS NULL OR t <= lv THEN lim ELSE weight * lv END AS target FROM by4),
goal AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM by5),
goal2 AS (SELECT *, target - whole * source_size AS rem FROM goal),
x AS (SELECT s.doc_id, s.source, s.size, g.source_size, g.target, g.whole, g.rem, CASE WHEN size > 0 THEN CAST(floor(2 * log2(size)) AS INTEGER) END AS class,
  (CAST(('0x' || substr(md5('mix-1|' || mark), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN goal2 g ON s.source IS NOT DISTINCT FROM g.source),
c0 AS (SELECT source, class, any_value(rem) AS rem, CAST(sum(size) AS DOUBLE) AS s, pow(2.0::DOUBLE, -class / 4) AS weight FROM x WHERE size > 0 AND rem > 0 GROUP BY source, class),
c1 AS (SELECT *, (rem - coalesce(sum(s) OVER (PARTITION BY source ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(s * weight) OVER (PARTITION BY source ORDER BY class ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c0),
c2 AS (SELECT *, min(CASE WHEN level * weight < 1 THEN class END) OVER (PARTITION BY source) AS fc, arg_min(level, class) FILTER (level * weight < 1) OVER (PARTITION BY source) AS fl FROM c1),
c3 AS (SELECT source, class, CASE WHEN fc IS NULL OR class < fc THEN 1.0 ELSE greatest(0.0, fl * weight) END AS p FROM c2),
y AS (SELECT x.*, u / (1 - u) * (1 - p) / p AS q0 FROM x JOIN c3 ON x.source IS NOT DISTINCT FROM c3.source AND x.class = c3.class WHERE size > 0 AND rem > 0 AND p > 0),
z AS (SELECT *, q0 / (1 + q0) AS q FROM y),
r AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM z),
m AS (SELECT doc_id, source, size, source_size, target, whole + CASE WHEN upto <= rem OR (upto - size < rem AND upto - rem <= rem - (upto - size)) THEN 1 ELSE 0 END AS copies FROM r
  UNION ALL SELECT doc_id, source, size, source_size, target, whole FROM x WHERE NOT (size > 0 AND rem > 0))
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM m
"""
