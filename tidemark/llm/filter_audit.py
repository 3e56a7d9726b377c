"""Filter interaction audit: what each filter removes in every order of application, from one SQL CUBE.

Every document gets one failure flag a filter. Documents are first summed by (part, flags); a CUBE over the flags and
the part then gives, in the grouping-set rows whose selected flags are all false, how many documents survive each subset
of the filters. A step of an order is a pair of subsets, before and after its filter, so every count of every order is
a join of those few rows, and no document is looked at again.

A null text is empty (no words; equal to other empty texts), a null source is the part "". A null doc_id is smaller than
no other and no other is smaller than it, so such a row never fails E, nor makes another fail it; it has no label. Rows
that repeat a doc_id count as documents of their own; the rows with the smallest doc_id of a text do not fail E. Of several labels of a
document the highest of each kind counts. Very long texts are one row like any other. Texts are told apart by SHA-256. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import materialize, own_text_exchange

SPACE = "\\x20\\x09-\\x0D"
#: Fixed failure conditions: words, distinct words and capitals in percent, characters.
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER, MARKS = 200, 50, 2, "#$%&*|"
FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """Flags A to D of one text, from itself alone."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_UPPER * F.length(text),
        "D": text.rlike(f"[{MARKS}]"),
    }


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A to E, n, good, toxic): how many documents of a part have just these flags, and how they are labelled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    x = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), *[c.alias(k) for k, c in text_failures(text).items()])
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic"))
    x = x.join(marks, F.col("doc_id") == F.col("_id"), "left")
    x = x.withColumns({"good": F.coalesce("_good", F.lit(False)), "toxic": F.coalesce("_toxic", F.lit(False))})
    kind = ["digest", "part", "A", "B", "C", "D", "good", "toxic"]
    x = x.groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("rows"))
    # a text's copies are summed by part and label before its smallest doc_id is sought: a hot text becomes a few rows a part
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows"))).alias("first")
    x = x.groupBy(*kind).agg(F.sum("rows").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("nameless"), first)
    x = materialize(x, "audit")  # read twice; no text is
    least = x.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    x = x.join(least.select(own_text_exchange("digest").alias("_digest"), "least"), F.col("digest") == F.col("_digest"))
    passing = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.rows")).otherwise(0)
    x = x.select("part", "A", "B", "C", "D", "good", "toxic", F.explode(F.array(F.struct(F.lit(False).alias("E"), passing.alias("n")), F.struct(F.lit(True).alias("E"), (F.col("n") - passing).alias("n")))).alias("e"))
    x = x.select("part", "A", "B", "C", "D", "e.E", "good", "toxic", "e.n").where("n > 0")
    return x.groupBy("part", *FILTERS).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def survivors(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, subset, n, good, toxic): documents that pass every filter of each subset; bit i of ``subset`` is filter i.

    ``counts``: part, a boolean that is never null for each filter, and the counts.
    """
    cube = counts.cube(*filters, "part").agg(*[F.sum(c).alias(c) for c in COUNTS], F.grouping("part").alias("_all"), *[(1 - F.grouping(f)).alias(f"_{f}") for f in filters])
    clear = F.lit(True)
    for f in filters:
        clear = clear & ((F.col(f"_{f}") == 0) | ~F.col(f))
    subset = sum((F.col(f"_{f}").cast("int") * (1 << i) for i, f in enumerate(filters)), F.lit(0))
    found = cube.where((F.col("_all") == 0) & clear).select("part", subset.alias("subset"), *COUNTS)
    # a subset that nobody survives has no such row; the empty one has a row for every part
    every = found.where("subset = 0").select(F.col("part").alias("_part"), F.explode(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))).alias("_subset"))
    both = every.join(found, (F.col("_part") == F.col("part")) & (F.col("_subset") == F.col("subset")), "left")
    return both.select(F.col("_part").alias("part"), F.col("_subset").alias("subset"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COUNTS])


def steps(spark, filters: str = FILTERS) -> DataFrame:
    """(filter_order, step, before, after, others): one row a step of each order, as subsets of filters."""
    bit, rows = {f: 1 << i for i, f in enumerate(filters)}, []
    for order in permutations(filters):
        before = 0
        for k, f in enumerate(order):
            rows.append(f"('{''.join(order)}', {k + 1}, {before}, {before | bit[f]}, {((1 << len(filters)) - 1) & ~bit[f]})")
            before |= bit[f]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(filter_order, step, before, after, others)")


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, as joins of pairs of subsets; ``counts`` as for ``survivors``."""
    alive = materialize(survivors(counts, filters), "audit", few=True)  # 2 ** len(filters) rows a part, joined several times
    at = lambda name: alive.select(F.col("part").alias(f"part_{name}"), F.col("subset").alias(f"subset_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in COUNTS])

    def pair(x: DataFrame, name: str, subset: str) -> DataFrame:
        return x.join(at(name), (F.col("part") == F.col(f"part_{name}")) & (F.col(subset) == F.col(f"subset_{name}")))

    full = (1 << len(filters)) - 1
    x = F.broadcast(steps(counts.sparkSession, filters))  # len(filters)! rows times their length, whatever the input
    x = at("was").join(x, F.col("subset_was") == F.col("before")).withColumn("part", F.col("part_was"))
    x = pair(x, "is", "after")
    x = x.withColumns({"removed": F.col("n_was") - F.col("n_is"), "own": F.col("after").bitwiseXOR(F.col("before")), "nothing": F.lit(0), "full": F.lit(full)})
    x = pair(pair(pair(pair(x, "none", "nothing"), "own", "own"), "others", "others"), "full", "full")
    # over all orders a filter comes right after the subset S in |S|! (k - 1 - |S|)! of them
    k = len(filters)
    weight = lambda s: factorial(bin(s).count("1")) * factorial(k - 1 - bin(s).count("1"))
    values = ", ".join(f"({s}, {s | 1 << i}, {1 << i}, {weight(s)})" for s in range(1 << k) for i in range(k) if not s >> i & 1)
    w = F.broadcast(counts.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(before, after, one, weight)"))
    share = at("was").join(w, F.col("subset_was") == F.col("before")).withColumn("part", F.col("part_was"))
    share = pair(share, "is", "after").groupBy(F.col("part").alias("_part"), F.col("one").alias("_one")).agg(F.sum((F.col("n_was") - F.col("n_is")) * F.col("weight")).alias("shapley"))
    x = x.join(share, (F.col("part") == F.col("_part")) & (F.col("own") == F.col("_one")))
    return x.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), F.col("n_is").alias("kept"), "removed",
        (F.col("n_none") - F.col("n_own") - F.col("removed")).alias("redundant"), (F.col("n_others") - F.col("n_full")).alias("unique_fails"),
        (F.col("good_was") - F.col("good_is")).alias("good_lost"), (F.col("toxic_was") - F.col("toxic_is")).alias("toxic_lost"), "shapley",
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(flagged(docs, labels))


#: Each document is taken through each order by its first failing step.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS ws FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
f AS (SELECT d.part, len(ws) < 200 AS fa, 100 * len(list_distinct(ws)) < 50 * len(ws) AS fb, 100 * (length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g'))) > 2 * length(d.text) AS fc,
  regexp_matches(d.text, '[#$%&*|]') AS fd, coalesce(d.doc_id > m.least, false) AS fe, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM d JOIN m ON d.text = m.text LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (SELECT part, (CASE WHEN fa THEN 'A' ELSE '' END) || (CASE WHEN fb THEN 'B' ELSE '' END) || (CASE WHEN fc THEN 'C' ELSE '' END) || (CASE WHEN fd THEN 'D' ELSE '' END) || (CASE WHEN fe THEN 'E' ELSE '' END) AS fails,
  good, toxic, count(*) AS n FROM f GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c, c d, c e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i] AS letter FROM o, (SELECT unnest(range(1, 6)) AS i)),
p AS (SELECT DISTINCT part FROM g),
gone AS (SELECT g.*, o.filter_order, coalesce(list_min([instr(o.filter_order, z) FOR z IN string_split(fails, '')]), 9) AS first FROM g, o WHERE fails <> '' UNION ALL SELECT g.*, o.filter_order, 9 FROM g, o WHERE fails = ''),
r AS (SELECT q.part, s.filter_order, s.step, s.letter,
  CAST(coalesce(sum(n) FILTER (WHERE first > step), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (WHERE first = step), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (WHERE first < step AND contains(fails, letter)), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (WHERE fails = letter), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(n) FILTER (WHERE first = step AND good), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(n) FILTER (WHERE first = step AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM p q CROSS JOIN s JOIN gone ON gone.part = q.part AND gone.filter_order = s.filter_order GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r
"""
