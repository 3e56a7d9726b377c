"""Quality rules: learned decision lists over text statistics; DataFrame functions only.

Sequential covering over labelled rows: each rule is a conjunction of thresholds that is grown for
information gain on one part of the labelled rows and pruned on the other, then the rows it covers
are taken out and the next is grown. The list becomes one Spark CASE expression. All statistics are
computed inside one row, so scoring a corpus has no shuffle at all.

A null text has no words, a very long one is one row like any other (its words and windows are arrays in that
row), an empty label table or one without low-quality rows learns no rules (all documents pass the method), an
empty table gives an empty result, a null doc_id has no label. Of thresholds with equal gain the first by feature
and value is taken, of rules that cover a document the first in the list speaks. Repeated rows give repeated
results, other columns are carried along. Repeated 8-word windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import materialize

SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Fixed base rule: fewer words, or a larger share of repeated words in percent.
LEAST_WORDS, MOST_REPEATED = 20, 30

FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "words_a_line": "n_words / greatest(n_lines, 1)",
    "words": "double(n_words)",
}


def with_stats(docs: DataFrame) -> DataFrame:
    """Adds the base statistics and those of the learned rules to each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    x = docs.withColumn("_words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+")))
    x = x.withColumn("n_words", F.size("_words").cast("long"))
    x = x.withColumn("_windows", F.expr(f"if(n_words < {WINDOW}, array(), transform(sequence(1, int(n_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))))"))
    # most texts repeat no window; only the others sort theirs
    x = x.withColumn("_sorted", F.expr("if(size(array_distinct(_windows)) < size(_windows), sort_array(transform(_windows, (h, i) -> struct(h, i))), null)"))
    x = x.withColumn("_starts", F.expr("""sort_array(transform(filter(transform(_sorted, (s, k) -> struct(s.i as i,
        (k > 0 and s.h = get(_sorted, k - 1).h) or (k + 1 < size(_sorted) and s.h = get(_sorted, k + 1).h) as twice)), s -> s.twice), s -> s.i))"""))
    covered = F.expr(f"aggregate(transform(_starts, (s, k) -> if(k + 1 < size(_starts), least({WINDOW}, get(_starts, k + 1) - s), {WINDOW})), 0, (a, b) -> a + b)")
    x = x.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    x = x.withColumn("_joined", F.array_join("_words", ""))
    x = x.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda s: s.rlike(f"[^{SPACE}]")))
    count = lambda pattern: F.regexp_count("_joined", F.lit(pattern)).cast("long")
    x = x.select(
        *docs.columns,
        # not deterministic for the optimizer: no filter is pushed below, where it would repeat these expressions inside lambdas
        (F.col("n_words") + F.monotonically_increasing_id() * 0).alias("n_words"), "n_repeat_words", F.length("_joined").cast("long").alias("word_chars"), count(f"[{SYMBOLS}]").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), F.size("_lines").cast("long").alias("n_lines"),
        count("[A-Z]").alias("n_upper"), count("[0-9]").alias("n_digits"), count("[!?]").alias("n_marks"),
    )
    return x.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def learn(labelled: DataFrame, features: dict[str, str] = FEATURES, bins: int = 32, max_rules: int = 8, max_conditions: int = 4, least_rows: int = 20, precision: float = 0.9) -> list[list[tuple[str, str, float]]]:
    """Ordered rules for ``low`` (boolean) from the statistics of ``labelled``; each is a list of (feature, op, threshold).

    The driver gets only sums: two a feature and bin, whatever the number of rows.
    """
    import math

    names = list(features)
    rows = labelled.where("low is not null").select(F.col("low").cast("int").alias("low"), (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0).alias("held"), *[F.expr(e).cast("double").alias(n) for n, e in features.items()])
    rows = materialize(rows, "quality")
    cuts = rows.agg(*[F.percentile_approx(n, [i / bins for i in range(1, bins)], 2000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(cuts[n] or [])) for n in names}
    cuts = {n: c for n, c in cuts.items() if c}
    # bin b of a feature: that many of its thresholds lie below the value, so "x > cuts[b]" is "bin > b"
    binned = rows.select("low", "held", *[reduce(lambda a, b: a + b, [(F.col(n) > t).cast("int") for t in c]).alias(n) for n, c in cuts.items()])
    binned = materialize(binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("n")), "quality")

    def cond(c):
        return F.col(c[0]) > c[2] if c[1] == ">" else F.col(c[0]) <= c[2]

    def covers(rule):
        return reduce(lambda a, b: a & b, [cond(c) for c in rule], F.lit(True))

    rules: list[list[tuple]] = []
    while len(rules) < max_rules and cuts:
        free = binned.where(~reduce(lambda a, b: a | b, map(covers, rules), F.lit(False)))
        rule: list[tuple] = []
        while len(rule) < max_conditions:
            pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in cuts]))
            sums = free.where(~F.col("held") & covers(rule)).select("low", "n", pairs.alias("p")).groupBy("p.f", "p.b").agg(F.sum(F.col("n") * F.col("low")).alias("bad"), F.sum("n").alias("n")).collect()
            at: dict = {}
            for r in sums:
                at.setdefault(r["f"], {})[r["b"]] = (r["bad"], r["n"])
            one = next(iter(at.values()), {})
            bad0, n0 = sum(v[0] for v in one.values()), sum(v[1] for v in one.values())
            if bad0 < least_rows or bad0 == n0:
                break
            best, gain = None, 0.0
            for f, hist in sorted(at.items()):
                bad = n = 0
                for b in range(len(cuts[f])):
                    bad, n = bad + hist.get(b, (0, 0))[0], n + hist.get(b, (0, 0))[1]
                    for op, p, m in (("<=", bad, n), (">", bad0 - bad, n0 - n)):
                        if p >= least_rows and (g := p * (math.log2(p / m) - math.log2(bad0 / n0))) > gain * (1 + 1e-9):
                            best, gain = (f, op, b), g
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        # pruning: the prefix of conditions that is best on the rows not grown on
        held = free.where("held")
        sums = held.agg(
            *[F.sum(F.when(covers(rule[: k + 1]), F.col("n"))).alias(f"n{k}") for k in range(len(rule))],
            *[F.sum(F.when(covers(rule[: k + 1]), F.col("n") * F.col("low"))).alias(f"bad{k}") for k in range(len(rule))],
        )
        sums = sums.first()
        worth = [(2 * (sums[f"bad{k}"] or 0) - (sums[f"n{k}"] or 0)) / max(1, sums[f"n{k}"] or 0) for k in range(len(rule))]
        k = max(range(len(rule)), key=lambda k: (round(worth[k], 3), -k))
        n, bad = sums[f"n{k}"] or 0, sums[f"bad{k}"] or 0
        if n == 0 or bad < precision * n:
            break
        rules.append(rule[: k + 1])
    return [[(f, op, cuts[f][b]) for f, op, b in rule] for rule in rules]


def verdict(rules, features: dict[str, str] = FEATURES) -> Column:
    """The decision list as ordered conditions: the number of the first rule that fires (from 1), or 0."""
    out = None
    for i, rule in enumerate(rules):
        test = reduce(lambda a, b: a & b, [F.expr(features[f]) > t if op == ">" else F.expr(features[f]) <= t for f, op, t in rule])
        out = F.when(test, i + 1) if out is None else out.when(test, i + 1)
    return F.lit(0) if out is None else out.otherwise(0)


def learned(docs: DataFrame, labels: DataFrame, *carried: str) -> tuple[list, DataFrame]:
    """Rules from ``labels.quality`` and the statistics of all documents (doc_id, numbers and the columns ``carried``), computed and written once."""
    stats = materialize(with_stats(docs.select("doc_id", "text", *carried)).drop("text"), "quality")
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
    rows = stats.drop(*carried).where(~F.col("base_failed")).join(marks, F.col("doc_id") == F.col("_id"))
    return learn(rows.withColumn("low", F.col("_quality") == 0)), stats


def passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the base rule or a learned rule rejects."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rules, stats = learned(docs.select("doc_id", "text", doc.alias("doc")), labels, "doc")
    return stats.where(~F.col("base_failed") & (verdict(rules) == 0)).select("doc.*")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rules, stats = learned(docs, labels)
    x = stats.withColumn("rule", verdict(rules))
    return x.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
