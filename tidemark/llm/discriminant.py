"""Quality classifier: a regularised quadratic discriminant over transformed statistics of whole documents.

Each document becomes a few numbers (lengths, shares, repetition), transformed so that they are nearer to normal: logarithms of
counts and lengths, square roots of shares; they are centred, scaled and cut off at ``CUT`` deviations. Each class has a
mean and a covariance, from sums that Spark adds up over all labelled rows that may be learned from. The covariance of a
class is shrunk towards that of both classes, then towards a multiple of the identity; how far is chosen by the loss
on parts of the training rows that were left out. The model keeps the inverses of the Cholesky factors, so a score is two
small matrix products: the difference of the log densities (half squared Mahalanobis distances and log determinants) plus
the log odds of the classes, as a probability.

A null text is empty and is scored by its numbers (all 0) like any other; a very long one is one row. Without rows of both labels every score is
0.5. Several labels of a document count as its lowest, labels other than 0 and 1 not at all. A null doc_id has no label and is not
held out. Repeated rows are learned from and scored as rows of their own; ties do not matter, as nothing is ordered. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import map_arrow, materialize

SPACE = "\\x20\\x09-\\x0D"
#: Values beyond so many deviations count as that.
CUT = 8.0
#: Shrinkage towards the common covariance and towards the identity that is tried, and parts of the training rows.
TO_COMMON, TO_IDENTITY, PARTS = (0.0, 0.1, 0.3, 0.6, 1.0), (0.001, 0.01, 0.05, 0.2), 3

#: Transformed statistics, as SQL over the counts of ``counts``.
FEATURES = {
    "words": "ln(1 + n_words)",
    "word_length": "ln(1 + n_chars / greatest(n_words, 1))",
    "distinct": "ln(1 + n_distinct) / ln(2 + n_words)",
    "repeated": "sqrt(n_repeated / greatest(n_words, 1))",
    "symbols": "sqrt(n_symbols / greatest(n_chars, 1))",
    "capitals": "sqrt(n_upper / greatest(n_chars, 1))",
    "digits": "sqrt(n_digits / greatest(n_chars, 1))",
    "stops": "sqrt(n_stops / greatest(n_words, 1))",
    "marks": "sqrt(n_marks / greatest(n_words, 1))",
    "line_length": "ln(1 + n_words / greatest(n_lines, 1))",
    "same_lines": "sqrt((n_lines - n_distinct_lines) / greatest(n_lines, 1))",
    "one_letter": "sqrt(n_single / greatest(n_words, 1))",
}


def counts(text: Column) -> dict[str, Column]:
    """Counts of one whole text."""
    text = F.coalesce(text, F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(f"[^{SPACE}]"))
    # a word that follows itself: pairs of neighbours, compared without an index into the list
    pairs = F.arrays_zip(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("x"), words.alias("y"))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return {
        "n_words": F.size(words), "n_distinct": F.size(F.array_distinct(words)), "n_repeated": F.size(F.filter(pairs, lambda p: p["x"] == p["y"])), "n_single": F.size(F.filter(words, lambda w: F.length(w) == 1)),
        "n_chars": F.length(F.regexp_replace(text, f"[{SPACE}]+", "")), "n_lines": F.size(lines), "n_distinct_lines": F.size(F.array_distinct(lines)),
        "n_symbols": count("[#*$%&|<>]"), "n_upper": count("[A-Z]"), "n_digits": count("[0-9]"), "n_stops": count("[.,;:]"), "n_marks": count("[!?]"),
    }


def features(docs: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and the transformed statistics x0, x1, ... of every document."""
    x = docs.select(*keys, *[c.cast("double").alias(n) for n, c in counts(F.col("text")).items()])
    return x.select(*keys, *[F.expr(e).alias(f"x{i}") for i, e in enumerate(FEATURES.values())])


class Model:
    """Centre and scale of the features, and for each class its mean, inverse Cholesky factor, log determinant and log prior."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, classes: list[tuple[np.ndarray, np.ndarray, float, float]]) -> None:
        self.centre, self.scale, self.classes = centre, scale, classes

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.zeros(len(x))
        z = np.clip((x - self.centre) / self.scale, -CUT, CUT)
        density = [prior - 0.5 * (((z - mean) @ whiten.T) ** 2).sum(1) - 0.5 * det for mean, whiten, det, prior in self.classes]
        return density[1] - density[0]


def moments(n: float, sums: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = sums / n
    return mean, squares / n - np.outer(mean, mean)


def model(centre: np.ndarray, scale: np.ndarray, sums: list[tuple[float, np.ndarray, np.ndarray]], common: float, identity: float) -> Model:
    """From (rows, sums, sums of products) of class 0 and 1, shrunk towards the common covariance and the identity."""
    total = sum(s[0] for s in sums)
    each = [moments(*s) for s in sums]
    both = sum(s[0] / total * cov for s, (_, cov) in zip(sums, each))
    classes = []
    for (n, *_), (mean, cov) in zip(sums, each):
        cov = (1 - common) * cov + common * both
        cov = (1 - identity) * cov + identity * max(np.trace(cov) / len(cov), 1e-6) * np.eye(len(cov))
        factor = np.linalg.cholesky(cov)
        classes.append((mean, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()), float(np.log(n / total))))
    return Model(centre, scale, classes)


def learn(rows: DataFrame) -> Model:
    """From stored rows with x0, x1, ..., ``label`` (0 or 1) and ``part``. The driver gets sums only: a bounded number of them."""
    names = [f"x{i}" for i in range(len(FEATURES))]
    k = len(names)
    spread = rows.agg(*[F.avg(n).alias(f"m{n}") for n in names], *[F.stddev_pop(n).alias(f"s{n}") for n in names]).first()
    if spread[f"m{names[0]}"] is None:
        return Model(np.zeros(k), np.ones(k), [])
    centre = np.array([spread[f"m{n}"] for n in names])
    scale = np.array([spread[f"s{n}"] or 1.0 for n in names])
    z = [F.greatest(F.lit(-CUT), F.least(F.lit(CUT), (F.col(n) - float(m)) / float(s))).alias(n) for n, m, s in zip(names, centre, scale)]
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    got = rows.select("label", "part", *z).groupBy("part", "label").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(n) for n in names]).alias("sums"), F.array(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in upper]).alias("squares")
    ).collect()

    def totals(without: int | None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        out = []
        for label in (0, 1):
            n, sums, squares = 0.0, np.zeros(k), np.zeros((k, k))
            for r in got:
                if r["label"] == label and r["part"] != without:
                    n, sums = n + r["n"], sums + np.array(r["sums"])
                    for (i, j), v in zip(upper, r["squares"]):
                        squares[i, j] += v
                        squares[j, i] += v if i != j else 0
            out.append((n, sums, squares))
        return out

    whole = totals(None)
    if not all(n for n, *_ in whole):
        return Model(centre, scale, [])
    tried = list(product(TO_COMMON, TO_IDENTITY))
    split = {p: [model(centre, scale, totals(p), *t) for t in tried] for p in range(PARTS) if all(n for n, *_ in totals(p))}

    def losses(batches):
        sums = np.zeros(len(tried))
        for batch in batches:
            label, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]])
            for p, models in split.items():
                own = part == p
                for i, m in enumerate(models):
                    sums[i] += np.logaddexp(0, np.where(label[own] == 1, -1, 1) * np.clip(m.log_odds(x[own]), -30, 30)).sum()
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(tried)), pa.int32()), "loss": pa.array(sums)})

    loss = map_arrow(rows.select("label", "part", *names), losses, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect() if split else []
    best = min(((round(r["loss"], 6), r["i"]) for r in loss), default=(0.0, tried.index((0.3, 0.05))))[1]
    return model(centre, scale, whole, *tried[best])


def train(stats: DataFrame, labels: DataFrame, learnable: Column) -> Model:
    """The model of all rows of ``stats`` (doc_id, x0, ...) whose label may be learned."""
    mark = labels.where(learnable & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("label"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int").alias("part")
    rows = stats.join(mark, F.col("doc_id") == F.col("_id")).select("label", part, *[f"x{i}" for i in range(len(FEATURES))])
    return learn(materialize(rows, "discriminant"))


def score(stats: DataFrame, fitted: Model) -> DataFrame:
    """doc_id and ``score`` of every row of ``stats``."""

    def rate(batches):
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            s = 1 / (1 + np.exp(-np.clip(fitted.log_odds(x), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return map_arrow(stats.select("doc_id", *[f"x{i}" for i in range(len(FEATURES))]), rate, "doc_id long, score double", 8192)


def fold(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; rows of fold 1 are not learned from."""
    stats = materialize(features(docs, "doc_id"), "discriminant")
    got = score(stats, train(stats, labels, fold("doc_id") != 1))
    return got.select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
