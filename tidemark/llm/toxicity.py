"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Training uses at most ``MAX_LABELLED`` labelled documents, the first by a digest of doc_id, of those
whose label may be learned. Presence of hashed n-grams is counted for both labels, the log-count
ratio of each n-gram scales its feature, and a logistic regression is fitted to the scaled features.
Scoring reads every whole text once and keeps no state.

The characters of n-grams are the bytes of the lower-case text, in fours, sixes and eights, so that one rule
serves all scripts; the ``FEATURES`` n-grams that tell the labels apart best are kept, whatever the size of the corpus.

A null text is empty and gets the score of the bias; a row with null doc_id is scored; without both
labels among the training rows every score is 0.5; several labels of one document count as its highest; ties among
n-grams go to the lower hash; very long texts are hashed in pieces; an empty table gives an empty result;
repeated rows give repeated results, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import map_arrow, materialize
from ._text import BASE, binary_column, blocks, distinct, lower_table, mix, space_table

#: Labelled rows that are learned from at most; a bound on what the driver fits.
MAX_LABELLED = 20_000
ORDERS, BITS = (4, 6, 8), 21
#: n-grams kept by likelihood ratio, the least such ratio, log-count ratio and number of documents of one.
FEATURES, LEAST_G, LEAST_RATIO, LEAST_DOCS = 1 << 11, 15.0, 1.0, 8
BLOCK = 2 << 20


def grams(data: np.ndarray, offsets: np.ndarray):
    """Hashed n-grams of each text (lower case, white space as one kind, a space at either end) with their rows."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    flat = lower_table()[data]
    flat[space_table()[data]] = 32
    out = np.full(len(data) + 2 * n, 32, np.uint8)
    at = offsets[:-1] + 2 * np.arange(n) + 1  # each text stands between two spaces
    row = np.repeat(np.arange(n), size)
    out[np.arange(len(data)) + 2 * row + 1] = flat
    row = np.repeat(np.arange(n), size + 2)
    del at
    if n == 1 and len(out) > 2 * BLOCK:
        yield from long_grams(out)
        return
    h = out.astype(np.uint64)
    rolled = h.copy()
    for k in range(2, max(ORDERS) + 1):
        if len(out) < k:
            break
        rolled = rolled[: len(out) - k + 1] * np.uint64(BASE) + h[k - 1 :]
        if k in ORDERS:
            ok = row[: len(rolled)] == row[k - 1 :]
            yield row[: len(rolled)][ok], (mix(rolled[ok] + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int32)


def long_grams(text: np.ndarray):
    """The same of one very long text, each n-gram once, from overlapping pieces."""
    for k in ORDERS:
        seen = np.zeros(1 << BITS, bool)
        for at in range(0, len(text) - k + 1, BLOCK):
            h = text[at : at + BLOCK + k - 1].astype(np.uint64)
            rolled = h[: len(h) - k + 1].copy()
            for i in range(1, k):
                rolled = rolled * np.uint64(BASE) + h[i : len(h) - k + 1 + i]
            seen[(mix(rolled + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64)] = True
        found = np.flatnonzero(seen).astype(np.int32)
        yield np.zeros(len(found), np.int64), found


def counted(docs: DataFrame) -> DataFrame:
    """(label, counts) from each partition: in how many documents each hashed n-gram stands."""

    def count(batches):
        sums, seen = np.zeros((2, 1 << BITS), np.uint32), np.zeros(2, np.int64)
        for batch in batches:
            data, offsets = binary_column(batch, "raw")
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            seen += np.bincount(label, minlength=2)[:2]
            for lo, hi in blocks(offsets, BLOCK):
                part = offsets[lo : hi + 1] - offsets[lo]
                for row, gram in grams(data[offsets[lo] : offsets[hi]], part):
                    key = distinct(row.astype(np.int64) << BITS | gram)
                    marks = label[lo:hi][key >> BITS]
                    for y in (0, 1):
                        sums[y] += np.bincount(key[marks == y] & ((1 << BITS) - 1), minlength=1 << BITS).astype(np.uint32)
        yield pa.RecordBatch.from_pydict({"label": pa.array([0, 1], pa.int32()), "docs": pa.array(seen), "counts": pa.array([s.tobytes() for s in sums], pa.binary())})

    return map_arrow(docs.select("raw", "label"), count, "label int, docs long, counts binary")


def present(docs: DataFrame, place: np.ndarray) -> DataFrame:
    """(label, features) of each document: the kept n-grams that it holds; ``place`` maps a hash to a feature or -1."""

    def find(batches):
        for batch in batches:
            data, offsets = binary_column(batch, "raw")
            lists = []
            for lo, hi in blocks(offsets, BLOCK):
                for rows in held(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], place):
                    lists.append(rows)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["label", "features"])

    return map_arrow(docs.select("raw", "label"), find, "label int, features array<int>")


def held_pairs(data: np.ndarray, offsets: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, by row."""
    rows, found = [], []
    for row, gram in grams(data, offsets):
        f = place[gram]
        ok = f >= 0
        rows.append(row[ok])
        found.append(f[ok])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = distinct(np.concatenate(rows).astype(np.int64) << 32 | np.concatenate(found).astype(np.int64))
    return key >> 32, key & 0xFFFFFFFF


def held(data, offsets, place) -> list[np.ndarray]:
    row, f = held_pairs(data, offsets, place)
    return np.split(f.astype(np.int32), np.searchsorted(row, np.arange(1, len(offsets) - 1))) if len(offsets) > 1 else []


def fit(labels: np.ndarray, features: list[np.ndarray], ratio: np.ndarray, l2: float = 3e-4, steps: int = 600, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on presence times ratio, both labels weighing alike.

    Gradient descent with momentum and steps scaled per weight, which fall to nothing over ``steps``.
    """
    col = np.concatenate(features).astype(np.int64) if features else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    value, n = ratio[col], len(labels)
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, n - labels.sum()))
    w = np.zeros(len(ratio) + 1)
    mean, square = w.copy(), w.copy()
    for t in range(1, steps + 1):
        z = np.bincount(row, value * w[col], n) + w[-1]
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * weight
        g = np.append(np.bincount(col, value * e[row], len(ratio)) + l2 * w[:-1], e.sum())
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= rate * (1 - t / steps) * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def likelihood_ratio(sums: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """G statistic of presence against label for each n-gram."""
    both, total = sums.sum(0), seen.sum()
    g = np.zeros(sums.shape[1])
    for y in (0, 1):
        for observed, expected in ((sums[y], both * seen[y] / total), (seen[y] - sums[y], (total - both) * seen[y] / total)):
            ok = observed > 0
            g[ok] += 2 * observed[ok] * np.log(observed[ok] / expected[ok])
    return g


def train(docs: DataFrame, labels: DataFrame, learnable: Column) -> tuple[np.ndarray, float]:
    """A weight for each hashed n-gram and the bias."""
    mark = labels.where(learnable & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("label"))
    mark = mark.orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED)  # bounded, so it may be broadcast
    rows = docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("raw")).join(F.broadcast(mark), F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy(F.xxhash64("raw").alias("_k"), "label").agg(F.first("raw").alias("raw"))  # each text once
    rows = materialize(rows.repartition(8, "_k").select("raw", "label"), "toxicity")
    sums, seen = np.zeros((2, 1 << BITS)), np.zeros(2)
    for r in materialize(counted(rows), "toxicity").toLocalIterator():
        sums[r["label"]] += np.frombuffer(r["counts"], np.uint32)
        seen[r["label"]] += r["docs"]
    weights = np.zeros(1 << BITS)
    if not seen.all():
        return weights, 0.0
    p, q = (sums[1] + 0.5) / (seen[1] + 1), (sums[0] + 0.5) / (seen[0] + 1)
    ratio = np.log(p) - np.log(q)
    evidence = np.where((sums.sum(0) >= LEAST_DOCS) & (np.abs(ratio) >= LEAST_RATIO), likelihood_ratio(sums, seen), 0)
    kept = np.argsort(-evidence, kind="stable")[:FEATURES]
    kept = np.sort(kept[evidence[kept] >= LEAST_G])
    place = np.full(1 << BITS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    got = present(rows, place).collect()
    w, b = fit(np.array([r["label"] for r in got]), [np.array(r["features"], np.int64) for r in got], ratio[kept])
    weights[kept] = w * ratio[kept]
    return weights, float(b)


def score(docs: DataFrame, weights: np.ndarray, bias: float, *keys: str) -> DataFrame:
    """``keys`` and ``score`` of every whole text."""
    place = np.where(weights != 0, np.arange(len(weights)), -1).astype(np.int32)
    kept = np.flatnonzero(weights)
    place[kept] = np.arange(len(kept))
    small = weights[kept]

    def rate(batches):
        for batch in batches:
            data, offsets = binary_column(batch, "raw")
            z = np.full(len(offsets) - 1, bias)
            for lo, hi in blocks(offsets, BLOCK):
                row, f = held_pairs(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], place)
                z[lo:hi] += np.bincount(row, small[f], hi - lo)
            s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    rows = docs.select(*keys, F.col("text").cast("binary").alias("raw"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return map_arrow(rows, rate, f"{schema}, score double")


def fold(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; rows of fold 0 are not learned from."""
    weights, bias = train(docs, labels, fold("doc_id") != 0)
    got = score(docs, weights, bias, "doc_id")
    return got.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
