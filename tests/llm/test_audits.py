"""Filter interactions, hard negatives and the quadratic discriminant against plain Python."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import SF, assert_same
from tidemark.llm import discriminant, filter_audit, hard_negatives, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_hard_negatives"])
def test_against_sql(spark, name):
    assert_same(spark, queries.QUERIES[name], queries.ORACLES[name])


# --- filter interactions ---


def brute_audit(rows, marks):
    """rows: (doc_id, text, source); marks: (doc_id, quality, toxic)."""
    good, toxic = {m[0] for m in marks if m[1] == 1 and m[0] is not None}, {m[0] for m in marks if m[2] == 1 and m[0] is not None}
    docs = []
    for doc_id, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows),
        }
        docs.append((source or "", {f for f, x in fails.items() if x}, doc_id in good, doc_id in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive = own
            for i, f in enumerate(order):
                gone = [d for d in alive if f in d[1]]
                alive = [d for d in alive if f not in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), i + 1] = [len(alive), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, i), v in out.items():
            if p == part:
                v.append(shapley[order[i - 1]])
    return out


def audited(df):
    got = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in got}
    assert len(out) == len(got)
    return out


def test_audit_against_every_order(spark, docs, labels):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    marks = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
    assert audited(filter_audit.digest(docs, labels)) == brute_audit(rows, marks)


def test_audit_of_copies_null_ids_and_several_labels(spark):
    rng = random.Random(3)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(260))
    texts = [clean, clean + " A" * 40, clean + " #", "same " * 250, "", None, "short", "SHORT | " * 120]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "a", "b"])) for _ in range(160)]
    rows += [(7, clean, "c"), (7, clean, "c"), (None, clean, "c"), (-5, "alone", "d")]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(40) for _ in range(rng.randrange(3))] + [(None, 1, 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, n long, part string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert audited(filter_audit.digest(df, labels)) == brute_audit(rows, marks)


def test_audit_of_nothing_and_of_two_filters(spark, empty, labels):
    assert filter_audit.digest(empty, labels).count() == 0
    assert audited(filter_audit.digest(empty.unionByName(spark.createDataFrame([(1, "x", "en", None, 1)], empty.schema)), labels.limit(0)))["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]
    counts = spark.createDataFrame([("p", True, True, 3, 1, 0), ("p", True, False, 2, 0, 2), ("p", False, False, 5, 5, 5)], "part string, X boolean, Y boolean, n long, good long, toxic long")
    got = audited(filter_audit.audit(counts, "XY"))
    assert got["p", "YX", 2] == [5, 2, 3, 2, 0, 2, 7] and got["p", "XY", 2] == [5, 0, 3, 0, 0, 0, 3]


# --- hard negatives ---


def brute_mine(rows):
    """rows: (vec_id, embedding, label) in stored order."""
    part = []
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        part.append((n, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, i, label, q in part:
        if i is None or i % 100:
            continue
        order = sorted(((-sum(a * b for a, b in zip(q, r[3])), r[1] is None, r[1] or 0, r[0], r) for r in part if r[0] != n), key=lambda x: x[:4])
        for p in [x for x in order if x[4][2] == label][:5]:
            score = -p[0]
            window = [x for x in order if x[4][2] != label and 30 * score <= -100 * x[0] <= 90 * score][:10]
            out += [(i, p[4][1], rank, x[4][1], score, -x[0]) for rank, x in enumerate(window, 1)]
    return sorted(out, key=str)


def mined(df):
    return sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect()), key=str)


@pytest.mark.parametrize("sizes", [dict(), dict(high=2, wide=7, chunk=3), dict(high=1, wide=3, chunk=16)])
def test_mining_over_blocks_and_chunks(spark, sizes):
    rng = random.Random(11)
    base = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(6)]
    vector = lambda: [x + rng.uniform(-0.4, 0.4) for x in rng.choice(base)]
    rows = [(i * 10, vector(), rng.randrange(3)) for i in range(90)]
    rows += [(1, None, 1), (2, [1.0, None] * 4, 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] * 8, 2), (5, vector(), None), (200, [], 1), (6, [0.5, 0.5], 2), (7, vector() + [9.0] * 5, 0)]
    rows += [(11, base[0], 0), (12, base[0], 1), (13, base[0], 1), (14, base[0], 0), (None, vector(), 1), (None, vector(), 2), (100, vector(), 4), (-100, vector(), 2), (15, [0.0] * 8, 2)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, score long, row string").coalesce(1)
    got = mined(hard_negatives.mine(df, **sizes))
    assert got == brute_mine([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]) and len(got) > 100


def test_mining_of_nothing_of_few_and_of_too_much(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert mined(hard_negatives.mine(spark.createDataFrame([], kind))) == []
    assert mined(hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], kind))) == []
    assert mined(hard_negatives.mine(spark.createDataFrame([(0, [1.0], 1)], kind))) == []
    few = spark.createDataFrame([(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2)], kind)
    assert mined(hard_negatives.mine(few)) == [(100, 1, 1, 2, 65536, 32768)]
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine(spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)], kind))


def test_large_components_are_multiplied_exactly(spark):
    rows = [(100, [float(1 << 22), 1.0], 1), (1, [float(1 << 22), 3.0], 1), (2, [float(3 << 20), 7.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)
    assert mined(hard_negatives.mine(df)) == brute_mine(rows) != []


# --- quadratic discriminant ---


def test_counts_against_python(spark, docs):
    got = docs.select("text", *[c.alias(n) for n, c in discriminant.counts(F.col("text")).items()]).collect()
    for r in got:
        text = r["text"] or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        want = {
            "n_words": len(words), "n_distinct": len(set(words)), "n_repeated": sum(a == b for a, b in zip(words, words[1:])), "n_single": sum(len(w) == 1 for w in words), "n_chars": sum(map(len, words)),
            "n_lines": len(lines), "n_distinct_lines": len(set(lines)), "n_upper": len(re.findall("[A-Z]", text)), "n_digits": len(re.findall("[0-9]", text)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_stops": len(re.findall("[.,;:]", text)), "n_marks": len(re.findall("[!?]", text)),
        }
        assert {k: r[k] for k in want} == want


def test_scores_are_differences_of_normal_densities(spark):
    """The model from sums in Spark against means, covariances and densities in NumPy."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    stats = discriminant.features(docs, "doc_id")
    fitted = discriminant.train(stats, labels, discriminant.fold("doc_id") != 1)
    names = [f"x{i}" for i in range(len(discriminant.FEATURES))]
    mark = labels.where(discriminant.fold("doc_id") != 1).groupBy("doc_id").agg(F.min("quality").alias("label"))
    rows = stats.join(mark, "doc_id").select("label", *names).toPandas()
    x = rows[names].to_numpy()
    assert np.allclose(fitted.centre, x.mean(0)) and np.allclose(fitted.scale, np.where(x.std(0) > 0, x.std(0), 1))
    z = np.clip((x - fitted.centre) / fitted.scale, -discriminant.CUT, discriminant.CUT)
    parts = [z[rows["label"] == c] for c in (0, 1)]
    own = [np.cov(p.T, bias=True) for p in parts]
    common = sum(len(p) * c for p, c in zip(parts, own)) / len(z)
    fits = []
    for a, b in itertools.product(discriminant.TO_COMMON, discriminant.TO_IDENTITY):
        density = []
        for p, c in zip(parts, own):
            s = (1 - a) * c + a * common
            s = (1 - b) * s + b * np.trace(s) / len(s) * np.eye(len(s))
            d = z - p.mean(0)
            density.append(math.log(len(p) / len(z)) - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
        fits.append(np.allclose(fitted.log_odds(x), density[1] - density[0], rtol=1e-6, atol=1e-6))
    assert any(fits)


def test_held_out_quality(spark):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")["quality"].to_dict()
    got = queries.op13_discriminant(spark, sf).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) >= 0.97 * len(held) and len(held) > 100


def test_awkward_rows_and_missing_labels(spark, docs, empty, labels):
    assert discriminant.digest(empty, labels).count() == 0
    got = discriminant.digest(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    for few in (labels.limit(0), labels.where("quality = 1"), labels.withColumn("quality", F.lit(None).cast("int"))):
        assert {(r["score"], r["predicted"]) for r in discriminant.digest(docs, few).collect()} == {(0.5, 1)}


def test_panels_of_the_grid_do_not_go_through_the_driver(spark):
    rows = hard_negatives.prepared(spark.createDataFrame([(i * 10, [0.5, i / 40], i % 3) for i in range(40)], "vec_id long, embedding array<float>, label int"))
    left, right = hard_negatives.panels(rows.where("id % 100 = 0"), 1, 2, np.int16), hard_negatives.panels(rows, 5, 2, np.int16)
    totals = hard_negatives.tiles(left, right, 1, 5, True, 2, np.int16, np.int32)
    assert "Broadcast" not in totals._jdf.queryExecution().executedPlan().toString()
    assert sum(len(r["tile"]) for r in totals.collect()) == 4 * 4 * 40
