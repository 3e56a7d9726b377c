"""Secrets, quality rules, mixing, toxicity and language-model scoring against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import SF, assert_same
from tidemark.llm import contextmix, mixing, quality, queries, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- secrets ---


def base_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII | re.IGNORECASE):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for rank, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 16), (2, "hex", r"[0-9a-f]+", 32)):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return [s for *_, s in sorted(out)]


def test_base_spans(spark, docs):
    for df in (docs, sample(spark)):
        texts = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r["doc_id"]].append(r["text"])
        for r in secrets.digest(df).collect():
            spans = base_spans(texts[r["doc_id"]][0])
            assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex"))
            assert set(spans) <= set(r["spans"].split(",")) | {""}


def test_ownership_separates_examples_from_live(spark):
    shared, own = "Zq81mXk2Lw93TbVn", "Pk7dQw2Xn5Bv8Rt1"
    rows = [(i, f"password = {shared}", "en", f"s{i}", 1) for i in range(4)] + [(10, f"password = {own}", "en", "s1", 1), (11, f"see {own} here", "en", "s1", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in secrets.digest(df).collect()}
    assert got[0]["n_live"] == 0 and got[10]["n_live"] == 1
    assert got[11]["spans"] == "bare:4:20" and got[11]["n_added"] == 1
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.redact(df).collect()}
    assert texts[0][0] == f"password = {shared}" and texts[10] == ("[REDACTED]", 10) and texts[11][0] == "see [REDACTED] here"


def brute_secrets(rows):
    """All spans of (doc_id, source, text) rows, candidate by candidate, without any table."""
    found, holders = [], collections.defaultdict(set)
    for doc, source, text in rows:
        text, mine = text or "", []
        for span in base_spans(text):
            kind, lo, hi = span.split(":")
            value = re.search(r"""[A-Za-z0-9+/_.=-]+$""", text[int(lo) : int(hi)]).group() if kind != "assign" else re.match(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(.*)$""", text[int(lo) : int(hi)], re.IGNORECASE | re.DOTALL).group(1)
            mine.append((int(lo), ("assign", "access", "hex").index(kind), int(hi), value.rstrip(".=")))
        for m in re.finditer(r"[A-Za-z0-9+/_.-]{8,}", text):
            value = m.group().rstrip(".=")
            free = all(m.start() + len(value) <= lo or hi <= m.start() for lo, kind, hi, _ in mine if kind < 3)
            if len(value) >= 8 and re.search("[0-9]", value) and re.search("[A-Za-z]", value) and free:
                mine.append((m.start(), 3, m.start() + len(value), value))
        for _, kind, _, value in mine:
            holders[value].add((doc, source, kind < 3))
        found.append((doc, mine))
    least = min(3, max(2, len({source for _, source, _ in rows})))

    def live(v):
        own = holders[v]
        return any(base for *_, base in own) and len({s for _, s, _ in own}) < least and len({(d, s) for d, s, _ in own}) < 25 and secrets.looks_live(v)

    names = ("assign", "access", "hex", "bare")
    return sorted((doc, ",".join(f"{names[k]}:{lo}:{hi}" for lo, k, hi, v in sorted(mine) if k < 3 or live(v))) for doc, mine in found)


def test_all_spans(spark):
    """Against brute force: repository and owner counts, bare repeats, marks at a value's end, values of eight characters."""
    own, wide, many, short = "Pk7dQw2Xn5Bv8Rt1", "Zq81mXk2Lw93TbVn", "Hn4kLp9sWd3vRx7c", "a9Kd3xQ7"
    rows = [(i, f"s{i % 4}", f"password = {wide}") for i in range(8)] + [(100 + i, "s1", f"see token: {many}, {many}") for i in range(30)]
    rows += [(50, "s1", f"token: {own}="), (51, "s1", f"so {own}. And {own}"), (52, "s2", f"x={own}"), (53, "s3", f"secret={short} {short}."), (54, None, None), (55, "s1", f"{wide} {many}"), (56, "s1", f"{short} or {'ab12' * 12}")]
    rows += [(1000 + r["doc_id"], r["source"], r["text"]) for r in sample(spark).collect()]
    got = secrets.digest(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert sorted((r["doc_id"], r["spans"]) for r in got) == brute_secrets(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[100]["n_live"] == 0 and by[50]["n_live"] == 1 and by[51]["n_added"] == 2 and by[53]["n_added"] == 1 and by[55]["n_added"] == 0


def test_redaction_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "token: Pk7dQw2Xn5Bv8Rt1", "s", "mine", "cut", 3)], "doc_id long, text string, source string, _key string, key string, n_chars int")
    assert [tuple(r) for r in secrets.redact(df).collect()] == [(1, "[REDACTED]", "s", "mine", "cut", 10)]


def test_secrets_edge_cases(spark, docs, empty):
    assert secrets.digest(empty).count() == 0 and secrets.digest(docs).count() == docs.count()
    back = secrets.redact(docs)
    assert back.columns == docs.columns and back.count() == docs.count()


# --- quality rules ---


def stats(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {j for starts in at.values() if len(starts) > 1 for i in starts for j in range(i, i + 8)}
    joined = "".join(words)
    return len(words), len(joined), sum(c in "#*$%&|<>" for c in joined), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark, docs):
    for df in (docs, sample(spark)):
        want = sorted(stats(r["text"]) for r in df.select("text").collect())
        cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert sorted(tuple(r[c] for c in cols) for r in quality.with_stats(df.select("doc_id", "text")).collect()) == want


def test_rules_find_the_planted_threshold(spark):
    rows = [(i, (i * 37 % 100) / 100, i * 53 % 100, (i * 37 % 100) > 60 and (i * 53 % 100) <= 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, x double, y long, low boolean")
    rules = quality.learn(df, {"x": "x", "y": "double(y)"})
    assert rules and {f for f, *_ in rules[0]} == {"x", "y"}
    got = df.withColumn("rule", quality.verdict(rules, {"x": "x", "y": "double(y)"}))
    assert got.where("low <> (rule > 0)").count() < 0.05 * 3000


def brute_rules(rows, names, bins=32, least=20, precision=0.9):
    """Sequential covering in plain Python over (held, low, values) rows with ready-made thresholds."""
    cuts = {n: sorted({v[i] for _, _, v in rows}) for i, n in enumerate(names)}
    rules, free = [], rows
    fires = lambda rule, v: all((v[names.index(f)] > t) == (op == ">") for f, op, t in rule)
    while len(rules) < 8:
        rule, grow = [], [r for r in free if not r[0]]
        while len(rule) < 4:
            here = [r for r in grow if fires(rule, r[2])]
            bad0, n0 = sum(r[1] for r in here), len(here)
            if bad0 < least or bad0 == n0:
                break
            best, gain = None, 0.0
            for f in sorted(cuts):
                for t in cuts[f][:-1]:
                    for op in ("<=", ">"):
                        got = [r[1] for r in here if fires([(f, op, t)], r[2])]
                        p, m = sum(got), len(got)
                        if p >= least and (g := p * (math.log2(p / m) - math.log2(bad0 / n0))) > gain * (1 + 1e-9):
                            best, gain = (f, op, t), g
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        score = []
        for k in range(len(rule)):
            got = [r[1] for r in free if r[0] and fires(rule[: k + 1], r[2])]
            score.append(((2 * sum(got) - len(got)) / max(1, len(got)), sum(got), len(got)))
        k = max(range(len(rule)), key=lambda k: (round(score[k][0], 3), -k))
        if score[k][2] == 0 or score[k][1] < precision * score[k][2]:
            break
        rules.append(rule[: k + 1])
        free = [r for r in free if not fires(rule[: k + 1], r[2])]
    return rules


def test_rules_match_brute_force(spark):
    """The same list and verdicts as a plain-Python covering, on three small-valued features and noisy labels."""
    draw = np.random.default_rng(3)
    rows = [(i, *map(float, draw.integers(0, 8, 3))) for i in range(900)]
    rows = [(i, a, b, c, bool((a > 5 and b <= 3) or c == 7 or draw.random() < 0.03)) for i, a, b, c in rows]
    df = spark.createDataFrame(rows, "doc_id long, a double, b double, c double, low boolean")
    features = {"a": "a", "b": "b", "c": "c"}
    held = {r["doc_id"]: r["h"] for r in df.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0).alias("h")).collect()}
    rules = quality.learn(df, features)
    assert len(rules) >= 2
    pair = [{(f, op) for f, op, _ in r} for r in rules]
    want = brute_rules([(held[i], low, (a, b, c)) for i, a, b, c, low in rows], ["a", "b", "c"])
    assert [{(f, op) for f, op, _ in r} for r in want] == pair and [[t for *_, t in r] for r in want] == [[t for *_, t in r] for r in rules]
    fired = {r["doc_id"]: r["rule"] for r in df.withColumn("rule", quality.verdict(rules, features)).collect()}
    for i, *v, _ in rows:
        n = next((k + 1 for k, rule in enumerate(rules) if all((v["abc".index(f)] > t) == (op == ">") for f, op, t in rule)), 0)
        assert fired[i] == n


def test_quality_edge_cases(spark, docs, empty, labels):
    none = labels.where("false")
    assert quality.digest(empty, labels).count() == 0
    got = {r["doc_id"]: r for r in quality.digest(docs, none).collect()}
    assert not got[2]["kept"] and not got[3]["kept"] and got[2]["n_words"] == 0
    kept = quality.passing(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 0


# --- mixing ---


def test_mixing_matches_sql(spark):
    assert_same(spark, queries.QUERIES["op4_mixing"], queries.ORACLES["op4_mixing"])


def test_water_level(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    left = 1510 - 30
    assert got["a"] == 30 and got["b"] == pytest.approx(left * 2 / 3) and got[None] == pytest.approx(left / 3)


def test_inclusion_probabilities_fill_what_is_left(spark):
    """Expected size is what is left of each target, smaller classes are likelier, and none exceeds one."""
    draw = np.random.default_rng(7)
    rows = [(i, "ab"[i % 2], int(x)) for i, x in enumerate(np.exp(draw.normal(4, 2, 4000)) + 1)] + [(9000 + i, None, 1) for i in range(40)] + [(9990, None, 100_000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    total = collections.Counter()
    for _, source, size in rows:
        total[source] += size
    left = {"a": 0.05 * total["a"], "b": 0.97 * total["b"], None: 60.0}
    goal = spark.createDataFrame(list(left.items()), "source string, left double")
    p = {(r["source"], r["class"]): r["p"] for r in mixing.inclusion(sized, goal).collect()}
    classes = sized.select("source", "size", mixing.size_class(F.col("size")).alias("c")).collect()
    for source, want in left.items():
        assert sum(p[source, r["c"]] * r["size"] for r in classes if r["source"] == source) == pytest.approx(want)
    assert all(0 <= x <= 1 for x in p.values()) and any(x == 1 for x in p.values())
    for (source, c), x in p.items():
        assert all(x >= y for (s, d), y in p.items() if s == source and d > c)


def test_mixing_hits_its_targets(spark):
    """The words taken of each source come within a document of its target, rows without ids are apart."""
    rows = [(None if i % 3 == 0 else i, "ab"[i % 5 == 0], f"w{i} " * (1 + i * 7 % 60)) for i in range(3000)]
    got = mixing.digest(spark.createDataFrame(rows, "doc_id long, source string, text string")).groupBy("target").agg(F.sum("taken").alias("taken")).collect()
    assert len(got) == 2 and all(abs(r["taken"] - r["target"]) <= 60 for r in got)


def test_mixing_edge_cases(spark, docs, empty):
    assert mixing.digest(empty).count() == 0
    rows = mixing.digest(docs).collect()
    assert len(rows) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.digest(docs.repartition(3)).collect()))
    zero = docs.where("doc_id in (2, 3, 4)")
    assert all(r["taken"] == 0 and r["target"] == 0 for r in mixing.digest(zero).collect())


# --- toxicity ---


def test_toxicity_held_out(spark):
    sf = SF.replace("0.001", "0.1")
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op1_toxicity(spark, sf).where("held_out").collect()
    marked = [(truth[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["doc_id"] in truth]
    assert all(0 <= s <= 1 for *_, s in marked)
    hits = sum(t == 1 and p == 1 for t, p, _ in marked)
    assert hits >= 0.85 * sum(t for t, *_ in marked)
    assert hits >= 0.85 * sum(p for _, p, _ in marked)


def test_toxicity_edge_cases(spark, docs, empty, labels):
    assert toxicity.digest(empty, labels).count() == 0
    rows = toxicity.digest(docs, labels.where("false")).collect()
    assert len(rows) == docs.count() and {r["score"] for r in rows} == {0.5}
    by = collections.defaultdict(set)
    for r in toxicity.digest(docs, labels).collect():
        by[r["doc_id"]].add(r["score"])
    assert all(len(v) == 1 for v in by.values())


def test_grams_ignore_position_in_block():
    data, offsets = np.frombuffer(b"an Idiot\tanidiot ", np.uint8), np.array([0, 9, 17])
    with np.errstate(over="ignore"):
        both = [set(g[r == 1].tolist()) for r, g in toxicity.grams(data, offsets)]
        alone = [set(g.tolist()) for _, g in toxicity.grams(data[9:], offsets[1:] - 9)]
    assert both == alone


def test_grams_of_long_texts(monkeypatch):
    data = np.frombuffer(("Word one two\tthree " * 40 + "end é").encode(), np.uint8)
    offsets = np.array([0, len(data)])
    with np.errstate(over="ignore"):
        whole = [set(g.tolist()) for _, g in toxicity.grams(data, offsets)]
        monkeypatch.setattr(toxicity, "BLOCK", 64)
        cut = [g.tolist() for _, g in toxicity.grams(data, offsets)]
    assert whole == list(map(set, cut)) and all(len(g) == len(set(g)) for g in cut)


def brute_toxicity(rows, toxic, steps=600):
    """Scores in plain Python dictionaries: presence of hashed byte n-grams, log-count ratios, likelihood ratios, gradient descent."""
    mask = (1 << 64) - 1

    def grams(text):
        b = " " + re.sub(r"[\x09-\x0d]", " ", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + " "
        b, out = b.encode(), set()
        for k in (4, 6, 8):
            for i in range(len(b) - k + 1):
                h = 0
                for c in b[i : i + k]:
                    h = (h * toxicity.BASE + c) & mask
                out.add(mix64((h + k) & mask) >> (64 - toxicity.BITS))
        return out

    sets = {i: grams(t) for i, t in rows}
    train = [i for i, _ in rows if i in toxic and zlib.crc32(str(i).encode()) % 5 != 0]
    count, seen = (collections.Counter(), collections.Counter()), [0, 0]
    for i in train:
        seen[toxic[i]] += 1
        count[toxic[i]].update(sets[i])

    def g_of(f):
        both, out = count[0][f] + count[1][f], 0.0
        for y in (0, 1):
            for o, e in ((count[y][f], both * seen[y] / len(train)), (seen[y] - count[y][f], (len(train) - both) * seen[y] / len(train))):
                out += 2 * o * math.log(o / e) if o else 0
        return out

    ratio = {f: math.log((count[1][f] + 0.5) / (seen[1] + 1)) - math.log((count[0][f] + 0.5) / (seen[0] + 1)) for f in set(count[0]) | set(count[1])}
    kept = [f for f in ratio if count[0][f] + count[1][f] >= toxicity.LEAST_DOCS and abs(ratio[f]) >= toxicity.LEAST_RATIO and g_of(f) >= toxicity.LEAST_G]
    kept = sorted(kept, key=lambda f: (-g_of(f), f))[: toxicity.FEATURES]
    w, bias = dict.fromkeys(kept, 0.0), 0.0
    weight = {1: 0.5 / max(1, seen[1]), 0: 0.5 / max(1, seen[0])}
    held = {i: [f for f in kept if f in sets[i]] for i in sets}
    m, v, mb, vb = dict.fromkeys(kept, 0.0), dict.fromkeys(kept, 0.0), 0.0, 0.0
    for t in range(1, steps + 1):
        g, gb = {f: 3e-4 * w[f] for f in kept}, 0.0
        for i in train:
            e = (1 / (1 + math.exp(-(sum(ratio[f] * w[f] for f in held[i]) + bias))) - toxic[i]) * weight[toxic[i]]
            gb += e
            for f in held[i]:
                g[f] += ratio[f] * e
        rate, a, b = 0.05 * (1 - t / steps), 1 - 0.9**t, 1 - 0.999**t
        for f in kept:
            m[f], v[f] = 0.9 * m[f] + 0.1 * g[f], 0.999 * v[f] + 0.001 * g[f] ** 2
            w[f] -= rate * m[f] / a / (math.sqrt(v[f] / b) + 1e-8)
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        bias -= rate * mb / a / (math.sqrt(vb / b) + 1e-8)
    return {i: 1 / (1 + math.exp(-(sum(ratio[f] * w[f] for f in held[i]) + bias))) for i in sets}


def test_scores_match_a_plain_classifier(spark):
    """120 short documents, two thirds labelled: the scores of every one, learned or held out."""
    draw = np.random.default_rng(11)
    mild, rude = "river stone garden morning letter window".split(), "idiot moron scum".split()
    rows = []
    for i in range(120):
        words = list(draw.choice(mild, 8)) + (list(draw.choice(rude, 2, replace=False)) if i % 4 == 0 else [])
        rows.append((i, " ".join(draw.permutation(words)).title() if i % 7 else None))
    toxic = {i: int(i % 4 == 0) for i in range(120) if i % 3}
    df, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    # equal texts are learned from once
    first = {}
    for i, t in rows:
        if i in toxic and zlib.crc32(str(i).encode()) % 5:
            first.setdefault((t, toxic[i]), i)
    once = {i: y for i, y in toxic.items() if zlib.crc32(str(i).encode()) % 5 == 0 or first[dict(rows)[i], y] == i}
    want = brute_toxicity(rows, once)
    got = {r["doc_id"]: r["score"] for r in toxicity.digest(df, labels).collect()}
    assert all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want) and max(got.values()) > 0.7 > 0.3 > min(got.values())


# --- language model ---


def test_base_scores(spark):
    rows = sample(spark).select("doc_id", "text").collect()
    tokens = lambda t: [*WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), "\n"]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = collections.Counter()
    for r in rows:
        if not held(r["doc_id"]):
            counts.update(tokens(r["text"]))
    n, v = counts.total(), len(counts)
    got = {r["doc_id"]: r for r in queries.op5_lm(spark, SF).collect()}
    for r in rows:
        t, g = tokens(r["text"]), got[r["doc_id"]]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held(r["doc_id"]), len(t), sum(counts[x] > 0 for x in t), n)
        assert g["base_score"] == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t))
        assert g["score"] < 0


def test_bit_probabilities_sum_to_one(monkeypatch):
    """Over all bytes in one context the probabilities are a distribution, and so are ending and going on after white space."""
    m = contextmix.Model(contextmix.huffman(np.arange(256)[::-1] ** 2), [contextmix.FIRST_BITS, 15, 15])
    rng = np.random.default_rng(5)
    for t in m.odds:
        t[:] = rng.normal(0, 2, len(t))
    m.weights[:] = rng.normal(0.3, 0.2, m.weights.shape)
    powers = contextmix.Powers()

    def units(*texts):
        offsets = np.cumsum([0, *map(len, texts)])
        with np.errstate(over="ignore"):
            return np.exp(m.units(np.frombuffer(b"".join(texts), np.uint8), offsets, np.full(len(texts), 4, np.uint8), powers))

    spaces = (b" ", b"\n", b"\t")
    stop, go_on = units(*spaces), units(*[x + b"A" for x in spaces])
    monkeypatch.setattr(contextmix, "space_table", lambda: np.zeros(256, bool))
    assert units(*[bytes((b,)) for b in range(256)]).sum() == pytest.approx(1, abs=1e-3)
    assert stop / units(*spaces) + go_on / units(*[x + b"A" for x in spaces]) == pytest.approx(1, abs=1e-5)


def mix64(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % (1 << 64)
    return x ^ (x >> 31)


class PlainModel:
    """The mixing of contexts one bit at a time, in plain Python over dictionaries of slots."""

    def __init__(self, nodes, turns, bits, lead):
        self.nodes, self.turns, self.bits, self.lead = nodes, turns, bits, lead
        self.counts = [collections.defaultdict(lambda: [0, 0]) for _ in range(4)]
        self.odds = [{} for _ in range(4)]
        self.weights = {(d, g): [0.35] * 4 + [0.0] for d in range(9) for g in range(8)}
        self.fixes = collections.defaultdict(lambda: [0.0, 0.0])
        self.seen = 0

    def map(self, fixes, place):
        p = 1 / (1 + math.exp(-(place % 24 - 11.5) / 2))
        zero, one = fixes.get(place, (0.0, 0.0))
        return math.log((one + 8 * p) / (zero + 8 * (1 - p)))

    def bits_of(self, unit, kind):
        """(depth, node, bit, gate, slots, far) of every bit of a unit, in rounds by depth."""
        for i, b in enumerate(unit):
            back = [unit[i - d] + 1 if i >= d else 0 for d in (1, 2, 3)]
            so_far = sum((c + 1) * pow(contextmix.BASE, j, 1 << 64) for j, c in enumerate(unit[:i])) % (1 << 64)
            one = back[0] or 257 + kind
            two, three = back[0] | back[1] << 16 | kind << 32, back[0] | back[1] << 16 | back[2] << 32 | kind << 48
            hashes = [(one & 511) << 8, *(mix64((x + n) % (1 << 64)) >> 32 for n, x in enumerate((two, three, so_far), 1))]
            path = [(min(k, 7), int(self.nodes[k][b]), int(self.turns[k][b])) for k in range(len(self.nodes)) if self.nodes[k][b] >= 0]
            if b in (32, 9, 10, 11, 12, 13):
                path.append((8, 255, int(i == len(unit) - 1)))
            for depth, node, bit in path:
                salt = (node + 1) * 0x9E3779B1 % (1 << 32)
                slots = [hashes[0] | node, *(((h ^ salt) * 0x85EBCA6B % (1 << 32)) >> (32 - n) for h, n in zip(hashes[1:], self.bits[1:], strict=True))]
                yield (len(self.nodes) if depth == 8 else self.depth_of(b, node)), depth, node, bit, min(i, 7), slots, i >= self.lead

    def depth_of(self, b, node):
        return next(k for k in range(len(self.nodes)) if self.nodes[k][b] == node)

    def predict(self, weights, fixes, depth, node, bit, gate, slots, far):
        odds = [o.get(s, 0.0) for o, s in zip(self.odds, slots, strict=True)]
        odds[3] *= far
        w = weights[depth, gate]
        z = w[4] + sum(a * o for a, o in zip(w, odds, strict=False))
        place = node * 24 + int(min(max(z * 2 + 12, 0), 23))
        return odds, z, place, math.log1p(math.exp(-(2 * bit - 1) * (z + self.map(fixes, place)) * 0.5))

    def step(self, units):
        """Learn from a step of (unit, kind, count): all its bits of a depth, then the next depth."""
        rounds = collections.defaultdict(list)
        for unit, kind, count in units:
            for at, *rest in self.bits_of(unit, kind):
                rounds[at].append((count, *rest))
        fixes = {k: tuple(v) for k, v in self.fixes.items()}
        for at in sorted(rounds):
            got = [(count, depth, gate, bit, slots, *self.predict(self.weights, fixes, depth, node, bit, gate, slots, far)) for count, depth, node, bit, gate, slots, far in rounds[at]]
            total, change = collections.Counter(), collections.defaultdict(lambda: [0.0] * 5)
            for count, depth, gate, bit, _, odds, z, _, _ in got:
                total[depth, gate] += count
                error = (bit - 1 / (1 + math.exp(-min(max(z, -30), 30)))) * count
                for i, o in enumerate([*odds, 0.1]):
                    change[depth, gate][i] += error * o
            for key, d in change.items():
                self.weights[key] = [w + 0.3 / (total[key] + 1e-9) * x for w, x in zip(self.weights[key], d, strict=True)]
            for count, _, _, bit, slots, _, _, place, _ in got:
                self.seen += count
                self.fixes[place][bit] += count
                for c, s in zip(self.counts, slots, strict=True):
                    c[s][bit] += count
            for row in got:
                for c, o, s in zip(self.counts, self.odds, row[4], strict=True):
                    o[s] = math.log((c[s][1] + 0.4) / (c[s][0] + 0.4))


def steps_of(units, limit):
    step, size = [], 0
    for u in units:
        if step and size + len(u[0]) > limit:
            yield step
            step, size = [], 0
        step.append(u)
        size += len(u[0])
    if step:
        yield step


def test_scores_match_plain_python(spark, monkeypatch):
    """Whole scores of 60 documents against a model that works bit by bit, in several shares."""
    monkeypatch.setattr(contextmix, "SHARE", 1200)
    monkeypatch.setattr(contextmix, "STEP", 2000)
    docs = sample(spark).orderBy("doc_id").limit(57).select("doc_id", "text").union(spark.createDataFrame([(9001, "  two  spaces\n\nend \t"), (9002, ""), (9003, None)], "doc_id long, text string")).cache()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    marks = {**dict.fromkeys(b".!?", 1), **dict.fromkeys(b",;:", 2)}

    def units_of(text):
        raw, out, before = (text or "").encode(), [], 0
        for m in re.finditer(rb"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", raw):
            kind = 0 if m.start() == 0 else 5 if raw[m.start() - 1] == 10 else before
            last = re.search(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*$)", m.group())
            if last:
                c = last.group()[0]
                before = marks.get(c, 4 if chr(c).isalnum() and c < 128 or c >= 128 else 3)
            else:
                before = 4
            out.append([m.group(), kind])
        if out:
            out[-1] = [out[-1][0] + b"\xff", out[-1][1], 8]
        return [(u[0], u[1] + (8 if len(u) > 2 else 0)) for u in out] or [(b"\xff", 8)]

    counts = collections.Counter()
    rows = docs.collect()
    for r in rows:
        for u in units_of(r["text"]):
            counts[u] += not held(r["doc_id"])
    x = docs.select("doc_id", F.col("text").cast("binary").alias("raw"), (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 1).alias("learnable"))
    table = contextmix.unit_rows(x).where("k >= 0").groupBy("u", "t", "k", "b").agg(F.sum("c").alias("c"))
    n = table.count()
    dealt = contextmix.dealt(table, n).collect()
    assert {(bytes(r["b"]), r["k"]): r["c"] for r in dealt} == dict(counts) and len({r["share"] for r in dealt}) > 1
    histogram = np.zeros(256, np.int64)
    for (unit, _), c in counts.items():
        np.add.at(histogram, np.frombuffer(unit, np.uint8), c)
    nodes, turns = contextmix.huffman(histogram)
    bits = contextmix.table_bits(n)
    parts = collections.defaultdict(list)
    for r in sorted(dealt, key=lambda r: (r["share"], r["u"], r["k"])):
        parts[r["share"]].append((bytes(r["b"]), r["k"], r["c"]))
    room = lambda units: max(contextmix.LEAST_BITS, (2 * sum(len(u) for u, *_ in units)).bit_length())
    short = [collections.defaultdict(lambda: [0, 0]) for _ in range(3)]
    weights, fixes, seen = collections.defaultdict(lambda: [0.0] * 5), collections.defaultdict(lambda: [0.0, 0.0]), 0
    for units in parts.values():
        units = [(u, k & 7, c) for u, k, c in units if c]
        m = PlainModel(nodes, turns, [*bits, room(units)], contextmix.LEAD)
        for step in steps_of(units, 2000):
            m.step(step)
        seen += m.seen
        for a, b in zip(short, m.counts, strict=False):
            for s, (zero, one) in b.items():
                a[s][0] += zero
                a[s][1] += one
        for key, w in m.weights.items():
            weights[key] = [a + b * m.seen for a, b in zip(weights[key], w, strict=True)]
        for place, (zero, one) in m.fixes.items():
            fixes[place][0] += zero
            fixes[place][1] += one
    weights = {k: [a / seen for a in w] for k, w in weights.items()}
    lp = {}
    for units in parts.values():
        m = PlainModel(nodes, turns, [*bits, room(units)], contextmix.LEAD)
        local = collections.defaultdict(lambda: [0, 0])
        for u, k, c in units:
            for _, _, _, bit, _, slots, _ in m.bits_of(u, k & 7):
                local[slots[3]][bit] += c
        m.odds = [{s: math.log((one + 0.4) / (zero + 0.4)) for s, (zero, one) in t.items()} for t in (*short, local)]
        for u, k, _ in units:
            lp[u, k] = -sum(m.predict(weights, fixes, *x[1:])[3] for x in m.bits_of(u, k & 7)) / math.log(10)
    got = {r["doc_id"]: r["score"] for r in contextmix.digest(docs).collect()}
    for r in rows:
        assert got[r["doc_id"]] == pytest.approx(sum(lp[u] for u in units_of(r["text"])), rel=3e-3, abs=1e-2)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    """The same scores from one, three and sixteen partitions, with several shares."""
    monkeypatch.setattr(contextmix, "SHARE", 2000)
    docs = sample(spark).limit(150).cache()
    seen = [{r["doc_id"]: r["score"] for r in contextmix.digest(docs.repartition(n)).collect()} for n in (1, 3, 16)]
    for other in seen[1:]:
        assert all(other[i] == pytest.approx(v, rel=1e-9) for i, v in seen[0].items())


def test_long_texts_are_cut_at_words(monkeypatch):
    text = b" start. " + b" ".join(b"w%d,  x\n" % (i * 7919 % 97) for i in range(900)) + b"z" * 4000 + b" end"
    other = b"short text"
    data, offsets = np.frombuffer(text + other, np.uint8), np.array([0, len(text), len(text), len(text) + len(other)])

    def all_units():
        u = contextmix.Units()
        with np.errstate(over="ignore"):
            u.add(data, offsets)
        row, inverse, codes, _, _, word, kind = u.distinct()
        return sorted(zip(row.tolist(), codes[inverse].tolist(), word[inverse].tolist(), kind[inverse].tolist(), strict=True))

    whole = all_units()
    monkeypatch.setattr(contextmix, "HASH_BLOCK", 300)
    assert all_units() == whole


def test_tables_grow_with_the_units():
    assert contextmix.table_bits(1000) == [17, 14, 14] and contextmix.table_bits(1 << 20) == [17, 19, 19] and contextmix.table_bits(1 << 40) == [17, 20, 23]


def test_model_learns(spark):
    texts = ["the cat sat on the mat and the dog ran to the cat. " * 4] * 40 + ["xq zv kj wp qz vx" * 5]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["bits_per_byte"] for r in contextmix.digest(df).collect()}
    assert got[0] < 3 < got[40]


def test_language_model_edge_cases(spark, docs, empty):
    assert contextmix.digest(empty).count() == 0
    rows = contextmix.digest(docs).collect()
    assert len(rows) == docs.count()
    by = collections.defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add(round(r["score"], 3))
    assert all(len(v) == 1 for v in by.values()) and by[2] == by[3]


def test_frequent_units_keep_their_odds(spark):
    """A unit counted 10 million times against units with its prefix."""
    units = {"the ": 10_000_000, "then ": 30_000, "them ": 50_000, "they ": 60_000, "these ": 40_000}
    histogram = np.zeros(256, np.int64)
    for u, c in units.items():
        np.add.at(histogram, np.frombuffer(u.encode(), np.uint8), c)
    tree = contextmix.huffman(histogram)
    rows = spark.createDataFrame([(i, 0, 4, bytearray(u.encode()), c) for i, (u, c) in enumerate(units.items())], "u long, t long, k int, b binary, c long")
    got = contextmix.unit_scores(rows, 5, contextmix.fitted(contextmix.learn_rows(rows, 5, tree), 5, tree)).collect()
    lp = {r["u"]: 10 ** r["lp"] for r in got}
    total = sum(units.values())
    assert lp[0] == pytest.approx(units["the "] / total, rel=0.1) and all(lp[i] < 0.05 for i in range(1, 5))
