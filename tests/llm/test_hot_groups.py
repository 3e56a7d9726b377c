"""Groups that hold a large share of all rows: one hash, one start of words, very many findings in a text; and the codecs of images."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.oracle import SF
from tidemark.llm import contextmix, media, secrets


def test_spans_are_masked_in_one_pass():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abcé漢\U0001f600") for _ in range(rng.randrange(60)))
        spans = sorted((a, min(len(text), a + rng.randrange(1, 9))) for a in (rng.randrange(len(text)) for _ in range(rng.randrange(6)))) if text else []
        marked = [any(a <= i < b for a, b in spans) for i in range(len(text))]
        got = secrets.mask_spans(text, spans, "_")
        assert got.replace("_", "") == "".join(c for c, m in zip(text, marked, strict=True) if not m)
    assert secrets.mask_spans("abcdef", [(0, 2), (1, 3), (4, 5)], "#") == "#d#f"
    assert len(secrets.mask_spans("x" * 2_000_000, [(i, i + 10) for i in range(0, 2_000_000, 20)], "")) == 1_000_000


def test_one_secret_in_most_rows(spark):
    """The join of spans and verdicts deals out both sides, so that Spark can split the hot hash."""
    hot, own = "Zq81mXk2Lw93TbVn", "Pk7dQw2Xn5Bv8Rt1"
    rows = [(i, f"password = {hot if i % 10 else own}{i if i % 10 == 0 else ''}", "en", f"s{i % 5}", 1) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = secrets.findings(df)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["doc_id"]: [s["is_live"] for s in r["found"]] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [x for x in plan.split("\n") if "Exchange hashpartitioning(h#" in x and "ENSURE_REQUIREMENTS" in x]
    assert len(joins) >= 3  # two of the sides of the join, one of the counts
    assert got == {i: [i % 10 == 0] for i in range(500)}


def test_a_frequent_start_of_words_is_split(spark, monkeypatch):
    monkeypatch.setattr(contextmix, "SHARE", 100)
    rng = random.Random(4)
    words = {f"http://h{rng.randrange(40)}.{rng.random()}" for _ in range(3000)} | {f"{rng.random():.4f}"[2:] + "x" for _ in range(3000)} | {"http", "htt", "http://"}
    rows = [(i, 1, 0, w.encode(), 1) for i, w in enumerate(sorted(words))]
    units = spark.createDataFrame(rows, "u long, t long, k int, b binary, c long")
    n, hot = contextmix.leads(units)
    assert n == len(rows) and {b"http"} == set(hot[4]) and max(hot) >= 8
    shares = collections.defaultdict(list)
    for r in contextmix.dealt(units, n, hot).collect():
        shares[r["share"]].append(bytes(r["b"]))
    assert sorted(x for s in shares.values() for x in s) == sorted(r[3] for r in rows)
    assert max(map(len, shares.values())) < 500 < max(collections.Counter(r["share"] for r in contextmix.dealt(units, n).collect()).values())
    where = {}
    for share, found in shares.items():
        lead = share % contextmix.DEEPEST
        assert all(where.setdefault((lead, b[:lead]), share) == share for b in found)  # all units with a lead are together


def test_scores_with_a_split_start_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(contextmix, "SHARE", 60)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).select("doc_id", F.concat(F.lit("http"), F.regexp_replace("text", " ", " http")).alias("text")).cache()
    x = docs.select("doc_id", F.col("text").cast("binary").alias("raw"), F.lit(True).alias("learnable"))
    units = contextmix.unit_rows(x).where("k >= 0").groupBy("u", "t", "k", "b").agg(F.sum("c").alias("c"))
    assert contextmix.leads(units)[1]
    seen = [{r["doc_id"]: r["score"] for r in contextmix.digest(docs.repartition(n)).collect()} for n in (1, 7)]
    assert all(seen[1][i] == pytest.approx(v, rel=1e-9) for i, v in seen[0].items()) and all(v < 0 for v in seen[0].values())


def test_every_row_of_a_share_is_kept():
    kind = lambda b: pa.RecordBatch.from_pydict({"share": pa.array([7] * len(b)), "b": pa.array(b, pa.binary())})
    parts = [kind([b"a" * 10, b""]), kind([b"b"]), kind([None, b"c" * 100])]
    (batch,) = contextmix.shares(parts)
    assert batch.num_rows == 5 and pa.types.is_large_binary(batch.column(1).type) and batch.column(1).to_pylist() == [b"a" * 10, b"", b"b", None, b"c" * 100]


# --- codecs ---


def plain_lzw(data: bytes, size: int) -> bytes:
    """Bit by bit, as the format tells it."""
    bits = "".join(f"{b:08b}" for b in data)
    at, table, out, old = 0, None, b"", None
    while len(out) < size:
        n = 258 if table is None else len(table) + (old is not None)  # the entry that this code is about to add
        width = 9 if n < 511 + 1 else 10 if n < 1023 + 1 else 11 if n < 2047 + 1 else 12
        code = int(bits[at : at + width], 2)
        at += width
        if code == 256:
            table, old = [bytes((i,)) for i in range(256)] + [b"", b""], None
            continue
        if code == 257:
            break
        entry = table[code] if code < len(table) else old + old[:1]
        if old is not None:
            table.append(old + entry[:1])
        out, old = out + entry, entry
    return out


CASES = [b"", b"a", b"aa", b"aaa", b"abab" * 800, bytes(5000), bytes(range(256)) * 40, b"ab" * 127 + b"c" * 129 + b"dd" + b"e" * 128, np.random.default_rng(3).bytes(20_000), ("Grüße, 漢字! " * 700).encode()]


@pytest.mark.parametrize("data", CASES, ids=range(len(CASES)))
def test_codecs_against_plain_forms(data):
    raw = media.lzw_encode(data)
    assert media.lzw_decode(raw, len(data)) == plain_lzw(raw, len(data)) == data
    packed = media.packbits_encode(data)
    assert media.packbits_decode(packed, len(data)) == data and len(packed) <= len(data) + -(-len(data) // 128)


def test_broken_lzw_is_an_error_or_short():
    raw = media.lzw_encode(b"some text that is repeated, some text that is repeated")
    assert len(media.lzw_decode(raw[: len(raw) // 2], 54)) < 54
    for broken in (b"\x80\x3f\xff\xff\xff\xff", b"\x80\x7f\xe0\x00\x00"):
        with pytest.raises(ValueError):
            media.lzw_decode(broken, 1000)


def test_a_third_of_the_payloads_goes_through_each_codec():
    seen = collections.Counter(media.read_tiff(media.store(f"{i:064d}".encode()))[0]["compression"] for i in range(600))
    assert all(150 < seen[c] < 250 for c in (media.LZW, media.PACKBITS, media.DEFLATE))


def test_digest_columns_against_plain_loops(spark, docs):
    import hashlib
    import zlib

    for df in (docs, spark.read.parquet(f"{SF}/documents.parquet").limit(30)):
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            raw = (r["text"] or "").encode()
            payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
            file = media.store(payload)
            n = len(payload) // 64
            columns = [sum(payload[c::64]) for c in range(64)]
            bits = sum((64 * v > sum(columns)) << (63 - c) for c, v in enumerate(columns))
            feature = f"{-(-n // media.PAGE_ROWS)}x{n}:{1000 * sum(columns) // len(payload)}:{bits:016x}"
            want[r["doc_id"], len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(file), hashlib.sha256(file).hexdigest(), feature] += 1
        assert collections.Counter(tuple(r) for r in media.media_digest(df).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature").collect()) == want


# --- long texts, links at the threshold ---


def test_long_texts_with_blank_lines_are_encoded_in_parts(monkeypatch):
    from tidemark.llm import packing

    rng = random.Random(6)
    path = packing.default_vocabulary()
    plain = packing.encoder(path)
    bits = ["word", "été", "x1", "42", "...", "!?", "漢字", "\U0001f600", "don't", "Ünï"]
    gaps = [" ", "\n", "  ", "\n\n", " \n ", "\t", " ", " ", "\x1c", "\x85", ""]
    texts = ["".join(rng.choice(bits) + rng.choice(gaps) for _ in range(300)) for _ in range(60)] + [" " * 500, "a" * 500 + "\n\n" + "b " * 300, "\n\na b"]
    whole = [plain(t) for t in texts]
    cut = []
    keep = packing.parts
    monkeypatch.setattr(packing, "LONG_TEXT", 40)
    monkeypatch.setattr(packing, "parts", lambda t, safe: (cut.append(list(keep(t, safe))), cut[-1])[1])
    small = packing.encoder(path)
    assert [small(t) for t in texts] == whole
    assert all("".join(c) == t for c, t in zip(cut, [t for t in texts if "".join(t) in {"".join(c) for c in cut}], strict=False)) and max(map(len, cut)) > 10


def test_rows_that_differ_in_other_columns_only_give_the_same_row_in_each_run(spark):
    from tidemark.llm import neardup

    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, f"s{i % 7}", i % 5) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    assert {tuple(neardup.deduplicated(df.repartition(n, "source")).first()) for n in (1, 3, 5)} == {min(rows, key=lambda r: f'{{"doc_id":1,"text":"{text}","source":"{r[2]}","n_chars":{r[3]}}}')}


def test_recall_of_planted_pairs_around_the_threshold(spark):
    """Pairs of sets of 8 to 500 shingles whose similarity lies from 0.75 up; each pair has words of its own, so that every link is known."""
    from tidemark.llm import neardup

    rng = random.Random(8)
    rows, want = [], set()
    for p in range(900):
        n = rng.choice([8, 12, 20, 40, 80, 200, 500])
        words = [f"p{p}w{i}" for i in range(n + 4)]
        other = list(words)
        # k shingles fall out and k come in: similarity (n - k) / (n + k)
        k = rng.choice([n // 7, n // 7, n // 7 + 1, max(1, n // 20)])
        other = [f"p{p}v{i}" for i in range(k)] + other[k:] if rng.random() < 0.5 else other[: len(other) - k] + [f"p{p}v{i}" for i in range(k)]
        a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (words, other))
        rows += [(2 * p, " ".join(words)), (2 * p + 1, " ".join(other))]
        if 100 * len(a & b) >= 75 * len(a | b):
            want.add(p)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    found = {p for p in range(900) if got[2 * p + 1] == 2 * p}
    assert not found - want and len(want) > 400 and len(found) >= 0.99 * len(want)
