"""Near duplicates, repeats, packing, archives, media and the pipeline against brute force and round trips."""

import base64
import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import SF
from tidemark.llm import _io, media, neardup, packing, queries, repeats, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = random.Random(11)


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


# --- near duplicates ---


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= 75 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check_components(df):
    want = brute_components([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").distinct().collect()])
    got = neardup.near_duplicates(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_components_of_the_sample(spark):
    check_components(spark.read.parquet(f"{SF}/documents.parquet").limit(200))


def test_families_chains_and_common_lines(spark):
    """A family of copies, a chain of edits, and a line that unrelated texts share."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    origin = [word() for _ in range(60)]
    texts = []
    for _ in range(40):
        w = list(origin)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = word()
        texts.append(" ".join(w))
    w = [word() for _ in range(80)]
    for i in range(12):
        w[i * 6] = word()
        texts.append(" ".join(w))
    line = " ".join(word() for _ in range(20))
    texts += [line + " " + " ".join(word() for _ in range(rng.choice((3, 6, 12, 30)))) for _ in range(40)]
    texts += [line, line.upper(), "a b", "A b", "", None]
    check_components(frame(spark, texts))


def test_near_duplicates_edge_cases(spark, docs, empty):
    assert neardup.near_duplicates(empty).count() == 0
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert [(r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] in (2, 3, 4)] == [(0, r["doc_id"]) for r in got if r["doc_id"] in (2, 3, 4)]


def test_contained_sets_of_window_size(spark):
    """Texts that are contained in texts with more shingles than the window."""
    draw = random.Random(17)
    texts = []
    for n in range(30, 65):
        for _ in range(6):
            text = [f"w{draw.getrandbits(40):x}" for _ in range(4 * n // 3 + 4)]
            texts += [" ".join(text[: n + 4]), " ".join(text)]
    check_components(frame(spark, texts))


def test_classes_are_sets_not_ids(spark):
    """Several texts under one id, null ids, and a group of near copies whose members share a line with strangers."""
    draw = random.Random(23)
    word = lambda: f"w{draw.getrandbits(30):x}"
    a, b, line = [word() for _ in range(60)], [word() for _ in range(60)], [word() for _ in range(12)]
    near = [*b[:30], word(), *b[31:]]
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(near)), (None, " ".join([*a[:5], word(), *a[6:]])), (None, " ".join(word() for _ in range(40)))]
    origin = [word() for _ in range(100)]
    for i in range(300):
        w = list(origin)
        for _ in range(draw.randrange(5)):
            at = draw.randrange(100)
            w[at : at + draw.randrange(2)] = [word() for _ in range(draw.randrange(2))]
        rows.append((10 + i, " ".join((line if i % 3 == 0 else []) + w)))
    rows += [(1000 + i, " ".join(line + [word() for _ in range(60)])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.grouped(df).collect()
    keyed = {(r["doc_id"], r["key"]): r["component_id"] for r in got}
    want = brute_components(list(enumerate(t for _, t in rows)))
    keys = [(r["doc_id"], r["key"]) for r in df.select("doc_id", F.xxhash64(F.col("text").cast("binary")).alias("key")).collect()]
    parts = collections.defaultdict(set)
    for i, (_, component) in want.items():
        parts[component].add(i)
    for members in parts.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        assert {keyed[keys[i]] for i in members} == {min(ids, default=None)}
    kept = neardup.deduplicated(df).collect()
    assert len(kept) == len(parts) and {r["text"] for r in kept} <= {t for _, t in rows}


def test_wanted_rows_beyond_the_filter(spark, monkeypatch):
    """Rows are joined where the bitmap would be too large; null ids and null texts meet their like."""
    df = spark.createDataFrame([(1, "a b c d e f"), (None, "g h i j k l"), (3, None), (4, "a b c d e f")], "doc_id long, text string")
    wanted = neardup.keyed(df).where("doc_id is null or doc_id = 4").select("doc_id", "key")
    few = {tuple(r) for r in neardup.full_sets(df, wanted).select("n", "s1", "s2").collect()}
    monkeypatch.setattr(neardup, "FILTER_BYTES", 1)
    exact = neardup.full_sets(df, wanted).select("n", "s1", "s2").collect()
    assert len(exact) == 2 and {tuple(r) for r in exact} <= few


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"Word{i * 7919 % 1013}" for i in range(3000)).encode() + b" " + b"x" * 9000 + b" end"
    data, offsets = np.frombuffer(text + b"a b c d e f", np.uint8), np.array([0, len(text), len(text) + 11])
    with np.errstate(over="ignore"):
        whole = neardup.shingles(data, offsets, neardup.Powers())
        monkeypatch.setattr(neardup, "BLOCK", 1000)
        cut = neardup.shingles(data, offsets, neardup.Powers())
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, cut, strict=True))


# --- repeats ---


def brute_repeats(texts):
    counts = collections.Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    out = []
    for b in texts:
        mask = bytearray(len(b))
        for i in range(len(b) - 199):
            if counts[b[i : i + 200]] > 1:
                mask[i : i + 200] = b"\1" * 200
        kept = bytes(c for c, m in zip(b, mask, strict=True) if not m)
        out.append((len(b), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return out


def check_repeats(df):
    rows = df.select("doc_id", "text").collect()
    want = sorted(zip([r["doc_id"] is None or r["doc_id"] for r in rows], brute_repeats([(r["text"] or "").encode() for r in rows]), strict=True))
    got = sorted((r["doc_id"] is None or r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in repeats.without_repeats(df).collect())
    assert got == want


def test_repeats_of_the_sample(spark):
    check_repeats(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize("hot", (2, 1000))
def test_passages_runs_and_copies(spark, monkeypatch, hot):
    """Passages in many contexts, runs of one character, copies, overlaps and texts around the length."""
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    p, q = text(260), text(420)
    texts = [text(rng.randrange(50, 400)) + p + text(rng.randrange(50, 400)) for _ in range(12)]
    texts += [text(100) + q[:300] + text(30), q[150:] + text(80), q + q, "x" * 1000, "y" * 199, "y" * 200, "y" * 200, p[:199], p[:200], text(500), "", None]
    texts.append(texts[0])
    check_repeats(frame(spark, texts))


def test_family_levels(monkeypatch):
    """Segments of a two-letter text in many batches: every window that occurs twice is marked, levels fall in size."""
    monkeypatch.setattr(repeats, "SCAN", 64)
    draw = np.random.default_rng(3)
    data = draw.integers(97, 99, 3000).astype(np.uint8)
    data[2000:2500] = data[100:600]
    cuts = sorted({0, 2801, *draw.integers(1, 2800, 60).tolist()})
    f, held = repeats.Family(), []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        held.append((lo, hi))
        f.add(repeats.Level(data[lo : hi + 199], [np.array([lo]), np.array([0]), np.array([0]), np.array([hi - lo])]))
    count = collections.Counter(data[i : i + 200].tobytes() for i in range(2801))
    marked = {a + i for level in f.levels for a, _, _, ranges in level.matches() for r in ranges for i in range(r["lo"], r["hi"])}
    assert marked == {i for i in range(2801) if count[data[i : i + 200].tobytes()] > 1}
    sizes = [len(x.order) for x in f.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == 2801
    for level in f.levels:
        keys = [level.data[i : i + 200].tobytes() for i in level.order]
        assert keys == sorted(keys)


@pytest.mark.parametrize("hot", (2, 1000))
def test_batches_extend_the_family(spark, monkeypatch, hot):
    """Three batches, one after the other, give what all documents at once give; levels are read back, merged and kept."""
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    draw = random.Random(37)
    text = lambda n: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz é\n", k=n))
    passages = [text(draw.randrange(220, 500)) for _ in range(6)]
    texts = [text(draw.randrange(30, 300)) + draw.choice(passages) + text(draw.randrange(30, 300)) for _ in range(60)] + ["z" * 700, text(300), "", None]
    texts += [texts[0], texts[1], passages[0]]
    df = frame(spark, texts).cache()
    family = repeats.Passages()
    for i in range(3):
        family.add(repeats.keyed(df.where(F.col("doc_id") % 3 == i)))
    got = repeats.stripped(repeats.keyed(df), family.cuts()).collect()
    want = brute_repeats([(t or "").encode() for t in texts])
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == dict(enumerate(want))
    index = family.union(family.index)
    if hot > 2:
        assert index.where("what = 'gone'").count() > 0 and family.levels().count() < index.where("what = 'level'").count()


def test_long_texts_in_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 500)
    draw = random.Random(41)
    text = lambda n: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    p = text(900)
    check_repeats(frame(spark, [text(1500) + p + text(700), text(333) + p[100:800] + text(2000), text(500), text(699), p[:400], "ab" * 1200]))


def test_repeats_edge_cases(spark, docs, empty):
    assert repeats.without_repeats(empty).count() == 0
    check_repeats(docs)


def test_repeats_of_rows_without_ids(spark):
    """A passage of a row with a null id and of another row, in different contexts."""
    draw = random.Random(19)
    text = lambda n: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage = text(260)
    check_repeats(spark.createDataFrame([(None, text(400) + passage + text(300)), (7, text(150) + passage + text(500))], "doc_id long, text string"))


# --- packing ---


def check_packing(df, vocabulary=None):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary or packing.default_vocabulary())
    ids = collections.defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        ids[r["doc_id"]].append([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    got = packing.pack(df).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for doc, rows in pieces.items():
        want = []
        for x in ids[doc]:
            want += [(at, min(1024, len(x) - at), zlib.crc32(np.array(x[at : at + 1024], "<u4").tobytes()), len(x)) for at in range(0, len(x), 1024)]
        assert sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == sorted(want)
    total = room = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        total, room = total + at, room + packing.padded(at, 1024)
    return 1 - total / room


def test_packing_of_the_sample(spark):
    assert check_packing(spark.read.parquet(f"{SF}/documents.parquet")) < 0.02


def test_encoder_gives_the_ids_of_the_library(spark, monkeypatch):
    """Whole documents at sf0.01 and texts with every kind of white space, marks and letters next to it."""
    from tokenizers import Tokenizer

    path = packing.default_vocabulary()
    t, encode = Tokenizer.from_file(path), packing.encoder(path)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("text").collect()]
    draw = random.Random(29)
    alphabet = list("ab1.'") + [" "] * 5 + ["\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "é", "漢", "ß", "\u0301", "👍", "'s", "<|endoftext|>", "½", "٣"]
    texts += ["".join(draw.choices(alphabet, k=draw.randrange(1, 40))) for _ in range(4000)]
    texts += [" a", "a ", "  ", " ", "", "x" * 5000 + " " + "y" * 200]
    want = t.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(encode(x), "<u4").tolist() for x in texts] == [e.ids for e in want]
    monkeypatch.setattr(packing, "HELD_CHUNKS", 50)
    few = packing.encoder(path)
    assert [np.frombuffer(few(x), "<u4").tolist() for x in texts[:900]] == [e.ids for e in want[:900]]
    words = ["".join(draw.choices([chr(i) for i in (*range(0x41, 0x5B), *range(0xC0, 0x250), *range(0x400, 0x530))], k=9)) + draw.choice(["", ",", "...", "?!", ")."]) for _ in range(5000)]
    assert np.frombuffer(encode(" ".join(words)), "<u4").tolist() == t.encode(" ".join(words), add_special_tokens=False).ids


def test_special_token_strings(spark):
    assert check_packing(frame(spark, ["a <|endoftext|> b", "<|endoftext|>", "", None, "é" * 3000])) < 1


def test_packing_edge_cases(spark, docs, empty):
    assert packing.pack(empty).count() == 0
    check_packing(docs)


def test_cutting_stock_uses_every_piece():
    g = np.random.default_rng(2)
    counts = {int(k): int(v) for k, v in zip(*np.unique(g.integers(1, 1025, 5000), return_counts=True), strict=True)}
    used, tokens, room = collections.Counter(), 0, 0
    for pattern, times in packing.solve(counts):
        size = sum(v * k for v, k in pattern.items())
        assert size <= 1024 and times > 0
        tokens, room = tokens + size * times, room + packing.padded(size, 1024) * times
        for v, k in pattern.items():
            used[v] += k * times
    assert dict(used) == counts and 1 - tokens / room < 0.01
    three = packing.solve({341: 30, 683: 30, 500: 4})
    assert sum(t for _, t in three) == 32


def test_pricing_finds_the_best_pattern():
    """Against all patterns of a small case: sequences of 16 with pieces of 3, 5 and 7."""
    lengths, duals = np.array([3, 5, 7]), np.array([3.5, 5.2, 7.9])
    cost = np.array([0, *[packing.padded(t, 16) for t in range(1, 17)]], float)
    best = min(cost[3 * a + 5 * b + 7 * c] - a * 3.5 - b * 5.2 - c * 7.9 for a in range(6) for b in range(4) for c in range(3) if 0 < 3 * a + 5 * b + 7 * c <= 16)
    p = packing.price(duals, lengths, cost, 16, 1)[0]
    size = sum(int(lengths[i]) * k for i, k in p.items())
    assert cost[size] - sum(duals[i] * k for i, k in p.items()) == pytest.approx(best)


# --- archives ---


def test_archive_round_trip(spark):
    html = ["<p>one</p>", "<p>one</p>", "", None, "é" * 5000, "<p>one</p>"] + [f"<p>page {i % 7}</p>" for i in range(40)]
    pages = spark.createDataFrame([(100 - i, f"http://x/{i}", h, "clash") for i, h in enumerate(html)], "page_id long, url string, html string, payload string")
    groups = collections.defaultdict(list)
    for i, h in enumerate(html):
        groups[(h or "").encode()].append(100 - i)
    want = {}
    for body, ids in groups.items():
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for i in ids:
            first = min(ids)
            want[i] = (len(body), sha, "response" if i == first else "revisit", None if i == first else first)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()}
    assert got == want
    assert warc.round_trip(pages.where("false")).count() == 0


def test_archive_edge_cases(spark):
    """Null ids and urls, repeated rows, a payload that most pages share, a very long page."""
    rows = [(5, None, "same"), (None, "http://x", "same"), (None, None, "alone"), (None, None, "alone"), (9, "u", None), (9, "u", None), (3, "u", "é" * 300_000), *[(100 + i, "u", "same") for i in range(200)]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect())
    assert got == {(5, 4, "response", None): 1, (None, 4, "revisit", 5): 1, (None, 5, "response", None): 2, (9, 0, "response", None): 2, (3, 600_000, "response", None): 1, **{(100 + i, 4, "revisit", 5): 1 for i in range(200)}}


def test_archive_files_and_faults(spark, tmp_path):
    records = [warc.record(i, f"http://x/{i}", b"payload %d " % i * 20, None) for i in range(30)]
    raw = warc.pack_archive(records)
    assert raw[:4] == bytes((0x5D, 0x2A, 0x4D, 0x18))
    (tmp_path / "a.warc.zst").write_bytes(raw)
    rows = warc.read_files(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["payload"]) for r in rows) == sorted(b"payload %d " % i * 20 for i in range(30))
    for bad in (raw[:-3], raw[:6], raw.replace(b"\x28\xb5\x2f\xfd", b"\0\0\0\0")):
        with pytest.raises((ValueError, warc.zstandard.ZstdError)):
            list(warc.iter_archive(bad))
    with pytest.raises(ValueError, match="Content-Length"):
        warc.parse_record(records[0].replace(b"payload 0", b"payload", 1))
    flipped = records[0].replace(b"payload 0", b"payl0ad 0", 1)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(flipped)


# --- media ---


def test_codecs_round_trip():
    g = random.Random(4)
    for n in (0, 1, 2, 127, 128, 129, 4000, 9000):
        for data in (bytes(n), g.randbytes(n), bytes(g.choice(b"ab ") for _ in range(n))):
            assert media.packbits_decode(media.packbits_encode(data), n) == data
            assert media.lzw_decode(media.lzw_encode(data), n) == data


@pytest.mark.parametrize("compression", (media.NONE, media.PACKBITS, media.LZW, media.DEFLATE))
@pytest.mark.parametrize("predictor", (1, 2))
@pytest.mark.parametrize("tile", (None, (16, 32)))
def test_tiff_round_trip(compression, predictor, tile):
    page = np.frombuffer(random.Random(5).randbytes(300 * 70), np.uint8).reshape(300, 70)
    pages = media.read_tiff(media.write_tiff([page, page[:3]], compression, predictor, tile))
    assert [(p["width"], p["height"], p["data"]) for p in pages] == [(70, 300, page.tobytes()), (70, 3, page[:3].tobytes())]


def test_codecs_read_fixed_strings():
    """Bytes that other programs write: the published PackBits example, LZW codes by hand, a deflate stream."""
    packed = bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")
    assert media.packbits_decode(packed, 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]  # clear, 7, 7 7, 8, 8, 7 7, 6, 6, end
    bits = "".join(f"{c:09b}" for c in codes)
    raw = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8))
    assert media.lzw_decode(raw, 9) == bytes((7, 7, 7, 8, 8, 7, 7, 6, 6))
    assert media.lzw_encode(bytes((7, 7, 7, 8, 8, 7, 7, 6, 6))) == raw
    head = b"MM\0*" + (8).to_bytes(4) + (8).to_bytes(2)
    strip = zlib.compress(bytes(range(12)))
    tags = [(256, 3, 4 << 16), (257, 3, 3 << 16), (258, 3, 8 << 16), (259, 3, 8 << 16), (262, 3, 1 << 16), (273, 4, 110), (278, 3, 3 << 16), (279, 4, len(strip))]
    file = head + b"".join(t.to_bytes(2) + k.to_bytes(2) + (1).to_bytes(4) + v.to_bytes(4) for t, k, v in tags) + bytes(4)
    file = file + bytes(110 - len(file)) + strip
    assert [(p["width"], p["height"], p["data"]) for p in media.read_tiff(file)] == [(4, 3, bytes(range(12)))]


def test_every_codec_and_layout_is_stored(spark):
    """Texts of one size go through all codecs, in strips and tiles, over several pages."""
    texts = [f"{i} " + "lorem ipsum dolor " * 2500 for i in range(24)]
    files = media.stored(frame(spark, texts))
    pages = media.read_tiff_pages(files, "file", "media").groupBy("file.doc_id").agg(F.count("*").alias("n"), F.max("compression").alias("c")).collect()
    assert {r["c"] for r in pages} == {media.PACKBITS, media.LZW, media.DEFLATE} and all(r["n"] == 3 for r in pages)
    layouts = {324 in {int.from_bytes(m[i : i + 2], "little") for i in range(len(m) - 200, len(m), 2)} for m in (r["media"] for r in files.collect())}
    assert layouts == {True, False}
    got = {r["doc_id"]: r for r in media.media_digest(frame(spark, texts)).collect()}
    assert all(got[i]["payload_sha256"] == hashlib.sha256(t.encode().ljust(-(-len(t) // 64) * 64, b"\0")).hexdigest() for i, t in enumerate(texts))


def test_hostile_sizes_are_errors():
    tiff = bytearray(media.write_tiff([np.zeros((4, 64), np.uint8)]))
    at = tiff.index((257).to_bytes(2, "little") + (4).to_bytes(2, "little")) + 8
    tiff[at : at + 4] = (0xFFFFFFF0).to_bytes(4, "little")
    with pytest.raises(ValueError, match="page size"):
        media.read_tiff(bytes(tiff))


def test_pages_as_rows(spark):
    tiff = media.write_tiff([np.zeros((4, 8), np.uint8), np.ones((2, 8), np.uint8)])
    df = spark.createDataFrame([(1, bytearray(tiff), "x"), (2, None, "x"), (3, bytearray(b"II*\0"), "x"), (4, bytearray(tiff[:40]), "x")], "id long, content binary, width string")
    got = media.read_tiff_pages(df, "id", "content").orderBy("id", "page_no").collect()
    assert [(r["id"], r["page_no"], r["height"]) for r in got if r["error"] is None] == [(1, 0, 4), (1, 1, 2)]
    assert {r["id"] for r in got if r["error"]} == {3, 4}


def test_media_digest(spark, docs, empty):
    assert media.media_digest(empty).count() == 0
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append((r["text"] or "").encode())
    seen = collections.defaultdict(set)
    for r in media.media_digest(docs).collect():
        raw = texts[r["doc_id"]][0]
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        seen[raw].add((r["media_sha256"], r["media_bytes"], r["feature"]))
    assert all(len(v) == 1 for v in seen.values())


# --- pipeline ---


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        assert docs.columns == names, name
        if name == "near duplicates":
            want = {c for _, c in brute_components([(r["doc_id"], r["text"]) for r in before.collect()]).values()}
            assert {r["doc_id"] for r in docs.collect()} == want
        if name == "secret scan":
            assert docs.count() == before.count()
        if name == "mixing":
            taken = {r["doc_id"]: r["copies"] for r in queries.mixing.digest(before).where("copies > 0").collect()}
            assert {r["doc_id"]: r["n"] for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == taken
    assert check_packing(docs) < 0.05
    before = len(_io.WRITTEN)
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} and out.count() > 0
    # the documents of the last stage but one and the tables of the last are left, all others are deleted
    left = _io.WRITTEN[before:]
    assert all(os.path.exists(x.removeprefix("file:")) for x in left) and sum("/stage-" in x for x in left) == 1


def test_stages_with_awkward_documents(spark, docs, empty):
    """Every stage but the last keeps columns of any name and their values; the counts follow from the input's rows."""
    import corpus_pipeline

    named = docs.withColumn("_key", F.lit("mine")).withColumn("_copy", F.lit(7)).withColumn("task", F.lit(None).cast("string"))
    want = {"quality rules": {1, 5}, "near duplicates": {1, 2, 3, 4, 5, None, 6, 7}, "secret scan": {1, 2, 3, 4, 5, None, 6, 7}, "mixing": None}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, named, SF)
        rows = out.collect()
        assert out.columns == named.columns and all((r["_key"], r["_copy"], r["task"]) == ("mine", 7, None) for r in rows), name
        if want[name] is not None:
            assert {r["doc_id"] for r in rows} <= want[name], name
        if name == "near duplicates":
            assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, want[name]))
        if name == "secret scan":
            assert len(rows) == docs.count()
        assert stage(spark, empty, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, named, SF).count() >= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def test_copies_without_ids_leave(spark):
    """An exact copy and a near copy with null ids go with the document they copy; null-id copies of each other leave one."""
    draw = random.Random(31)
    text = lambda n: " ".join(f"w{draw.getrandbits(30):x}" for _ in range(n))
    a, b = text(60), text(60)
    rows = [(3, a), (None, a), (None, a + " more"), (None, b), (None, b), (None, b + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"][:20]) for r in neardup.deduplicated(df).collect()]
    assert sorted(kept, key=str) == sorted([(3, a[:20]), (None, b[:20])], key=str)
