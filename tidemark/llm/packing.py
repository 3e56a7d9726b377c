"""Packing documents into token sequences by cutting-stock column generation.

Each document is tokenized once, by the tokenizers library; its full stretches of ``SEQUENCE`` tokens are
sequences of their own and what is left over is one piece. A linear program over the histogram of piece lengths chooses how
often each pattern of lengths is used; its columns are priced by a knapsack over exact totals, as a
sequence whose total is a power of two needs no padding. Patterns are rounded down, the few pieces
left are placed by best fit, and ranked pieces are dealt to the slots of the patterns. A piece's rank among
those of its length is its place in the task that cut it, after the counts of the tasks before: nothing is
sorted, however frequent a length.

Only the histogram (at most ``SEQUENCE`` counts) and the patterns (at most twice as many) are on the
driver. A null text is empty and yields one piece with the end token; a null doc_id is packed like any other;
a very long text is encoded in parts that end where two tokens part; an empty table gives no piece; repeated rows are packed
once each; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._io import map_arrow, materialize

SEQUENCE, END = 1024, 0
#: Chunks of text whose ids a task holds, and their greatest length once it holds so many; what is beyond is encoded each time.
HELD_CHUNKS, CHUNK_CHARS = 500_000, 48
#: Characters of the parts that a very long text is encoded in.
LONG_TEXT = 1 << 20
#: Rounds of pricing, patterns that enter in each, and the share of padding at which it may stop early.
MAX_ROUNDS, PATTERNS_A_ROUND, TOLERANCE = 120, 48, 0.002

PIECE_SCHEMA = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, task int, place long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Chunks(dict):
    """Ids of chunks as bytes; those that are not held count as empty and are noted in ``new``."""

    def __init__(self) -> None:
        super().__init__({"": b""})
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> bytes:
        self.new.append(chunk)
        return b""


def byte_alphabet() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable bytes stand for themselves, the others for letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}


def parts(text: str, safe: re.Pattern):
    """A text in parts of at least ``LONG_TEXT`` characters that begin at a safe place; a stretch without one stays whole."""
    at = 0
    while len(text) - at > LONG_TEXT and (m := safe.search(text, at + LONG_TEXT)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encoder(path: str):
    """A function from text to the bytes of its ids (little-endian, 32 bits), as the tokenizers library gives them.

    With a byte-level vocabulary that splits by its usual pattern, a single space or line feed between two characters
    that are not white space parts two tokens: a space begins the next one, a line feed is one of its own. Such
    texts are cut there, and each chunk that the task has not met before is encoded by the library. A chunk of letters, with
    marks after it or not, is one word of the pattern, and a run of marks another: the library's model encodes the word
    alone. All other texts, and those with strings of special tokens, are encoded whole, very long ones in parts of some ``LONG_TEXT``
    characters that end at such a place.
    """
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    whole = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    first = spec.get("pre_tokenizer") or {}
    plain = first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True) and not spec.get("normalizer") and spec["model"]["type"] == "BPE"
    feed = whole("\n")
    if not plain or len(feed) != 4:
        return whole
    special = [t["content"] for t in spec.get("added_tokens", [])]
    odd, word, letters = re.compile(r"\s\s"), re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u052f]+)([.,;:!?)]*)"), byte_alphabet()
    tokens, blank = tokenizer.model.tokenize, letters[32]
    safe, cuttable = re.compile(r"(?<=\S)[ \n](?=\S)"), not any(re.search(r"\s", x) for x in special)
    packs = [struct.Struct(f"<{n}I").pack for n in range(4 * CHUNK_CHARS)]
    heads, others, marks = Chunks(), Chunks(), Chunks()  # chunks at a line's start, after a space (without it), and runs of marks

    def ids(chunk: str, held: Chunks, space: str) -> bytes:
        if not (chunk.isascii() and chunk.isalpha()):
            m = word.fullmatch(chunk)
            if not m or len(chunk) > CHUNK_CHARS:
                return whole(space + chunk)
            name, after = m.groups()
            if after:
                if name in held:
                    out = held[name]
                else:
                    out = ids(name, held, space)
                    if len(held) < HELD_CHUNKS:
                        held[name] = out
                if after not in marks:
                    marks[after] = whole(after)
                return out + marks[after]
            if not chunk.isascii():
                chunk = chunk.encode().decode("latin-1").translate(letters)
        found = tokens(blank + chunk if space else chunk)
        return packs[len(found)](*[t.id for t in found]) if len(found) < len(packs) else np.array([t.id for t in found], "<u4").tobytes()

    def line_ids(head: str, rest: list[str]) -> bytes:
        out = heads[head] + b"".join(map(others.__getitem__, rest))
        if not heads.new and not others.new:
            return out
        extra = {}
        for held, space in ((heads, ""), (others, " ")):
            for c in held.new:
                if len(held) < HELD_CHUNKS and len(c) <= CHUNK_CHARS:
                    held[c] = ids(c, held, space)
                else:
                    extra[c, space] = ids(c, held, space)
            held.new.clear()
        if not extra:
            return heads[head] + b"".join(map(others.__getitem__, rest))
        get = lambda held, c, space: extra[c, space] if (c, space) in extra else held[c]
        return get(heads, head, "") + b"".join([get(others, c, " ") for c in rest])

    def encode(text: str) -> bytes:
        if odd.search(text) or text[:1].isspace() or text[-1:].isspace() or any(x in text for x in special):
            return b"".join(map(whole, parts(text, safe))) if cuttable else whole(text)
        return feed.join([line_ids(head, rest) for head, *rest in (line.split(" ") for line in text.split("\n"))])

    return encode


def pieces(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """Every document's pieces: at most ``sequence`` ids each, with their CRC-32; ``place`` counts the pieces of a length in a task."""

    def cut(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(vocabulary or default_vocabulary())
        task, seen = TaskContext.get().partitionId(), np.zeros(sequence + 1, np.int64)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            at_row, starts, lengths, sums, totals, places = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + last
                n = len(ids) // 4
                for at in range(0, n, sequence):
                    part = ids[4 * at : 4 * (at + sequence)]
                    size = len(part) // 4
                    at_row.append(row)
                    starts.append(at)
                    lengths.append(size)
                    sums.append(zlib.crc32(part))
                    totals.append(n)
                    places.append(seen[size])
                    seen[size] += 1
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(long(at_row)), long(starts), pa.array(lengths, pa.int32()), long(sums), long(totals), pa.array(np.full(len(starts), task, np.int32)), long(places)], names=[f.split()[0] for f in PIECE_SCHEMA.split(", ")])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), cut, PIECE_SCHEMA)


def padded(total: int, sequence: int) -> int:
    """Tokens that a sequence with that total takes: a power of two is not padded."""
    return total if total & (total - 1) == 0 else sequence


def price(duals: np.ndarray, lengths: np.ndarray, cost: np.ndarray, sequence: int, most: int) -> list[dict[int, int]]:
    """Up to ``most`` patterns with negative reduced cost, the least first: knapsack dynamic programming
    over exact totals, and for each length the best pattern that holds it."""
    best = np.full(sequence + 1, -np.inf)
    best[0] = 0.0
    last = np.full(sequence + 1, -1)
    fits = np.searchsorted(lengths, np.arange(sequence + 1), "right")
    for total in range(int(lengths[0]), sequence + 1):
        value = best[total - lengths[: fits[total]]] + duals[: fits[total]]
        j = int(value.argmax())
        best[total], last[total] = value[j], j
    upto = np.maximum.accumulate(best)  # a padded sequence may hold less than is paid for
    where = np.maximum.accumulate(np.where(best == upto, np.arange(sequence + 1), 0))
    found = [(float(cost[t] - best[t]), t, -1) for t in range(1, sequence) if cost[t] == t]
    rest = sequence - lengths
    found += zip((sequence - duals - upto[rest]).tolist(), where[rest].tolist(), range(len(lengths)), strict=True)
    out, seen = [], set()
    for value, total, with_ in sorted(found):
        if value > -1e-7 * sequence or len(out) >= most:
            break
        pattern = {} if with_ < 0 else {with_: 1}
        while total > 0:
            j = int(last[total])
            pattern[j] = pattern.get(j, 0) + 1
            total -= int(lengths[j])
        key = tuple(sorted(pattern.items()))
        if key not in seen:
            seen.add(key)
            out.append(pattern)
    return out


def solve(counts: dict[int, int], sequence: int = SEQUENCE, max_rounds: int = MAX_ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Patterns {length: pieces} and how often each is used; together they hold every piece exactly once.

    The linear program minimizes padded length subject to demand; revised simplex with the basis
    inverse updated in place. It stops when no column prices in, or after ``max_rounds`` rounds of pricing;
    the rounding places every piece in any case.
    """
    lengths = np.array(sorted(length for length, n in counts.items() if n and length < sequence))
    out = [({sequence: 1}, counts[sequence])] if counts.get(sequence) else []
    if not len(lengths):
        return out
    m = len(lengths)
    demand = np.array([counts[int(x)] for x in lengths], float)
    cost = np.array([0, *[padded(t, sequence) for t in range(1, sequence + 1)]], float)
    # the first basis: of each length as many as fit; the first columns to enter are best-fit patterns
    columns: list[dict[int, int]] = [{i: sequence // int(x)} for i, x in enumerate(lengths)]
    price_of = lambda c: float(cost[sum(int(lengths[i]) * k for i, k in c.items())])
    prices = np.array([price_of(c) for c in columns])
    basis = list(range(m))
    inverse = np.diag([1.0 / c[i] for i, c in enumerate(columns)])
    x, duals = inverse @ demand, prices @ inverse
    place = {int(v): i for i, v in enumerate(lengths)}
    seeds = best_fit({int(v): int(counts[int(v)]) for v in lengths}, sequence)
    entering = [{place[v]: k for v, k in p.items()} for p, _ in sorted(seeds, key=lambda p: -p[1])]
    for done in range(max_rounds):
        if done:
            entering = price(duals, lengths, cost, sequence, PATTERNS_A_ROUND)
        if not entering:
            break
        for pattern in entering:
            a = np.zeros(m)
            a[list(pattern)] = list(pattern.values())
            gain = duals @ a - price_of(pattern)
            if gain < 1e-7 * sequence:  # an earlier pivot of this round has priced it out
                continue
            d = inverse @ a
            ok = d > 1e-9
            if not ok.any():
                continue
            r = int(np.argmin(np.where(ok, x / np.where(ok, d, 1), np.inf)))
            step = inverse[r] / d[r]
            inverse -= np.outer(d, step)
            inverse[r] = step
            amount = max(0.0, x[r] / d[r])
            x = np.maximum(x - amount * d, 0)
            x[r] = amount
            duals = duals - gain * step
            columns.append(pattern)
            basis[r], prices[r] = len(columns) - 1, price_of(pattern)
        if prices @ x <= (1 + TOLERANCE) * (lengths @ demand):
            break
    left = {int(v): int(counts[int(v)]) for v in lengths}
    for b, amount in sorted(zip(basis, x, strict=True), key=lambda p: -p[1]):
        pattern = {int(lengths[i]): k for i, k in columns[b].items()}
        times = min([int(amount + 1e-6), *(left[v] // k for v, k in pattern.items())])
        if times > 0:
            out.append((pattern, times))
            for v, k in pattern.items():
                left[v] -= k * times
    return out + best_fit(left, sequence)


def best_fit(left: dict[int, int], sequence: int) -> list[tuple[dict[int, int], int]]:
    """Patterns for the pieces that rounding left: the longest first, filled by the largest that still fit; equal fillings at once."""
    left, out = {k: v for k, v in left.items() if v}, []
    while left:
        room, pattern = sequence, {}
        for v in sorted(left, reverse=True):
            k = min(left[v], room // v)
            if k:
                pattern[v] = k
                room -= k * v
        times = min(left[v] // k for v, k in pattern.items())
        out.append((pattern, times))
        for v, k in pattern.items():
            left[v] -= k * times
            if not left[v]:
                del left[v]
    return out


def pack(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """Every piece with its sequence and place there: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, vocabulary, sequence), "packing")
    per = materialize(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most sequence rows
    slots, base = [], 0
    given: dict[int, int] = {}
    for pattern, times in solve(counts, sequence):
        at = 0
        for v in sorted(pattern, reverse=True):
            k = pattern[v]
            slots.append((v, given.get(v, 0), given.get(v, 0) + k * times, base, k, at))
            given[v] = given.get(v, 0) + k * times
            at += v * k
        base += times
    slot = spark.createDataFrame(slots, "length int, lo long, hi long, base long, k long, at long")
    slot = slot.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "base", "k", "at"))).alias("slots"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = cut.join(materialize(per.select("length", "task", before.alias("first")), "ranks"), ["length", "task"]).withColumn("rank", F.col("first") + F.col("place"))
    x = x.join(F.broadcast(slot), "length")  # at most one row a length, one slot a pattern that holds it
    x = x.withColumn("s", F.expr("element_at(filter(slots, s -> s.lo <= rank and rank < s.hi), 1)"))
    place = F.col("rank") - F.col("s.lo")
    return x.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("s.base") + F.floor(place / F.col("s.k"))).cast("long").alias("sequence_id"), (F.col("s.at") + place % F.col("s.k") * F.col("length")).cast("long").alias("offset"))
