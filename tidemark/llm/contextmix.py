"""Language-model scoring by online logistic context mixing over the bits of a text.

A text is its UTF-8 bytes and an end symbol (byte 255, which UTF-8 never uses), cut into units: a word
with the white space after it. Every byte is a path in a Huffman tree of the corpus's bytes, and every
step on the path a bit that is predicted from hashed contexts inside the unit: the last one, two and three
bytes with the kind of unit end before the unit, and the whole unit so far. After white space one more bit
tells whether the unit ends there, so that the bits of a text add up to its probability. The predictors'
log-odds are combined by weights that the bit's place gates, and the result is refined by an adaptive map of
the node and the mixed log-odds. The sum over all bits is the probability of the text; divided by its length it
is bits per byte.

Units are counted over the whole corpus, so each different one is learned from and predicted once, with
its count as weight. They are dealt by their first bytes into shares of some ``SHARE`` units, as many as
there are units for. All units that agree in more than those bytes are in one share, so the counts of the
whole-unit context are exact and grow with the corpus, however large; they never leave their share. First bytes
that more units have than two shares hold are dealt by one byte more, and so on. The
tables of the short contexts grow with the number of units up to ``MOST_BITS`` and are broadcast.

Learning is online: a share is walked in order of its units in small steps; a step is predicted with what the
share has seen before, the weights are corrected by the error, then the step is added to the counts. Shares,
their order and all sums are whole numbers that depend on the corpus alone: counts are summed exactly and
weights averaged in fixed point, so scores do not depend on partitions or cluster. Word counts for the
base score are exact sums over all learnable texts. The ``TOP`` most frequent units are broadcast (a fixed
bound), all others are joined.

Null texts are empty and score the end symbol alone; a null doc_id is learned from; without learnable
texts all counts are zero; very long texts are cut at words while they are read; repeated rows count and score
twice; an empty table gives an empty result; other columns are ignored. Words and units are told apart by 64-bit
hashes. Nothing depends on ties: units of a share are walked in the order of their hashes, and of equally frequent units all or none are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import map_arrow, materialize
from ._text import BASE, Powers, binary_column, blocks, lower_table, mix, prefix_hash, space_table, span_hash, words

#: log2 of the slots of the first context's table, which is exact, and of the least and largest tables of the next two.
FIRST_BITS, LEAST_BITS, MOST_BITS = 17, 14, (20, 23)
CONTEXTS, GATES, BUCKETS, NODES = 4, 8, 24, 256
#: Units of a share, and first bytes that deal them out; more of those from 2**27 and 2**35 units on.
SHARE, LEAD = 1 << 16, 4
#: Leads are shorter than that.
DEEPEST = 64
#: Slots of a table in a row that is shuffled, units that are broadcast, bytes of a block and of the distinct units held,
#: bytes of a step of learning and of the stretches that are counted or predicted at once.
CHUNK, TOP, BLOCK, HELD, STEP, STRETCH = 8192, 1 << 18, 6 << 20, 24 << 20, 1 << 13, 1 << 15
HASH_BLOCK = 2 << 20
PRIOR, RATE = 0.4, 0.3
#: Log-odds are kept in steps of 1/512 and weights summed in steps of 2**-16.
FIXED = 1 << 16
END, STOP = 255, 255  # the symbol at a text's end; the node of the bit after white space


class Units:
    """The units of many texts: gathered batch by batch, then made distinct."""

    def __init__(self, powers: Powers | None = None) -> None:
        self.data: list[np.ndarray] = []
        self.parts: list[tuple] = []
        self.rows = self.size = 0
        self.powers = powers or Powers()

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        """Texts one after the other; those longer than a block are cut before words, each piece with the word before it."""
        space = space_table()
        cuts, rows, head, tail = [0], [], [], []
        starts = [0]
        for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            at, first = lo, True
            while hi - at > 2 * HASH_BLOCK:
                inner = space[data[at + HASH_BLOCK : hi]]
                words_at = np.flatnonzero(inner[:-1] & ~inner[1:]) + 1
                if len(words_at) < 2:
                    break
                before, cut = at + HASH_BLOCK + int(words_at[0]), at + HASH_BLOCK + int(words_at[1])
                starts.append(before)
                cuts.append(cut)
                rows.append(row)
                head.append(first)
                tail.append(False)
                at, first = before, False
            starts.append(hi)
            cuts.append(hi)
            rows.append(row)
            head.append(first)
            tail.append(True)
        begin, end = np.array(starts[:-1], np.int64), np.array(cuts[1:], np.int64)
        rows, head, tail = np.array(rows, np.int64), np.array(head, bool), np.array(tail, bool)
        size = np.concatenate([[0], np.cumsum(end - begin)])
        for lo, hi in blocks(size, HASH_BLOCK):
            whole = bool(head[lo:hi].all() and tail[lo:hi].all())
            piece = data[begin[lo] : end[hi - 1]] if whole else np.concatenate([data[b:e] for b, e in zip(begin[lo:hi].tolist(), end[lo:hi].tolist(), strict=True)])
            self._add(piece, size[lo : hi + 1] - size[lo], rows[lo:hi], head[lo:hi], tail[lo:hi])
        self.rows += len(offsets) - 1

    def _add(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, head: np.ndarray, tail: np.ndarray) -> None:
        """Pieces of texts: the first unit of one without ``head`` and the text's end in one without ``tail`` belong to its neighbours."""
        starts, ends, first = words(data, offsets)
        filled = offsets[:-1][np.diff(offsets) > 0]
        mark = np.zeros(len(data), bool)
        mark[starts] = mark[filled] = True
        at = np.flatnonzero(mark)
        row = np.searchsorted(offsets, at, "right") - 1
        stop = np.append(at[1:], len(data))
        last = np.append(row[1:] != row[:-1], True) if len(at) else np.zeros(0, bool)
        word = np.searchsorted(starts, at)
        has = np.zeros(len(at), bool)
        has[np.searchsorted(at, starts)] = True
        size = np.zeros(len(at), np.int64)
        size[has] = ends - starts
        # what stands before the unit: 0 the start of the text, 1 a sentence's end, 2 a comma, 3 other marks, 4 a letter or digit, 5 a new line
        kinds = np.full(256, 3, np.uint8)
        kinds[[46, 33, 63]] = 1
        kinds[[44, 59, 58]] = 2
        kinds[np.r_[48:58, 65:91, 97:123, 128:256]] = 4
        kind = np.full(len(at), 4, np.uint8)
        inner = np.ones(len(at), bool)
        inner[np.searchsorted(at, filled)] = False
        prev = inner & (word > 0)
        prev &= word > first[row]
        kind[prev] = kinds[data[ends[word[prev] - 1] - 1]]
        kind[inner & (data[at - 1] == 10)] = 5
        kind[~inner] = 0
        last &= tail[row]
        prefix = prefix_hash(data, self.powers)
        code = span_hash(prefix, at, stop, self.powers)
        bare = np.flatnonzero(np.diff(offsets) == 0)  # empty texts: the end alone
        zero = np.zeros(len(bare), np.int64)
        own = inner | head[row]
        pick = lambda x: x[own]
        row = np.concatenate([pick(row), bare])
        last = np.concatenate([pick(last), zero == 0])
        kind = np.concatenate([pick(kind), zero.astype(np.uint8)])
        code = mix(np.concatenate([pick(code), zero.view(np.uint64)]) + kind * np.uint64(2 * BASE % (1 << 64)) + last * np.uint64(BASE))
        self.parts.append((rows[row] + self.rows, np.concatenate([pick(at), zero]) + self.size, np.concatenate([pick(stop - at), zero]), np.concatenate([pick(size), zero]), kind, last, code))
        self.data.append(data)
        self.size += len(data)

    def distinct(self):
        """Row and distinct unit of each unit; of each distinct one its code, bytes, offsets, word length, and kind with 8 added at a text's end."""
        row, at, size, word, kind, last, code = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        data = np.concatenate(self.data)
        codes, first, inverse = np.unique(code, return_index=True, return_inverse=True)
        at, size, word, kind, last = at[first], size[first], word[first], kind[first], last[first]
        text, offsets = gathered(data, at, size, last)
        return row, inverse, codes.view(np.int64), text, offsets, word, kind + 8 * last.astype(np.uint8)


def gathered(data, at, size, last):
    """Bytes of the given stretches one after the other, each with the end symbol where ``last``, and their offsets."""
    offsets = np.zeros(len(at) + 1, np.int64)
    np.cumsum(size + last, out=offsets[1:])
    inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size + last)
    body = inside < np.repeat(size, size + last)
    text = np.full(offsets[-1], END, np.uint8)
    text[body] = data[(np.repeat(at, size + last) + inside)[body]]
    return text, offsets


def word_codes(text, offsets, word, powers) -> np.ndarray:
    """64-bit hash of each distinct unit's word in lower case; 0 without a word."""
    prefix = prefix_hash(lower_table()[text], powers)
    return np.where(word > 0, span_hash(prefix, offsets[:-1], offsets[:-1] + word, powers).view(np.int64), 0)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, bits) by depth and byte: the inner node a byte passes there, -1 below its leaf, and the turn it takes."""
    import heapq

    heap = [(int(c) + 1, i, (i,)) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    turns: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    for node in range(255):
        (c0, i0, b0), (c1, i1, b1) = heapq.heappop(heap), heapq.heappop(heap)
        for bit, group in ((0, b0), (1, b1)):
            for byte in group:
                turns[byte].append((node, bit))
        heapq.heappush(heap, (c0 + c1, min(i0, i1), b0 + b1))
    depth = max(map(len, turns))
    nodes, bits = np.full((depth, 256), -1, np.int32), np.zeros((depth, 256), np.uint8)
    for byte, path in enumerate(turns):
        for k, (node, bit) in enumerate(reversed(path)):
            nodes[k, byte], bits[k, byte] = node, bit
    return nodes, bits


def so_far(text: np.ndarray, offsets: np.ndarray, powers: Powers) -> np.ndarray:
    """32-bit hash of what each byte's unit holds before it."""
    prefix = prefix_hash(text, powers)
    start = np.repeat(offsets[:-1], np.diff(offsets))
    return (mix((prefix[:-1] - prefix[start]) * powers.down[start] + np.uint64(3)) >> np.uint64(32)).astype(np.uint32)


def contexts(text: np.ndarray, offsets: np.ndarray, inside: np.ndarray, kind: np.ndarray, powers: Powers) -> list[np.ndarray]:
    """32-bit context hashes of every byte; the first is an index of its own, with 8 bits left for the node."""
    k = np.repeat(kind, np.diff(offsets)).astype(np.uint64)
    b = text.astype(np.uint64) + np.uint64(1)
    back = []
    for d in range(1, 4):
        x = np.zeros(len(text), np.uint64)
        x[d:] = b[:-d]
        x[inside < d] = 0
        back.append(x)
    s = [np.uint64(8 * i) for i in range(8)]
    one = np.where(back[0] > 0, back[0], np.uint64(257) + k)
    two = back[0] | back[1] << s[2] | k << s[4]
    three = back[0] | back[1] << s[2] | back[2] << s[4] | k << s[6]
    return [(one & np.uint64(511)).astype(np.uint32) << np.uint32(8), *((mix(x + np.uint64(i)) >> np.uint64(32)).astype(np.uint32) for i, x in enumerate((two, three), 1)), so_far(text, offsets, powers)]


def slots_of(hashes: list[np.ndarray], node: np.ndarray, bits: list[int]) -> list[np.ndarray]:
    """The slot of a node in the table of each context; one hash alone is that of whole units."""
    node = node.astype(np.uint32)
    salt = (node + np.uint32(1)) * np.uint32(0x9E3779B1)
    out = [hashes[0] | node] if len(hashes) > 1 else []
    return out + [((h ^ salt) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - b) for h, b in zip(hashes[len(out) :], bits[len(bits) - len(hashes) + len(out) :], strict=True)]


def odds_of(counts: np.ndarray) -> np.ndarray:
    """Log-odds of (zeros, ones) in steps of 1/512, so that sums in another form give the same."""
    c = counts.reshape(-1, 2)
    return (np.round(np.log((c[:, 1] + PRIOR) / (c[:, 0] + PRIOR)) * 512) / 512).astype(np.float32)


def table_bits(units: int) -> list[int]:
    """log2 of the slots of the tables of short contexts, from the number of distinct units."""
    grown = max(LEAST_BITS, int(units).bit_length() - 2)
    return [FIRST_BITS, *(min(grown, m) for m in MOST_BITS)]


class Model:
    """Counts and log-odds of each table, gated weights, the refining map and the tree of bytes.

    ``shared`` are the bits of the tables of the short contexts; that of whole units is made anew for each share.
    """

    def __init__(self, tree: tuple[np.ndarray, np.ndarray], shared: list[int], lead: int = LEAD) -> None:
        self.tree, self.lead = tree, lead
        self.bits = [*shared, LEAST_BITS]
        self.counts = [np.zeros(2 << b, np.uint64) for b in self.bits]
        self.odds = [np.zeros(1 << b, np.float32) for b in self.bits]
        self.fresh()

    def fresh(self) -> None:
        """Weights and map before any learning."""
        self.weights = np.full((GATES + 1, GATES, CONTEXTS + 1), 0.35, np.float32)
        self.weights[..., -1] = 0
        self.fixes = np.zeros((2, NODES * BUCKETS))
        self.map = self.refined()
        self.seen = 0

    def room(self, size: int) -> None:
        """An empty table of whole units for a share of that many bytes."""
        bits = max(LEAST_BITS, int(2 * size).bit_length())
        if self.bits[-1] != bits:
            self.bits[-1] = bits
            self.counts[-1], self.odds[-1] = np.zeros(2 << bits, np.uint64), np.zeros(1 << bits, np.float32)
        else:
            self.counts[-1][:] = 0
            self.odds[-1][:] = 0

    def refined(self) -> np.ndarray:
        """Log-odds for each node and bucket of mixed log-odds; the bucket's middle counts as a few observations."""
        middle = np.tile((np.arange(BUCKETS) - BUCKETS / 2 + 0.5) / 2, NODES)
        p = 1 / (1 + np.exp(-middle))
        return np.log((self.fixes[1] + 8 * p) / (self.fixes[0] + 8 * (1 - p))).astype(np.float32)

    def steps(self, text: np.ndarray, offsets: np.ndarray, kind: np.ndarray, powers: Powers, limit: int, whole: bool = False):
        """Units of about ``limit`` bytes at a time: their range, cuts, and the bits of each byte as ``walk`` gives them, with all slots or those of ``whole`` units alone."""
        for lo, hi in blocks(offsets, limit):
            part, cuts = text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            if not len(part):
                continue
            size = np.diff(cuts)
            inside = np.arange(len(part)) - np.repeat(cuts[:-1], size)
            final = inside == np.repeat(size, size) - 1
            hashes = [so_far(part, cuts, powers)] if whole else contexts(part, cuts, inside, kind[lo:hi] & 7, powers)
            yield lo, hi, cuts, size, self.walk(part, hashes, inside, final)

    def walk(self, text, hashes, inside, final):
        """(depth, which bytes, node, bit, gate, slots, whether in reach of the whole-unit table) along the tree, then the bit after white space."""
        nodes, turns = self.tree
        gate, far = np.minimum(inside, GATES - 1), (inside >= self.lead).astype(np.float32)
        alive = np.arange(len(text))
        for k in range(len(nodes)):
            node = nodes[k][text[alive]]
            alive = alive[node >= 0]
            if not len(alive):
                break
            node = node[node >= 0]
            yield min(k, GATES - 1), alive, node, turns[k][text[alive]], gate[alive], slots_of([h[alive] for h in hashes], node, self.bits), far[alive]
        space = np.flatnonzero(space_table()[text])
        node = np.full(len(space), STOP)
        yield GATES, space, node, final[space].astype(np.uint8), gate[space], slots_of([h[space] for h in hashes], node, self.bits), far[space]

    def mixed(self, depth, node, gate, slots, far):
        """Log-odds of each predictor, mixed, and the bucket of the map."""
        odds = [t[x] for t, x in zip(self.odds, slots, strict=True)]
        odds[-1] = odds[-1] * far
        w = self.weights[depth]
        z = w[gate, CONTEXTS]
        for i, o in enumerate(odds):
            z = z + w[gate, i] * o
        place = node.astype(np.int64) * BUCKETS + np.clip(z * 2 + BUCKETS / 2, 0, BUCKETS - 1).astype(np.int64)
        return odds, z, place

    def gather(self, text, offsets, kind, powers, count) -> None:
        """Add units, each ``count`` times, to the table of whole units."""
        for lo, hi, _, size, walk in self.steps(text, offsets, kind, powers, STRETCH, whole=True):
            times = np.repeat(count[lo:hi], size)
            for _, which, _, bit, _, slots, _ in walk:
                np.add.at(self.counts[-1], slots[-1] * np.uint32(2) + bit, times[which])
        self.odds[-1] = odds_of(self.counts[-1])

    def units(self, text, offsets, kind, powers, count=None) -> np.ndarray:
        """Natural log-probability of each unit; where ``count`` is given, learn from it that often."""
        out = np.zeros(len(kind))
        for lo, hi, cuts, size, walk in self.steps(text, offsets, kind, powers, STRETCH if count is None else STEP):
            total = np.zeros(cuts[-1], np.float64)
            times = None if count is None else np.repeat(count[lo:hi], size)
            for depth, which, node, bit, gate, slots, far in walk:
                odds, z, place = self.mixed(depth, node, gate, slots, far)
                sign = bit.astype(np.float32) * 2 - 1
                total[which] -= np.log1p(np.exp(np.clip(-sign * (z + self.map[place]) * np.float32(0.5), -60, 60)))
                if times is not None:
                    self._learn(self.weights[depth], z, odds, slots, gate, place, bit, times[which])
            if times is not None:
                self.map = self.refined()
            out[lo:hi] = np.add.reduceat(total, cuts[:-1])
        return out

    def _learn(self, w, z, odds, slots, gate, place, bit, count):
        times = count.astype(np.float64)
        self.seen += int(count.sum())
        rate = RATE / (np.bincount(gate, times, GATES) + 1e-9)
        error = (bit - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) * times
        for i, o in enumerate(odds):
            w[:, i] += (rate * np.bincount(gate, error * o, GATES)).astype(np.float32)
        w[:, CONTEXTS] += (rate * 0.1 * np.bincount(gate, error, GATES)).astype(np.float32)
        self.fixes += np.bincount(place + bit * np.int64(NODES * BUCKETS), times, 2 * NODES * BUCKETS).reshape(2, -1)
        for c, o, x in zip(self.counts, self.odds, slots, strict=True):
            np.add.at(c, x * np.uint32(2) + bit, count)
            n = c.reshape(-1, 2)[x]
            o[x] = np.log((n[:, 1] + PRIOR) / (n[:, 0] + PRIOR))


UNIT_SCHEMA = "u long, t long, k int, b binary, c long"


def unit_rows(docs: DataFrame) -> DataFrame:
    """Every distinct unit of a task: u (code), t (its word's code), k (kind), b (bytes), c (times in learnable texts).

    Rows with k = -1 count the byte t.
    """

    def rows(batches):
        held, size = [], 0

        def emit():
            u, t, k, word_bytes, c = ([x[i] for x in held] for i in range(5))
            u, t, k, c = np.concatenate(u), np.concatenate(t), np.concatenate(k), np.concatenate(c)
            b = pa.chunked_array(word_bytes).combine_chunks()
            first, place = np.unique(u, return_index=True, return_inverse=True)[1:]
            total = np.bincount(place, c, len(first)).astype(np.int64)
            for lo in range(0, len(first), 100_000):
                f = first[lo : lo + 100_000]
                yield batch_of(u[f], t[f], k[f], b.take(pa.array(f)), total[lo : lo + 100_000])

        def flush(units, learnable):
            row, inverse, codes, text, offsets, word, kind = units.distinct()
            count = np.bincount(inverse, np.concatenate(learnable)[row], len(codes)).astype(np.int64)
            with np.errstate(over="ignore"):
                t = word_codes(text, offsets, word, units.powers)
            histogram[:] += np.bincount(text, np.repeat(count, np.diff(offsets)), 256).astype(np.int64)
            held.append((codes, t, kind.astype(np.int32), binary_array(text, offsets), count))
            return len(text)

        histogram = np.zeros(256, np.int64)
        units, learnable = Units(), []
        for batch in batches:
            data, offsets = binary_column(batch, "raw")
            with np.errstate(over="ignore"):
                units.add(data, offsets)
            learnable.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64))
            if units.size >= BLOCK:
                size += flush(units, learnable)
                units, learnable = Units(units.powers), []
                if size >= HELD:
                    yield from emit()
                    held, size = [], 0
        if units.rows:
            flush(units, learnable)
        if held:
            yield from emit()
        yield batch_of(np.arange(256), np.arange(256), np.full(256, -1, np.int32), pa.array([b""] * 256, pa.binary()), histogram)

    return map_arrow(docs.select("raw", "learnable"), rows, UNIT_SCHEMA)


def binary_array(text: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(text))])


def batch_of(u, t, k, b, c) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(t, pa.int64()), pa.array(k, pa.int32()), b, pa.array(c, pa.int64())], names=["u", "t", "k", "b", "c"])


def narrow(counts: np.ndarray) -> bytes:
    """Whole counts in the least width that holds all of them, which the first byte tells."""
    most = int(counts.max())
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes((width,)) + counts.astype(f"<u{width}").tobytes()


def widened(raw) -> np.ndarray:
    return np.frombuffer(raw[1:], f"<u{raw[0]}").astype(np.uint64)


def leads(units: DataFrame) -> tuple[int, dict[int, list[bytes]]]:
    """How many units there are, and which first bytes are too frequent for one share: by length from ``LEAD``.

    Units that start with those are dealt by one byte more, and so on, so that no lead fills a task. The driver gets the
    frequent ones only, at most one for each ``2 * SHARE`` units.
    """
    hot: dict[int, list[bytes]] = {}
    rows, total, length = units, None, LEAD
    while length < DEEPEST:
        each = rows.groupBy(F.substring("b", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        got = each.agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") > 2 * SHARE, F.col("p"))).alias("hot")).first()
        total = int(got["n"] or 0) if total is None else total
        if not got["hot"]:
            break
        hot[length] = sorted(map(bytes, got["hot"]))
        rows = rows.where(F.substring("b", 1, length).isin(hot[length]))
        length += 1
    return total or 0, hot


def dealt(units: DataFrame, n: int, hot: dict[int, list[bytes]] | None = None) -> DataFrame:
    """Units in shares that their first bytes decide, whole shares to a partition and in a fixed order; a share tells how many bytes those are (modulo ``DEEPEST``)."""
    lead = None
    for length, found in sorted((hot or {}).items()):
        rest = ~F.substring("b", 1, length).isin(found)
        lead = F.when(rest, length) if lead is None else lead.when(rest, length)
    lead = F.lit(LEAD) if lead is None else lead.otherwise(max(hot) + 1)
    share = F.pmod(F.xxhash64(F.expr("substring(b, 1, _lead)")), F.lit(max(1, -(-n // SHARE)))) * DEEPEST + F.col("_lead")
    return units.withColumn("_lead", lead).withColumn("share", share).drop("_lead").repartition("share").sortWithinPartitions("share", "u", "k")


def whole(held: list) -> pa.RecordBatch:
    """One batch of all rows: the bytes get offsets of 64 bits, as those of 32 would be left in several."""
    at = held[0].schema.get_field_index("b")
    table = pa.Table.from_batches(held)
    (batch,) = table.set_column(at, "b", table.column(at).cast(pa.large_binary())).combine_chunks().to_batches()
    return batch


def shares(batches, *names: str):
    """The rows of one share after the other, as one batch each."""
    held, now = [], None
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("share")).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else []
        for lo, hi in zip(edges, edges[1:], strict=False):
            if held and ids[lo] != now:
                yield whole(held)
                held = []
            now = ids[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield whole(held)


def lead_in(batch) -> int:
    """First bytes that decide the share of this batch."""
    return batch.column(batch.schema.get_field_index("share"))[0].as_py() % DEEPEST


def share_columns(batch):
    """Bytes, offsets, kinds and counts of a share's units, and its learnable ones apart."""
    text, offsets = binary_column(batch, "b")
    column = lambda name, kind: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(kind)
    kind, count = column("k", np.uint8), column("c", np.uint64)
    return text, offsets, kind, count


def learnable_of(text, offsets, kind, count):
    use = np.flatnonzero(count)
    if len(use) == len(count):
        return text, offsets, kind, count
    size = np.diff(offsets)[use]
    cuts = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(offsets[use] - cuts[:-1], size) + np.arange(cuts[-1])
    return text[at], cuts, kind[use], count[use]


STATE = 99
LEARN_SCHEMA = "kind int, t long, bytes binary"


def learn_rows(units: DataFrame, n: int, tree, hot: dict | None = None) -> DataFrame:
    """What each task learns from its shares: chunks of the counts of table i (kind i) and the sum of weights and maps (kind ``STATE``)."""
    bits = table_bits(n)

    def learn(batches):
        model, powers, total = Model(tree, bits), Powers(), None
        sums = [np.zeros(2 << b, np.uint64) for b in bits]

        def emit(kind, t, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(t), kind, np.int32)), pa.array(t, pa.int64()), pa.array(b, pa.binary())], names=["kind", "t", "bytes"])

        for batch in shares(batches):
            text, offsets, kind, count = learnable_of(*share_columns(batch))
            if not len(kind):
                continue
            for c, o in zip(model.counts[:-1], model.odds[:-1], strict=True):
                c[:] = 0
                o[:] = 0
            model.fresh()
            model.lead = lead_in(batch)
            model.room(len(text))
            with np.errstate(over="ignore"):
                model.units(text, offsets, kind, powers, count)
            for c, x in zip(sums, model.counts, strict=False):
                c += x
            weights = np.round(model.weights.ravel().astype(np.float64) * FIXED).astype(np.int64) * model.seen
            state = np.concatenate([[model.seen], weights, model.fixes.ravel().astype(np.int64)])
            total = state if total is None else total + state
        if total is None:
            return
        for i, c in enumerate(sums):
            c = c.reshape(-1, min(CHUNK, 1 << bits[i]) * 2)
            used = np.flatnonzero(c.any(axis=1))
            yield emit(i, used, [narrow(c[j]) for j in used])
        yield emit(STATE, [0], [total.astype("<i8").tobytes()])

    return map_arrow(dealt(units.select("u", "b", "k", "c"), n, hot), learn, LEARN_SCHEMA, SHARE)


def summed(chunks: DataFrame) -> DataFrame:
    """Log-odds of each chunk of each table from the sum of all tasks' counts, and the sum of their states; tasks add as rows stream in."""

    def add(batches):
        sums: dict = {}
        for batch in batches:
            for kind, t, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                c = np.frombuffer(raw.as_py(), "<i8").copy() if kind == STATE else widened(raw.as_py())
                sums[kind, t] = sums[kind, t] + c if (kind, t) in sums else c
        out = [c.astype("<i8").tobytes() if k == STATE else odds_of(c).astype("<f2").tobytes() for (k, _), c in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sums], pa.int32()), pa.array([t for _, t in sums], pa.int64()), pa.array(out, pa.binary())], names=["kind", "t", "bytes"])

    return map_arrow(chunks.repartition("kind", "t"), add, LEARN_SCHEMA)


def fitted(learned: DataFrame, n: int, tree) -> Model:
    """The model of all shares together; the table of whole units stays with the shares."""
    model = Model(tree, table_bits(n))
    model.counts = []
    for r in materialize(summed(learned), "fitted").toLocalIterator():
        if r["kind"] == STATE:
            x = np.frombuffer(r["bytes"], "<i8")
            size = model.weights.size
            model.weights = (x[1 : 1 + size] / max(1, int(x[0])) / FIXED).astype(np.float32).reshape(model.weights.shape)
            model.fixes = x[1 + size :].reshape(2, -1).astype(float)
            model.map = model.refined()
        else:
            odds = np.frombuffer(r["bytes"], "<f2")
            model.odds[r["kind"]][r["t"] * len(odds) : (r["t"] + 1) * len(odds)] = odds
    return model


def unit_scores(units: DataFrame, n: int, model: Model, hot: dict | None = None) -> DataFrame:
    """(u, t, c, lp): log10 probability of each distinct unit, share by share."""
    state = ([o.astype(np.float16) for o in model.odds[:-1]], model.weights, model.map, model.tree, model.bits[:-1])
    shared = units.sparkSession.sparkContext.broadcast(state)

    def rate(batches):
        m, powers = None, Powers()
        for batch in shares(batches):
            if m is None:
                odds, weights, refine, tree, bits = shared.value
                m = Model(tree, [1] * len(bits))
                m.bits[:-1], m.odds[:-1], m.weights, m.map = bits, [o.astype(np.float32) for o in odds], weights, refine
            text, offsets, kind, count = share_columns(batch)
            with np.errstate(over="ignore"):
                m.lead = lead_in(batch)
                m.room(len(text))
                m.gather(*learnable_of(text, offsets, kind, count)[:3], powers, count[count > 0])
                lp = m.units(text, offsets, kind, powers) / np.log(10)
            names = ("u", "t", "c")
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in names), pa.array(lp)], names=[*names, "lp"])

    return map_arrow(dealt(units, n, hot), rate, "u long, t long, c long, lp double", SHARE)


def frequent(units: DataFrame) -> DataFrame:
    """The most frequent units, at most ``TOP``: all above a count that a histogram of logarithms of counts gives, so that no task sorts them."""
    rank = F.floor(64 * F.log2("c"))
    left, least = TOP, None
    for r in sorted(units.where("c > 0").groupBy(rank.alias("r")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):  # at most 64 * 63 rows
        if r["n"] > left:
            break
        left, least = left - r["n"], r["r"]
    return units.where(F.lit(False) if least is None else (F.col("c") > 0) & (rank >= least))


SUM_SCHEMA = "bytes long, n_tokens long, known long, base double, lp double, rest array<long>"


def sums(docs: DataFrame, top: dict[str, np.ndarray], *keys: str) -> DataFrame:
    """Of each whole text: length, tokens, sums over broadcast units, and the codes of all others."""
    shared = docs.sparkSession.sparkContext.broadcast(top)
    names = [*keys, *(f.split()[0] for f in SUM_SCHEMA.split(", "))]

    def add(batches):
        top = shared.value

        def flush(held, units):
            row, inverse, codes, _, _, word, _ = units.distinct()
            place = np.minimum(np.searchsorted(top["u"], codes), max(0, len(top["u"]) - 1))
            here = top["u"][place] == codes if len(top["u"]) else np.zeros(len(codes), bool)
            of = lambda v: np.bincount(row, v[inverse], units.rows)
            value = lambda k: np.where(here, top[k][place], 0.0) if len(top["u"]) else np.zeros(len(codes))
            n_tokens, known, base, lp = of((word > 0).astype(float)) + 1, of(value("known")), of(value("base")), of(value("lp"))
            other = ~here[inverse]
            who, what = row[other], codes[inverse[other]]
            order = np.argsort(who, kind="stable")
            cuts = np.searchsorted(who[order], np.arange(units.rows + 1))
            rest = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(what[order]))
            at = 0
            for columns, size in held:
                s = slice(at, at + len(size))
                at += len(size)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(size), pa.array(n_tokens[s].astype(np.int64)), pa.array(known[s].astype(np.int64)), pa.array(base[s]), pa.array(lp[s]), rest[s]], names=names)

        held, units = [], Units()
        for batch in batches:
            data, offsets = binary_column(batch, "raw")
            with np.errstate(over="ignore"):
                units.add(data, offsets)
            held.append((batch.columns[:-1], np.diff(offsets)))
            if units.size >= BLOCK:
                yield from flush(held, units)
                held, units = [], Units(units.powers)
        if units.rows:
            yield from flush(held, units)

    rows = docs.select(*keys, "raw")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return map_arrow(rows, add, f"{schema}, {SUM_SCHEMA}")


def scored(docs: DataFrame, learnable: Column) -> DataFrame:
    """doc_id, learnable, bytes, n_tokens, n_known, train_tokens, base_score and score of every row."""
    x = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("raw"), F.coalesce(learnable, F.lit(True)).alias("learnable"))
    found = materialize(unit_rows(x).groupBy("u", "t", "k", "b").agg(F.sum("c").alias("c")), "units")
    units = found.where("k >= 0")
    histogram = np.zeros(256, np.int64)
    for r in found.where("k = -1").select("t", "c").collect():
        histogram[r["t"]] = r["c"]
    tree = huffman(histogram)
    size, hot = leads(units)
    learned = materialize(learn_rows(units, size, tree, hot), "contexts")
    counts = materialize(units.where("t <> 0").groupBy("t").agg(F.sum("c").alias("n")).where("n > 0"), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = units.agg(F.coalesce(F.sum(F.when(F.col("k") >= 8, F.col("c"))), F.lit(0)).alias("ends")).first()["ends"]
    n, v = total["n"] + ends, total["v"] + (ends > 0)
    whole = float(np.log10(n + 0.5 * (v + 1)))
    # of each unit: its log-probability, and its word's share of the base score (0 without a word)
    valued = unit_scores(units, size, fitted(learned, size, tree), hot).join(counts, "t", "left")
    base = F.when(F.col("t") == 0, 0.0).otherwise(F.log10(F.coalesce("n", F.lit(0)) + 0.5) - F.lit(whole))
    valued = materialize(valued.select("u", "c", "lp", base.alias("base"), F.col("n").isNotNull().cast("int").alias("known")), "valued")
    best = frequent(valued).toArrow()
    top = {k: best.column(k).to_numpy() for k in ("u", "lp", "base", "known")}
    order = np.argsort(top["u"])
    got = sums(x, {k: a[order] for k, a in top.items()}, "doc_id", "learnable").withColumn("row", F.monotonically_increasing_id())
    got = materialize(got, "sums")
    each = got.select("row", F.explode("rest").alias("u")).join(valued.select("u", F.col("lp").alias("l"), F.col("base").alias("b"), F.col("known").alias("k")), "u")
    each = each.groupBy("row").agg(F.sum("l").alias("l"), F.sum("b").alias("b"), F.sum("k").alias("k"))
    y = got.drop("rest").join(each, "row", "left")
    more = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    end = float(np.log10(ends + 0.5)) - whole
    return y.select(
        "doc_id", "learnable", "bytes", "n_tokens", (more("known", "k") + F.lit(int(ends > 0))).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (more("base", "b") + F.lit(end)).alias("base_score"), more("lp", "l").alias("score"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The scores of every document; rows with crc32(doc_id) mod 5 = 1 are not learned from."""
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    got = scored(docs, ~held)
    bits = -F.col("score") * float(np.log2(10)) / F.greatest(F.col("bytes"), F.lit(1))
    return got.select("doc_id", (~F.col("learnable")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", bits.alias("bits_per_byte"))
