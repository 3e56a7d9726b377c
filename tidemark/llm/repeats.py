"""Repeated passages by a logarithmic family of suffix arrays.

Every byte that is covered by a string of ``LENGTH`` bytes that also starts anywhere else is removed.
Windows of that length are dealt out by content: each belongs to the least hashed ``GRAM``-byte gram that it
holds, its anchor, so equal windows meet wherever they stand. Consecutive windows with one anchor
form a segment. Equal segments (one anchor, 96 bits of digest) are one kind; anchors that one segment alone
has leave at once. Kinds that share an anchor go to the index: buckets of anchors, each a family of suffix
arrays, sorted starts of windows over the text of the level. A new batch gets its array, is merge-scanned against
the levels for long matches, byte by byte, and levels of equal size merge geometrically. Levels are rows
of a table in the shared folder: ``Passages.add`` takes further documents at any time, reads the levels of the
buckets that they touch and writes those that are new.

Kinds of an anchor with very many different ones (a passage with as many contexts as copies) are cut into
single windows, so that no bucket holds them all; equal windows (one anchor, 128 bits of digest) are counted.

Null texts are empty; texts shorter than ``LENGTH`` bytes lose nothing; very long texts are cut into overlapping
pieces while they are read; equal rows are two occurrences, so both lose what they share; rows that share a
doc_id, null included, are told apart by their text; an empty table gives an empty result, other columns are ignored.
There are no ties to break: every occurrence of a passage is removed, and of equal least grams of a window the first is its anchor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._io import map_arrow, materialize, own_exchange
from ._text import Powers, binary_column, blocks, mix, prefix_hash, span_hash

LENGTH, GRAM = 200, 100
#: Kinds of an anchor from which on they are cut into windows, kinds of a bucket in the first batch, and windows that are compared at once.
HOT_SEGMENTS, BUCKET_SEGMENTS, SCAN = 1000, 1000, 1 << 15
BLOCK = 1 << 20
#: Base of the second digest.
BASE2 = 0xD6E8FEB86659FD93


def least_in_window(key: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive entries, by doubling."""
    done, out = 1, key
    while done * 2 <= width:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[: len(out) - (width - done)], out[width - done :])
    return out


def segments(data: np.ndarray, offsets: np.ndarray, powers: Powers, powers2: Powers):
    """Row, first window, number of windows, anchor and two digests of every segment of a block of texts."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none, none
    prefix = prefix_hash(data, powers)
    grams = mix((prefix[GRAM:] - prefix[:-GRAM]) * powers.down[: len(data) - GRAM + 1])
    bits = np.uint64(max(21, int(len(data)).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    least = least_in_window((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    at = np.flatnonzero(ends - np.arange(len(least)) >= LENGTH)
    if not len(at):
        return none, none, none, none, none, none
    anchor = (least[at] & mask).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    p0, count = at[first], np.diff(np.append(first, len(at)))
    h = span_hash(prefix, p0, p0 + count - 1 + LENGTH, powers)
    a = grams[anchor[first]]
    del grams, least, ends
    g = span_hash(prefix_hash(data, powers2), p0, p0 + count - 1 + LENGTH, powers2)
    row = np.searchsorted(offsets, p0, "right") - 1
    return row, p0 - offsets[row], count, a.view(np.int64), h.view(np.int64), (g >> np.uint64(32)).astype(np.uint32).view(np.int32)


SEGMENT_SCHEMA = "doc_id long, key long, p int, w int, a long, h long, g int"


def pieces(offsets: np.ndarray):
    """(first row, end row, start in it, bytes) of stretches of whole rows, and of overlapping parts of rows that are longer than a block."""
    for lo, hi in blocks(offsets, BLOCK):
        size = int(offsets[hi] - offsets[lo])
        if size <= BLOCK + LENGTH:
            yield lo, hi, 0, size
        else:
            for at in range(0, size - LENGTH + 1, BLOCK):
                yield lo, lo + 1, at, min(size - at, BLOCK + LENGTH - 1)


def located(docs: DataFrame) -> DataFrame:
    """One row per segment: doc_id, key (of the text), p (first window), w (windows), a (anchor), h and g (digests)."""

    def find(batches):
        powers, powers2 = Powers(), Powers(BASE2)
        for batch in batches:
            data, offsets = binary_column(batch, "raw")
            for lo, hi, at, size in pieces(offsets):
                cuts = offsets[lo : hi + 1] - offsets[lo] if at == 0 and size == offsets[hi] - offsets[lo] else np.array([0, size])
                with np.errstate(over="ignore"):
                    row, p, w, a, h, g = segments(data[offsets[lo] + at : offsets[lo] + at + size], cuts, powers, powers2)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(p + at, pa.int32()), pa.array(w, pa.int32()), pa.array(a), pa.array(h), pa.array(g, pa.int32())], names=[f.split()[0] for f in SEGMENT_SCHEMA.split(", ")])

    return map_arrow(docs.select("doc_id", "key", "raw"), find, SEGMENT_SCHEMA)


CONTENT_SCHEMA = "a long, h long, g int, w int, x long, y long, bytes binary"


def contents(docs: DataFrame) -> DataFrame:
    """For ``wanted`` segments (p, w, a, h, g, hot) of each text: their bytes or, where hot, the number and digests of each window."""

    def cut(batches):
        powers, powers2 = Powers(), Powers(BASE2)
        fields = [f.split() for f in CONTENT_SCHEMA.split(", ")]
        types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        for batch in batches:
            rows = []
            for raw, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = raw.as_py()
                for s in wanted:
                    part = raw[s["p"] : s["p"] + s["w"] - 1 + LENGTH]
                    if not s["hot"]:
                        rows.append((s["a"], s["h"], s["g"], s["w"], None, None, part))
                        continue
                    at = np.arange(s["w"])
                    with np.errstate(over="ignore"):
                        x, y = (span_hash(prefix_hash(np.frombuffer(part, np.uint8), q), at, at + LENGTH, q).view(np.int64).tolist() for q in (powers, powers2))
                    rows += [(s["a"], s["h"], s["g"], k, i, j, None) for k, (i, j) in enumerate(zip(x, y, strict=True))]
            columns = zip(*rows, strict=True) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    return map_arrow(docs.select("raw", "wanted"), cut, CONTENT_SCHEMA)


class Level:
    """Segments one after the other in ``data`` and ``order``, the starts of their windows sorted by what follows them."""

    def __init__(self, data: np.ndarray, keys: list[np.ndarray], order: np.ndarray | None = None, uid: str | None = None) -> None:
        self.data, self.keys, self.uid = data, keys, uid  # keys: a, h, g and w of each segment
        w = keys[3].astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(w + LENGTH - 1)])
        if order is None:
            starts = np.concatenate([np.arange(lo, lo + n) for lo, n in zip(self.at[:-1].tolist(), w.tolist(), strict=True)])
            order = starts[np.argsort(self.windows(starts), kind="stable")]
        self.order = order.astype(np.int32)
        self.hit = np.zeros(len(data), bool)

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)[starts]).view(f"S{LENGTH}").ravel()

    def find_own(self) -> None:
        """Mark windows that occur twice in this level."""
        keys = self.windows(self.order)
        same = np.flatnonzero(keys[1:] == keys[:-1])
        self.hit[self.order[same]] = self.hit[self.order[same + 1]] = True

    def scan(self, old: Level) -> None:
        """Mark what this level, a new batch, and an old one have in common, reading both in their order."""
        keys = self.windows(self.order)
        edges = np.zeros(len(keys) + 1, np.int64)
        for at in range(0, len(old.order), SCAN):
            part = old.order[at : at + SCAN]
            theirs = old.windows(part)
            left, right = np.searchsorted(keys, theirs), np.searchsorted(keys, theirs, "right")
            both = right > left
            old.hit[part[both]] = True
            np.add.at(edges, left[both], 1)
            np.add.at(edges, right[both], -1)
        self.hit[self.order[np.cumsum(edges[:-1]) > 0]] = True

    def place(self, key: bytes) -> int:
        """How many windows come before ``key``."""
        lo, hi = 0, len(self.order)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.data[self.order[mid] : self.order[mid] + LENGTH].tobytes() < key:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def merged(self, other: Level) -> Level:
        """One level of both, stretch by stretch."""
        shift, out, done = len(self.data), [], 0
        for at in range(0, len(self.order), SCAN):
            mine = self.order[at : at + SCAN]
            end = at + SCAN
            upto = other.place(self.data[self.order[end] : self.order[end] + LENGTH].tobytes()) if end < len(self.order) else len(other.order)
            theirs = other.order[done:upto]
            done = max(done, upto)
            starts = np.concatenate([mine, theirs + shift])
            out.append(starts[np.argsort(np.concatenate([self.windows(mine), other.windows(theirs)]), kind="stable")])
        new = Level(np.concatenate([self.data, other.data]), [np.concatenate(k) for k in zip(self.keys, other.keys, strict=True)], np.concatenate(out))
        new.hit = np.concatenate([self.hit, other.hit])
        return new

    def matches(self):
        """(a, h, g, ranges of windows) of the segments with marked windows."""
        for i in np.flatnonzero(np.add.reduceat(self.hit, self.at[:-1])) if len(self.hit) else ():
            a, h, g, w = (k[i] for k in self.keys)
            yield int(a), int(h), int(g), runs(self.hit[self.at[i] : self.at[i] + w])


class Family:
    """Levels of falling size."""

    def __init__(self, levels: list[Level] | None = None) -> None:
        self.levels = sorted(levels or [], key=lambda x: -len(x.order))
        self.gone: list[str] = []

    def add(self, new: Level) -> None:
        """A batch: scanned against itself and every level, then merged while the level before is no more than twice as large."""
        new.find_own()
        for old in self.levels:
            new.scan(old)
        self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2].order) <= 2 * len(self.levels[-1].order):
            b, a = self.levels.pop(), self.levels.pop()
            self.gone += [x.uid for x in (a, b) if x.uid]
            self.levels.append(a.merged(b))


def runs(mask: np.ndarray) -> list[dict]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


RANGES = "array<struct<lo:int,hi:int>>"
RANGE_TYPE = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


INDEX_SCHEMA = f"what string, uid string, bucket long, a long, h long, g int, ranges {RANGES}, data binary, starts binary, keys binary"


def indexed(rows: DataFrame) -> DataFrame:
    """What a batch changes in the index: rows are the live levels of its buckets (uid, data, starts, keys) and its segments (a, h, g, w, data), by bucket.

    Rows come out as new levels, levels that have merged into them (``gone``) and matches of segments, old and new.
    """
    names = [f.split()[0] for f in INDEX_SCHEMA.replace(RANGES, "x").split(", ")]

    def change(batches):
        import uuid

        def close(bucket, family):
            base = dict.fromkeys(names)
            out = [base | {"what": "gone", "uid": u, "bucket": bucket} for u in family.gone]
            for level in family.levels:
                out += [base | {"what": "match", "bucket": bucket, "a": a, "h": h, "g": g, "ranges": r} for a, h, g, r in level.matches()]
                if level.uid is None:
                    keys = b"".join(k.astype(t).tobytes() for k, t in zip(level.keys, ("<i8", "<i8", "<i4", "<i4"), strict=True))
                    out.append(base | {"what": "level", "uid": uuid.uuid4().hex, "bucket": bucket, "data": level.data.tobytes(), "starts": level.order.astype("<i4").tobytes(), "keys": keys})
            columns = [pa.array([r[n] for r in out], t) for n, t in zip(names, types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), RANGE_TYPE, pa.binary(), pa.binary(), pa.binary()]
        now, family, waiting, fresh = None, None, [], []

        def flush():
            """Restored levels first, then what has come of the batch so far."""
            nonlocal family, waiting, fresh
            if family is None:
                family, waiting = Family(waiting), []
            if fresh:
                a, h, g, w, data = zip(*fresh, strict=True)
                family.add(Level(np.frombuffer(b"".join(data), np.uint8), [np.array(a, np.int64), np.array(h, np.int64), np.array(g, np.int32), np.array(w, np.int32)]))
                fresh = []

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bucket, uid, a, h, g, w, data, starts, keys = r
                if bucket != now:
                    if now is not None:
                        flush()
                        yield close(now, family)
                    now, family = bucket, None
                if uid is not None:
                    n = len(keys) // 24
                    parts = [np.frombuffer(keys, t, n, at * n) for t, at in (("<i8", 0), ("<i8", 8), ("<i4", 16), ("<i4", 20))]
                    waiting.append(Level(np.frombuffer(data, np.uint8), parts, np.frombuffer(starts, "<i4"), uid))
                else:
                    fresh.append((a, h, g, w, data))
            if now is not None and fresh:
                flush()
        if now is not None:
            flush()
            yield close(now, family)

    return map_arrow(rows.select("bucket", "uid", "a", "h", "g", "w", "data", "starts", "keys"), change, INDEX_SCHEMA)


class Passages:
    """Repeated passages of a growing set of documents.

    ``add`` takes a DataFrame (doc_id, key, raw) that can be read again; ``cuts`` gives the byte intervals of all
    documents so far that repeat anywhere among them. Segments, kinds that have been looked at and the index are tables in the
    shared folder, one more for each batch. The number of buckets is set by the first batch.
    """

    def __init__(self) -> None:
        self.docs: list[DataFrame] = []
        self.segs: list[DataFrame] = []
        self.seen: list[DataFrame] = []
        self.index: list[DataFrame] = []
        self.buckets = 0

    @staticmethod
    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def kinds(self) -> DataFrame:
        """(a, h, g, n, at): different segments of anchors that occur twice; ``at`` is one place, m the kinds of the anchor."""
        segs = self.union(self.segs)
        per = segs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(own_exchange("a"))
        self.shared = materialize(segs.join(per, "a"), "shared", codec="zstd")
        place = F.struct(F.col("doc_id").alias("i"), F.col("key").alias("k"), "p", "w")
        return materialize(self.shared.groupBy("a", "h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at")), "kinds", codec="zstd")

    def add(self, docs: DataFrame) -> None:
        self.docs.append(docs)
        self.segs.append(materialize(located(docs), "segments", codec="zstd"))
        self.every = kinds = self.kinds()
        per = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(own_exchange("a"), (F.col("m") > HOT_SEGMENTS).alias("hot"))
        wanted = kinds.join(per, "a").select("a", "h", "g", "at", "hot")
        if self.seen:
            done = self.union(self.seen).select("a", "h", "g", F.col("x").isNotNull().alias("hot")).distinct()
            wanted = wanted.join(done, ["a", "h", "g", "hot"], "left_anti")
        wanted = wanted.groupBy(F.col("at.i").alias("i"), F.col("at.k").alias("k")).agg(F.collect_list(F.struct("at.p", "at.w", "a", "h", "g", "hot")).alias("wanted"))
        texts = self.union(self.docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")))
        found = materialize(contents(texts).dropDuplicates(["a", "h", "g", "w"]), "contents", codec="zstd")
        self.seen.append(found)
        cold = found.where("x is null")
        if not self.buckets:
            self.buckets = 1 << max(6, (cold.count() // BUCKET_SEGMENTS).bit_length())
        none = lambda kind: F.lit(None).cast(kind)
        fresh = cold.select(F.pmod("a", F.lit(self.buckets)).alias("bucket"), none("string").alias("uid"), "a", "h", "g", "w", F.col("bytes").alias("data"), none("binary").alias("starts"), none("binary").alias("keys"))
        rows = fresh
        if self.index:
            touched = fresh.select("bucket").distinct()
            live = self.levels().join(touched, "bucket", "left_semi")
            rows = fresh.unionByName(live.select("bucket", "uid", none("long").alias("a"), none("long").alias("h"), none("int").alias("g"), none("int").alias("w"), "data", "starts", "keys"))
        rows = rows.repartition("bucket").sortWithinPartitions("bucket", F.col("uid").isNull(), "a", "h", "g")
        self.index.append(materialize(indexed(rows), "index", codec="zstd"))

    def levels(self) -> DataFrame:
        """Live levels: those that no later batch has merged into another."""
        index = self.union(self.index)
        gone = index.where("what = 'gone'").select("bucket", "uid")
        return index.where("what = 'level'").join(gone, ["bucket", "uid"], "left_anti")

    def cuts(self) -> DataFrame:
        """(doc_id, key, cuts): byte intervals of each text."""
        found = self.union(self.seen)
        parts = self.union(self.index).where("what = 'match'").select("a", "h", "g", "ranges")
        # single windows of hot anchors: equal ones of different kinds are counted
        hot = found.where("x is not null").select("a", "h", "g", "w", "x", "y")
        twice = hot.groupBy("a", "x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(own_exchange("a"), "x", "y")
        single = hot.join(twice, ["a", "x", "y"]).groupBy("a", "h", "g").agg(F.array_sort(F.collect_list(F.struct(F.col("w").alias("lo"), (F.col("w") + 1).alias("hi")))).alias("ranges"))
        ranges = parts.unionByName(single).groupBy("a", "h", "g").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
        counted = self.every.select("a", "h", "g", "n").join(ranges, ["a", "h", "g"], "left").where("n > 1 or ranges is not null")
        counted = counted.select(own_exchange("a"), "h", "g", (F.col("n") > 1).alias("again"), "ranges")
        whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("w").alias("hi")))
        got = self.shared.join(counted, ["a", "h", "g"]).withColumn("r", F.when(F.col("again"), whole).otherwise(F.col("ranges")))
        spans = F.transform("r", lambda r: F.struct((F.col("p") + r["lo"]).alias("lo"), (F.col("p") + r["hi"] - 1 + LENGTH).alias("hi")))
        return got.groupBy("doc_id", "key").agg(F.flatten(F.collect_list(spans)).alias("cuts"))


def joined_cuts(cuts: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((c["lo"], c["hi"]) for c in cuts or []):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def without_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; ``texts`` adds the bytes that stay (``kept``)."""
    x = keyed(docs)
    family = Passages()
    family.add(x)
    return stripped(x, family.cuts(), texts)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text) and raw, the text's bytes."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(F.col("doc_id").cast("long"), raw.alias("raw"), F.xxhash64(raw).alias("key"))


def stripped(x: DataFrame, cut: DataFrame, texts: bool = False) -> DataFrame:
    """The result columns of rows (doc_id, key, raw) and their ``cut``."""
    got = x.join(cut.withColumnRenamed("doc_id", "_id").withColumnRenamed("key", "_key"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").select("doc_id", "raw", "cuts")

    def strip(batches):
        for batch in batches:
            rows = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for raw, cuts in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw, spans = raw.as_py(), joined_cuts(cuts)
                left, at = [], 0
                for lo, hi in spans:
                    left.append(raw[at:lo])
                    at = hi
                kept = b"".join([*left, raw[at:]])
                rows["n_bytes"].append(len(raw))
                rows["n_removed"].append(len(raw) - len(kept))
                rows["n_spans"].append(len(spans))
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                rows["kept"].append(kept if texts else None)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)]], names=["doc_id", *rows])

    out = map_arrow(got, strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if texts else out.drop("kept")
