"""Whole Arrow batches of texts as byte arrays: words, hashes and prefix sums without a loop over characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Odd multiplier of the polynomial hash.
BASE = 0x9E3779B97F4A7C15


def binary_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary or string column and row offsets; null rows are empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    col = col.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int):
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[32, 9, 10, 11, 12, 13]] = True
    return t


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the index of its first word (one more entry at the end)."""
    inside = ~space_table()[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1]
    before[cuts[cuts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    cuts = offsets[1:] - 1
    after[cuts[cuts >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Powers:
    """Powers of an odd base and its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = BASE) -> None:
        self.base = base
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) <= n:
            m = max(n + 1, 1 << 16)
            up = np.full(m, self.base, np.uint64)
            down = np.full(m, pow(self.base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            with np.errstate(over="ignore"):
                self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)


def prefix_hash(data: np.ndarray, powers: Powers) -> np.ndarray:
    """P with P[i] = sum of (data[j] + 1) * BASE**j over j < i."""
    powers.to(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of the bytes in [start, end), the same wherever they stand."""
    return mix((prefix[ends] - prefix[starts]) * powers.down[starts] + (ends - starts).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values of ``x``, ascending: by sorting, which is faster here than hashing."""
    y = np.sort(x)
    new = np.ones(len(y), bool)
    np.not_equal(y[1:], y[:-1], out=new[1:])
    return y[new]
