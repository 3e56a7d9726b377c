"""Media columns: lossless TIFF images of byte payloads, written and read page by page.

``read_tiff_pages`` walks the image directories of each file in a binary column, decodes
uncompressed, PackBits, LZW and deflate strips or tiles, undoes horizontal prediction and emits
one row per page. A null file gives no row; a file that is broken, or that claims pages larger than its
bytes can hold, gives one row with ``error`` set. ``media_digest`` stores whole texts as TIFF files, reads the
stored bytes back as rows of pages and digests those: codec and layout of a file follow from its payload's
checksum, so texts of every length go through every codec, in strips and in tiles. A null text is empty, an empty
text is one block of 64 zero bytes, a very long text takes many pages and one file, repeated rows give
repeated results, an empty table gives an empty result, other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._io import map_arrow

NONE, LZW, DEFLATE, PACKBITS = 1, 5, 8, 32773  # TIFF compression codes
WIDTH = 64
#: Rows of a strip, of a tile and of a page; longer payloads take more pages.
STRIP_ROWS, TILE, PAGE_ROWS = 48, (64, 32), 256
#: Decoded bytes that a stored byte can stand for at most, in any of the codecs.
MOST_RATIO = 4096
TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8}


#: Equal bytes from which a run is written as one; shorter ones stay inside literals.
LEAST_RUN = 3


def packbits_encode(data: bytes) -> bytes:
    """Runs and the stretches between them, found for all bytes at once; the loop is over those pieces."""
    b = np.frombuffer(data, np.uint8)
    edges = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]]) if len(b) else np.zeros(1, np.int64)
    long = np.flatnonzero(np.diff(edges) >= LEAST_RUN)
    out, at = bytearray(), 0

    def literal(end: int) -> None:
        for i in range(at, end, 128):
            part = data[i : min(i + 128, end)]
            out.append(len(part) - 1)
            out.extend(part)

    for start, end in zip(edges[long].tolist(), edges[long + 1].tolist(), strict=True):
        literal(start)
        for i in range(start, end, 128):
            n = min(128, end - i)
            out.extend((257 - n, data[i]) if n > 1 else (0, data[i]))
        at = end
    literal(len(data))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while i < len(data) and len(out) < size:
        head = data[i]
        i += 1
        if head < 128:
            out += data[i : i + head + 1]
            i += head + 1
        elif head > 128:
            out += data[i : i + 1] * (257 - head)
            i += 1
    return bytes(out)


#: LZW codes: start a new table, end; the first of strings; the entries that fill a table.
CLEAR, END, FIRST, FULL = 256, 257, 258, 4094


def code_widths(n: int) -> np.ndarray:
    """Bits of the first ``n`` codes after a clear: each adds an entry, and codes widen one early."""
    entries = FIRST + np.arange(n)
    return 9 + (entries >= 512).astype(np.int64) + (entries >= 1024) + (entries >= 2048)


def lzw_encode(data: bytes) -> bytes:
    """TIFF's variant: codes of 9 to 12 bits, most significant bit first, widened one code early.

    The loop only looks up (code so far, next byte); codes are packed to bits afterwards, all at once.
    """
    runs, codes, table, nxt = [], [CLEAR], {}, FIRST
    cur = -1
    for byte in data:
        if cur < 0:
            cur = byte
            continue
        key = cur << 8 | byte
        found = table.get(key)
        if found is not None:
            cur = found
            continue
        codes.append(cur)
        table[key] = nxt
        nxt += 1
        if nxt == FULL:
            runs.append(codes)
            codes, table, nxt = [CLEAR], {}, FIRST
        cur = byte
    if cur >= 0:
        codes.append(cur)
    codes.append(END)
    runs.append(codes)
    values, widths = [], []
    before = 9
    for codes in runs:
        own = code_widths(len(codes))
        widths.append(np.concatenate([[before], own[:-1]]))  # the first code, which clears, still has the width of the run before
        values.append(np.array(codes, np.int64))
        before = int(own[-1])
    value, width = np.concatenate(values), np.concatenate(widths)
    place = width[:, None] - 1 - np.arange(12)
    bits = (value[:, None] >> np.maximum(place, 0) & 1).astype(np.uint8)
    return np.packbits(bits[place >= 0]).tobytes()


def lzw_decode(data: bytes, size: int) -> bytes:
    """Codes between two clears are cut from the bits at once, as their widths follow from their number; the loop is over codes."""
    padded = np.frombuffer(data + bytes(4), np.uint8).astype(np.int64)
    most = 8 * len(data)
    widths = code_widths(FULL - FIRST + 4)  # as long as a table can last
    ends = np.cumsum(widths)
    out, at, width = [], 0, 9
    total = 0
    if most >= 9 and (int(padded[0]) << 1 | int(padded[1]) >> 7) == CLEAR:
        at = 9
    while total < size and at < most:
        n = int(np.searchsorted(ends, most - at, "right"))
        place = at + ends[:n] - widths[:n]
        q = place >> 3
        word = padded[q] << 24 | padded[q + 1] << 16 | padded[q + 2] << 8 | padded[q + 3]
        codes = word >> (32 - widths[:n] - (place & 7)) & ((1 << widths[:n]) - 1)
        stops = np.flatnonzero((codes == CLEAR) | (codes == END))
        stop = int(stops[0]) if len(stops) else n
        table = SINGLE.copy()
        add, prev = table.append, None
        for code in codes[:stop].tolist():
            if prev is None:
                if code > 255:
                    raise ValueError("LZW code out of range")
                entry = table[code]
            elif code < len(table):
                entry = table[code]
                add(prev + entry[:1])
            elif code == len(table):
                entry = prev + prev[:1]
                add(entry)
            else:
                raise ValueError("LZW code out of range")
            out.append(entry)
            total += len(entry)
            if total >= size:
                break
            prev = entry
        if stop == n:
            if total < size and n == len(ends):
                raise ValueError("LZW table without end")
            break
        if codes[stop] == END:
            break
        at += int(ends[stop])
    return b"".join(out)


SINGLE = [bytes((i,)) for i in range(256)] + [b"", b""]
ENCODERS = {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda b: zlib.compress(b, 6)}


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, tile: tuple[int, int] | None = None) -> bytes:
    """A little-endian TIFF of 8-bit grey pages (rows x columns), in strips or, with ``tile`` (rows, columns), in tiles."""
    body, dirs = bytearray(b"II*\0\0\0\0\0"), []
    for page in pages:
        h, w = page.shape
        if tile:
            th, tw = tile
            padded = np.zeros((-(-h // th) * th, -(-w // tw) * tw), np.uint8)
            padded[:h, :w] = page
            parts = [padded[y : y + th, x : x + tw] for y in range(0, h, th) for x in range(0, w, tw)]
        else:
            parts = [page[y : y + STRIP_ROWS] for y in range(0, h, STRIP_ROWS)]
        offsets, counts = [], []
        for part in parts:
            if predictor == 2:
                part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
            raw = ENCODERS[compression](np.ascontiguousarray(part).tobytes())
            offsets.append(len(body))
            counts.append(len(raw))
            body += raw
            body += b"\0" * (len(body) % 2)
        fields = [(256, 4, [w]), (257, 4, [h]), (258, 3, [8]), (259, 3, [compression]), (262, 3, [1]), (277, 3, [1]), (317, 3, [predictor])]
        fields += [(322, 4, [tile[1]]), (323, 4, [tile[0]]), (324, 4, offsets), (325, 4, counts)] if tile else [(273, 4, offsets), (278, 4, [STRIP_ROWS]), (279, 4, counts)]
        dirs.append(sorted(fields))
    link = 4
    for fields in dirs:
        entries = bytearray()
        for tag, kind, values in fields:
            raw = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(raw) > 4:
                at = len(body)
                body += raw + b"\0" * (len(raw) % 2)
                raw = struct.pack("<I", at)
            entries += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
        struct.pack_into("<I", body, link, len(body))
        body += struct.pack("<H", len(fields)) + entries
        link = len(body)
        body += b"\0\0\0\0"
    return bytes(body)


def read_tiff(data: bytes) -> list[dict]:
    """Every page: width, height, samples, compression, predictor and the decoded 8-bit samples."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, pages, seen = struct.unpack_from(order + "I", data, 4)[0], [], set()
    while at:
        if at in seen or at + 2 > len(data):
            raise ValueError("broken chain of image directories")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        tags = {}
        for k in range(n):
            tag, kind, count, _ = struct.unpack_from(order + "HHII", data, at + 2 + 12 * k)
            if kind not in (1, 3, 4):
                continue
            place = at + 2 + 12 * k + 8
            if TYPE_SIZE[kind] * count > 4:
                (place,) = struct.unpack_from(order + "I", data, place)
            tags[tag] = list(struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind]}", data, place))
        w, h, spp = tags[256][0], tags[257][0], tags.get(277, [1])[0]
        comp, pred = tags.get(259, [NONE])[0], tags.get(317, [1])[0]
        if any(b != 8 for b in tags.get(258, [8])) or pred not in (1, 2) or tags.get(284, [1])[0] != 1:
            raise ValueError("unsupported sample layout")
        if min(w, h, spp) < 1 or h * w * spp > MOST_RATIO * len(data):
            raise ValueError("page size does not fit its file")
        image = np.empty((h, w * spp), np.uint8)
        if 324 in tags:
            tw, th = tags[322][0], tags[323][0]
            if min(tw, th) < 1 or th * tw * spp > MOST_RATIO * len(data):
                raise ValueError("tile size does not fit its file")
            places = [(y, x * spp, th, tw * spp) for y in range(0, h, th) for x in range(0, w, tw)]
            offsets, counts = tags[324], tags[325]
        else:
            rows = min(tags.get(278, [h])[0], h) or h
            places = [(y, 0, min(rows, h - y), w * spp) for y in range(0, h, rows)]
            offsets, counts = tags[273], tags[279]
        if not len(places) == len(offsets) == len(counts):
            raise ValueError("strips or tiles are missing")
        for (y, x, ph, pw), o, c in zip(places, offsets, counts, strict=True):
            raw, size = data[o : o + c], ph * pw
            if comp == NONE:
                part = raw
            elif comp == PACKBITS:
                part = packbits_decode(raw, size)
            elif comp == LZW:
                part = lzw_decode(raw, size)
            elif comp in (DEFLATE, 32946):
                part = zlib.decompressobj().decompress(raw, size)
            else:
                raise ValueError(f"unsupported compression {comp}")
            if len(part) < size:
                raise ValueError("a strip or tile is too short")
            part = np.frombuffer(part, np.uint8, size).reshape(ph, pw)
            if pred == 2:
                part = np.cumsum(part.reshape(ph, -1, spp), axis=1, dtype=np.uint8).reshape(ph, pw)
            image[y : y + ph, x : x + pw] = part[: h - y, : w * spp - x]
        pages.append({"width": w, "height": h, "samples": spp, "compression": comp, "predictor": pred, "data": image.tobytes()})
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
    return pages


PAGE_SCHEMA = "page_no int, width int, height int, samples int, compression int, predictor int, data binary, error string"


def read_tiff_pages(df: DataFrame, key: str, content: str) -> DataFrame:
    """One row per page of each file in ``content``: key, page_no, width, height, samples, compression, predictor, data, error.

    The pages of a file are consecutive rows of one partition.
    """
    names = [f.split()[0] for f in PAGE_SCHEMA.split(", ")]
    arrow = {"int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    kinds = [arrow[f.split()[1]] for f in PAGE_SCHEMA.split(", ")]

    def pages(batches):
        for batch in batches:
            rows, at = [], []

            def flush(batch=batch):
                columns = [pa.array([r.get(n) for r in rows], t) for n, t in zip(names, kinds, strict=True)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=[key, *names])

            for i, raw in enumerate(batch.column(1)):
                raw = raw.as_py()
                if raw is None:
                    continue
                try:
                    found = [{"page_no": n, **p} for n, p in enumerate(read_tiff(raw))]
                except (ValueError, KeyError, IndexError, OverflowError, MemoryError, struct.error, zlib.error) as e:
                    found = [{"error": str(e) or type(e).__name__}]
                for r in found:
                    rows.append(r)
                    at.append(i)
                    if len(rows) >= 512:
                        yield flush()
                        rows, at = [], []
            yield flush()

    kind = df.select(key).schema[0].dataType.simpleString()
    return map_arrow(df.select(key, content), pages, f"`{key}` {kind}, {PAGE_SCHEMA}")


def store(payload: bytes) -> bytes:
    """The stored form of a payload of whole 64-byte rows: its checksum picks the codec and whether pages are cut into strips or tiles."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    pick = zlib.crc32(payload)
    comp = (PACKBITS, LZW, DEFLATE)[pick % 3]
    return write_tiff([rows[i : i + PAGE_ROWS] for i in range(0, len(rows), PAGE_ROWS)], comp, 1 + pick // 3 % 2, TILE if pick // 6 % 2 else None)


def feature(pages: int, rows: int, columns: np.ndarray) -> str:
    """Pages, rows, mean in thousandths and a 64-bit hash: which columns are brighter than the mean."""
    total = int(columns.sum())
    bits = int("".join("1" if int(c) * WIDTH > total else "0" for c in columns), 2)
    return f"{pages}x{rows}:{total * 1000 // (rows * WIDTH)}:{bits:016x}"


def stored(docs: DataFrame) -> DataFrame:
    """(file, media): each text as a TIFF file; file holds doc_id, n_bytes, and size and digest of what is stored."""

    def write(batches):
        for batch in batches:
            media, sizes = [], []
            for raw in batch.column(1):
                raw = raw.as_py() or b""
                sizes.append(len(raw))
                media.append(store(raw + b"\0" * ((-len(raw)) % 64 or (0 if raw else 64))))
            file = pa.StructArray.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(map(len, media), pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in media], pa.string())], ["doc_id", "n_bytes", "media_bytes", "media_sha256"])
            yield pa.RecordBatch.from_arrays([file, pa.array(media, pa.binary())], names=["file", "media"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("raw"))
    return map_arrow(rows, write, "file struct<doc_id:long,n_bytes:long,media_bytes:long,media_sha256:string>, media binary")


DIGEST_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digested(pages: DataFrame) -> DataFrame:
    """The digest columns of each file from its rows of pages, which follow one another; a page is held at a time."""
    fields = [f.split() for f in DIGEST_SCHEMA.split(", ")]
    types = [pa.int64() if t == "long" else pa.string() for _, t in fields]

    def digest(batches):
        now, state, done = None, None, []

        def close():
            size, sha, tail, n, columns = state
            done.append((now["doc_id"], now["n_bytes"], size, sha.hexdigest(), zlib.crc32(tail), now["media_bytes"], now["media_sha256"], feature(n, size // WIDTH, columns)))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[]] * len(types), types, strict=True)], names=[n for n, _ in fields])
            done.clear()
            return out

        for batch in batches:
            for file, n, data, error in zip(*(batch.column(i) for i in range(4)), strict=True):
                if error.as_py():
                    raise ValueError(error.as_py())
                if n.as_py() == 0:
                    if state:
                        close()
                    now, state = file.as_py(), [0, hashlib.sha256(), b"", 0, np.zeros(WIDTH, np.int64)]
                data = data.as_py()
                state[0] += len(data)
                state[1].update(data)
                state[2] = data[-64:]
                state[3] += 1
                state[4] += np.frombuffer(data, np.uint8).reshape(-1, WIDTH).sum(axis=0, dtype=np.int64)
            yield flush()
        if state:
            close()
        yield flush()

    return map_arrow(pages.select("file", "page_no", "data", "error"), digest, DIGEST_SCHEMA)


def media_digest(docs: DataFrame) -> DataFrame:
    """Store every whole text as TIFF, read it back page by page, and return sizes, digests and a feature of what was read."""
    return digested(read_tiff_pages(stored(docs), "file", "media"))
