"""Zstandard WARC archives: one frame per record, the dictionary in a leading skippable frame.

Writer and reader work on archives of bounded size, held as rows ``(archive_id, content)`` of a
table in the shared folder (or as files read by Spark's ``binaryFile`` source, see ``read_files``).
A null payload is empty; a page without an id that repeats another's payload revisits it, one without a url
gets about:blank; an empty table gives no archive and no record; repeated rows give repeated records; other
columns of the input are ignored. A record is held whole in memory, an archive closes after the record that
fills it, so a very long page has an archive of its own. A broken archive raises ``ValueError``.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._io import map_arrow, materialize

SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, b"\x37\xa4\x30\xec"
#: Payload bytes of an archive, bytes of its dictionary and of the samples that it is trained on.
ARCHIVE_BYTES, DICT_BYTES, SAMPLE_BYTES = 8 << 20, 16 << 10, 1 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, revisit_of: int | None) -> bytes:
    """A WARC/1.1 response with its payload, or a revisit that keeps only the HTTP headers."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit_of is not None else http + payload
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page-{i}')}>"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if revisit_of is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
        "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join((url or 'about:blank').split())}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}", f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit_of is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(revisit_of)}", f"X-Refers-To-Page-ID: {revisit_of}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack_archive(records: list[bytes]) -> bytes:
    """The dictionary, where enough records are there to train one, then a frame for each record."""
    samples, size = [], 0
    for r in records:
        if size < SAMPLE_BYTES:
            samples.append(r)
            size += len(r)
    out, trained = bytearray(), None
    if len(samples) >= 16:
        try:
            trained = zstandard.train_dictionary(min(DICT_BYTES, max(1024, size // 8)), samples)
        except zstandard.ZstdError:
            trained = None
    if trained is not None:
        raw = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
        out += struct.pack("<II", SKIPPABLE, len(raw)) + raw
    c = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True, write_content_size=True)
    for r in records:
        out += c.compress(r)
    return bytes(out)


def frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its header and block headers."""
    if len(data) < at + 6 or struct.unpack_from("<I", data, at)[0] != FRAME:
        raise ValueError(f"no frame at byte {at}")
    flags = data[at + 4]
    single = flags >> 5 & 1
    pos = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
    while True:
        if pos + 3 > len(data):
            raise ValueError("truncated frame")
        head = int.from_bytes(data[pos : pos + 3], "little")
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    pos += 4 * (flags >> 2 & 1)
    if pos > len(data):
        raise ValueError("truncated frame")
    return pos


def parse_record(raw: bytes) -> dict:
    """Headers and block of the one record in ``raw``, its version, lengths and digests checked."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        k, colon, v = line.partition(":")
        if not colon:
            raise ValueError(f"broken header {line!r}")
        headers[k.strip().lower()] = v.strip()
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if k not in headers:
            raise ValueError(f"header {k} is missing")
    size = int(headers["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("Content-Length does not match the record")
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("block digest does not match")
    out = {"type": headers["warc-type"], "headers": headers, "block": block, "payload": None, "payload_bytes": None}
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        lengths = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        out["payload_bytes"] = int(lengths[0]) if lengths else len(payload)
        if out["type"] == "response":
            out["payload"] = payload
            if lengths and len(payload) != out["payload_bytes"]:
                raise ValueError("HTTP Content-Length does not match the payload")
            if "warc-payload-digest" in headers and headers["warc-payload-digest"] != f"sha1:{digest(payload)}":
                raise ValueError("payload digest does not match")
    return out


def iter_archive(data: bytes):
    """Every record of an archive: the dictionary is taken from the leading skippable frame, if there is one."""
    at, trained = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data, 0)[0] == SKIPPABLE:
        (size,) = struct.unpack_from("<I", data, 4)
        raw, at = data[8 : 8 + size], 8 + size
        if len(raw) != size:
            raise ValueError("truncated dictionary")
        if raw[:4] == struct.pack("<I", FRAME):
            raw = zstandard.ZstdDecompressor().decompress(raw)
        if raw[:4] != DICTIONARY:
            raise ValueError("the leading skippable frame holds no dictionary")
        trained = zstandard.ZstdCompressionDict(raw)
    d = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(data):
        if len(data) >= at + 8 and struct.unpack_from("<I", data, at)[0] & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        end = frame_end(data, at)
        frame = data[at:end]
        size = zstandard.frame_content_size(frame)
        raw = d.decompress(frame) if size >= 0 else d.decompressobj().decompress(frame)
        if size >= 0 and len(raw) != size:
            raise ValueError("frame length does not match")
        yield parse_record(raw)
        at = end


def write_archives(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, payload, revisit_of) to a table (archive_id, content) in the shared folder."""

    def write(batches):
        from pyspark import TaskContext

        held, size, count = [], 0, 0
        part = TaskContext.get().partitionId()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([f"{part:06d}-{count:06d}"]), pa.array([pack_archive(held)], pa.binary())], names=["archive_id", "content"])

        for batch in batches:
            for page, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(record(page, url, payload or b"", first))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size, count = [], 0, count + 1
        if held:
            yield flush()

    return materialize(map_arrow(pages.select(F.col("page_id").cast("long"), "url", "payload", F.col("revisit_of").cast("long")), write, "archive_id string, content binary"), "warc")


READ_SCHEMA = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, record_id string, target_uri string, payload binary"


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the archives in ``content``; ``payloads`` also returns the responses' bytes."""
    names = [f.split()[0] for f in READ_SCHEMA.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in READ_SCHEMA.split(", ")])
    number = lambda x: int(x) if x else None

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for r in iter_archive(content.as_py() or b""):
                    h = r["headers"]
                    rows.append(dict(zip(names, (number(h.get("x-page-id")), r["type"], r["payload_bytes"], h.get("warc-payload-digest", "").removeprefix("sha1:") or None, number(h.get("x-refers-to-page-id")), h["warc-record-id"], h.get("warc-target-uri"), r["payload"] if payloads else None), strict=True)))
                    if len(rows) >= 512:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return map_arrow(archives.select("content"), read, READ_SCHEMA)


def read_files(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of ``*.warc.zst`` files in any store that Spark reads."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(path)
    return read_archives(files.select("content"), payloads)


def with_revisits(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """Adds ``revisit_of``: the smallest key with an equal payload, null for that page itself and where no equal page has a key.

    Digests and keys are resolved first, in tables of their own, so that Spark can split the join on a digest that
    very many pages share; payloads travel once, by key and digest.
    """
    total = F.sha2(F.col(payload), 256)
    sums = materialize(pages.select(F.col(key).alias("k"), total.alias("s")), "sums")
    first = materialize(sums.groupBy("s").agg(F.min("k").alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1 and f is not null").select("s", "f"), "first")
    later = materialize(sums.join(first, "s").where("k is null or k <> f").select("k", "s", "f").distinct(), "later").alias("l")
    doc = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"), F.col(key).alias("k"), total.alias("s")).alias("d")
    got = doc.join(later, F.col("d.k").eqNullSafe(F.col("l.k")) & (F.col("d.s") == F.col("l.s")), "left")
    return got.select("d.page.*", F.col("l.f").alias("revisit_of"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page as a record, read the archives back and return the digest columns of each page."""
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    back = read_archives(write_archives(with_revisits(rows, "page_id", "payload")))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
