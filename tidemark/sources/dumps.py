"""Dump files of binary documents as a data source that Spark splits: reading by byte ranges, writing in parts.

A file is a sequence of documents without marks between them. A task gets a range of bytes and reads the documents that
start in it. To find the first, it goes back some way before its range and looks for a place from which several whole documents follow one
another, each well formed down to its last element. The end of a document may look like a document of its own, so the
first one found is passed over; what follows it is a boundary, as inside a document no two documents stand side by side,
unless a binary value holds part of a dump itself. A place is looked at in full only if its first element has a known type
and its last byte is a zero, so that a wrong place costs a few bytes however long the document that it would begin.
Many small ranges are dealt to tasks in runs; each range is still found by itself. ``gaps`` finds whether the documents of a file cover it without gap or
overlap, from their offsets alone.

Files may be larger than memory and than any array: a task holds one document and a buffer. Paths are what pyarrow's file
systems open (local, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tidemark.sources import bson

#: Bytes of a task's range and of the way back from it at first; documents that must follow one another; the largest document, in bytes.
SPLIT, BACK, CHAIN, LARGEST = 64 << 20, 1 << 16, 8, 64 << 20
BUFFER = 4 << 20
#: Bytes of a task of small ranges, and tasks before ranges are dealt in runs; documents and bytes of a batch that a task hands on.
RUN, TASKS = 8 << 20, 64
BATCH, BATCH_BYTES = 4096, 8 << 20


def opened(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Bytes:
    """Bytes of a file at any place, through one buffer of about ``buffer`` bytes."""

    def __init__(self, file, length: int, buffer: int = BUFFER) -> None:
        self.file, self.length, self.at, self.data, self.buffer = file, length, 0, b"", min(buffer, BUFFER)

    def get(self, at: int, n: int) -> bytes:
        """At most ``n`` bytes from ``at``; fewer only at the end of the file."""
        n = max(0, min(n, self.length - at))
        if not (self.at <= at and at + n <= self.at + len(self.data)):
            self.at, self.data = at, self.file.read_at(min(max(n, self.buffer), self.length - at), at)
        return self.data[at - self.at : at - self.at + n]

    def one(self, at: int) -> int:
        """The byte at ``at``; one outside the buffer leaves it as it is."""
        return self.data[at - self.at] if self.at <= at < self.at + len(self.data) else self.file.read_at(1, at)[0]


def document_at(w: Bytes, at: int) -> bytes | None:
    """The bytes of a document that starts at ``at``; None if none can."""
    head = w.get(at, 4)
    size = int.from_bytes(head, "little", signed=True) if len(head) == 4 else 0
    if not 5 <= size <= LARGEST or at + size > w.length or w.one(at + size - 1):
        return None
    return w.get(at, size)


def follows(w: Bytes, at: int) -> bool:
    """Whether ``CHAIN`` whole documents, or fewer up to the end of the file, start at ``at``."""
    for _ in range(CHAIN):
        if at == w.length:
            return True
        raw = document_at(w, at)
        if raw is None:
            return False
        try:
            bson.checked(raw)
        except (ValueError, IndexError):
            return False
        at += len(raw)
    return True


def candidate(w: Bytes, lo: int, hi: int) -> int | None:
    """The first place in [lo, hi) from which documents follow one another."""
    import numpy as np

    known = np.isin(np.arange(256), bson.KINDS)
    for base in range(lo, hi, BUFFER):
        block = w.get(base, min(hi - base, BUFFER) + 4)
        if len(block) < 5:
            return None
        b = np.frombuffer(block, np.uint8)
        sizes = np.ndarray(len(b) - 4, "<i4", b, strides=(1,)).astype(np.int64)
        at = base + np.arange(len(sizes))
        first = np.where(sizes == 5, b[4:] == 0, known[b[4:]])  # the type of the first element, or the end
        for p in at[(sizes >= 5) & (sizes <= LARGEST) & (at + sizes <= w.length) & first].tolist():
            if follows(w, p):
                return p
    return None


def first_start(w: Bytes, lo: int) -> int | None:
    """The first boundary at or after ``lo``: from the start of the file, or past a document that was found before ``lo``."""
    back = BACK
    while True:
        base = max(0, lo - back)
        at = 0 if base == 0 else candidate(w, base, lo)
        if at is not None and base:
            at += len(document_at(w, at) or b"")
        if at is not None and (at <= lo or base == 0):
            while at < lo:
                raw = document_at(w, at)
                if raw is None:
                    raise ValueError(f"no whole document at byte {at}")
                at += len(raw)
            return at if at < w.length else None
        back *= 4


def read_range(path: str, lo: int, hi: int, length: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the documents that start in [lo, hi)."""
    system, inner = opened(path)
    with system.open_input_file(inner) as file:
        w = Bytes(file, length, BACK + hi - lo)
        at = first_start(w, lo)
        while at is not None and at < min(hi, length):
            raw = document_at(w, at)
            if raw is None:
                raise ValueError(f"{path}: no whole document at byte {at}")
            yield at, raw
            at += len(raw)


@dataclass
class Range(InputPartition):
    """The ranges [lo, lo + split), and so on up to ``hi``, of a file."""

    path: str
    lo: int
    hi: int
    length: int
    split: int


class DumpReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT))

    def run(self, size: int) -> int:
        """Bytes of a task where all files have ``size`` bytes: one range of a small dump, a run of ranges of a large one."""
        return self.split * max(1, min(-(-RUN // self.split), size // (self.split * TASKS)))

    def partitions(self) -> list[Range]:
        """Ranges of all ``*.bson`` files of the path, in folders below it too."""
        from pyarrow import fs

        system, inner = opened(self.path)
        info = system.get_file_info(inner)
        files = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
        prefix = self.path[: self.path.index(inner)] if inner in self.path else ""
        found = sorted((f for f in files if f.type == fs.FileType.File and f.path.endswith(".bson") and not f.base_name.startswith("_")), key=lambda f: f.path)
        out, step = [], self.run(sum(f.size for f in found))
        for f in found:
            out += [Range(prefix + f.path, lo, min(lo + step, f.size), f.size, self.split) for lo in range(0, f.size, step)]
        return out or [Range("", 0, 0, 0, 1)]

    def read(self, partition: Range):
        import pyarrow as pa

        p, write = partition, json.JSONEncoder(ensure_ascii=False).encode

        def batch(rows):
            at, size, text = zip(*rows)
            columns = [pa.array([p.path] * len(rows), pa.string()), *[pa.array(c, pa.int64()) for c in ([p.length] * len(rows), at, size)], pa.array(text, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["path", "length", "at", "size", "json"])

        rows, held = [], 0
        for lo in range(p.lo, p.hi, p.split) if p.path else ():
            for at, raw in read_range(p.path, lo, min(lo + p.split, p.hi), p.length):
                rows.append((at, len(raw), write(bson.typed(raw))))
                held += len(raw)
                if len(rows) >= BATCH or held >= BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)


@dataclass
class Written(WriterCommitMessage):
    name: str


class DumpWriter(DataSourceArrowWriter):
    """Each task writes one file under a name of its own; names without ``_`` appear when all tasks have ended well."""

    def __init__(self, options, overwrite: bool, column: int) -> None:
        self.path, self.overwrite, self.column, self.run = options["path"], overwrite, column, uuid.uuid4().hex[:12]

    def write(self, batches) -> Written:
        system, inner = opened(self.path)
        system.create_dir(inner, recursive=True)
        name = f"{self.run}-{uuid.uuid4().hex}.bson"
        with system.open_output_stream(f"{inner}/_{name}") as out:
            for batch in batches:
                for text in batch.column(self.column).to_pylist():
                    if text is not None:
                        out.write(bson.encode(json.loads(text)))
        return Written(name)

    def commit(self, messages) -> None:
        from pyarrow import fs

        system, inner = opened(self.path)
        new = {m.name for m in messages if m is not None}
        old = [f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.path.endswith(".bson") and not f.base_name.startswith("_")] if self.overwrite else []
        for name in sorted(new):
            system.move(f"{inner}/_{name}", f"{inner}/{name}")
        for path in old:
            system.delete_file(path)

    def abort(self, messages) -> None:
        from pyarrow import fs

        system, inner = opened(self.path)
        for f in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            if f.base_name.startswith(f"_{self.run}"):
                system.delete_file(f.path)


class DumpSource(DataSource):
    """``spark.read.format("dump")``: (path, length, at, size, json); ``df.write.format("dump")`` takes a column ``json``. Both use extended JSON."""

    @classmethod
    def name(cls) -> str:
        return "dump"

    def schema(self) -> str:
        return "path string, length long, at long, size long, json string"

    def reader(self, schema) -> DumpReader:
        return DumpReader(self.options)

    def writer(self, schema, overwrite: bool) -> DumpWriter:
        return DumpWriter(self.options, overwrite, schema.fieldNames().index("json"))


def read_dump(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """All documents of the dump files of a path: (path, length of the file, at, size, json)."""
    spark.dataSource.register(DumpSource)
    return spark.read.format("dump").option("splitBytes", split).load(path)


def write_dump(df: DataFrame, path: str, mode: str = "append") -> None:
    """The extended JSON documents of column ``json``, one file a task; null rows are left out."""
    df.sparkSession.dataSource.register(DumpSource)
    df.select("json").write.format("dump").mode(mode).save(path)


def export_lines(docs: DataFrame, column: str = "json") -> DataFrame:
    """``docs`` with extended JSON turned into the lines of an export, in column ``line``; a null stays null."""

    @F.pandas_udf("string")
    def line(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else json.dumps(bson.exported(json.loads(t)), ensure_ascii=False, separators=(", ", ": ")))

    return docs.withColumn("line", line(column))


def gaps(dump: DataFrame) -> DataFrame:
    """(path, at) of places where the documents of a file leave a gap or overlap, or where it ends early; empty if all is well.

    Rows are (path, at, size); a file's rows meet in one partition of numbers, sorted with spilling.
    """
    w = Window.partitionBy("path").orderBy("at")
    x = dump.select("path", "length", "at", "size", F.lag(F.col("at") + F.col("size"), 1, 0).over(w).alias("due"), F.lead("at").over(w).alias("next"))
    end = F.col("at") + F.col("size")
    return x.where((F.col("at") != F.col("due")) | (F.col("next").isNull() & (end != F.col("length")))).select("path", "at")
