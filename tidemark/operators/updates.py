"""Documents after a log of inserts, updates of any field and deletions, as an aggregate that batches can be merged into.

Each operation writes at paths: a whole document at the root, ``$set`` and ``$unset`` at a field or a path with dots.
A write at a path ends what stood there and below, and puts leaves there. So a document is the set of leaves
that no later write at the leaf's own path or above has ended, and all that has to be kept is, for each document and path, the last
write and the last leaf: maxima, which combine before a shuffle, whatever the order in which operations come. A document that many
operations touch is no hot group, as its rows are reduced to one a path first.

A path through a value that is no document, which a server rejects, stands in that value's place while it is set. A document
within that has lost all its fields by unsetting them is not kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRITES = "id string, ts timestamp, seq long, path array<string>, ends string, leaf string"
STATE = "id string, path array<string>, ended struct<ts:timestamp,seq:long,what:string>, leaf struct<ts:timestamp,seq:long,value:string>"


def leaves(path: list[str], value) -> Iterator[tuple[list[str], str]]:
    """Leaves of a value: arrays and empty documents are leaves as they are, and so is a typed value of extended JSON."""
    if isinstance(value, dict) and value and not next(iter(value)).startswith("$"):
        for k, v in value.items():
            yield from leaves([*path, k], v)
    else:
        yield path, json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def writes_of(op: str, doc: str | None) -> Iterator[tuple[list[str], str | None, str | None]]:
    """(path, how it ends what was there, leaf): ``whole``, ``gone`` or ``field`` for a write's own path, None for the leaves under it."""
    if op == "d":
        yield [], "gone", None
        return
    body = json.loads(doc or "{}")
    if op == "u":
        body.pop("$v", None)
    if op == "u" and body and next(iter(body)).startswith("$"):
        for how, fields in body.items():
            if how not in ("$set", "$unset"):
                raise ValueError(f"a log holds no {how}, as its operations can be repeated")
            for name, value in fields.items():
                path = name.split(".")
                yield path, "field", None
                if how == "$set":
                    yield from ((p, None, v) for p, v in leaves(path, value))
        return
    yield [], "whole", None
    for k, v in body.items():
        yield from ((p, None, v) for p, v in leaves([k], v))


def writes(log: DataFrame) -> DataFrame:
    """The writes of a log (id, ts, seq, op, doc): ``doc`` is a document, an update with ``$set`` and ``$unset``, or one that replaces; other operations write nothing."""

    def parse(frames):
        for pdf in frames:
            rows = [(i, ts, seq, path, ends, leaf) for i, ts, seq, op, doc in pdf.itertuples(index=False) for path, ends, leaf in writes_of(op, doc)]
            yield pd.DataFrame(rows, columns=["id", "ts", "seq", "path", "ends", "leaf"])

    x = log.where(F.col("op").isin("i", "u", "d"))
    return x.select(F.col("id").cast("string"), F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("long"), "op", "doc").mapInPandas(parse, WRITES)


def reduced(rows: DataFrame) -> DataFrame:
    """The last write and the last leaf of each document and path, from writes or from states of batches."""
    return rows.groupBy("id", "path").agg(F.max("ended").alias("ended"), F.max("leaf").alias("leaf"))


def state_of(log: DataFrame) -> DataFrame:
    w = writes(log)
    at = ("ts", "seq")
    ended = F.when(F.col("ends").isNotNull(), F.struct(*at, F.col("ends").alias("what")))
    leaf = F.when(F.col("leaf").isNotNull(), F.struct(*at, F.col("leaf").alias("value")))
    return reduced(w.select("id", "path", ended.alias("ended"), leaf.alias("leaf")))


def put(doc: dict, path: list[str], value) -> None:
    """Puts a value at a path; a number steps into a list, and what is no document or list on the way becomes a document."""
    at = doc
    for i, name in enumerate(path):
        last = i == len(path) - 1
        if isinstance(at, list):
            k = int(name)
            at.extend([None] * (k + 1 - len(at)))
        else:
            k = name
        if last:
            at[k] = value
            return
        under = at[k] if isinstance(at, list) else at.get(k)
        if not (isinstance(under, dict) or isinstance(under, list) and path[i + 1].isdigit()):
            under = at[k] = {}
        at = under


def document(rows) -> str | None:
    """A document from the state of its paths, names sorted; None if it is not there."""
    ended = {tuple(r["path"]): (r["ended"]["ts"], r["ended"]["seq"], r["ended"]["what"]) for r in rows if r["ended"] is not None}
    root = ended.get(())
    if root is None or root[2] != "whole":
        return None
    alive = []
    for r in rows:
        if r["leaf"] is None:
            continue
        path, at = tuple(r["path"]), (r["leaf"]["ts"], r["leaf"]["seq"])
        if at >= root[:2] and all(path[:i] not in ended or at >= ended[path[:i]][:2] for i in range(1, len(path) + 1)):
            alive.append((at, list(path), r["leaf"]["value"]))
    doc: dict = {}
    for _, path, value in sorted(alive, key=lambda x: x[0]):  # what was written later stands on what was there
        put(doc, path, json.loads(value))
    return json.dumps(doc, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def documents(state: DataFrame) -> DataFrame:
    """(id, doc) of the documents that are there. The paths of one document meet in a row, as the document itself would."""

    def build(batches):
        import pyarrow as pa

        for batch in batches:
            docs = [document(rows) for rows in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(docs, pa.string())], names=["id", "doc"])

    rows = state.groupBy("id").agg(F.collect_list(F.struct("path", "ended", "leaf")).alias("paths"))
    return rows.mapInArrow(build, "id string, doc string").where("doc is not null")


def applied(log: DataFrame) -> DataFrame:
    """(id, doc) after all operations of a log, by (ts, seq); an update of a document that is not there does nothing."""
    return documents(state_of(log))
