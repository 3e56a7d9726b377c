"""What documents hold: each path with its types, however deep."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Types of values that extended JSON marks by a name.
MARKED = {
    "$oid": "objectId", "$date": "date", "$numberInt": "int", "$numberLong": "long", "$numberDouble": "double", "$numberDecimal": "decimal", "$binary": "binary", "$uuid": "binary", "$timestamp": "timestamp",
    "$regularExpression": "regex", "$code": "code", "$symbol": "symbol", "$undefined": "undefined", "$minKey": "minKey", "$maxKey": "maxKey",
}


def type_of(v) -> str:
    if isinstance(v, dict):
        return MARKED.get(next(iter(v), ""), "object")
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int" if -(1 << 31) <= v < 1 << 31 else "long"
    return {str: "string", float: "double", list: "array", type(None): "null"}[type(v)]


def walk(doc: dict):
    """(path, type) of every value below a document; ``[]`` stands for the elements of an array. A stack, so no depth is too deep."""
    todo = [(k, v) for k, v in reversed(doc.items())]
    while todo:
        path, v = todo.pop()
        kind = type_of(v)
        yield path, kind
        if kind == "object":
            todo += [(f"{path}.{k}", x) for k, x in reversed(v.items())]
        elif kind == "array":
            todo += [(f"{path}[]", x) for x in reversed(v)]


def schema_profile(docs: DataFrame, doc: str, position: str, limit: int | None = None) -> DataFrame:
    """(path, types, values, docs, last_type): how often each path has each type, in how many documents it stands, and the type that the last one by ``position`` gives it.

    ``doc`` is extended JSON of an object; a null is no document. ``limit`` bounds the documents that are looked at. Each batch is
    summed by path and type before a row leaves its task, so what is shuffled grows with the number of paths only; documents
    whose names are data make as many paths.
    """

    def count(frames):
        for pdf in frames:
            seen: dict[tuple[str, str], list] = {}
            for text, at in zip(pdf["doc"], pdf["at"], strict=True):
                if text is None:
                    continue
                own: set[str] = set()
                for n, (path, kind) in enumerate(walk(json.loads(text))):
                    row = seen.setdefault((path, kind), [0, 0, at, n])
                    row[0] += 1
                    row[1] += path not in own  # a document counts once a path, with the type that it has first
                    own.add(path)
                    row[2], row[3] = max((row[2], row[3]), (at, n))
            yield pd.DataFrame([(p, k, *v) for (p, k), v in seen.items()], columns=["path", "kind", "n", "docs", "at", "place"])

    rows = docs.select(F.col(doc).alias("doc"), F.col(position).cast("long").alias("at"))
    rows = rows.limit(limit) if limit is not None else rows
    each = rows.mapInPandas(count, "path string, kind string, n long, docs long, at long, place long")
    each = each.groupBy("path", "kind").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.max(F.struct("at", "place")).alias("last"))
    out = each.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct(F.col("kind").alias("type"), F.col("n").alias("values")))).alias("types"), F.sum("n").alias("values"), F.sum("docs").alias("docs"), F.max_by("kind", "last").alias("last_type")
    )
    return out
