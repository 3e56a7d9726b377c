"""A table with versions in a shared folder: readers see whole versions, writers replace them at once or not at all.

A version is a manifest, a small JSON file ``version-<n>`` that names the folder of its rows. Rows are written first, under a
name of their own; then the manifest is renamed into place, which fails if that version is there already. A run that ends in
between leaves the old version and rows that nobody reads. A batch that has a name is applied once, however often it is run,
as each version lists the names of the batches in it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.work import remove, versions

#: Names of batches that a version keeps, and tries of a write that others get ahead of.
KEPT_BATCHES, TRIES = 1000, 20


class Conflict(Exception):
    """Another writer has published this version."""


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict:
    """The manifest of a version, the newest by default; that of an empty table is version 0 without rows."""
    n = version if version is not None else max(versions(spark, folder, "version"), default=0)
    if n == 0:
        return {"version": 0, "rows": None, "batches": []}
    path = _path(spark, f"{folder}/version-{n}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame | None:
    """The rows of a version; None if there is none yet."""
    found = manifest(spark, folder, version)
    return None if found["rows"] is None else spark.read.parquet(f"{folder}/{found['rows']}")


def publish(spark: SparkSession, folder: str, number: int, rows: str, batches: list[str]) -> None:
    """Make ``rows`` version ``number``; raises ``Conflict`` if it is there."""
    text = json.dumps({"version": number, "rows": rows, "batches": batches[-KEPT_BATCHES:]})
    draft, final = _path(spark, f"{folder}/draft-{uuid.uuid4().hex}"), _path(spark, f"{folder}/version-{number}")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    names = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        names.rename(fs.makeQualified(draft), fs.makeQualified(final), options)  # not over one that is there
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e) or "exists" in str(e):
            raise Conflict(f"version {number}") from e
        raise


def update(spark: SparkSession, folder: str, change: Callable[[DataFrame | None], DataFrame], batch: str | None = None) -> int:
    """The version that holds ``change`` of the rows before it; where another writer was first, the change is made anew on that one's rows."""
    for _ in range(TRIES):
        now = manifest(spark, folder)
        if batch is not None and batch in now["batches"]:
            return now["version"]
        rows = f"rows-{uuid.uuid4().hex}"
        change(read(spark, folder, now["version"])).write.parquet(f"{folder}/{rows}")
        try:
            publish(spark, folder, now["version"] + 1, rows, now["batches"] + ([batch] if batch is not None else []))
            return now["version"] + 1
        except Conflict:
            remove(spark, f"{folder}/{rows}")
    raise Conflict(f"{TRIES} tries at {folder}")


def upserted(old: DataFrame | None, new: DataFrame, key: list[str], history: str = "history", keep: str = "retry_num > 1") -> DataFrame:
    """New rows over old ones by ``key``, null keys too; where ``keep`` holds of the new row, the old row's other columns are added to its history."""
    values = [c for c in new.columns if c not in key]
    past = f"array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in new.schema if f.name in values)}>>"
    none = F.array().cast(past)
    if old is None:
        return new.withColumn(history, none)
    o = old.select(*[F.col(c).alias(f"_{c}") for c in key], F.struct(*values).alias("_old"), F.col(history).alias("_past"))
    n = new.select(*key, F.struct(*values).alias("_new"), F.expr(keep).alias("_keep"))
    on = F.lit(True)
    for c in key:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    x = n.join(o, on, "full_outer")
    replaced = F.col("_new").isNotNull()
    earlier = F.coalesce("_past", none)
    grown = F.when(replaced & F.col("_keep") & F.col("_old").isNotNull(), F.concat(earlier, F.array("_old").cast(past))).otherwise(earlier)
    value = lambda c: F.when(replaced, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
    return x.select(*[F.when(replaced, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in key], *map(value, values), grown.alias(history))


def upsert(spark: SparkSession, folder: str, new: DataFrame, key: list[str], batch: str | None = None, keep: str = "retry_num > 1") -> int:
    """Put rows into a table of states; ``batch`` names the write, so that it counts once."""
    return update(spark, folder, lambda old: upserted(old, new, key, keep=keep), batch)


def cleaned(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Delete all but the newest versions, and rows that no version names; not while a writer is at work."""
    found = versions(spark, folder, "version")
    live = {manifest(spark, folder, n)["rows"] for n in found[-keep:]}
    for n in found[:-keep]:
        remove(spark, f"{folder}/version-{n}")
    path = _path(spark, folder)
    for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
        name = x.getPath().getName()
        if name.startswith("draft-") or name.startswith("rows-") and name not in live:
            remove(spark, f"{folder}/{name}")
