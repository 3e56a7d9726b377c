"""The shared work folder that results of streams and file sinks are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; a temporary one only where that is unset in a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def versions(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers n of the entries ``prefix-n`` in a folder of any file system that Spark writes to, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    return sorted(int(n.removeprefix(f"{prefix}-")) for n in names if n.startswith(f"{prefix}-"))


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df, tag: str):
    """``df`` written once and read back, so that several uses see the same rows in the same places."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
