"""Readers: tables of a folder, text manifests, dumps of records and tolerant JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; columns are pruned and filters pushed by what the plan uses."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_range(key: str, lo=None, hi=None) -> Column:
    """The half-open range [lo, hi); None is unbounded. Plain comparisons, so they reach the scan."""
    out = F.lit(True)
    if lo is not None:
        out = out & (F.col(key) >= lo)
    if hi is not None:
        out = out & (F.col(key) < hi)
    return out


def manifest(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines of the form ``ns,type{...}`` as ns, kind and spec; lines of another form are dropped."""
    form = r"^(.*?),(.*?)(\{.*\})$"
    part = lambda i: F.regexp_extract(value, form, i)
    return lines.where(F.col(value).rlike(form)).select(part(1).alias("ns"), part(2).alias("kind"), part(3).alias("spec"))


def split_corrupt(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON lines parsed by ``schema``; ``corrupt`` keeps a line that does not parse, null for the others."""
    parsed = F.from_json(value, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.withColumn("_p", parsed).select(*[c for c in lines.columns if c != value], "_p.*").withColumnRenamed("_bad", "corrupt")


def read_bson(spark: SparkSession, path: str) -> DataFrame:
    """Documents of ``*.bson`` dump files as (path, n, json). The format is a sequence of length-prefixed documents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bson").option("recursiveFileLookup", "true").load(path)

    def decode(batches):
        import json

        import pandas as pd

        from tidemark.sources.bson import documents

        for pdf in batches:
            rows = [(p, i, json.dumps(doc, ensure_ascii=False)) for p, raw in zip(pdf["path"], pdf["content"], strict=True) for i, doc in enumerate(documents(raw))]
            yield pd.DataFrame(rows, columns=["path", "n", "json"])

    return files.select("path", "content").mapInPandas(decode, "path string, n long, json string")
