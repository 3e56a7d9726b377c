"""A corpus pipeline: quality rules, near duplicates, secrets, mixing and packing, in this order.

Between stages the documents are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm._io import WRITTEN, discard, materialize, table

STAGES = [
    ("quality rules", stages.quality_rules),
    ("near duplicates", stages.near_duplicates),
    ("secret scan", stages.secret_scan),
    ("mixing", stages.mix),
    ("packing", stages.pack),
]

#: The learned rules and the tokenizer are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    since = len(WRITTEN)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, "stage")
            discard(spark, since, keep=WRITTEN[-1])  # work tables of this stage and the documents before it
    return docs
