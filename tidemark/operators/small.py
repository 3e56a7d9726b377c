"""Broadcasts of checked size, and tasks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a reference table is broadcast; beyond it the planner chooses the join.
MOST_ROWS = 100_000
#: Rows that a task gets of a table that is dealt out by key.
TASK_ROWS = 250_000


def small(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``df`` marked to be broadcast if it has no more than ``most`` rows; counting stops there."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` to as many partitions as its number of ``rows`` needs, so that a task sorts or hashes no more rows
    in a larger table; a table too small to fill every core is left to the planner. Joins, groups and windows by the same keys keep the partitions."""
    n = -(-rows // TASK_ROWS)
    return df.repartition(n, *keys) if n > df.sparkSession.sparkContext.defaultParallelism else df
