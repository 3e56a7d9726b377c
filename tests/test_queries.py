"""Every registered query against its SQL."""

import pytest

from tests.oracle import SF, assert_same
from tidemark.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    assert_same(spark, registry.QUERIES[name], registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert df.count() > 0 and df.columns


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["k", "status", "src_hash", "dst_hash"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_sizes_beyond_a_terabyte_are_as_in_sql(spark, tmp_path):
    from pathlib import Path

    from pyspark.sql import functions as F

    from tests.oracle import SF, assert_same
    from tidemark.functions.scalars import pretty_bytes
    from tidemark.plans import registry

    for table in Path(SF).iterdir():
        if table.name != "orders.parquet":
            (tmp_path / table.name).symlink_to(table)
    big = spark.read.parquet(f"{SF}/orders.parquet").limit(50).withColumns({"o_orderkey": F.col("o_orderkey") + 5_000_000, "o_custkey": F.col("o_custkey") + 900_000})
    big.write.parquet(str(tmp_path / "orders.parquet"))
    assert_same(spark, registry.QUERIES["scalar_numbers"], registry.ORACLES["scalar_numbers"], str(tmp_path))
    one = spark.range(1).select(pretty_bytes(F.lit(3 << 40)).alias("t"), pretty_bytes(F.lit(3 << 40), "G").alias("g"), pretty_bytes(F.lit(3 << 40), "K").alias("k")).first()
    assert tuple(one) == ("3.00T", "3072.00G", "3221225472.00K")
