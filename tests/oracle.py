"""Running a query in both engines and comparing the rows."""

import math
import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def duck(sf: str = SF):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return f"{v:.6f}" if isinstance(v, float) else str(v)


def assert_same(spark, query, sql, sf: str = SF):
    df = query(spark, sf)
    rel = duck(sf).sql(sql)
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    kinds, types = dict(df.dtypes), dict(zip(rel.columns, map(str, rel.types), strict=True))
    assert {n: KINDS.get(kinds[n], kinds[n]) for n in names} == {n: types[n] for n in names}
    mine = sorted(tuple(cell(r[n]) for n in names) for r in df.collect())
    at = [rel.columns.index(n) for n in names]
    theirs = sorted(tuple(cell(r[i]) for i in at) for r in rel.fetchall())
    assert mine == theirs
