import os

from tidemark.llm import _io


def test_work_tables_are_read_back_and_discarded(spark):
    df = _io.materialize(spark.range(5), "test")
    path = _io.WRITTEN[-1]
    assert df.count() == 5 and df.columns == ["id"]
    _io.discard(spark)
    assert not _io.WRITTEN and not os.path.exists(path.removeprefix("file:"))
