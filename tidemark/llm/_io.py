"""Work tables in the shared folder, and Arrow mapping that runs on any executor."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch; texts may be long, so fewer than Spark's default.
BATCH_ROWS = 512
#: Paths of work tables of this driver, see ``discard``.
WRITTEN: list[str] = []

# Functions travel by value: an executor needs only the public libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where it is unset and the session is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def materialize(df: DataFrame, tag: str, few: bool = False, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors.

    ``few``: a narrow table; its rows are dealt to one task a core to be written, so that the many empty or tiny
    partitions of a shuffle do not each become a file. ``codec``: how files are compressed, the session's way by default.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    out = df.repartition(spark.sparkContext.defaultParallelism) if few else df
    out.write.parquet(path, compression=codec)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def own_exchange(column: str) -> Column:
    """The long column under its name, as an expression that hides how an aggregate has dealt it out.

    A join on it then gets an exchange of its own on this side, without which Spark cannot split a hot key on the other.
    """
    return F.col(column).bitwiseXOR(F.lit(0)).alias(column)


def own_text_exchange(column: str) -> Column:
    """The same for a text column."""
    return F.concat(column, F.lit("")).alias(column)


def discard(spark: SparkSession, since: int = 0, keep: str | None = None) -> None:
    """Delete the work tables written after the first ``since``, but for that at the path ``keep``; call it once the
    results that read them are stored."""
    for name in WRITTEN[since:]:
        if name != keep:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    WRITTEN[since:] = [x for x in WRITTEN[since:] if x == keep]


def map_arrow(df: DataFrame, fn, schema: str, size: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` whose function gets batches of at most ``size`` rows; Spark also bounds a batch's bytes, so long texts
    stay within a worker's memory. No setting of the session is touched."""

    def sliced(batches):
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), size):
                yield batch.slice(at, size)

    return df.mapInArrow(lambda batches: fn(sliced(batches)), schema)
