"""Streams over files: tailing the change log, windowed statistics and merging into a state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.work import fresh_path, remove, versions


def tail(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    """Rows of a growing set of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def latest(log: DataFrame) -> tuple:
    """(ts, seq) of the newest entry of a log that is no mark of idle time: where a stream that starts now begins. Nulls for an empty log."""
    return tuple(log.where("op <> 'n'").agg(F.max(F.struct("ts", "seq")).alias("x")).select("x.ts", "x.seq").first())


def since(log: DataFrame, ts, seq: int | None = None) -> DataFrame:
    """The entries of a log or stream after a time, or after an entry (ts, seq); the time is a plain comparison, which reaches the scan."""
    if seq is None:
        return log.where(F.col("ts") > F.lit(ts))
    return log.where((F.col("ts") >= F.lit(ts)) & ((F.col("ts") > F.lit(ts)) | (F.col("seq") > seq)))


ROUND = "shard string, ns string, round_start timestamp, n long, bytes long"


def rounds(log: DataFrame, minutes: int, late: str = "10 minutes") -> DataFrame:
    """(shard, ns, round_start, n, bytes) of the rounds of a stream: counters by shard and namespace that are written and set to zero at each round's end.

    The counters are state by key; a timer in event time fires once the watermark has passed the end of the oldest round that is open,
    so a key that falls silent is written too. Entries that come after their round was written are dropped. Each task
    sums its entries by key and round first, so a hot key sends one row a task and batch.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    width = minutes * 60

    def partial(frames):
        for pdf in frames:
            g = pdf.groupby(["shard", "ns", "round"], as_index=False, dropna=False).agg(n=("size", "size"), bytes=("size", "sum"), at=("at", "max"))
            yield g[["shard", "ns", "round", "n", "bytes", "at"]]

    def step(key, frames, state):
        held: dict[int, list[int]] = {}
        if state.exists:
            for r, n, b in zip(*state.get, strict=True):
                held[r] = [n, b]
        mark = state.getCurrentWatermarkMs()
        for pdf in frames:
            for r, n, b in zip(pdf["round"], pdf["n"], pdf["bytes"], strict=True):
                if (r + width) * 1000 >= mark:
                    x = held.setdefault(int(r), [0, 0])
                    x[0] += int(n)
                    x[1] += int(b)
        over = sorted(r for r in held if (r + width) * 1000 < mark)
        done = [(*key, pd.Timestamp(r, unit="s"), *held.pop(r)) for r in over]
        if held:
            state.update(([*held], [x[0] for x in held.values()], [x[1] for x in held.values()]))
            state.setTimeoutTimestamp(max((min(held) + width) * 1000, mark + 1))
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame(done, columns=["shard", "ns", "round_start", "n", "bytes"])

    x = log.select("shard", "ns", F.col("ts").cast("timestamp").alias("at"), F.col("size").cast("long").alias("size"), F.expr(f"unix_seconds(cast(ts as timestamp)) div {width} * {width}").alias("round")).where("at is not null")
    x = x.mapInPandas(partial, "shard string, ns string, round long, n long, bytes long, at timestamp").withWatermark("at", late)
    return x.groupBy("shard", "ns").applyInPandasWithState(step, ROUND, "rounds array<long>, n array<long>, bytes array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def windowed_stats(log: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Counts and sizes by five-minute bucket, namespace and operation.

    Seconds dropped and rounded up to five minutes is a tumbling window that is offset by one minute,
    labelled by its last minute. Watermarks need a time with zone.
    """
    x = log.withColumn("_at", F.col("ts").cast("timestamp")).withWatermark("_at", late)
    g = x.groupBy(F.window("_at", "5 minutes", "5 minutes", "1 minute"), "shard", "ns", "op").agg(F.count(F.lit(1)).alias("count"), F.min("size").alias("min_size"), F.max("size").alias("max_size"), F.sum("size").alias("total_size"))
    return g.select((F.col("window.end") - F.expr("interval 1 minute")).cast("timestamp_ntz").alias("bucket"), "shard", "ns", "op", "count", "min_size", "max_size", "total_size")


def run_once(stream: DataFrame, mode: str = "append", tag: str = "stream", at: str | None = None) -> DataFrame:
    """Process all that is there now and return what has been written.

    ``at`` names the folder of results and offsets; the next run with the same one resumes after what this one has
    read. In append mode a window is written once its watermark has passed, and rows that come later are dropped; in
    complete mode the whole result is written anew.
    """
    spark = stream.sparkSession
    at = at or fresh_path(spark, tag)
    out, offsets = f"{at}/rows", f"{at}/offsets"
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).outputMode("append").trigger(availableNow=True).start()
    else:
        q = stream.writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(out)).option("checkpointLocation", offsets).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


#: Batches after which the deltas of a state are merged into one.
COMPACT_EVERY = 8


def last_of(rows: DataFrame) -> DataFrame:
    """The last operation per id; deletions stay as marks."""
    return rows.groupBy("id").agg(F.max_by(F.struct("op", "value", "ts", "seq"), F.struct("ts", "seq")).alias("x")).select("id", "x.*")


def state_rows(spark: SparkSession, at: str, upto: int | None = None) -> DataFrame | None:
    """The parts of a state: its newest merged table (before batch ``upto``, which may be writing one) and the deltas after it."""
    base = [n for n in versions(spark, at, "base") if upto is None or n < upto][-1:]
    deltas = [n for n in versions(spark, at, "delta") if (upto is None or n <= upto) and (not base or n > base[0])]
    paths = [f"{at}/base-{n}" for n in base] + [f"{at}/delta-{n}" for n in deltas]
    return spark.read.parquet(*paths) if paths else None


def compact(spark: SparkSession, at: str, n: int, merge) -> None:
    """After every ``COMPACT_EVERY``th batch: the rows of a state merged into one table, older parts deleted."""
    if (n + 1) % COMPACT_EVERY:
        return
    merge(state_rows(spark, at, n)).write.mode("overwrite").parquet(f"{at}/base-{n}")
    for kind in ("delta", "base"):
        for old in versions(spark, at, kind):
            if old < n - COMPACT_EVERY:  # the newest merged table covers them, and no batch that may run again reads them
                remove(spark, f"{at}/{kind}-{old}")


def fold_batches(log: DataFrame, delta, merge, tag: str = "state", at: str | None = None) -> tuple[DataFrame | None, str]:
    """The state of a log over all batches so far, and its folder: ``delta`` makes the rows of one batch, ``merge`` reduces rows of several.

    The state lives beside its offsets in the folder ``at``, so a restarted stream goes on with both. A batch writes only
    its own rows; every ``COMPACT_EVERY`` batches they are merged with the rest, so that no batch
    rewrites the state. A batch that is run again overwrites what it wrote before.
    """
    spark = log.sparkSession
    at = at or fresh_path(spark, tag)

    def step(batch: DataFrame, n: int) -> None:
        delta(batch).write.mode("overwrite").parquet(f"{at}/delta-{n}")
        compact(spark, at, n, merge)

    q = log.writeStream.foreachBatch(step).option("checkpointLocation", f"{at}/offsets").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = state_rows(spark, at)
    return (None if rows is None else merge(rows)), at


def merge_batches(log: DataFrame, tag: str = "state", at: str | None = None) -> DataFrame:
    """The last operation per id over all batches so far."""
    delta = lambda batch: last_of(batch.where(F.col("op").isin("i", "u", "d")).select("id", "op", "value", "ts", "seq"))
    rows, _ = fold_batches(log, delta, last_of, tag, at)
    if rows is None:
        return log.sparkSession.createDataFrame([], "id long, last_op string, value double")
    return rows.where("op <> 'd'").select("id", F.col("op").alias("last_op"), "value")


def merge_updates(log: DataFrame, tag: str = "documents", at: str | None = None) -> DataFrame:
    """(id, doc) after all operations (id, ts, seq, op, doc) of a stream so far, in whatever order they came."""
    from tidemark.operators import updates

    rows, _ = fold_batches(log, updates.state_of, updates.reduced, tag, at)
    return updates.documents(rows if rows is not None else log.sparkSession.createDataFrame([], updates.STATE))


def counter_deltas(snapshots: DataFrame, at: str | None = None) -> DataFrame:
    """(entity, ts, seq, delta) of a stream of counters (entity, ts, seq, counter): what each reading adds to the one before, 0 for an entity's first.

    The last reading of each entity is the state, a delta of batches like any other here; a batch is compared
    within itself by a window and with the state by one join on entities. Readings are taken in the order of batches: one that
    comes after newer ones is compared with those.
    """
    from pyspark.sql import Window

    spark = snapshots.sparkSession
    at = at or fresh_path(spark, "deltas")
    last = lambda rows: rows.groupBy("entity").agg(F.max_by(F.struct("ts", "seq", "counter"), F.struct("ts", "seq")).alias("x")).select("entity", "x.*")

    def step(batch: DataFrame, n: int) -> None:
        rows = batch.select("entity", "ts", "seq", "counter")
        before = state_rows(spark, at, n - 1)
        w = Window.partitionBy("entity").orderBy("ts", "seq")
        x = rows.withColumn("_prev", F.lag("counter").over(w))
        if before is not None:
            x = x.join(last(before).select(F.col("entity").alias("_e"), F.col("counter").alias("_held")), F.col("entity").eqNullSafe(F.col("_e")), "left")
            x = x.withColumn("_prev", F.coalesce("_prev", "_held"))
        x.select("entity", "ts", "seq", F.coalesce(F.col("counter") - F.col("_prev"), F.lit(0)).cast("long").alias("delta")).write.mode("overwrite").parquet(f"{at}/out/batch={n}")
        last(rows).write.mode("overwrite").parquet(f"{at}/delta-{n}")
        compact(spark, at, n, last)

    q = snapshots.writeStream.foreachBatch(step).option("checkpointLocation", f"{at}/offsets").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("entity long, ts timestamp_ntz, seq long, delta long").option("recursiveFileLookup", "true").parquet(f"{at}/out") if versions(spark, f"{at}", "delta") else spark.createDataFrame([], "entity long, ts timestamp_ntz, seq long, delta long")


def catalog_changes(spark: SparkSession, folder: str, catalog: DataFrame, poll: str) -> DataFrame:
    """(entry..., change) of a poll of a catalog: ``new`` and ``dropped`` against the poll before, which a table with versions in ``folder`` keeps.

    ``poll`` names the poll: run again after a failure it compares with the same one before. The first poll finds nothing.
    """
    from tidemark.sources import versioned

    now = catalog.distinct()
    found = versioned.manifest(spark, folder)
    own = poll in found["batches"]
    version = found["version"] if not own else next(n for n in range(found["version"], 0, -1) if poll not in versioned.manifest(spark, folder, n - 1)["batches"]) - 1
    before = versioned.read(spark, folder, version)
    if not own:
        versioned.update(spark, folder, lambda _: now, poll)
    if before is None:
        return now.limit(0).withColumn("change", F.lit("new"))
    return now.exceptAll(before).withColumn("change", F.lit("new")).unionByName(before.exceptAll(now).withColumn("change", F.lit("dropped")))


def round_counts(stream: DataFrame, at: str, *by: str) -> DataFrame:
    """Counts by round: each call is one, starts its counters at zero, reads what has come since the last and adds its rows to those before."""
    spark = stream.sparkSession
    number = len(versions(spark, at, "round"))
    out = f"{at}/round-{number}"

    def add(batch: DataFrame, n: int) -> None:
        batch.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/batch-{n}")

    spark.createDataFrame([], stream.select(*by).schema.add("n", "long")).write.parquet(f"{out}/batch-none")
    q = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{at}/offsets").trigger(availableNow=True).start()
    q.awaitTermination()
    rounds = [spark.read.option("recursiveFileLookup", True).parquet(f"{at}/round-{i}").withColumn("round", F.lit(i)) for i in range(number + 1)]
    rows = rounds[0]
    for r in rounds[1:]:
        rows = rows.unionByName(r)
    return rows.groupBy("round", *by).agg(F.sum("n").alias("n"))
