"""Streams over growing folders: late rows, restarts, rounds and merged states."""

import datetime as dt
import os
import time

from tidemark.streaming import streams

SCHEMA = "id long, op string, value double, ts timestamp_ntz, seq long, shard string, ns string, size long"


def at(text):
    return dt.datetime.fromisoformat(f"2024-05-01 {text}")


def write(spark, folder, *rows):
    """One more file of the stream; a file is a batch, in the order of writing."""
    n = len(os.listdir(folder)) if os.path.isdir(folder) else 0
    full = [(i, op, float(seq), ts, seq, "s0", "db.c", 10) for i, op, ts, seq in rows]
    path = f"{folder}/part-{n}"
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.parquet(path)
    time.sleep(1.1)  # files are told apart by the second they were written in


def tail(spark, folder):
    return streams.tail(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


def test_late_rows_are_dropped_in_append_mode(spark, tmp_path):
    """Windows come out once the watermark has passed them; a row behind it is left out, one within it counts."""
    src = f"{tmp_path}/src"
    write(spark, src, (1, "i", at("10:00:30"), 1), (2, "i", at("10:03:00"), 2), (3, "i", at("10:30:00"), 3))
    write(spark, src, (5, "i", at("10:27:00"), 5))
    write(spark, src, (4, "i", at("10:02:00"), 4))
    write(spark, src, (6, "i", at("11:30:00"), 6))
    out = streams.run_once(streams.windowed_stats(tail(spark, src), late="10 minutes"), at=f"{tmp_path}/out")
    got = {(r["bucket"].strftime("%H:%M"), r["op"]): r["count"] for r in out.collect()}
    # 10:00:30 is in the bucket of 10:00, whose window ends at 10:01; the row at 10:02 came when 10:20 was the watermark
    assert got == {("10:00", "i"): 1, ("10:05", "i"): 1, ("10:30", "i"): 2}


def test_streams_resume(spark, tmp_path):
    """A second run reads only what has come since, and both runs' rows are in the result."""
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    write(spark, src, (1, "i", at("10:00:00"), 1))
    first = streams.run_once(tail(spark, src).select("id", "seq"), at=out)
    assert [r["seq"] for r in first.collect()] == [1]
    write(spark, src, (2, "i", at("10:01:00"), 2))
    again = streams.run_once(tail(spark, src).select("id", "seq"), at=out)
    assert sorted(r["seq"] for r in again.collect()) == [1, 2]


def test_state_survives_restarts(spark, tmp_path, monkeypatch):
    """Deltas, merged tables and offsets of one folder over three runs; later operations win, deletions remove."""
    monkeypatch.setattr(streams, "COMPACT_EVERY", 2)
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    write(spark, src, (1, "i", at("10:00:00"), 1), (2, "i", at("10:00:00"), 2))
    write(spark, src, (1, "u", at("10:01:00"), 3))
    streams.merge_batches(tail(spark, src), at=out)
    write(spark, src, (2, "d", at("10:02:00"), 4), (3, "i", at("10:02:00"), 5))
    streams.merge_batches(tail(spark, src), at=out)
    write(spark, src, (3, "u", at("09:00:00"), 6), (4, "i", at("10:03:00"), 7))
    write(spark, src, (5, "i", at("10:03:00"), 8))
    got = {r["id"]: (r["last_op"], r["value"]) for r in streams.merge_batches(tail(spark, src), at=out).collect()}
    assert got == {1: ("u", 3.0), 3: ("i", 5.0), 4: ("i", 7.0), 5: ("i", 8.0)}
    assert any(x.startswith("base-") for x in os.listdir(out))


def test_rounds_start_at_zero(spark, tmp_path):
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    write(spark, src, (1, "i", at("10:00:00"), 1), (2, "u", at("10:00:00"), 2), (3, "u", at("10:00:00"), 3))
    streams.round_counts(tail(spark, src), out, "op")
    write(spark, src, (1, "u", at("10:05:00"), 4))
    got = {(r["round"], r["op"]): r["n"] for r in streams.round_counts(tail(spark, src), out, "op").collect()}
    assert got == {(0, "i"): 1, (0, "u"): 2, (1, "u"): 1}


def test_rounds_over_two_runs_with_late_rows_and_a_silent_key(spark, tmp_path):
    """Counters start at zero in each round and are written by timer; a key that falls silent is written; rows too late for their round are not counted twice."""
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    kind = "ts timestamp_ntz, seq long, shard string, ns string, op string, size long"
    src, out = str(tmp_path / "log"), str(tmp_path / "rounds")

    def write(*rows):
        spark.createDataFrame([(at(m), i, s, n, "i", b) for i, (m, s, n, b) in enumerate(rows)], kind).coalesce(1).write.mode("append").parquet(src)

    def run():
        s = spark.read.parquet(src).schema
        x = streams.run_once(streams.rounds(streams.tail(spark, src, s, files_per_trigger=1), 60, "10 minutes"), at=out)
        got = [(r["shard"], r["ns"], (r["round_start"] - t0) // dt.timedelta(minutes=60), r["n"], r["bytes"]) for r in x.collect()]
        assert len(got) == len(set(got))
        return sorted(got, key=str)

    write((5, "a", "x", 10), (59, "a", "x", 1), (30, "b", None, 5), (61, "a", "x", 2))
    assert run() == []
    write((75, "a", "x", 3), (58, "a", "x", 7))  # late, but its round is open: the watermark is at 51
    write((200, "a", "y", 1))
    first = run()
    assert first == [("a", "x", 0, 3, 18), ("a", "x", 1, 2, 5), ("b", None, 0, 1, 5)]
    write((20, "a", "x", 99), (205, "a", "y", 1), (199, "a", "y", 1))  # the first is too late: its round is written
    write((400, "c", "z", 1))
    assert run() == sorted([*first, ("a", "y", 3, 3, 3)], key=str)


def test_a_stream_starts_after_a_time_or_an_entry(spark, tmp_path):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(t, 1, "i"), (t, 2, "u"), (t + dt.timedelta(seconds=1), 1, "u"), (t + dt.timedelta(seconds=1), 2, "n")]
    spark.createDataFrame(rows, "ts timestamp_ntz, seq long, op string").write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert streams.latest(log) == (rows[2][0], 1) and streams.latest(log.where("false")) == (None, None)
    seen = lambda df: sorted((r["ts"], r["seq"]) for r in df.collect())
    assert seen(streams.since(log, t)) == [r[:2] for r in rows[2:]]
    assert seen(streams.since(log, t, 1)) == [r[:2] for r in rows[1:]]
    stream = streams.since(streams.tail(spark, str(tmp_path / "log"), log.schema), *streams.latest(log))
    assert seen(streams.run_once(stream)) == [rows[3][:2]]
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in streams.since(log, t)._jdf.queryExecution().executedPlan().toString()


def test_deltas_of_counters_over_batches_and_runs(spark, tmp_path):
    """More batches than are compacted at once, in two runs, entities that come and go, a counter that starts anew."""
    import random

    rng = random.Random(3)
    readings, value = [], {}
    for seq in range(120):
        e = rng.choice([1, 2, 3, None])
        value[e] = 0 if rng.random() < 0.05 else value.get(e, 100) + rng.randrange(9)
        readings.append((e, dt.datetime(2024, 5, 1) + dt.timedelta(seconds=seq // 2), seq, value[e]))
    folder, out = str(tmp_path / "log"), str(tmp_path / "state")
    kind = "entity long, ts timestamp_ntz, seq long, counter long"
    for i in range(12):
        spark.createDataFrame(readings[i * 10 : i * 10 + 10], kind).coalesce(1).write.parquet(f"{folder}/part-{i:02d}")
        time.sleep(1.05)
        if i in (8, 11):
            got = streams.counter_deltas(streams.tail(spark, f"{folder}/*", spark.createDataFrame([], kind).schema, files_per_trigger=1), out)
    last, want = {}, []
    for e, ts, seq, c in readings:
        want.append((e, ts, seq, c - last.get(e, c)))
        last[e] = c
    assert sorted((tuple(r[c] for c in ("entity", "ts", "seq", "delta")) for r in got.collect()), key=lambda r: r[2]) == want


def test_polls_of_a_catalog(spark, tmp_path):
    folder = str(tmp_path / "catalog")
    poll = lambda name, *ns: sorted((r["ns"], r["change"]) for r in streams.catalog_changes(spark, folder, spark.createDataFrame([(n,) for n in ns], "ns string"), name).collect())
    assert poll("one", "a", "b") == []
    assert poll("two", "b", "c", "c") == [("a", "dropped"), ("c", "new")]
    assert poll("two", "b", "c") == [("a", "dropped"), ("c", "new")]  # run again
    assert poll("three", "b", "c") == [] and poll("four") == [("b", "dropped"), ("c", "dropped")]
