"""Edge cases of the operators on small hand-built frames."""

import struct

from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.operators import balance, catalogs, diff, dupes, metrics, ranges
from tidemark.sources import bson
from tidemark.sources.tables import manifest, read_bson


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect())


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, h string")


def test_full_diff_all_states(spark):
    a = kv(spark, (1, "a"), (2, "b"), (3, None), (4, "d"))
    b = kv(spark, (1, "a"), (2, "x"), (3, None), (5, "e"))
    assert rows(diff.full_diff(a, b), "k", "status") == [(1, "match"), (2, "mismatch"), (3, "match"), (4, "source_only"), (5, "dest_only")]
    assert rows(diff.lookup_diff(a, b), "k", "status") == [(1, "match"), (2, "mismatch"), (3, "match"), (4, "missing")]


def test_true_matches_are_counted(spark):
    x = diff.full_diff(kv(spark, (1, "a")), kv(spark, (1, "a"), (2, "b")))
    assert diff.summary(x).first()["matches"] == 1


def test_null_is_told_apart_from_empty(spark):
    df = spark.createDataFrame([("", 1), (None, 1)], "a string, b int").select(s.row_hash("a", "b").alias("h"))
    assert len(set(rows(df, "h"))) == 2


def test_hash_tells_separators_and_nulls_apart(spark):
    """Values with separators, marks of null and lengths in them, in both hashes."""
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("\\N", "x"), ("-", "x"), ("1:a", "b"), ("a", "1:b"), ("", "1:a"), ("1:a", "")], "a string, b string")
    got = df.select(s.row_hash("a", "b").alias("h"), s.row_hash_unordered("a", "b").alias("u"))
    assert len({r["h"] for r in got.collect()}) == len({r["u"] for r in got.collect()}) == 9
    pair = spark.createDataFrame([(1, "a|b", "c"), (2, None, "x")], "k long, a string, b string"), spark.createDataFrame([(1, "a", "b|c"), (2, "\\N", "x")], "k long, a string, b string")
    left, right = (diff.hashed(x, "k", "a", "b") for x in pair)
    assert rows(diff.full_diff(left, right), "k", "status") == [(1, "mismatch"), (2, "mismatch")]


def test_null_keys_stay_on_their_side(spark):
    a, b = kv(spark, (None, "a"), (1, "a")), kv(spark, (1, "a"))
    key = lambda df: sorted((str(r["k"]), r["status"]) for r in df.collect())
    assert key(diff.full_diff(a, b)) == [("1", "match"), ("None", "source_only")]
    assert key(diff.full_diff(b, a)) == [("1", "match"), ("None", "dest_only")]
    assert key(diff.full_diff(a, a)) == [("1", "match"), ("None", "match")]
    assert key(diff.lookup_diff(a, b)) == [("1", "match"), ("None", "missing")]


def test_passed_keys_leave_the_list_of_failed_ones(spark):
    r = spark.createDataFrame([("a", [1, 2, 3]), ("b", [4])], "ns string, failed array<bigint>")
    again = spark.createDataFrame([("a", 2, "pass"), ("a", 3, "stay")], "ns string, k long, outcome string")
    assert rows(diff.pull_passed(r, again, "ns"), "ns", "failed") == [("a", [1, 3]), ("b", [4])]


def test_misordered_fields(spark):
    df = spark.createDataFrame([(1, "x", "y"), (2, "x", "y")], "k long, a string, b string")
    t = diff.three_way(diff.with_both_hashes(df, "a", "b"), diff.with_both_hashes(df, "a", "b", reverse=F.col("k") == 2))
    assert rows(t, "k", "status") == [(1, "match"), (2, "misordered")]


def test_recheck_outcomes(spark):
    failed = spark.createDataFrame([("n", 1), ("n", 2), ("n", 3), ("n", 4)], "ns string, k long")
    a, b = kv(spark, (1, "a"), (2, "b"), (3, "c")), kv(spark, (1, "a"), (2, "x"))
    assert rows(diff.recheck(failed, a, b), "k", "outcome") == [(1, "pass"), (2, "stay"), (3, "stay"), (4, "pass")]


def test_status_history_starts_at_second_try(spark):
    old = spark.createDataFrame([("a", "running", 0, []), ("b", "running", 1, [])], "k string, status string, retry_num int, history array<struct<status:string,retry_num:int>>")
    new = spark.createDataFrame([("a", "done", 1), ("b", "done", 2), ("c", "done", 1)], "k string, status string, retry_num int")
    got = {r["k"]: (r["status"], len(r["history"])) for r in diff.upsert_status(old, new, ["k"]).collect()}
    assert got == {"a": ("done", 0), "b": ("done", 1), "c": ("done", 0)}


def test_floor_join_both_forms(spark):
    r = spark.createDataFrame([(0, 0, 10), (1, 10, 20), (2, 20, None)], "id int, lo long, hi long")
    x = spark.createDataFrame([(-1,), (0,), (9,), (10,), (1000,)], "v long")
    for few in (True, False):
        assert rows(ranges.floor_join(x, "v", r, few=few), "v", "id") == [(0, 0), (9, 0), (10, 1), (1000, 2)]


def test_floor_join_of_many_ranges(spark):
    """Uneven ranges beyond the bound of the broadcast form, with gaps and an open end."""
    bounds = sorted({(i * i * 37) % 5000 for i in range(200)} | {5000})
    r = spark.createDataFrame([(i, lo, hi if i % 5 else hi - 1) for i, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False))] + [(999, 5000, None)], "id int, lo long, hi long")
    assert r.count() > ranges.FEW
    x = spark.range(-3, 6000).withColumnRenamed("id", "v")
    got = dict(rows(ranges.floor_join(x, "v", r), "v", "id"))
    assert got == dict(rows(ranges.floor_join(x, "v", r, few=True), "v", "id")) and got[5999] == 999 and -1 not in got


def test_ranks_within_groups(spark):
    df = spark.range(500).selectExpr("id % 3 as g", "id * 7919 % 500 as k")
    got = ranges.ranked(df, "k", "g").collect()
    for g in range(3):
        keys = sorted(r["k"] for r in got if r["g"] == g)
        assert {r["k"]: r["r"] for r in got if r["g"] == g} == {k: i + 1 for i, k in enumerate(keys)} and {r["total"] for r in got if r["g"] == g} == {len(keys)}


def test_open_ends_have_middles(spark):
    x = spark.createDataFrame([(0, 10), (3, 8), (None, -10), (10, None), (None, None)], "lo long, hi long").select(s.midpoint("lo", "hi").alias("m"))
    assert [r["m"] for r in x.collect()] == [5, 5, -(1 << 62) - 5, (1 << 62) + 4, -1]


def test_merge_runs(spark):
    r = spark.createDataFrame([("n", 0, 1, "a"), ("n", 1, 2, "a"), ("n", 2, 3, "b"), ("n", 3, None, "a")], "ns string, lo long, hi long, shard string")
    got = [(x["shard"], x["lo"], x["hi"], x["mids"]) for x in ranges.merge_runs(r).orderBy("lo").collect()]
    assert got == [("a", 0, 2, [1]), ("b", 2, 3, []), ("a", 3, None, [])]


def test_equal_depth_covers_all_rows(spark):
    got = ranges.equal_depth_bounds(spark.range(103), "id", 10).orderBy("tile").collect()
    assert [r["n"] for r in got] == [11] * 3 + [10] * 7 and got[0]["lo"] == 0 and got[-1]["hi"] == 102


def test_unseen_shards_have_no_load(spark):
    load = spark.createDataFrame([("n", "s0", 90, 20), ("n", "s1", 10, 20)], "ns string, shard string, total_ops long, active_chunks long")
    shards = spark.createDataFrame([("s0",), ("s1",), ("s2",)], "shard string")
    got = {r["shard"]: (r["delta_ops"], r["above"]) for r in balance.shard_targets(load, shards).collect()}
    assert got == {"s0": (33 - 90, True), "s1": (23, True), "s2": (33, False)}


def test_hot_ranges_take_the_crossing_one(spark):
    a = spark.createDataFrame([("n", 1, 50), ("n", 2, 30), ("n", 3, 20)], "ns string, range_id int, cnt long")
    assert rows(balance.hot_ranges(a, 60), "range_id") == [1, 2] and rows(balance.hot_ranges(a, 0), "range_id") == [1]


def test_duplicates(spark):
    x = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    assert rows(dupes.archive(x, "k", "v"), "v", "copy_no") == [("a", 1), ("b", 2)]
    assert dupes.summary(x, "k").first() == (3, 1, 2)
    assert dupes.summary(x.where("k > 9"), "k").first() == (0, 0, 0)
    kept, rejected = dupes.restore(x, spark.createDataFrame([(2, "d"), (3, "e"), (3, "f")], "k long, v string"), "k")
    assert rows(kept, "k") == [1, 1, 2, 3] and rows(rejected, "v") == ["d", "f"]


def test_index_diff_kinds(spark):
    schema = "ns string, name string, key string, uniq boolean, sparse boolean, ttl int"
    a = spark.createDataFrame([("n", c, c, False, False, 1) for c in "abcde"], schema)
    b = spark.createDataFrame([("n", "a", "a", False, False, 1), ("n", "b", "b", False, False, 2), ("n", "c", "c", True, False, 1), ("n", "d", "d", True, True, 1)], schema)
    assert rows(catalogs.index_diff(a, b), "name", "diff_kind") == [("b", "ttl"), ("c", "unique"), ("d", "other"), ("e", "missing")]


def test_counters_and_balance(spark):
    x = spark.createDataFrame([(1, 0, 5), (1, 1, 9), (1, 2, 2)], "e int, t int, c long")
    assert rows(metrics.deltas(x, "e", "c", "t"), "t", "delta") == [(0, 0), (1, 4), (2, -7)]
    assert metrics.size_balance(spark.createDataFrame([("a", 10)], "shard string, size long")).first()["status"] is None


def test_names_and_numbers(spark):
    one = spark.range(1)
    got = one.select(
        s.ns_db(F.lit("db")).alias("a"), s.ns_collection(F.lit("d.x.y")).alias("b"), s.client_ip(F.lit("::1:27017")).alias("c"), s.parse_bytes(F.lit("x")).alias("d"), s.ratio(F.lit(1), F.lit(0)).alias("e"),
        s.uuid_text(F.unhex(F.lit("00112233445566778899aabbccddeeff")), legacy=True).alias("f"), s.hash64(F.lit("")).alias("g"), s.base64_url(F.unhex(F.lit("fbff"))).alias("h"), s.gigabytes(F.lit(1 << 30)).alias("i"),
    ).first()
    assert (got["a"], got["b"], got["c"], got["d"], got["e"]) == (None, "x.y", "::1", None, 0.0)
    assert got["f"] == "33221100-5544-7766-8899-aabbccddeeff" and got["g"] != 0 and got["h"] == "-_8" and got["i"] == 1.0
    assert one.select(s.base32(F.encode(F.lit("ab"), "utf-8")).alias("x")).first()["x"] == "MFRA===="


def test_shapes():
    assert s.shape_of('{"b":1,"a":{"$gt":2}}') == '{"shape":{"a":{"$gt":1},"b":1},"fields":["a","b"]}'
    assert s.shape_of('{"$or":[{"b":1},{"a":2}]}') == '{"shape":{"$or":[{"b":1},{"a":1}]},"fields":["a","b"]}'
    assert s.shape_of("[1]") is None and s.shape_of("{") is None and s.shape_of(None) is None


def test_manifest_drops_other_lines(spark):
    lines = spark.createDataFrame([('a.b,dup{"x":1}',), ("nothing",)], "value string")
    assert rows(manifest(lines), "ns", "kind", "spec") == [("a.b", "dup", '{"x":1}')]


def test_dump_files(spark, tmp_path):
    body = b"\x10n\0" + struct.pack("<i", 7) + b"\x02s\0" + struct.pack("<i", 3) + b"hi\0" + b"\x08b\0\x01" + b"\x0ax\0"
    doc = struct.pack("<i", len(body) + 5) + body + b"\0"
    assert list(bson.documents(doc * 2)) == [{"n": 7, "s": "hi", "b": True, "x": None}] * 2
    (tmp_path / "a.bson").write_bytes(doc * 2)
    assert rows(read_bson(spark, str(tmp_path)), "n") == [0, 1]


def test_which_ranges_may_move(spark):
    x = spark.createDataFrame([(1, 30, None), (2, 90, None), (3, None, None), (4, None, True), (5, 90, False)], "id int, minutes_since_move int, balanced boolean")
    assert rows(x.where(balance.movable()), "id") == [2, 3, 5]
    x = spark.createDataFrame([(-1000, 300), (-100, 300), (50, -50)], "f long, t long").select(balance.move_target("f", "t").alias("m"))
    assert [r["m"] for r in x.collect()] == [99, -33, -16]
    a = spark.createDataFrame([([(1, 5, None), (2, 6, None)],)], "chunks array<struct<id:int,cnt:int,balanced:boolean>>")
    assert [c["balanced"] for c in balance.mark_balanced(a, [2]).first()["chunks"]] == [None, True]


def test_sizes_of_plans(spark):
    x = spark.range(1).select(ranges.partition_count(1000, 10**6), ranges.partition_count(1 << 30, 50), ranges.partition_count(1 << 30, 10**6), ranges.sample_size(5000), ranges.sample_size(10**9))
    assert tuple(x.first()) == (1, 1, 3, 50, 25_000)
    x = spark.range(1).select(ranges.split_size(10**9, 2), ranges.split_size(10**6, 2), ranges.split_size(10**8, 2))
    assert tuple(x.first()) == (16793599, 2 << 20, 5_000_000)


def plain_pairs(rows_, where):
    on = {}
    for k, r, _ in rows_:
        on[k, where[r]] = on.get((k, where[r]), 0) + 1
    return sum(c * (c - 1) // 2 for c in on.values())


def test_conflicts_are_resolved_by_moves(spark):
    """Copies of keys in ranges 0 to 5 of two shards: moves end with no key twice on a shard, the input's conflicts never grow."""
    rows_ = [(k, r, f"s{r % 2}") for k in range(40) for r in ((k % 3) * 2, (k % 3) * 2 + 2 if k % 3 < 2 else 0)]
    df = spark.createDataFrame(sorted(set(rows_)), "k long, range_id long, shard string")
    keys, _, found = dupes.resolved(df, ["s0", "s1", "s2"])
    where = {r["range_id"]: r["shard"] for r in found.collect()}
    assert plain_pairs(set(rows_), where) == dupes.conflict_pairs(keys, found).first()["pairs"] == 0
    assert dupes.resolved(df.where("false"), ["s0"])[2].count() == 0
    keys, start, found = dupes.resolved(df, ["s0"])
    assert start.exceptAll(found).count() > 0 or dupes.conflict_pairs(keys, found).first()["pairs"] > 0


def test_no_single_move_is_left_that_gains(spark):
    """Random placements with copies inside a range and hot keys: pairs are counted right, never grow, and no move of one range would lower them."""
    import random

    for seed in range(3):
        rng = random.Random(seed)
        home = {r: f"s{rng.randrange(3)}" for r in range(14)}
        rows_ = [(rng.choice([0, 0, rng.randrange(30)]), r, home[r]) for r in (rng.randrange(14) for _ in range(150))]
        df = spark.createDataFrame(rows_, "k long, range_id long, shard string")
        keys, start, found = dupes.resolved(df, ["s0", "s1", "s2"])
        where = {r["range_id"]: r["shard"] for r in found.collect()}
        assert dupes.conflict_pairs(keys, start).first()["pairs"] == plain_pairs(rows_, home)
        left = plain_pairs(rows_, where)
        assert left == dupes.conflict_pairs(keys, found).first()["pairs"] <= plain_pairs(rows_, home)
        assert all(plain_pairs(rows_, where | {r: s}) >= left for r in where for s in ("s0", "s1", "s2"))


def test_index_hints_of_many_collections_are_dealt_out_not_broadcast(spark, monkeypatch):
    from tidemark.operators import catalogs, small

    monkeypatch.setattr(small, "TASK_ROWS", 20)
    ns = spark.range(100).select(F.concat(F.lit("n"), "id").alias("ns"))
    found = catalogs.hinted_index(ns.selectExpr("ns", "explode(array('a', 'ab', 'ba', 'b')) AS name", "split(name, '') AS fields"), ns.selectExpr("ns", "array('b') AS key_fields"))
    assert {r["name"] for r in found.collect()} == {"b"} and found.count() == 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count(", 20)") >= 2 and ", 4)" not in plan


def test_tables_with_copies_are_dealt_out_by_their_rows(spark, monkeypatch):
    from tests.oracle import SF, assert_same
    from tidemark.operators import small
    from tidemark.plans import registry

    monkeypatch.setattr(small, "TASK_ROWS", 100)
    query = registry.QUERIES["restore_insert"]
    plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(k#" in plan and ", 15)" in plan and ", 4)" not in plan
    assert_same(spark, query, registry.ORACLES["restore_insert"])
