"""Trees of hashes, interval search, typed keys, dumps, updates, versions and plans against plain Python."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from tests.test_operators import kv, rows
from tidemark.operators import diff, merkle, ranges


def brute_states(a, b):
    a, b = dict(a), dict(b)
    return {k: "dest_only" if k not in a else "source_only" if k not in b else "match" if a[k] == b[k] else "mismatch" for k in {*a, *b}}


def states(df, column="status"):
    got = [(r["k"], r[column]) for r in df.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


@pytest.mark.parametrize("left,right", [([(None, "x"), (1, "a"), (2, "b")], [(None, "y"), (1, "a"), (3, "c")]), ([(None, "x"), (1, "a")], [(1, "b")]), ([(1, "a")], [(None, None), (2, None)]), ([(None, None)], [(None, None)]), ([], [(None, "a")])])
def test_null_keys_in_every_comparison(spark, left, right):
    a, b = kv(spark, *left), kv(spark, *right)
    want = brute_states(left, right)
    assert states(diff.full_diff(a, b)) == want
    assert states(diff.id_diff(a, b)) == {k: v for k, v in want.items() if v.endswith("only")}
    ids = spark.createDataFrame([(None,), (1,), (1,), (9,)], "k long")
    assert states(diff.changed_diff(a, b, ids)) == {k: v for k, v in want.items() if k in (None, 1)}
    failed = spark.createDataFrame([("n", k) for k in (None, 1, 2, 3, 4)], "ns string, k long")
    assert states(diff.recheck(failed, a, b), "outcome") == {k: "pass" if want.get(k, "match") == "match" else "stay" for k in (None, 1, 2, 3, 4)}


# --- interval search ---


@pytest.mark.parametrize("values", [[], [3], list(range(0, 200, 3)), [1, 1, 1, 5]])
def test_last_at_most_counts_like_bisect(spark, values):
    x = spark.createDataFrame([(i, values) for i in range(-2, 205)], "x long, v array<long>")
    assert rows(x.select("x", ranges.last_at_most(F.col("v"), F.col("x"), 128).alias("n")), "x", "n") == [(i, bisect.bisect_right(values, i)) for i in range(-2, 205)]


def test_floor_join_with_one_range_a_billion_times_wider(spark):
    narrow = [(i * 50, i * 50 + 7, f"n{i}") for i in range(300)]
    wide = [(1 << 20, (1 << 20) + (7 << 30), "wide"), (1 << 50, None, "open")]
    keys = [k for i in range(300) for k in (i * 50, i * 50 + 6, i * 50 + 7, i * 50 - 1)] + [(1 << 20) - 1, 1 << 20, 1 << 30, (1 << 20) + (7 << 30), 1 << 50, 1 << 60]
    r = spark.createDataFrame(narrow + wide, "lo long, hi long, name string")
    x = spark.createDataFrame([(k, i) for i, k in enumerate(keys)] + [(None, -1)], "key long, i int")
    want = sorted((i, n) for i, k in enumerate(keys) for lo, hi, n in narrow + wide if lo <= k and (hi is None or k < hi))
    for few in (False, None, True):
        assert rows(ranges.floor_join(x, "key", r, few=few), "i", "name") == want
    below = r.unionByName(spark.createDataFrame([(None, -9, "below")], r.schema))
    y = x.unionByName(spark.createDataFrame([(-(1 << 62), 9001), (-10, 9002), (-9, 9003)], x.schema))
    for few in (False, True):
        assert rows(ranges.floor_join(y, "key", below, few=few), "i", "name") == sorted([*want, (9001, "below"), (9002, "below")])
    plan = ranges.floor_join(x, "key", r, few=False)._jdf.queryExecution().executedPlan().toString()
    assert "Nested" not in plan and "Cartesian" not in plan


def test_floor_join_of_texts_and_of_no_ranges(spark):
    r = spark.createDataFrame([(f"k{i:03d}", f"k{i:03d}z", i) for i in range(0, 200, 2)], "lo string, hi string, i int")
    x = spark.createDataFrame([(f"k{i:03d}a",) for i in range(200)] + [("a",)], "key string")
    assert rows(ranges.floor_join(x, "key", r, few=False), "key", "i") == [(f"k{i:03d}a", i) for i in range(0, 200, 2)]
    assert ranges.floor_join(x, "key", r.limit(0), few=False).count() == 0


def test_floor_join_keeps_bins_small_where_ranges_are_many(spark, monkeypatch):
    depths, search = [], ranges.last_at_most
    monkeypatch.setattr(ranges, "last_at_most", lambda v, x, size=None: depths.append(size) or search(v, x, size))
    monkeypatch.setattr(ranges, "BIN", 2)
    monkeypatch.setattr(ranges, "MOST_BOUNDS", 5)
    big = 1 << 60
    for below in (False, True):
        held = [(None, -5, -1)] * below + [(big + i * 10, big + i * 10 + 7, i) for i in range(400)]
        r = spark.createDataFrame(held, "lo long, hi long, name int")
        x = spark.createDataFrame([(None,), (-9,), (-5,), (0,)] + [(big + k,) for k in range(-3, 4010)], "key long")
        want = sorted([(-9, -1)] * below + [(big + k, k // 10) for k in range(4000) if k % 10 < 7])
        assert rows(ranges.floor_join(x, "key", r, few=False), "key", "name") == want
    assert max(d for d in depths if d) == 9


# --- trees of hashes ---


@pytest.mark.parametrize("seed", range(3))
def test_tree_finds_what_differs_and_opens_nothing_else(spark, seed):
    rng = random.Random(seed)
    a = {rng.randrange(-10**6, 10**6): f"v{rng.random()}" for _ in range(4000)}
    b = dict(a)
    for k in rng.sample(sorted(a), 5):
        b[k] = "other"
    for k in rng.sample(sorted(a), 3):
        b.pop(k, None)
    b[2_000_000 + seed] = "new"
    left, right = list(a.items()), list(b.items())
    if seed:
        left, right = left + [(None, "x")], right + [(None, "y" if seed == 2 else "x")]
    found, nodes = merkle.tree_diff(kv(spark, *left), kv(spark, *right), fanout=8, leaf_rows=10)
    want = {k: v for k, v in brute_states(left, right).items() if v != "match"}
    assert states(found) == want
    opened = nodes.collect()
    last = max(r["level"] for r in opened)
    assert sum(r["source_rows"] for r in opened if r["level"] == last) < 500 < len(a)  # of the leaves
    assert len([r for r in opened if r["level"] == last]) <= len(want)


def test_tree_of_equal_and_of_empty_tables(spark):
    a = kv(spark, *[(i, str(i)) for i in range(100)])
    found, nodes = merkle.tree_diff(a, a, 4, 5)
    assert found.count() == 0 and nodes.count() == 0
    none = a.limit(0)
    assert merkle.tree_diff(none, none)[0].count() == 0
    assert merkle.tree_diff(a, none, 4, 5)[0].count() == 100


def test_tree_over_keys_that_are_no_numbers(spark):
    a = {f"key{i}": str(i) for i in range(3000)} | {None: "x"}
    b = a | {"key7": "other", "new": "1", None: "y"}
    b.pop("key2999")
    make = lambda d: spark.createDataFrame(list(d.items()), "k string, h string")
    found, nodes = merkle.tree_diff(make(a), make(b), fanout=8, leaf_rows=10)
    assert states(found) == {"key7": "mismatch", "new": "dest_only", "key2999": "source_only", None: "mismatch"}
    last = max(r["level"] for r in nodes.collect())
    assert nodes.where(f"level = {last}").agg(F.sum("source_rows")).first()[0] < 200


def test_swapped_values_are_seen_and_many_nodes_are_joined(spark, monkeypatch):
    a, b = kv(spark, *[(i, str(i)) for i in range(200)]), kv(spark, *[(i, str(i ^ 1)) for i in range(200)])
    monkeypatch.setattr(merkle, "MOST_NODES", 3)
    assert states(merkle.tree_diff(a, b, 4, 5)[0]) == {i: "mismatch" for i in range(200)}


def test_rows_are_summed_once_for_all_levels_of_the_tree(spark, monkeypatch):
    calls, sums = [], merkle.node_sums
    monkeypatch.setattr(merkle, "node_sums", lambda *x: calls.append(x[2]) or sums(*x))
    a, b = kv(spark, *[(i, str(i)) for i in range(3000)]), kv(spark, *[(i, "x" if i == 77 else str(i)) for i in range(3000)])
    found, nodes = merkle.tree_diff(a, b, fanout=3, leaf_rows=5)
    assert states(found) == {77: "mismatch"} and calls == ["source", "dest"]
    opened = nodes.orderBy("level").collect()
    assert [r["level"] for r in opened] == list(range(len(opened))) and len(opened) > 4 and [r["source_rows"] for r in opened[-2:]] == [15, 5]


def test_tree_tells_a_missing_hash_from_a_dash(spark):
    a = [(i, str(i)) for i in range(50)]
    for left, right in ((None, "-"), ("-", None), (None, ""), (None, None)):
        found, nodes = merkle.tree_diff(kv(spark, *a, (50, left)), kv(spark, *a, (50, right)), 4, 5)
        assert states(found) == ({50: "mismatch"} if left != right else {}) and bool(nodes.count()) == (left != right)


def test_leaves_are_joined_64_a_row_and_rows_are_filtered_where_they_are_read(spark, monkeypatch):
    monkeypatch.setattr(merkle, "MOST_NODES", 3)
    rng = random.Random(5)
    a = {i: str(i) for i in range(-3000, 3000)}
    b = a | {i: "x" for i in rng.sample(sorted(a), 150)} | {9000: "new"}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, nodes = merkle.tree_diff(kv(spark, *a.items()), kv(spark, *b.items()), fanout=8, leaf_rows=5)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert states(found) == {k: v for k, v in brute_states(a, b).items() if v != "match"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert len(semi) == 2 and all("BroadcastHashJoin" in line for line in semi)
    last = nodes.where(f"level = {nodes.agg(F.max('level')).first()[0]}").select("node")
    bits = {r["_word"]: r["_bits"] % 2**64 for r in merkle.packed(last).collect()}
    assert sorted(64 * w + i for w, x in bits.items() for i in range(64) if x >> i & 1) == sorted(r["node"] for r in last.collect()) and len(bits) < 25 < 100 < last.count()


def test_sums_of_a_tree_are_whole_numbers_of_hashes_of_64_bits(spark):
    x = spark.createDataFrame([(i, str(i), i) for i in range(100)], "k long, h string, _at long")
    sums = merkle.node_sums(x, F.lit(0).cast("long"), "source")
    assert dict(sums.dtypes)["source_sum"] == "array<bigint>" and "conv(" not in sums._jdf.queryExecution().executedPlan().toString()
    assert all(0 < w < 100 << 24 for w in sums.first()["source_sum"])


# --- keys of mixed types ---

#: Values in ascending order; those in one list are equal.
ORDERED = [
    [{"$minKey": 1}],
    [""], ["\x00"], ["\x00\x00"], ["\x00a"], ["a"], ["a\x00"], ["a\x00b"], ["ab"], ["b"], ["\U0001f600"], ["\ue000"],
    [{}], [{"a": 1}, {"a": 1.0}, {"a": {"$numberLong": "1"}}], [{"a": 1, "b": 2}, {"b": 2.0, "a": 1}], [{"a": 1, "b": 3}], [{"a": 1, "c": 0}], [{"a": 2}], [{"b": 0}],
    [[]], [[1], [1.0]], [[1, "x"], [1.0, "x"]], [[1, 1]], [[2]],
    [{"$binary": {"base64": "", "subType": "00"}}], [{"$binary": {"base64": "gA==", "subType": "00"}}], [{"$binary": {"base64": "/w==", "subType": "00"}}], [{"$binary": {"base64": "AA==", "subType": "00"}}], [{"$binary": {"base64": "AAA=", "subType": "00"}}], [{"$binary": {"base64": "AQ==", "subType": "03"}}],
    [{"$oid": "0" * 24}], [{"$oid": "f" * 24}],
    [False], [True],
    [{"$date": {"$numberLong": "-5"}}], [{"$date": "1970-01-01T00:00:00Z"}, {"$date": {"$numberLong": "0"}}], [{"$date": "2024-01-01T00:00:00.001Z"}],
    [None],
    [{"$timestamp": {"t": 1, "i": 2}}], [{"$timestamp": {"t": 4000000000, "i": 0}}],
    [float("-inf"), {"$numberDouble": "-Infinity"}], [{"$numberDecimal": "-1e300"}, ], [-(2**63)], [-1.5], [-1, -1.0, {"$numberDecimal": "-1"}], [{"$numberDouble": "-0.0"}], [0, {"$numberDecimal": "0.00"}], [5e-324], [{"$numberDecimal": "0.1"}], [0.1], [0.5], [1], [2**53 - 1], [2**53, float(2**53)], [2**53 + 1], [2**53 + 2], [2**63 - 1], [1e19], [{"$numberDecimal": "12345678901234567890123456789012.33"}], [{"$numberDecimal": "12345678901234567890123456789012.34"}], [1e300], [{"$numberDouble": "Infinity"}], [{"$numberDouble": "NaN"}],
    [{"$maxKey": 1}],
]


def test_order_of_typed_keys():
    from tidemark.functions.typed_keys import MISSING, key_of

    keys = [[key_of(v) for v in same] for same in ORDERED]
    assert all(len(set(k)) == 1 for k in keys)
    flat = [MISSING] + [k[0] for k in keys]
    assert flat == sorted(flat) and len(set(flat)) == len(flat)


def test_no_key_is_the_start_of_another():
    """So that keys inside documents and arrays end where they should."""
    from tidemark.functions.typed_keys import key_of

    keys = sorted(key_of(same[0]) for same in ORDERED)
    assert not any(b.startswith(a) for a, b in zip(keys, keys[1:]))
    rng = random.Random(5)
    values = [rng.choice(ORDERED)[0] for _ in range(400)]
    pairs = [[a, b] for a, b in zip(values, values[1:])]
    rank = {key_of(same[0]): i for i, same in enumerate(ORDERED)}
    assert sorted(pairs, key=key_of) == sorted(pairs, key=lambda p: [rank[key_of(x)] for x in p])


def test_typed_diff_and_order(spark):
    a = spark.createDataFrame([("1", "x"), ('"1"', "x"), ('{"a": 1, "b": 2}', "x"), ("[1, 2]", "x"), (None, "x"), ("7", "x")], "k string, h string")
    b = spark.createDataFrame([("1.0", "x"), ('"1"', "y"), ('{"b": 2.0, "a": 1}', "x"), ("[1, 2, 3]", "x"), (None, "z"), ("true", None)], "k string, h string")
    from tidemark.operators import typed

    got = states(typed.merge_diff(a, b))
    assert got == {"1": "match", '"1"': "mismatch", '{"a": 1, "b": 2}': "match", "[1, 2]": "source_only", None: "mismatch", "7": "source_only", "[1, 2, 3]": "dest_only", "true": "dest_only"}
    assert [r["k"] for r in typed.in_order(a.unionByName(b.where("h = 'y' or k = 'true'")).dropDuplicates(["k"]), "k").collect()] == [None, '"1"', '{"a": 1, "b": 2}', "[1, 2]", "true", "1", "7"]
    assert rows(typed.duplicates(a.unionByName(b), "k").where("k is not null"), "copies") == [2, 2, 2]


# --- dumps ---

DOCS = [
    {}, {"a": 1}, {"n": {"$numberLong": "5"}, "big": 1 << 40, "x": 1.5, "minus": -0.0, "t": True, "f": False, "none": None}, {"s": "é漢\x00x", "empty": ""},
    {"d": {"d": {"d": {}}}, "list": [1, [2, {"x": None}], "y"], "o": {"$oid": "0123456789abcdef01234567"}}, {"at": {"$date": {"$numberLong": "-5"}}, "ts": {"$timestamp": {"t": 4000000000, "i": 7}}},
    {"b": {"$binary": {"base64": "AAECgA==", "subType": "05"}}, "r": {"$regularExpression": {"pattern": "^a", "options": "i"}}, "c": {"$code": "f()"}, "y": {"$symbol": "z"}},
    {"k": [{"$minKey": 1}, {"$maxKey": 1}, {"$undefined": True}], "nan": {"$numberDouble": "NaN"}, "inf": {"$numberDouble": "-Infinity"}},
    {"dec": [{"$numberDecimal": t} for t in ("0", "1.50", "-123456789012345678901234567890.1234", "1E+6000", "NaN", "Infinity", "-Infinity", "0E-6176")]},
]


def test_every_type_survives_a_round_trip():
    from tidemark.sources import bson

    for doc in DOCS:
        raw = bson.encode(doc)
        again = bson.typed(raw)
        assert bson.encode(again) == raw
        if "big" in doc:
            doc = doc | {"n": 5, "big": {"$numberLong": str(1 << 40)}}
            again = again | {"n": int(again["n"]["$numberLong"])}
        assert repr(again) == repr(doc)
        for broken in (raw[:-1], raw + b"\x00", raw[:4] + b"\x99" + raw[5:] if len(raw) > 5 else b"\x05\0\0\0\1"):
            with pytest.raises((ValueError, IndexError)):
                bson.typed(broken)


def test_export_forms():
    import uuid

    from tidemark.sources import bson

    u = uuid.UUID("00112233-4455-6677-8899-aabbccddeeff")
    import base64

    binary = lambda raw, kind: {"$binary": {"base64": base64.b64encode(raw).decode(), "subType": kind}}
    legacy = u.bytes[7::-1] + u.bytes[:7:-1]
    doc = {
        "l": {"$numberLong": "5"}, "i": 3, "x": 1.5, "nan": {"$numberDouble": "NaN"}, "d": {"$date": {"$numberLong": "1"}}, "e": {"$date": {"$numberLong": "-1000"}}, "o": {"$oid": "ab" * 12}, "n": {"$numberDecimal": "1.50"}, "y": {"$symbol": "s"},
        "t": {"$timestamp": {"t": 7, "i": 2}}, "u4": binary(u.bytes, "04"), "u3": binary(legacy, "03"), "b": binary(b"ab", "00"), "m": {"$minKey": 1}, "a": [{"$numberLong": "6"}, {"k": {"$oid": "00"}}], "z": {}, "q": None,
    }
    assert bson.exported(doc) == {
        "l": 5, "i": 3, "x": 1.5, "nan": {"$numberDouble": "NaN"}, "d": "1970-01-01T00:00:00.001Z", "e": "1969-12-31T23:59:59Z", "o": "ab" * 12, "n": "1.50", "y": "s",
        "t": {"t": 7, "i": 2}, "u4": str(u), "u3": str(u), "b": "YWI=", "m": {"$minKey": 1}, "a": [6, {"k": "00"}], "z": {}, "q": None,
    }


def test_base32_of_all_lengths(spark):
    import base64

    from tidemark.functions import scalars

    values = [bytes(range(200, 200 + n)) for n in range(12)] + [None, b"\x00", b"\xff" * 20]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v binary")
    assert rows(df.select("i", scalars.base32("v").alias("x")), "i", "x") == [(i, None if v is None else base64.b32encode(v).decode()) for i, v in enumerate(values)]


def test_order_of_reports_by_each_metric(spark):
    from tidemark.operators import metrics

    stats = spark.createDataFrame([("b", "s0", None, 5, 1), ("a", "s0", 10, None, 3), ("c", "s0", 10, 5, 2), ("c", "s1", 0, 1, 9)], "ns string, shard string, cache_bytes long, dirty_bytes long, data_bytes long")
    order = lambda name: [(r["ns"], r["shard"]) for r in stats.orderBy(*metrics.sorted_by(stats, name)).collect()]
    assert order("cacheMB") == order("what?") == [("a", "s0"), ("c", "s0"), ("b", "s0"), ("c", "s1")]
    assert order("namespace")[0] == ("a", "s0") and order("DATAGB")[0] == ("c", "s1") and order("dirty%") == [("c", "s0"), ("a", "s0"), ("b", "s0"), ("c", "s1")]


def test_ranges_find_the_same_documents(spark, tmp_path, monkeypatch):
    """Ranges of any size, with documents inside documents, long ones, and zeros and whole documents inside binary values."""
    import json

    from tidemark.sources import bson, dumps

    rng = random.Random(2)
    inner = bson.encode({"a": 1}) + bson.encode({"b": {"c": []}})
    import base64

    some = [*DOCS, {"blob": {"$binary": {"base64": base64.b64encode(bytes(300) + inner).decode(), "subType": "00"}}}, {"long": "x" * 5000}, {"deep": [{"i": i, "e": {}} for i in range(200)]}]
    docs = [rng.choice(some) | {"i": i} for i in range(400)]
    file = tmp_path / "x" / "part.bson"
    file.parent.mkdir()
    raws = [bson.encode(x) for x in docs]
    file.write_bytes(b"".join(raws))
    (tmp_path / "empty.bson").write_bytes(b"")
    (tmp_path / "note.txt").write_bytes(b"no dump")
    starts = [0]
    for raw in raws:
        starts.append(starts[-1] + len(raw))
    for split, back in ((97, 50), (1000, 300), (1000, 1 << 16), (64 << 20, 1)):
        monkeypatch.setattr(dumps, "BACK", back)
        got = [x for lo in range(0, starts[-1], split) for x in dumps.read_range(str(file), lo, min(lo + split, starts[-1]), starts[-1])]
        assert [x[0] for x in got] == starts[:-1] and [x[1] for x in got] == raws
    df = dumps.read_dump(spark, str(tmp_path), split=3000)
    assert df.rdd.getNumPartitions() > 30
    assert [json.loads(r["json"])["i"] for r in df.orderBy("at").collect()] == list(range(400)) and dumps.gaps(df).count() == 0
    assert dumps.gaps(df.where(f"at <> {starts[3]}")).collect()[0]["at"] == starts[4]
    cut = tmp_path / "cut"
    cut.mkdir()
    (cut / "cut.bson").write_bytes(b"".join(raws)[:-3])
    with pytest.raises(Exception, match="no whole document"):
        dumps.read_dump(spark, str(cut), split=3000).count()


def test_dump_written_appended_and_overwritten(spark, tmp_path):
    import json

    from tidemark.sources import dumps

    docs = spark.createDataFrame([(json.dumps(d), i) for i, d in enumerate(DOCS)] + [(None, -1)], "json string, i int")
    path = str(tmp_path / "out")
    read = lambda: sorted(r["json"] for r in dumps.read_dump(spark, path).collect())
    dumps.write_dump(docs.repartition(3), path)
    once = read()
    assert len(once) == len(DOCS)
    dumps.write_dump(docs, path)
    assert read() == sorted(once * 2)
    dumps.write_dump(docs.where("i = 1"), path, "overwrite")
    assert read() == ['{"a": 1}']
    with pytest.raises(Exception, match="zero in it"):
        dumps.write_dump(spark.createDataFrame([('{"a\\u0000": 1}',)], "json string"), path)
    assert read() == ['{"a": 1}'] and not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]


def test_a_place_that_is_no_document_costs_few_bytes_and_many_small_ranges_are_few_tasks(tmp_path):
    from tidemark.sources import bson, dumps

    class Counted:
        def __init__(self, raw):
            self.raw, self.read = raw, 0

        def read_at(self, n, at):
            self.read += n
            return self.raw[at : at + n]

    # the bytes of the numbers read as lengths of 3 to 4 MB, which the file is long enough for
    raw = b"".join(bson.encode({"i": i, "a": [1 << 22 | i % 7, 3 << 20, 0x30000 + i]}) for i in range(1000)) * 500
    file = Counted(raw)
    w = dumps.Bytes(file, len(raw))
    assert dumps.first_start(w, len(raw) // 2) is not None and file.read < 16 << 20
    (tmp_path / "a.bson").write_bytes(raw)
    parts = dumps.DumpReader({"path": str(tmp_path), "splitBytes": str(1 << 15)}).partitions()
    assert len(parts) < 100 and [p.lo for p in parts] == [0, *[p.hi for p in parts[:-1]]] and parts[-1].hi == len(raw)
    found = [x.column(2).to_pylist() for p in parts[:2] for x in dumps.DumpReader({"path": str(tmp_path)}).read(p)]
    assert sum(found, []) == list(range(0, parts[1].hi, len(raw) // 500_000))


# --- updates of any field ---


def plain_updates(log):
    """Operations one after the other on dictionaries."""
    import json

    docs = {}

    def walk(doc, path):
        for p in path[:-1]:
            doc = doc.setdefault(p, {})
        return doc

    for i, _, _, op, text in sorted(log, key=lambda r: r[1:3]):
        body = json.loads(text) if text else {}
        body.pop("$v", None) if op == "u" else None
        if op == "d":
            docs.pop(i, None)
        elif op == "i" or not body or not next(iter(body)).startswith("$"):
            docs[i] = body
        elif i in docs:
            for name, value in body.get("$set", {}).items():
                path = name.split(".")
                at = walk(docs[i], path)
                at[path[-1]] = json.loads(json.dumps(value))
            for name in body.get("$unset", {}):
                path, at = name.split("."), docs[i]
                for p in path[:-1]:
                    at = at.get(p) if isinstance(at, dict) else None
                if isinstance(at, dict):
                    at.pop(path[-1], None)
    return {str(i): d for i, d in docs.items()}


def servable(log):
    """Without operations that a server would have rejected: a path through a value that is no document."""
    import json

    kept, docs = [], {}
    for r in sorted(log, key=lambda r: r[1:3]):
        body = json.loads(r[4]) if r[4] else {}
        doc, ok = docs.get(str(r[0])), True
        for name in body.get("$set", {}):
            at = doc
            for p in name.split(".")[:-1]:
                at = at.get(p) if isinstance(at, dict) else at
                ok = ok and (at is None and p not in (doc or {}) or isinstance(at, dict))
            ok = ok and doc is not None
        if ok:
            kept.append(r)
            docs = plain_updates([x for x in kept if x[3] in "iud" and x[0] == r[0]]) | {k: v for k, v in docs.items() if k != str(r[0])}
    return [r for r in log if r in kept]


def no_empty(x):
    """Without documents that have become empty by unsetting: paths keep only what is set."""
    if isinstance(x, dict):
        y = {k: no_empty(v) for k, v in x.items()}
        return {k: v for k, v in y.items() if v != {}}
    return x


def random_log(rng, n, ids):
    import datetime as dt
    import json

    value = lambda: rng.choice([rng.randrange(99), "téxt", None, True, {"x": rng.randrange(9), "y": {"z": 1}}, {"y": 2}, [1, 2], {"$numberLong": "5"}])
    path = lambda: rng.choice(["a", "a.x", "a.y", "a.y.z", "b", "b.c.d", "c"])
    out = []
    for seq in range(n):
        kind = rng.random()
        if kind < 0.25:
            op, doc = "i", {k: value() for k in rng.sample("abc", rng.randrange(4))}
        elif kind < 0.35:
            op, doc = "u", {"$v": 1, "a": value()}
        elif kind < 0.42:
            op, doc = "d", None
        elif kind < 0.47:
            op, doc = rng.choice("nc"), {"x": 1}
        elif kind < 0.75:
            op, doc = "u", {"$v": 2, "$set": {path(): value()}}
        else:
            op, doc = "u", {"$unset": {path(): True}}
        out.append((rng.randrange(ids), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(50)), seq, op, None if doc is None else json.dumps(doc)))
    return out


LOG = "id long, ts timestamp, seq long, op string, doc string"


@pytest.mark.parametrize("seed", range(4))
def test_updates_against_dictionaries(spark, seed):
    import json

    from tidemark.operators import updates

    log = servable(random_log(random.Random(seed), 1500, 120))
    got = {r["id"]: json.loads(r["doc"]) for r in updates.applied(spark.createDataFrame(log, LOG).repartition(3)).collect()}
    want = plain_updates([r for r in log if r[3] in "iud"])
    assert {k: no_empty(v) for k, v in got.items()} == {k: no_empty(v) for k, v in want.items()} and len(got) > 40


def test_updates_of_lists_and_bad_operators(spark):
    from tidemark.operators import updates

    t = "2024-01-01 00:00:00"
    log = lambda *docs: spark.createDataFrame([(1, None, n, op, d) for n, (op, d) in enumerate(docs)], LOG).withColumn("ts", F.lit(t).cast("timestamp"))
    doc = lambda *docs: [r["doc"] for r in updates.applied(log(*docs)).collect()]
    assert doc(("i", '{"l": [1, {"k": 2}]}'), ("u", '{"$set": {"l.1.k": 3, "l.3": 4}}')) == ['{"l":[1,{"k":3},null,4]}']
    assert doc(("i", '{"l": [1], "e": {}}'), ("u", '{"$v": 1}')) == ["{}"]
    assert doc(("u", '{"$set": {"a": 1}}')) == [] and doc(("i", "{}"), ("d", None), ("u", '{"$set": {"a": 1}}')) == []
    assert updates.applied(log(("i", "{}")).limit(0)).count() == 0
    with pytest.raises(Exception, match="holds no .push"):
        doc(("i", "{}"), ("u", '{"$push": {"a": 1}}'))


def test_updates_in_a_stream_that_is_run_twice_with_late_rows(spark, tmp_path):
    import json

    from tidemark.streaming import streams

    log = servable(random_log(random.Random(9), 1400, 60))
    src, at = str(tmp_path / "log"), str(tmp_path / "state")
    shuffled = random.Random(1).sample(log, len(log))  # files hold operations in no order
    step = -(-len(log) // 12)
    for i in range(12):
        spark.createDataFrame(shuffled[i * step : i * step + step], LOG).coalesce(1).write.mode("append").parquet(src)
        if i in (6, 11):
            stream = streams.tail(spark, src, spark.read.parquet(src).schema, files_per_trigger=1)
            got = {r["id"]: no_empty(json.loads(r["doc"])) for r in streams.merge_updates(stream, at=at).collect()}
            if i == 11:
                assert got == {k: no_empty(v) for k, v in plain_updates([r for r in log if r[3] in "iud"]).items()}


# --- prefix sums, bounds, sketches ---


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_prefix_sums_and_splits(spark, n):
    rng = random.Random(n)
    keys = rng.sample(range(10_000), n)
    sizes = {k: rng.choice([0, 1, 5, 5000]) for k in keys}
    df = spark.createDataFrame([(k, b) for k, b in sizes.items()], "k long, b long").repartition(5)
    before, want, last = 0, [], None
    for k in sorted(keys):
        want.append((k, before, last, sum(sizes.values())))
        before, last = before + sizes[k], sizes[k]
    got = sorted(tuple(r[c] for c in ("k", "before", "prev", "total")) for r in ranges.prefix_sums(df, "k", "b").collect())
    assert got == want
    size = max(sum(sizes.values()) // 2 // 10, 0)
    size = size if size >= 1000 else 2000
    splits = [(k, b, size) for k, b, prev, _ in want if prev is not None and b // size > (b - prev) // size]
    twice = df.unionByName(df.withColumn("b", F.lit(0).cast("long"))).unionByName(spark.createDataFrame([(None, 9)], "k long, b long"))  # keys that repeat, a row without
    assert rows(ranges.split_keys(twice, "k", "b", 2, mega=1000), "split_key", "bytes_before", "split_size") == splits


@pytest.mark.parametrize("n", [1, 3, 7, 40])
def test_equal_shares_with_hot_keys(spark, n):
    keys = [5] * 60 + list(range(30)) + [29] * 25 + [100]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long").repartition(4)
    order, base, more = sorted(keys), len(keys) // n, len(keys) % n
    want, at = [], 0
    for t in range(n):
        part = order[at : at + base + (t < more)]
        at += len(part)
        if part:
            want.append((t + 1, part[0], part[-1], len(part)))
    assert rows(ranges.equal_depth_bounds(df, "k", n), "tile", "lo", "hi", "n") == want
    plan = ranges.equal_depth_bounds(df, "k", n)
    assert ranges.equal_depth_bounds(df.limit(0), "k", n).count() == 0 and plan.columns == ["tile", "lo", "hi", "n"]


def test_sketches_keep_their_error(spark):
    df = spark.range(0, 200_000, 1, 7).select((F.col("id") * 7919 % 100_003 + F.when(F.col("id") % 3 == 0, 10**6).otherwise(0)).alias("k"))
    order = sorted(r["k"] for r in df.collect())
    for r in ranges.sketched_bounds(df, "k", 20, 1e-3).collect():
        place = len(order) * r["bound_no"] / 20
        assert bisect.bisect_left(order, r["bound"]) - 201 <= place <= bisect.bisect_right(order, r["bound"]) + 201
    plan = ranges.sketched_bounds(df, "k", 20)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


# --- profiles ---


def test_profile_of_nested_documents(spark):
    import json

    from tidemark.operators import profile

    deep = {"x": 1}
    for _ in range(60):
        deep = {"d": [deep]}
    docs = [
        {"a": 1, "n": {"x": "t", "y": {"z": [1, 2.5, {"w": None}, []]}}, "o": {"$oid": "0" * 24}}, {"a": "x", "n": None, "b": {"$numberLong": "5"}}, {"a": {"k": True}, "n": {"x": 1 << 40}}, {}, {"": {"": 0}, "a": [[1], [["s"]]]}, deep,
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(99, None)], "at long, doc string").repartition(3)

    def plain(path, v, out):
        kind = profile.type_of(v)
        out.append((path, kind))
        if kind == "object":
            for k, x in v.items():
                plain(f"{path}.{k}", x, out)
        elif kind == "array":
            for x in v:
                plain(path + "[]", x, out)

    want = {}
    for d in docs:
        out = []
        for k, v in d.items():
            plain(k, v, out)
        for p in {p for p, _ in out}:
            want.setdefault(p, [{}, 0, None])[1] += 1
        for p, t in out:
            want[p][0][t] = want[p][0].get(t, 0) + 1
            want[p][2] = t
    got = {r["path"]: [{t["type"]: t["values"] for t in r["types"]}, r["docs"], r["last_type"]] for r in profile.schema_profile(df, "doc", "at").collect()}
    assert got == want and got["d" + "[].d" * 59 + "[].x"][0] == {"int": 1}
    one = profile.schema_profile(df.where("at = 1"), "doc", "at", limit=1).collect()
    assert sorted(r["path"] for r in one) == ["a", "b", "n"] and profile.schema_profile(df.where("at = 99"), "doc", "at").count() == 0


# --- versions ---


def status(spark, *rows_):
    return spark.createDataFrame(list(rows_), "ns string, lo long, hi long, status string, retry_num int")


def table(spark, folder):
    from tidemark.sources import versioned

    return sorted(((r["ns"], r["lo"], r["hi"]), r["status"], r["retry_num"], [(h["status"], h["retry_num"]) for h in r["history"]]) for r in versioned.read(spark, folder).collect())


def test_states_are_put_and_read_back(spark, tmp_path):
    from tidemark.sources import versioned

    folder, key = str(tmp_path / "status"), ["ns", "lo", "hi"]
    assert versioned.read(spark, folder) is None
    assert versioned.upsert(spark, folder, status(spark, ("a", 0, 5, "running", 1), ("a", 5, None, "running", 1)), key, "one") == 1
    assert versioned.upsert(spark, folder, status(spark, ("a", 5, None, "failed", 1), ("b", 0, 9, "done", 1)), key, "two") == 2
    assert versioned.upsert(spark, folder, status(spark, ("a", 5, None, "done", 2)), key) == 3
    want = [(("a", 0, 5), "running", 1, []), (("a", 5, None), "done", 2, [("failed", 1)]), (("b", 0, 9), "done", 1, [])]
    assert table(spark, folder) == want
    assert versioned.upsert(spark, folder, status(spark, ("a", 5, None, "again", 9)), key, "two") == 3 and table(spark, folder) == want  # a batch counts once
    assert versioned.read(spark, folder, 1).count() == 2
    versioned.cleaned(spark, folder, keep=1)
    assert table(spark, folder) == want and versioned.upsert(spark, folder, status(spark, ("c", 0, 1, "new", 0)), key) == 4


def test_a_crash_before_publishing_leaves_the_old_version(spark, tmp_path, monkeypatch):
    from tidemark.sources import versioned

    folder, key = str(tmp_path / "status"), ["ns", "lo", "hi"]
    versioned.upsert(spark, folder, status(spark, ("a", 0, 5, "running", 1)), key, "one")
    old = table(spark, folder)
    with monkeypatch.context() as m:
        m.setattr(versioned, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            versioned.upsert(spark, folder, status(spark, ("a", 0, 5, "done", 2)), key, "two")
    assert table(spark, folder) == old
    assert versioned.upsert(spark, folder, status(spark, ("a", 0, 5, "done", 2)), key, "two") == 2
    assert table(spark, folder) == [(("a", 0, 5), "done", 2, [("running", 1)])]


def test_two_writers_at_once_both_count(spark, tmp_path):
    from tidemark.sources import versioned

    folder, key = str(tmp_path / "status"), ["ns", "lo", "hi"]
    versioned.upsert(spark, folder, status(spark, ("a", 0, 5, "running", 1)), key)
    tries = []

    def change(old):
        if not tries:  # another writer is first
            versioned.upsert(spark, folder, status(spark, ("b", 0, 1, "done", 1)), key)
        tries.append(1)
        return versioned.upserted(old, status(spark, ("a", 0, 5, "done", 2)), key)

    assert versioned.update(spark, folder, change) == 3 and len(tries) == 2
    assert table(spark, folder) == [(("a", 0, 5), "done", 2, [("running", 1)]), (("b", 0, 1), "done", 1, [])]
    with pytest.raises(versioned.Conflict):
        versioned.publish(spark, folder, 2, "rows-x", [])
