"""Documents of any types: order, diffs, dumps, updates on any field, and profiles of what they hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import typed
from tidemark.plans.base import query
from tidemark.sources import derived as d
from tidemark.sources.tables import load

# --- keys of mixed types ---


def mixed(spark, sf):
    """Keys of nine types in extended JSON, from suppliers."""
    k, bal, name = F.col("s_suppkey"), F.col("s_acctbal").cast("string"), F.concat(F.lit('"'), F.col("s_name"), F.lit('"'))
    n = F.col("s_nationkey").cast("string")
    joined = lambda *x: F.concat(*[y if not isinstance(y, str) else F.lit(y) for y in x])
    forms = (
        None, F.lit('{"$minKey": 1}'), name, joined('{"b": ', bal, ', "a": ', n, "}"), joined("[", n, ", ", name, "]"), F.when(k % 2 == 0, "true").otherwise("false"),
        joined('{"$numberLong": "', k.cast("string"), '"}'), bal, F.lit('{"$maxKey": 1}'), F.lit("null"), joined('{"a": ', n, "}"),
    )
    at = (k % len(forms)).cast("int")
    text = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        if form is not None:
            text = F.when(at == i, form).otherwise(text)
    return load(spark, sf, "supplier").select(k.alias("id"), text.alias("value"))


@query("""SELECT id, CAST(row_number() OVER (ORDER BY rank, n1 NULLS FIRST, b1 NULLS FIRST, t, id) AS BIGINT) AS place FROM (SELECT s_suppkey AS id,
    CASE s_suppkey % 11 WHEN 0 THEN -2 WHEN 1 THEN -1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 10 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 8 WHEN 9 THEN 10 WHEN 8 THEN 99 ELSE 18 END AS rank,
    CASE s_suppkey % 11 WHEN 3 THEN s_nationkey WHEN 10 THEN s_nationkey WHEN 4 THEN s_nationkey WHEN 5 THEN CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END WHEN 6 THEN s_suppkey WHEN 7 THEN s_acctbal END::DOUBLE AS n1,
    CASE s_suppkey % 11 WHEN 3 THEN s_acctbal END AS b1, CASE WHEN s_suppkey % 11 IN (2, 4) THEN s_name ELSE '' END AS t FROM supplier)""")
def typed_places(spark, sf):
    """Places of values of many types in one order; equal values stand in the order of their ids."""
    from tidemark.operators.ranges import ranked

    x = typed.keyed(mixed(spark, sf), "value").select("id", F.struct("kb", "id").alias("kb"))
    return ranked(x, "kb").select("id", F.col("r").cast("long").alias("place"))


def typed_pair(spark, sf):
    """The pair of copies under keys that are numbers, texts, documents and arrays by turns; the copies write the same number or document in other ways."""
    from tidemark.plans.diff_queries import pair

    def named(x, other):
        k = F.col("k").cast("string")
        number = F.concat(k, F.lit(".0")) if other else F.concat(F.lit('{"$numberLong": "'), k, F.lit('"}'))
        doc = F.concat(F.lit('{"x": 1.0, "a": '), k, F.lit("}")) if other else F.concat(F.lit('{"a": '), k, F.lit('.0, "x": 1}'))
        kind = F.col("k") % 4
        text = F.when(kind == 0, number).when(kind == 1, F.concat(F.lit('"'), k, F.lit('"'))).when(kind == 2, doc).otherwise(F.concat(F.lit("["), k, F.lit("]")))
        return x.select(text.alias("k"), "h")

    s, t = pair(spark, sf)
    return named(s, False), named(t, True)


@query("SELECT CAST(k % 4 AS BIGINT) AS kind, status, CAST(count(*) AS BIGINT) AS n FROM diffed GROUP BY ALL")
def typed_merge(spark, sf):
    """States of rows by the type of their key."""
    s, t = typed_pair(spark, sf)
    k = F.col("k")
    kind = F.when(k.startswith('"'), 1).when(k.startswith('{"a"') | k.startswith('{"x"'), 2).when(k.startswith("["), 3).otherwise(0)
    return typed.merge_diff(s, t).groupBy(kind.cast("long").alias("kind"), "status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT k % 4 AS kind, CAST(count(*) AS BIGINT) AS ids, CAST(sum(copies) AS BIGINT) AS copies FROM (SELECT k, count(*) AS copies FROM (SELECT k FROM src UNION ALL SELECT k FROM dst) GROUP BY k HAVING count(*) > 1) GROUP BY 1")
def typed_dupes(spark, sf):
    """Keys that occur twice, in whatever form they are written."""
    s, t = typed_pair(spark, sf)
    k = F.col("k")
    kind = F.when(k.startswith('"'), 1).when(k.startswith('{"a"') | k.startswith('{"x"'), 2).when(k.startswith("["), 3).otherwise(0)
    return typed.duplicates(s.unionByName(t), "k").groupBy(kind.cast("long").alias("kind")).agg(F.count(F.lit(1)).alias("ids"), F.sum("copies").alias("copies"))


# --- dumps ---

#: Documents of a dump file: a task writes one file, so files grow in number, not in size.
FILE_DOCS = 100_000


def dumped(spark, sf):
    """Orders as typed documents with nested parts, written as dump files."""
    from tidemark.sources import dumps
    from tidemark.sources.work import fresh_path

    text = lambda c: F.to_json(F.struct(F.col(c).alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("v")))) - 6)
    doc = F.concat(
        F.lit('{"_id": {"$numberLong": "'), F.col("k").cast("string"), F.lit('"}, "cust": '), F.col("cust").cast("string"), F.lit(', "status": '), text("status"),
        F.lit(', "paid": {"cents": {"$numberLong": "'), F.col("cents").cast("string"), F.lit('"}, "share": '), (F.col("cents") / 1000).cast("string"),
        F.lit('}, "at": {"$date": "'), F.col("day"), F.lit('T00:00:00Z"}, "tags": ['), text("prio"), F.lit(', null, true, {"$minKey": 1}]}'),
    )
    path, x = fresh_path(spark, "dump"), d.source(spark, sf)
    files = max(3, -(-x.count() // FILE_DOCS))  # a count of the table's footers
    dumps.write_dump(x.select(doc.alias("json")).repartition(files), path)
    return path


@query("SELECT k, cust, status, cents, day, prio, round(cents / 1000, 3) AS share, 'min' AS last FROM src")
def dump_restore(spark, sf):
    """A table written as dump files and read again by byte ranges, many a file."""
    from tidemark.sources import dumps

    at = lambda p: F.get_json_object("json", p)
    x = dumps.read_dump(spark, dumped(spark, sf), split=1 << 16)
    return x.select(
        at("$._id.$numberLong").cast("long").alias("k"), at("$.cust").cast("long").alias("cust"), at("$.status").alias("status"), at("$.paid.cents.$numberLong").cast("long").alias("cents"),
        F.date_format(F.timestamp_millis(at("$.at.$date.$numberLong").cast("long")), "yyyy-MM-dd").alias("day"), at("$.tags[0]").alias("prio"), F.round(at("$.paid.share").cast("double"), 3).alias("share"),
        F.when(at("$.tags[3].$minKey") == "1", "min").alias("last"),
    )


@query("""SELECT k, '{"_id": ' || k || ', "cust": ' || cust || ', "status": "' || status || '", "paid": {"cents": ' || cents || '}, "at": "' || day || 'T00:00:00Z", "tags": ["' || prio || '", null, true, {"$minKey": 1}]}' AS line FROM src""")
def export_typed(spark, sf):
    """Lines of an export from dump files: every type in the form that it is exported in."""
    from tidemark.sources import dumps

    x = dumps.export_lines(dumps.read_dump(spark, dumped(spark, sf), split=1 << 18))
    return x.select(F.get_json_object("line", "$._id").cast("long").alias("k"), F.regexp_replace("line", ', "share": [^}]*', "").alias("line"))


@query("SELECT CAST(count(*) AS BIGINT) AS docs, CAST(0 AS BIGINT) AS gaps, CAST(max(k) AS BIGINT) AS last FROM src")
def dump_cover(spark, sf):
    """Documents found by tasks that start anywhere in a file, and places where they leave a gap or overlap."""
    from tidemark.sources import dumps
    from tidemark.sources.work import stored

    x = dumps.read_dump(spark, dumped(spark, sf), split=1 << 15)
    x = stored(x.select("path", "length", "at", "size", F.get_json_object("json", "$._id.$numberLong").cast("long").alias("k")), "places")  # files are read once
    n = x.agg(F.count(F.lit(1)).alias("docs"), F.max("k").alias("last"))
    return n.join(dumps.gaps(x).agg(F.count(F.lit(1)).alias("gaps")))


# --- updates of any field ---


def update_log(e):
    """A log of documents with nested fields: whole ones, fields and paths set and unset, replacements and deletions."""
    n = F.col("event_id").cast("string")
    whole = F.concat(F.lit('{"a": '), n, F.lit(', "n": {"x": '), n, F.lit(', "y": {"z": '), n, F.lit('}}, "l": [1, {"k": '), n, F.lit("}]}"))
    set_ = F.concat(F.lit('{"$v": 1, "$set": {"n.x": '), n, F.lit(', "m": {"p": '), n, F.lit('}, "l.1.k": '), n, F.lit("}}"))
    unset = F.when(F.col("event_id") % 2 == 0, F.lit('{"$unset": {"n.y": true}}')).otherwise(F.concat(F.lit('{"$set": {"n": {"x": '), n, F.lit('}}, "$unset": {"l": true}}')))
    replace = F.concat(F.lit('{"$v": 1, "a": '), n, F.lit("}"))
    t = F.col("event_type")
    doc = F.when(t == "signup", whole).when(t == "click", set_).when(t == "view", unset).when(t == "error", replace)
    op = F.when(t == "signup", "i").when(t == "purchase", "d").otherwise("u")
    return e.select((F.col("user_id") % 50).alias("id"), "ts", F.col("event_id").alias("seq"), op.alias("op"), doc.alias("doc"))


def field_values(x):
    at = lambda p: F.get_json_object("doc", p).cast("long")
    return x.select(F.col("id").cast("long").alias("id"), at("$.a").alias("a"), at("$.n.x").alias("nx"), at("$.n.y.z").alias("nyz"), at("$.m.p").alias("mp"))


FIELDS = """WITH e AS (SELECT user_id % 50 AS id, event_id AS v, event_type AS t, row_number() OVER (PARTITION BY user_id % 50 ORDER BY ts, event_id) AS rn FROM events),
    r AS (SELECT id, max(rn) FILTER (t IN ('signup', 'error', 'purchase')) AS root FROM e GROUP BY id), x AS (SELECT e.*, r.root FROM e JOIN r USING (id) WHERE e.rn >= r.root)
    SELECT id, first(v ORDER BY rn) AS a, first(CASE WHEN t = 'error' THEN NULL ELSE v END ORDER BY rn DESC) FILTER (t IN ('signup', 'error', 'click') OR t = 'view' AND v % 2 = 1) AS nx,
    first(CASE WHEN t = 'signup' THEN v END ORDER BY rn DESC) FILTER (t IN ('signup', 'error', 'view')) AS nyz, first(CASE WHEN t = 'click' THEN v END ORDER BY rn DESC) FILTER (t IN ('signup', 'error', 'click')) AS mp
    FROM x GROUP BY id HAVING min(t) FILTER (rn = root) <> 'purchase'"""


@query(FIELDS)
def apply_any_field(spark, sf):
    """Documents after a log with updates of nested fields."""
    from tidemark.operators import updates

    return field_values(updates.applied(update_log(load(spark, sf, "events"))))


@query(FIELDS)
def stream_any_field(spark, sf):
    """The same through a stream whose batches are merged into a state of paths."""
    from tidemark.streaming import streams

    log = update_log(streams.tail(spark, f"{sf}/events.parquet*", load(spark, sf, "events").schema))
    return field_values(streams.merge_updates(log))


# --- profiles and states ---


@query("""WITH e AS (SELECT event_id AS v, event_type AS t, row_number() OVER (ORDER BY event_id) AS rn FROM events), x AS (
      SELECT 'a' AS path, CASE WHEN t IN ('signup', 'error') THEN 'int' END AS kind, v FROM e UNION ALL SELECT '$v', CASE WHEN t IN ('click', 'error') THEN 'int' END, v FROM e
      UNION ALL SELECT 'n', CASE WHEN t = 'signup' THEN 'object' END, v FROM e UNION ALL SELECT 'n.x', CASE WHEN t = 'signup' THEN 'int' END, v FROM e
      UNION ALL SELECT 'n.y', CASE WHEN t = 'signup' THEN 'object' END, v FROM e UNION ALL SELECT 'n.y.z', CASE WHEN t = 'signup' THEN 'int' END, v FROM e
      UNION ALL SELECT 'l', CASE WHEN t = 'signup' THEN 'array' END, v FROM e UNION ALL SELECT 'l[]', CASE WHEN t = 'signup' THEN unnest(['int', 'object']) END, v FROM e UNION ALL SELECT 'l[].k', CASE WHEN t = 'signup' THEN 'int' END, v FROM e)
    SELECT path, CAST(count(*) AS BIGINT) AS values, CAST(count(DISTINCT v) AS BIGINT) AS docs, string_agg(DISTINCT kind, ',' ORDER BY kind) AS types, CASE path WHEN 'l[]' THEN 'object' ELSE max(kind) END AS last_type FROM x WHERE kind IS NOT NULL GROUP BY path""")
def schema_nested(spark, sf):
    """Paths and types of nested documents: those of the log that are whole or replace, and their updates' version fields."""
    from tidemark.operators import profile

    log = update_log(load(spark, sf, "events"))
    bare = F.when(F.col("doc").contains('"$set"') | F.col("doc").contains('"$unset"'), F.when(F.col("doc").contains('"$v"'), F.lit('{"$v": 1}'))).otherwise(F.col("doc"))
    x = profile.schema_profile(log.select(bare.alias("doc"), "seq"), "doc", "seq")
    return x.select("path", "values", "docs", F.array_join(F.transform("types", lambda t: t["type"]), ",").alias("types"), "last_type")


@query("""SELECT 'db.orders' AS ns, r.lo, r.hi, CASE WHEN n.bad IS NULL THEN 'done' WHEN n.left_bad = 0 THEN 'done' ELSE 'failed' END AS status, CAST(CASE WHEN n.bad IS NULL THEN 1 ELSE 2 END AS INTEGER) AS retry_num, CAST(coalesce(n.left_bad, 0) AS BIGINT) AS failed,
    CAST(CASE WHEN n.bad IS NULL THEN 0 ELSE 1 END AS INTEGER) AS earlier, n.bad AS failed_before FROM ranges r LEFT JOIN
    (SELECT r.id, CAST(count(*) AS BIGINT) AS bad, count(*) FILTER (NOT (d.status = 'dest_only' OR d.k % 2 = 0)) AS left_bad FROM diffed d JOIN ranges r ON d.k >= r.lo AND (r.hi IS NULL OR d.k < r.hi) WHERE d.status <> 'match' GROUP BY r.id) n USING (id)""")
def status_store(spark, sf):
    """States of ranges in a versioned table: a diff writes the first, a recheck of what failed the second, and the first moves to the history."""
    from tidemark.operators import diff, ranges
    from tidemark.plans.diff_queries import pair
    from tidemark.sources import versioned
    from tidemark.sources.work import fresh_path

    s, t = pair(spark, sf)
    parts, folder = d.ranges(spark, sf).select("id", "lo", "hi"), fresh_path(spark, "status")
    key = ["ns", "lo", "hi"]

    def states(failed, retry, only=False):
        n = ranges.floor_join(failed.select("k"), "k", parts).groupBy("id").agg(F.count(F.lit(1)).alias("failed"))
        x = parts.join(n, "id", "left").withColumn("failed", F.coalesce("failed", F.lit(0)))
        x = x.join(again.select("id"), "id", "left_semi") if only else x
        return x.select(F.lit("db.orders").alias("ns"), "lo", "hi", F.when(F.col("failed") > 0, "failed").otherwise("done").alias("status"), F.lit(retry).alias("retry_num"), "failed")

    failed = diff.full_diff(s, t).where("status <> 'match'").withColumn("ns", F.lit("db.orders"))
    versioned.upsert(spark, folder, states(failed, 1), key, "diff")
    again = parts.join(versioned.read(spark, folder).where("status = 'failed'").select(F.col("lo").alias("_lo")), F.col("lo") == F.col("_lo"), "left_semi")
    repaired = s.where("k % 2 = 0").unionByName(t.where("k % 2 <> 0").join(s.select("k"), "k", "left_semi"))
    versioned.upsert(spark, folder, states(diff.recheck(failed, s, repaired).where("outcome = 'stay'"), 2, only=True), key, "recheck")
    out = versioned.read(spark, folder)
    return out.select(*key, "status", "retry_num", "failed", F.size("history").alias("earlier"), F.get("history", F.lit(0))["failed"].alias("failed_before"))
