"""Scans, sinks, generators, text sources, schema profiles, scalar functions and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.plans.base import query
from tidemark.sources import derived as d
from tidemark.sources.tables import load, manifest, split_corrupt
from tidemark.sources.work import fresh_path
from tidemark.streaming import streams

# --- scans ---


@query("SELECT * FROM supplier")
def scan_full(spark, sf):
    return load(spark, sf, "supplier")


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey")
def scan_sorted(spark, sf):
    return load(spark, sf, "supplier").select("s_suppkey", "s_name").orderBy("s_suppkey")


@query("SELECT o_orderkey FROM orders")
def scan_ids(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT user_id * 7 FROM events)")
def lookup_in(spark, sf):
    """Point lookups of many keys at once: a semi join instead of batches of IN lists."""
    ids = load(spark, sf, "events").select((F.col("user_id") * 7).alias("o_orderkey")).distinct()
    return load(spark, sf, "orders").join(ids, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 25 = 0")
def sample_rate(spark, sf):
    """A repeatable sample of one in 25 keys."""
    return load(spark, sf, "orders").where("o_orderkey % 25 = 0").select("o_orderkey")


# --- text and JSON sources ---


@query("SELECT 'db.' || lower(p_brand) AS ns, 'c' || (p_size % 3) AS kind, '{\"t\":' || p_size || '}' AS spec, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY ALL")
def regex_manifest(spark, sf):
    p = load(spark, sf, "part")
    lines = p.select(F.concat(F.lit("db."), F.lower("p_brand"), F.lit(",c"), F.col("p_size") % 3, F.lit('{"t":'), F.col("p_size"), F.lit("}")).alias("value"))
    return manifest(lines).groupBy("ns", "kind", "spec").agg(F.count(F.lit(1)).alias("n"))


LINE = "CASE event_type WHEN 'error' THEN CASE event_id % 4 WHEN 0 THEN 'Error: write failed' WHEN 1 THEN 'warning: error ignored' WHEN 2 THEN 'Transient Error, retrying' ELSE 'could not connect' END ELSE 'applied op ' || event_type END"


@query(f"""SELECT seq, line, (regexp_matches(line, '\\bfail', 'i') OR regexp_matches(line, '\\berror', 'i') OR regexp_matches(line, '\\bunable', 'i') OR regexp_matches(line, '\\bcould not', 'i'))
    AND NOT (regexp_matches(line, 'warning|recoverable error|transient error', 'i')) AS is_alert FROM (SELECT event_id AS seq, {LINE} AS line FROM events)""")
def log_classify(spark, sf):
    """Lines with an error phrase and none of the exclusions, in any case."""
    x = load(spark, sf, "events").select(F.col("event_id").alias("seq"), F.expr(LINE).alias("line"))
    alert = F.col("line").rlike(r"(?i)\b(fail|error|unable|could not)") & ~F.col("line").rlike(r"(?i)(warning|recoverable error|transient error)")
    return x.withColumn("is_alert", alert)


@query("SELECT min(event_id) AS first, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'signup' AND event_id % 3 = 0")
def log_trigger(spark, sf):
    """The first line that has the phrase a coordinator waits for, and how many do."""
    line = F.when((F.col("event_type") == "signup") & (F.col("event_id") % 3 == 0), F.concat(F.lit("state is READY_FOR_PAUSE at "), "event_id")).otherwise(F.concat(F.lit("state is ready_for_pause at "), "event_id"))
    x = load(spark, sf, "events").select("event_id", line.alias("line")).where(s.is_trigger("line"))
    return x.agg(F.min("event_id").alias("first"), F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id AS seq, CASE WHEN event_id % 4 = 0 THEN 'COMMITTED' ELSE 'RUNNING' END AS state, event_id % 5 <> 0 AS can_commit, CAST(event_id % 90 AS BIGINT) AS lag, CAST(event_id * 2 AS BIGINT) AS copied, CAST(event_id * 4 AS BIGINT) AS total,
    CASE WHEN event_id = 0 THEN 0.0 ELSE 50.0 END::DOUBLE AS pct, CASE WHEN event_id % 5 = 0 THEN 'not yet' END AS info FROM events""")
def json_status(spark, sf):
    """Polled status documents: state, whether it can commit, lag, bytes copied and what stands against it."""
    k = F.col("event_id")
    text = F.to_json(F.struct(F.struct(
        F.when(k % 4 == 0, "COMMITTED").otherwise("RUNNING").alias("state"), (k % 5 != 0).alias("canCommit"), (k % 90).alias("lagTimeSeconds"),
        F.struct((k * 4).alias("estimatedTotalBytes"), (k * 2).alias("estimatedCopiedBytes")).alias("collectionCopy"), F.when(k % 5 == 0, "not yet").alias("info"),
    ).alias("progress"), F.lit(True).alias("success")))
    p = F.from_json("text", "progress struct<state:string,canCommit:boolean,lagTimeSeconds:long,info:string,collectionCopy:struct<estimatedTotalBytes:long,estimatedCopiedBytes:long>>")["progress"]
    x = load(spark, sf, "events").select(k.alias("seq"), text.alias("text")).select("seq", p.alias("p"))
    copied, total = F.col("p.collectionCopy.estimatedCopiedBytes"), F.col("p.collectionCopy.estimatedTotalBytes")
    return x.select("seq", "p.state", F.col("p.canCommit").alias("can_commit"), F.col("p.lagTimeSeconds").alias("lag"), copied.alias("copied"), total.alias("total"), (100 * s.ratio(copied, total)).alias("pct"), "p.info")


@query("SELECT event_id AS seq, CASE WHEN event_id % 10 = 3 THEN NULL ELSE CAST(props::JSON->>'k' AS BIGINT) END AS k, CASE WHEN event_id % 10 = 3 THEN substr(props, 1, length(props) - 1) END AS corrupt FROM events")
def corrupt_rows(spark, sf):
    """Rows that do not parse are kept apart with their text."""
    line = F.when(F.col("event_id") % 10 == 3, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return split_corrupt(load(spark, sf, "events").select(F.col("event_id").alias("seq"), line.alias("value")), "k long")


@query("SELECT s_suppkey AS id, 'shard' || i AS shard, s_suppkey * 10 + i AS size FROM supplier, (SELECT unnest(range(3)) AS i)")
def map_explode(spark, sf):
    """Per-shard entries of a map keyed by shard and host."""
    k = F.col("s_suppkey")
    m = F.create_map(*[x for i in range(3) for x in (F.lit(f"shard{i}/host{i}:27018"), k * 10 + i)])
    x = load(spark, sf, "supplier").select(k.alias("id"), F.explode(m).alias("host", "size"))
    return x.select("id", F.substring_index("host", "/", 1).alias("shard"), "size")


# --- sinks, written and read back ---


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf):
    """Appended in two checkpoints with a header each, read back as one table."""
    path = fresh_path(spark, "csv")
    x = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    for part in (x.where("c_custkey % 2 = 0"), x.where("c_custkey % 2 <> 0")):
        part.write.mode("append").option("header", True).csv(path)
    return spark.read.schema(x.schema).option("header", True).csv(path)


@query("SELECT * FROM supplier")
def raw_dump(spark, sf):
    """A table dumped whole and restored."""
    path = fresh_path(spark, "dump")
    x = load(spark, sf, "supplier")
    x.write.parquet(path)
    return spark.read.schema(x.schema).parquet(path)


@query("SELECT 'host' || (s_suppkey % 4) AS host, s_suppkey AS id, CAST(r AS INTEGER) AS run, s_suppkey * 100 + r AS size FROM supplier, (SELECT unnest(range(3)) AS r)")
def host_stats_append(spark, sf):
    """Statistics of each host, appended run by run and read back by host."""
    path = fresh_path(spark, "hosts")
    k = F.col("s_suppkey")
    for run in range(3):
        x = load(spark, sf, "supplier").select(F.concat(F.lit("host"), k % 4).alias("host"), k.alias("id"), F.lit(run).alias("run"), (k * 100 + run).alias("size"))
        x.write.mode("append").partitionBy("host").parquet(path)
    return spark.read.schema("id long, run int, size long, host string").parquet(path).select("host", "id", "run", "size")


@query("SELECT event_id AS seq, substr(props, 1, length(props) - 1) AS text FROM events WHERE event_id % 10 = 3")
def corrupt_sink(spark, sf):
    """Only the rows that do not parse, written apart as compressed text and read back."""
    path = fresh_path(spark, "corrupt")
    line = F.when(F.col("event_id") % 10 == 3, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    bad = split_corrupt(load(spark, sf, "events").select(F.col("event_id").alias("seq"), line.alias("value")), "k long").where("corrupt is not null")
    bad.select("seq", F.col("corrupt").alias("text")).write.option("compression", "gzip").json(path)
    return spark.read.schema("seq long, text string").json(path)


@query("""SELECT i AS line, CASE i WHEN -1 THEN '<table><tr><th>db</th><th>ns</th><th>index</th><th>uses</th></tr>' ELSE '<tr><td>' || db || '</td><td>' || ns || '</td><td>' || replace(name, '&', '&amp;') || '</td><td>' || uses || '</td></tr>' END AS html FROM
    (SELECT row_number() OVER (ORDER BY ns, name) - 1 AS i, db, ns, name, primary_ops + secondary_ops AS uses FROM idx UNION ALL SELECT -1, NULL, NULL, NULL, NULL)""")
def report_html(spark, sf):
    """A health report as lines of HTML: index usage in order, text escaped; line numbers come from counts of parts."""
    from tidemark.operators import metrics
    from tidemark.operators.ranges import ranked

    u = metrics.index_usage(d.index_stats(spark, sf))
    safe = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    cells = [safe("db"), safe("ns"), safe("name"), (F.col("primary_ops") + F.col("secondary_ops")).cast("string")]
    line = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    body = ranked(u.select(F.struct("ns", "name").alias("key"), line.alias("html")), "key").select((F.col("r") - 1).cast("long").alias("line"), "html")
    head = spark.range(1).select(F.lit(-1).cast("long").alias("line"), F.lit("<table><tr>" + "".join(f"<th>{h}</th>" for h in ("db", "ns", "index", "uses")) + "</tr>").alias("html"))
    return head.unionByName(body)


@query("""SELECT o_orderkey AS k, '{"k":' || o_orderkey || ',"day":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') || '","cents":"' || CAST(round(o_totalprice * 100) AS BIGINT) || '"}' AS json FROM orders""")
def export_json(spark, sf):
    """Lines of JSON with times in ISO form and exact numbers as text."""
    o = load(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("k"), F.to_json(F.struct(F.col("o_orderkey").alias("k"), s.iso_utc("o_orderdate").alias("day"), F.round(F.col("o_totalprice") * 100).cast("long").cast("string").alias("cents"))).alias("json"))


# --- generators ---


def gen_sql() -> str:
    """The generated rows in SQL: field i is of type i mod 6, everything follows from digests of row and field."""
    word = lambda i, at: f"CAST(('0x' || substr(md5('{i}-' || id), {at}, 4)) AS INTEGER)"
    h = lambda i: f"md5('{i}-' || id)"
    kinds = (
        lambda i: f"substr({h(i)}, 1, 24)",
        lambda i: "concat_ws('-', " + ", ".join(f"substr({h(i)}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")",
        lambda i: f"TIMESTAMP '2023-11-14 22:13:20' + to_seconds(id * 60 + {i})",
        lambda i: f"substr(repeat({h(i)}, 4), 1, 20 + {word(i, 1)} % 80)",
        lambda i: f"upper(substr(sha256('{i}-' || id), 1, 2 * (16 + {word(i, 1)} % 16)))",
        lambda i: f"{word(i, 5)} % 2 = 0",
    )
    return "SELECT CAST(id AS BIGINT) AS doc_id, " + ", ".join(f"{kinds[i % 6](i)} AS field_{i}" for i in range(12)) + " FROM (SELECT o_orderkey AS id FROM orders)"


@query(gen_sql())
def gen_rows(spark, sf):
    """A synthetic row for each key of orders: the type of field i is i mod 6 (id, uuid, time, text, bytes as hex, flag)."""
    h = lambda i: F.md5(F.concat(F.lit(f"{i}-"), F.col("id").cast("string")))
    word = lambda i, at: F.conv(F.substring(h(i), at, 4), 16, 10).cast("int")
    kinds = (
        lambda i: F.substring(h(i), 1, 24),
        lambda i: F.concat_ws("-", *[F.substring(h(i), at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        lambda i: F.timestamp_seconds(F.lit(1700000000 + i) + F.col("id") * 60).cast("timestamp_ntz"),
        lambda i: F.substring(F.repeat(h(i), 4), F.lit(1), 20 + word(i, 1) % 80),
        lambda i: F.upper(F.substring(F.sha2(F.concat(F.lit(f"{i}-"), F.col("id").cast("string")), 256), F.lit(1), 2 * (16 + word(i, 1) % 16))),
        lambda i: word(i, 5) % 2 == 0,
    )
    return load(spark, sf, "orders").select(F.col("o_orderkey").alias("id")).select(F.col("id").alias("doc_id"), *[kinds[i % 6](i).alias(f"field_{i}") for i in range(12)])


@query("""SELECT 'id' || k AS _id, k % 97 AS x, k * 1.5::DOUBLE AS score, k % 2 = 0 AS is_active, dup AS is_duplicate FROM (SELECT c_custkey AS k, NULL::BOOLEAN AS dup FROM customer UNION ALL SELECT c_custkey, true FROM customer WHERE c_custkey % 100 = 0)""")
def gen_dupes(spark, sf):
    """A synthetic row for each customer, and for one in a hundred of them once more."""
    base, n = load(spark, sf, "customer").select(F.col("c_custkey").alias("id")), F.col("id")
    row = lambda df, dup: df.select(F.concat(F.lit("id"), n).alias("_id"), (n % 97).alias("x"), (n * 1.5).cast("double").alias("score"), (n % 2 == 0).alias("is_active"), dup.alias("is_duplicate"))
    return row(base, F.lit(None).cast("boolean")).unionByName(row(base.where("id % 100 = 0"), F.lit(True)))


# --- schemas and shapes ---

#: Fixed names of types in emitted classes; all others are strings.
TYPES = {"long": "long", "int": "int", "double": "double", "date": "DateTime", "bool": "bool", "binary": "byte[]"}


def typed_json(df):
    """Rows as extended JSON objects that keep the types of their columns; nulls are left out."""
    of = {"bigint": lambda c: F.struct(c.cast("string").alias("$numberLong")), "timestamp_ntz": lambda c: F.struct(s.iso_utc(c).alias("$date"))}
    return F.to_json(F.struct(*[F.when(F.col(f"`{n}`").isNotNull(), of[t](F.col(f"`{n}`")) if t in of else F.col(f"`{n}`")).alias(n) for n, t in df.dtypes]))


KINDS = "CASE column_type WHEN 'BIGINT' THEN 'long' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'DateTime' WHEN 'DATE' THEN 'DateTime' WHEN 'BOOLEAN' THEN 'bool' WHEN 'BLOB' THEN 'byte[]' ELSE 'string' END"
EMITTED = ("events", "orders", "documents", "labels")


@query(" UNION ALL ".join(f"SELECT '{t}' AS class, column_name AS field, {KINDS} AS type, '    public ' || {KINDS} || ' ' || upper(column_name[1]) || column_name[2:] || ' {{ get; set; }}' AS line FROM (DESCRIBE {t})" for t in EMITTED))
def schema_emit(spark, sf):
    """Class fields for what the rows of tables hold, and the line of source that declares each; the type that a field had last counts, unknown types are strings."""
    from functools import reduce

    from tidemark.operators.profile import schema_profile as profile

    kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv]), "last_type"), F.lit("string"))
    each = []
    for t in EMITTED:
        df = load(spark, sf, t)
        found = profile(df.select(typed_json(df).alias("doc"), F.monotonically_increasing_id().alias("at")), "doc", "at")
        each.append(found.select(F.lit(t).alias("class"), F.col("path").alias("field"), kind.alias("type")))
    line = F.concat(F.lit("    public "), "type", F.lit(" "), F.upper(F.substring("field", 1, 1)), F.expr("substring(field, 2)"), F.lit(" { get; set; }"))
    return reduce(lambda a, b: a.unionByName(b), each).withColumn("line", line)


@query("""SELECT 'k' AS key, 'integer' AS type, CAST(count(*) AS BIGINT) AS n, max(event_id) AS last FROM events UNION ALL SELECT 'tag', CASE WHEN (SELECT max(event_id) FROM events WHERE event_id % 3 = 0) % 2 = 0 THEN 'string' ELSE 'boolean' END, CAST(count(*) AS BIGINT), max(event_id) FROM events WHERE event_id % 3 = 0""")
def schema_profile(spark, sf):
    """Every key of schemaless rows with how often it occurs and the type that it had last."""
    e = load(spark, sf, "events")
    tag = F.when(F.col("event_id") % 3 != 0, "").when(F.col("event_id") % 2 == 0, ',"tag":"x"').otherwise(',"tag":true')
    doc = F.concat(F.expr("substring(props, 1, length(props) - 1)"), tag, F.lit("}"))
    m = e.select("event_id", F.from_json(doc, "map<string,string>").alias("m"), doc.alias("doc"))
    x = m.select("event_id", F.explode("m").alias("key", "v"))
    kind = F.when(F.col("v").isin("true", "false"), "boolean").when(F.col("v").rlike(r"^-?\d+$"), "integer").otherwise("string")
    return x.groupBy("key").agg(F.max_by(kind, F.col("event_id")).alias("type"), F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


@query("""SELECT CASE event_type WHEN 'view' THEN '{"shape":{"user":{"$gt":1}},"fields":["user"]}' WHEN 'click' THEN '{"shape":{"$and":[{"user":1},{"k":{"$in":1}}]},"fields":["k","user"]}' ELSE '{"shape":{"k":1,"user":1},"fields":["k","user"]}' END AS shape,
    CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""")
def query_shape(spark, sf):
    """Predicates without their values, and how often each shape occurs."""
    u, k = F.col("user_id"), F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "view", F.concat(F.lit('{"user":{"$gt":'), u, F.lit("}}")))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"$and":[{"user":'), u, F.lit('},{"k":{"$in":['), k, F.lit("]}}]}")))
        .otherwise(F.concat(F.lit('{"user":'), u, F.lit(',"k":'), k, F.lit("}")))
    )
    once = load(spark, sf, "events").groupBy(text.alias("t")).agg(F.count(F.lit(1)).alias("n"))  # each text is parsed once
    return once.groupBy(s.query_shape("t").alias("shape")).agg(F.sum("n").alias("n"))


# --- scalar functions ---


@query("""SELECT c_custkey AS id, md5(c_name) AS md5, sha1(c_name) AS sha1, sha256(c_name) AS sha256, upper(hex(c_name)) AS hex, base64(c_name::BLOB) AS b64, lower(regexp_extract('h' || c_custkey || '-Shard-' || (c_custkey % 5) || '.x', '(?i)(shard[-_]?[0-9]+)', 1)) AS shard,
    CASE WHEN length(c_name) > 12 THEN substr(c_name, 1, 9) || '...' ELSE c_name END AS short, '10.1.1.' || (c_custkey % 250) AS ip, 'm://*****@h' || c_custkey AS masked, 'coll' AS bare, 'db.metrics' AS view_ns, 'db.system.buckets.m' || c_nationkey AS bucket_ns FROM customer""")
def scalar_text(spark, sf):
    k = F.col("c_custkey")
    n = F.col("c_name")
    return load(spark, sf, "customer").select(
        k.alias("id"), F.md5(n).alias("md5"), F.sha1(n).alias("sha1"), F.sha2(n, 256).alias("sha256"), F.hex(n).alias("hex"), F.base64(n.cast("binary")).alias("b64"),
        s.shard_name(F.concat(F.lit("h"), k, F.lit("-Shard-"), k % 5, F.lit(".x"))).alias("shard"), s.shorten(n, 12).alias("short"),
        s.client_ip(F.concat(F.lit("10.1.1."), k % 250, F.lit(":"), k)).alias("ip"), s.mask_credentials(F.concat(F.lit("m://u:p"), k, F.lit("@h"), k)).alias("masked"),
        s.strip_number(F.concat(F.lit("coll_"), k)).alias("bare"), s.bucket_to_view(F.lit("db.system.buckets.metrics")).alias("view_ns"), s.view_to_bucket(F.concat(F.lit("db.m"), F.col("c_nationkey"))).alias("bucket_ns"),
    )


@query("""SELECT o_orderkey AS id, CASE WHEN b >= 1073741824 THEN printf('%.2fG', round(b / 1073741824.0, 2)) WHEN b >= 1048576 THEN printf('%.2fM', round(b / 1048576.0, 2)) WHEN b >= 1024 THEN printf('%.2fK', round(b / 1024.0, 2)) ELSE printf('%.2fB', b::DOUBLE) END AS pretty,
    (o_orderkey % 50) * 1048576 AS parsed, CASE WHEN o_custkey % 3 = 0 THEN 0.0 ELSE o_orderkey / (o_custkey % 3)::DOUBLE END AS ratio, o_orderkey + (b - o_orderkey) // 2 AS middle, o_orderkey AS log_secs, o_orderkey AS t, CAST(o_custkey % 100 AS INTEGER) AS i,
    CASE WHEN o_orderkey % 5000 = 0 THEN 'PT0S' ELSE 'PT' || CASE WHEN o_orderkey % 5000 >= 3600 THEN '1H' ELSE '' END || CASE WHEN (o_orderkey % 5000) % 3600 // 60 > 0 THEN ((o_orderkey % 5000) % 3600 // 60) || 'M' ELSE '' END || CASE WHEN (o_orderkey % 5000) % 60 > 0 THEN ((o_orderkey % 5000) % 60) || 'S' ELSE '' END END AS ttl,
    o_orderkey % 2 <> 0 AS truthy FROM (SELECT *, o_orderkey * o_custkey + o_orderkey AS b FROM orders)""")
def scalar_numbers(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    b = k * c + k
    t = s.log_time(F.concat(k, F.lit(", "), c % 100))
    return load(spark, sf, "orders").select(
        k.alias("id"), s.pretty_bytes(b, "G").alias("pretty"), s.parse_bytes(F.concat(k % 50, F.lit("MB"))).alias("parsed"), s.ratio(k, c % 3).alias("ratio"), s.midpoint(k, b).alias("middle"),
        s.log_seconds(F.shiftleft(k, 32) + 7).alias("log_secs"), t["t"].cast("long").alias("t"), t["i"].alias("i"), s.ttl_text(k % 5000).alias("ttl"), s.truthy(k % 2).alias("truthy"),
    )


@query("""SELECT c_custkey AS id, md5(c_name) AS md5, xor(list_reduce([4294967295::BIGINT] || [ascii(ch)::BIGINT FOR ch IN string_split(c_name, '')], lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) AS crc,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_reduce([CAST(ch AS INTEGER) FOR ch IN string_split(rpad(substr(bits, i * 5 + 1, 5), 5, '0'), '')], lambda a, b: a * 2 + b) AS INTEGER) + 1, 1) FOR i IN range(CAST(ceil(length(bits) / 5) AS BIGINT))], '') AS b32, substr(replace(replace(replace(base64(c_name::BLOB), '+', '-'), '/', '_'), '=', ''), 1) AS url64, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'pydriver' ELSE 'pydriver 4.' || (c_custkey % 7) END AS driver,
    CASE WHEN c_custkey % 3 = 0 THEN 'first' || c_custkey WHEN c_custkey % 3 = 1 THEN 'direct' || c_custkey END AS usr FROM (SELECT *, array_to_string([lpad(bin(ascii(ch)), 8, '0') FOR ch IN string_split(c_name, '')], '') AS bits FROM customer)""")
def scalar_sessions(spark, sf):
    """Codes of names, the driver of a session from nested metadata, and its user: the first effective one or the one named."""
    k, n = F.col("c_custkey"), F.col("c_name")
    driver = F.struct(F.struct(F.when(k % 5 != 0, "pydriver").alias("name"), F.when(k % 5 > 1, F.concat(F.lit("4."), k % 7)).alias("version")).alias("driver"))
    users = F.when(k % 3 == 0, F.array(F.struct(F.concat(F.lit("first"), k).alias("user")), F.struct(F.lit("second").alias("user"))))
    session = F.struct(users.alias("effectiveUsers"), F.when(k % 3 != 2, F.concat(F.lit("direct"), k)).alias("user"))
    return load(spark, sf, "customer").select(k.alias("id"), F.md5(n).alias("md5"), F.crc32(n.cast("binary")).alias("crc"), F.rtrim(s.base32(n.cast("binary")), F.lit("=")).alias("b32"), s.base64_url(n.cast("binary")).alias("url64"), s.driver_text(F.to_json(driver)).alias("driver"), s.first_user(F.to_json(session)).alias("usr"))


@query("""SELECT r.id, CASE WHEN id = 0 THEN -4611686018427387904 + (hi >> 1) WHEN hi IS NULL THEN (lo >> 1) + 4611686018427387903 + ((lo & 1) + 1 >> 1) ELSE lo + (hi - lo) // 2 END AS middle, CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(id * 7 AS BIGINT) END AS minutes,
    CAST(floor((10 + length(CAST(lo AS VARCHAR))) * 0.65) AS BIGINT) AS stored, lo / 1073741824.0::DOUBLE AS gb FROM ranges r""")
def scalar_ranges(spark, sf):
    """Middles of ranges with open ends, minutes since the last move, estimated sizes of documents."""
    r = d.ranges(spark, sf)
    now = F.lit("2024-05-01 12:00:00").cast("timestamp_ntz")
    moved = F.when(F.col("id") % 3 != 0, now - F.make_interval(mins=F.col("id") * 7) - F.expr("interval 20 seconds"))
    doc = F.concat(F.lit('{"sk": "'), F.col("lo").cast("string"), F.lit('"}'))
    return r.select("id", s.midpoint(F.when(F.col("id") > 0, F.col("lo")), "hi").alias("middle"), s.minutes_between(moved.cast("timestamp_ntz"), now).alias("minutes"), s.stored_size(doc).alias("stored"), s.gigabytes("lo").alias("gb"))


@query("""SELECT id, kind, CAST(row_number() OVER (ORDER BY CASE kind WHEN 'null' THEN -2 WHEN 'min' THEN -1 WHEN 'string' THEN 2 WHEN 'binary' THEN 5 WHEN 'bool' THEN 8 WHEN 'number' THEN 18 ELSE 99 END, num NULLS FIRST, txt NULLS FIRST, id) AS INTEGER) AS place FROM (
    SELECT s_suppkey AS id, CASE s_suppkey % 7 WHEN 0 THEN 'null' WHEN 1 THEN 'min' WHEN 2 THEN 'string' WHEN 3 THEN 'binary' WHEN 4 THEN 'bool' WHEN 5 THEN 'number' ELSE 'max' END AS kind,
      CASE WHEN s_suppkey % 7 IN (4, 5) THEN s_acctbal END AS num, CASE WHEN s_suppkey % 7 IN (2, 3) THEN s_name END AS txt FROM supplier)""")
def typed_order(spark, sf):
    """Values of mixed kinds in one order: missing, least key, then by rank of kind and by value, greatest key last."""
    from tidemark.operators.ranges import ranked

    k = F.col("s_suppkey") % 7
    kind = F.element_at(F.array(*map(F.lit, ("null", "min", "string", "binary", "bool", "number", "max"))), (k + 1).cast("int"))
    x = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), kind.alias("kind"), F.when(k.isin(4, 5), F.col("s_acctbal")).alias("num"), F.when(k.isin(2, 3), F.col("s_name")).alias("txt"))
    x = ranked(x.select("id", "kind", F.struct(s.kind_rank("kind").alias("r"), "num", "txt", F.col("id").alias("i")).alias("key")), "key")
    return x.select("id", "kind", F.col("r").cast("int").alias("place"))


@query("""SELECT seq, id FROM (SELECT seq, id, op, lag(op) OVER (PARTITION BY id ORDER BY ts, seq) AS before FROM log WHERE op IN ('i', 'd')) WHERE op = 'i' AND before = 'i'""")
def rejected_ops(spark, sf):
    """Inserts that an ordered bulk write has to drop, because the id is there already; the rest is retried without them."""
    from tidemark.operators import dupes

    return dupes.rejected_inserts(d.change_log(spark, sf)).select("seq", "id")


@query("""WITH x AS (SELECT id, ts, seq, value, CASE WHEN op = 'i' OR (op = 'u' AND seq % 3 = 0) THEN 'whole' WHEN op = 'u' THEN 'set' ELSE 'delete' END AS form FROM log WHERE op IN ('i', 'u', 'd')),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, seq) AS rn FROM x), w AS (SELECT id, max(rn) FILTER (form = 'whole') AS whole, max(rn) FILTER (form = 'delete') AS gone FROM r GROUP BY id)
    SELECT r.id, arg_max(r.value, r.rn) AS a, arg_max(r.value, r.rn) FILTER (form = 'whole') AS b FROM r JOIN w USING (id) WHERE w.whole > coalesce(w.gone, 0) AND r.rn >= w.whole GROUP BY r.id""")
def apply_updates(spark, sf):
    """Documents after a log whose updates replace a document whole (fields a and b) or set one field (a)."""
    from tidemark.operators import dupes

    x = d.change_log(spark, sf).where(F.col("op").isin("i", "u", "d"))
    form = F.when((F.col("op") == "i") | ((F.col("op") == "u") & (F.col("seq") % 3 == 0)), "whole").when(F.col("op") == "u", "set").otherwise("delete")
    return dupes.applied(x.withColumn("form", form))


@query("""SELECT entity, CAST(ms AS BIGINT) AS ms FROM (SELECT user_id AS entity, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) // 1000 AS ms, event_id FROM events) WHERE ms IS NOT NULL ORDER BY ms DESC, entity, event_id LIMIT 20""")
def longest_durations(spark, sf):
    """The twenty longest times between two events of an entity."""
    from pyspark.sql import Window

    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ms = F.floor((us - F.lag(us).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))) / 1000).cast("long")
    x = load(spark, sf, "events").select(F.col("user_id").alias("entity"), ms.alias("ms"), "event_id").where("ms is not null")
    return x.orderBy(F.desc("ms"), "entity", "event_id").limit(20).select("entity", "ms")


@query("SELECT 'user' || c_nationkey AS usr, 'db' || (c_custkey % 2) AS db, string_agg(DISTINCT 'role' || (c_custkey % 5), ',' ORDER BY 'role' || (c_custkey % 5)) AS roles FROM customer GROUP BY 1, 2 ORDER BY 2, 1")
def users_scan(spark, sf):
    """Users with their roles, sorted by their id (database and name)."""
    k = F.col("c_custkey")
    g = load(spark, sf, "customer").groupBy(F.concat(F.lit("user"), "c_nationkey").alias("usr"), F.concat(F.lit("db"), k % 2).alias("db")).agg(F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("role"), k % 5))), ",").alias("roles"))
    return g.orderBy("db", "usr")


@query("""SELECT event_id AS seq, CAST(event_id % 6 AS INTEGER) AS attempt, CASE WHEN event_id % 6 + 1 < 5 THEN ts + to_seconds(CAST(2 ** (event_id % 6 + 1) - 1 + 10 * (event_id % 6 + 1) AS BIGINT)) END AS next_at FROM events WHERE event_type = 'error'""")
def retry_schedule(spark, sf):
    """When failed operations are tried again: each try waits two to the power of its number, and ten seconds; after five there is no other."""
    wait = F.aggregate(F.sequence(F.lit(0), F.col("attempt")), F.lit(0).cast("long"), lambda acc, n: acc + F.pow(F.lit(2), n).cast("long") + 10)
    x = load(spark, sf, "events").where("event_type = 'error'").select(F.col("event_id").alias("seq"), (F.col("event_id") % 6).cast("int").alias("attempt"), "ts")
    return x.select("seq", "attempt", F.when(F.col("attempt") + 1 < 5, F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + wait * 1_000_000).cast("timestamp_ntz")).alias("next_at"))


@query("""SELECT c_custkey AS id, CASE WHEN h >= 9223372036854775808 THEN CAST(h - 18446744073709551616 AS BIGINT) ELSE CAST(h AS BIGINT) END AS hash64, u[:8] || '-' || u[9:12] || '-' || u[13:16] || '-' || u[17:20] || '-' || u[21:32] AS standard,
    u[7:8] || u[5:6] || u[3:4] || u[1:2] || '-' || u[11:12] || u[9:10] || '-' || u[15:16] || u[13:14] || '-' || u[17:20] || '-' || u[21:32] AS legacy,
    CASE c_custkey % 6 WHEN 5 THEN NULL ELSE c_custkey * 1024 ** (c_custkey % 6)::BIGINT END::BIGINT AS bytes FROM (SELECT *, md5(c_name) AS u, CAST('0x' || substr(md5(c_name), 1, 16) AS UBIGINT)::HUGEINT AS h FROM customer)""")
def scalar_ids(spark, sf):
    """64-bit hashes of text, 16 bytes as identifiers in both byte orders, sizes in all units as bytes (text of no size is null)."""
    k, raw = F.col("c_custkey"), F.unhex(F.md5("c_name"))
    size = F.concat(k.cast("string"), F.element_at(F.array(*map(F.lit, ("B", "KB", " MB", "gb ", "T", "XB"))), (k % 6 + 1).cast("int")))
    return load(spark, sf, "customer").select(k.alias("id"), s.hash64("c_name").alias("hash64"), s.uuid_text(raw).alias("standard"), s.uuid_text(raw, legacy=True).alias("legacy"), s.parse_bytes(size).alias("bytes"))


# --- streams ---


def log_stream(spark, sf):
    return d.log_of(streams.tail(spark, f"{sf}/events.parquet*", load(spark, sf, "events").schema))


@query("SELECT seq, ts, id, op, ns FROM log WHERE op <> 'n'")
def stream_tail(spark, sf):
    return streams.run_once(log_stream(spark, sf).where("op <> 'n'").select("seq", "ts", "id", "op", "ns"))


@query("""SELECT date_trunc('minute', ts) + to_minutes((65 - minute(ts)) % 5) AS bucket, shard, ns, op, CAST(count(*) AS BIGINT) AS count, min(size) AS min_size, max(size) AS max_size, CAST(sum(size) AS BIGINT) AS total_size
    FROM log WHERE op <> 'n' AND ns NOT LIKE 'config.%' GROUP BY ALL""")
def stream_stats(spark, sf):
    x = log_stream(spark, sf).where((F.col("op") != "n") & ~F.col("ns").startswith("config."))
    return streams.run_once(streams.windowed_stats(x), mode="complete")


@query("SELECT entity, ts, seq, CAST(coalesce(counter - lag(counter) OVER (PARTITION BY entity ORDER BY ts, seq), 0) AS BIGINT) AS delta FROM snap")
def stream_deltas(spark, sf):
    """Changes of counters through a stream of readings, the last of each entity kept as state."""
    from tidemark.sources.work import fresh_path

    path = fresh_path(spark, "readings")
    x = d.snapshots(spark, sf).select("entity", "ts", "seq", "counter")
    x.repartitionByRange(4, "ts").sortWithinPartitions("ts", "seq").write.parquet(path)
    return streams.counter_deltas(streams.tail(spark, path, x.schema))


@query("""WITH s AS (SELECT DISTINCT ns, op, CAST(day(ts) AS INTEGER) AS day FROM log WHERE day(ts) IN (1, 2, 3)) SELECT ns, op, 'new' AS change, day FROM s b WHERE day > 1 AND NOT EXISTS (SELECT 1 FROM s a WHERE a.ns = b.ns AND a.op = b.op AND a.day = b.day - 1)
    UNION ALL SELECT ns, op, 'dropped', day + 1 FROM s a WHERE day < 3 AND NOT EXISTS (SELECT 1 FROM s b WHERE a.ns = b.ns AND a.op = b.op AND b.day = a.day + 1)""")
def catalog_polls(spark, sf):
    """Three polls of a catalog, each against the one before, which a table with versions keeps."""
    from functools import reduce

    from tidemark.sources.work import fresh_path

    folder, log = fresh_path(spark, "catalog"), d.change_log(spark, sf)
    polls = []
    for day in (1, 2, 3):
        now = log.where(F.dayofmonth("ts") == day).select("ns", "op")
        polls.append(streams.catalog_changes(spark, folder, now, f"day-{day}").withColumn("day", F.lit(day)))
    return reduce(lambda a, b: a.unionByName(b), polls)


@query("""SELECT * FROM (SELECT date_trunc('minute', ts) + to_minutes((65 - minute(ts)) % 5) AS bucket, shard, ns, op, CAST(count(*) AS BIGINT) AS count, min(size) AS min_size, max(size) AS max_size, CAST(sum(size) AS BIGINT) AS total_size
    FROM log WHERE op <> 'n' GROUP BY ALL) WHERE bucket + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM log WHERE op <> 'n')""")
def stream_windows(spark, sf):
    """The same windows in append mode: those that the watermark has passed, each written once."""
    return streams.run_once(streams.windowed_stats(log_stream(spark, sf).where("op <> 'n'")))


@query("""SELECT id, op AS last_op, value FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM log WHERE op IN ('i', 'u', 'd') AND ns NOT LIKE 'config.%' AND ns NOT LIKE 'admin.%') WHERE rn = 1 AND op <> 'd'""")
def stream_compact(spark, sf):
    x = log_stream(spark, sf).where(~F.col("ns").startswith("config.") & ~F.col("ns").startswith("admin."))
    return streams.merge_batches(x)
