"""Registration of queries, and the derived inputs in SQL that their oracles share."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}

#: Named inputs, each a SELECT over the test tables; ``tidemark.sources.derived`` builds the same in Spark.
INPUTS = {
    "src": """SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
        strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS prio FROM orders""",
    "dst": """SELECT k, cust, status, cents + CASE WHEN k % 89 = 0 THEN 100 ELSE 0 END AS cents, day, prio FROM src WHERE k % 97 <> 0
        UNION ALL SELECT k + 100000000, cust, status, cents, day, prio FROM src WHERE k % 101 = 0""",
    "hsrc": """SELECT k, md5(coalesce(length(CAST(k AS VARCHAR)) || ':' || CAST(k AS VARCHAR), '-') || coalesce(length(CAST(cust AS VARCHAR)) || ':' || CAST(cust AS VARCHAR), '-') || coalesce(length(CAST(status AS VARCHAR)) || ':' || CAST(status AS VARCHAR), '-') || coalesce(length(CAST(cents AS VARCHAR)) || ':' || CAST(cents AS VARCHAR), '-') || coalesce(length(CAST(day AS VARCHAR)) || ':' || CAST(day AS VARCHAR), '-') || coalesce(length(CAST(prio AS VARCHAR)) || ':' || CAST(prio AS VARCHAR), '-')) AS h FROM src""",
    "hdst": """SELECT k, md5(coalesce(length(CAST(k AS VARCHAR)) || ':' || CAST(k AS VARCHAR), '-') || coalesce(length(CAST(cust AS VARCHAR)) || ':' || CAST(cust AS VARCHAR), '-') || coalesce(length(CAST(status AS VARCHAR)) || ':' || CAST(status AS VARCHAR), '-') || coalesce(length(CAST(cents AS VARCHAR)) || ':' || CAST(cents AS VARCHAR), '-') || coalesce(length(CAST(day AS VARCHAR)) || ':' || CAST(day AS VARCHAR), '-') || coalesce(length(CAST(prio AS VARCHAR)) || ':' || CAST(prio AS VARCHAR), '-')) AS h FROM dst""",
    # states by comparison of fields, not of hashes
    "diffed": """SELECT coalesce(s.k, d.k) AS k, CASE WHEN s.here IS NULL THEN 'dest_only' WHEN d.here IS NULL THEN 'source_only'
        WHEN s.cust IS NOT DISTINCT FROM d.cust AND s.status IS NOT DISTINCT FROM d.status AND s.cents IS NOT DISTINCT FROM d.cents AND s.day IS NOT DISTINCT FROM d.day AND s.prio IS NOT DISTINCT FROM d.prio
        THEN 'match' ELSE 'mismatch' END AS status FROM (SELECT *, true AS here FROM src) s FULL OUTER JOIN (SELECT *, true AS here FROM dst) d ON s.k = d.k""",
    "log": """SELECT event_id AS seq, ts, user_id AS id,
        CASE event_type WHEN 'signup' THEN 'i' WHEN 'click' THEN 'u' WHEN 'view' THEN 'u' WHEN 'purchase' THEN 'd' ELSE CASE WHEN event_id % 2 = 0 THEN 'n' ELSE 'c' END END AS op,
        CASE WHEN user_id % 29 = 0 THEN 'config.chunks' WHEN user_id % 31 = 0 THEN 'admin.users' ELSE 'db' || (user_id % 3) || '.c' || (user_id % 5) END AS ns,
        CAST(length(props) AS BIGINT) AS size, 'shard' || (user_id % 4) AS shard, event_id % 37 = 0 AS from_migrate, value FROM events""",
    "kept_log": "SELECT * FROM log WHERE op <> 'n' AND NOT from_migrate AND ns NOT LIKE 'config.%' AND ns NOT LIKE 'admin.%'",
    "width": "SELECT CAST(ceil((max(o_orderkey) + 1) / 16.0) AS BIGINT) AS w FROM orders",
    "ranges": """SELECT CAST(i AS BIGINT) AS id, 'db.orders' AS ns, i * w AS lo, CASE WHEN i = 15 THEN NULL ELSE (i + 1) * w END AS hi, 'shard' || (i // 2 % 3) AS shard,
        i = 7 AS jumbo FROM width, (SELECT unnest(range(16)) AS i)""",
    "uranges": "SELECT CAST(i AS BIGINT) AS id, CAST(i * 20 AS BIGINT) AS lo, CASE WHEN i = 7 THEN NULL ELSE CAST((i + 1) * 20 AS BIGINT) END AS hi, 'shard' || (i % 3) AS shard FROM (SELECT unnest(range(8)) AS i)",
    "activity": """SELECT l.ns, r.id AS range_id, r.shard, CAST(count(*) AS BIGINT) AS cnt FROM kept_log l JOIN uranges r ON l.id >= r.lo AND (r.hi IS NULL OR l.id < r.hi) GROUP BY ALL""",
    "load": "SELECT ns, shard, CAST(sum(cnt) AS BIGINT) AS total_ops, CAST(count(*) AS BIGINT) AS active_chunks FROM activity GROUP BY ALL",
    "targets": """SELECT ns, shard, CAST(total_ops AS BIGINT) AS total_ops, CAST(active_chunks AS BIGINT) AS active_chunks, CAST(target - total_ops AS BIGINT) AS delta_ops,
        round(CASE WHEN target = 0 THEN 0.0 ELSE 100.0 * total_ops / target END, 4) AS delta_pct,
        seen AND (abs(CASE WHEN target = 0 THEN 0.0 ELSE 100.0 * total_ops / target END - 100) >= 3.0 OR total_ops = 0) AND active_chunks > 1 AS above
        FROM (SELECT n.ns, s.shard, coalesce(l.total_ops, 0) AS total_ops, coalesce(l.active_chunks, 0) AS active_chunks, l.ns IS NOT NULL AS seen,
          CAST(sum(coalesce(l.total_ops, 0)) OVER (PARTITION BY n.ns) AS BIGINT) // count(*) OVER (PARTITION BY n.ns) AS target
          FROM (SELECT DISTINCT ns FROM load) n CROSS JOIN (SELECT DISTINCT shard FROM uranges) s LEFT JOIN load l ON l.ns = n.ns AND l.shard = s.shard)""",
    "pairs": """SELECT a.ns, a.rn AS pair_no, a.shard AS from_shard, b.shard AS to_shard FROM
        (SELECT *, CAST(row_number() OVER (PARTITION BY ns ORDER BY total_ops DESC, shard) AS INTEGER) AS rn, sum(above::INT) OVER (PARTITION BY ns) AS n FROM targets) a
        JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY ns ORDER BY total_ops, shard DESC) AS INTEGER) AS rn FROM targets) b ON a.ns = b.ns AND a.rn = b.rn
        WHERE a.above AND NOT (NOT b.above AND b.total_ops > 0) AND a.shard <> b.shard AND a.rn <= least(2, a.n)""",
    "dup": "SELECT k, cust, status, cents, 1 AS part FROM src UNION ALL SELECT k, cust, status, cents + 1, 2 FROM src WHERE k % 50 = 0 UNION ALL SELECT k, cust, status, cents + 2, 3 FROM src WHERE k % 200 = 0",
    "dup_ids": "SELECT k, CAST(count(*) AS BIGINT) AS copies FROM dup GROUP BY k HAVING count(*) > 1",
    "archive": """SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY cents, part) AS INTEGER) AS copy_no, cust, status, cents FROM dup WHERE k IN (SELECT k FROM dup_ids)""",
    "snap": """SELECT user_id AS entity, ts, event_id AS seq, 'shard' || (user_id % 4) AS shard, 'db' || (user_id % 3) || '.c' || (user_id % 5) AS ns,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS counter FROM events""",
    "nsmetric": "SELECT ns, shard, round(sum(value), 2) AS v FROM log GROUP BY ns, shard",
    "sess": """SELECT c_custkey AS id, CASE WHEN c_custkey % 13 = 0 THEN '(no appName)' ELSE c_mktsegment END AS app, 'user' || c_nationkey AS usr, '10.0.' || (c_custkey % 7) || '.' || (c_custkey % 11) AS ip,
        CASE WHEN c_custkey % 4 = 0 THEN 'java 4.' ELSE 'python 3.' END || (c_custkey % 3) AS driver, CASE WHEN c_custkey % 5 = 0 THEN 'command' ELSE 'query' END AS op,
        c_acctbal > 0 AS active, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(trunc(c_acctbal) AS BIGINT) END AS secs FROM customer""",
    "idx": """SELECT 'db' || (p_partkey % 2) AS db, 'db' || (p_partkey % 2) || '.' || p_brand AS ns, p_type AS name, CAST(sum(CASE WHEN p_partkey % 4 = 0 THEN p_size % 5 ELSE 0 END) AS BIGINT) AS primary_ops,
        CAST(sum(CASE WHEN p_partkey % 4 = 1 THEN p_size % 3 ELSE 0 END) AS BIGINT) AS secondary_ops, CAST(sum(p_size) * 1024 AS BIGINT) AS size_bytes, min(TIMESTAMP '2024-01-01' + to_days(p_size)) AS since, p_type = 'SMALL' AS shard_key FROM part GROUP BY ALL""",
    "ispec_a": "SELECT DISTINCT p_brand AS ns, p_type AS name, p_type || '_1' AS key, p_type = 'PROMO' AS uniq, false AS sparse, CASE WHEN p_type = 'ECONOMY' THEN 86400 END AS ttl FROM part",
    "ispec_b": """SELECT ns, name, key, CASE WHEN ns = 'Brand#3' THEN NOT uniq ELSE uniq END AS uniq, ns = 'Brand#4' AS sparse, CASE WHEN ns = 'Brand#5' AND ttl IS NOT NULL THEN 172800 ELSE ttl END AS ttl
        FROM ispec_a WHERE NOT (ns = 'Brand#6' AND name = 'LARGE')""",
    "chunks_a": "SELECT ns || '_' || lo || '_' || coalesce(CAST(hi AS VARCHAR), 'max') AS chunk_id, ns, shard FROM ranges",
    "chunks_b": "SELECT chunk_id, ns, CASE WHEN chunk_id LIKE '%max' THEN 'shard9' ELSE shard END AS shard FROM chunks_a WHERE chunk_id NOT LIKE 'db.orders_0_%'",
    "grants": "SELECT DISTINCT 'role' || c_nationkey AS role, 'db' || (c_custkey % 2) || '.' || lower(c_mktsegment) AS resource, CASE c_custkey % 5 WHEN 0 THEN 'find' WHEN 1 THEN 'insert' WHEN 2 THEN 'update' WHEN 3 THEN 'remove' ELSE 'find' END AS action FROM customer",
    "colls": "SELECT 'db' || (s_nationkey % 4) || '.n' || s_nationkey AS ns, 'shard' || (s_suppkey % 3) AS shard, md5('n' || s_nationkey || CASE WHEN s_nationkey % 7 = 0 AND s_suppkey % 3 = 1 THEN 'x' ELSE '' END) AS uuid FROM supplier",
    "dupx": "SELECT d.k, d.part, r.id AS range_id, r.shard FROM (SELECT k, part, CASE WHEN part = 2 THEN (k * 7) % (SELECT max(k) + 1 FROM src) ELSE k END AS place FROM dup) d JOIN ranges r ON d.place >= r.lo AND (r.hi IS NULL OR d.place < r.hi)",
    "conf": "SELECT k, shard, CAST(count(*) AS BIGINT) AS n FROM dupx WHERE k IN (SELECT k FROM dup_ids) GROUP BY k, shard HAVING count(*) > 1",
}


def with_inputs(sql: str) -> str:
    """Prefix ``sql`` with the inputs that it names, directly or through others, in their order."""
    import re

    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in INPUTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(INPUTS[name])

    visit(sql)
    if not needed:
        return sql
    head = ",\n".join(f"{n} AS ({INPUTS[n]})" for n in INPUTS if n in needed)
    return f"WITH {head}\n{sql.strip().removeprefix('WITH ')}" if not sql.strip().startswith("WITH ") else f"WITH {head},\n{sql.strip()[5:]}"


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with the SQL that gives the same rows."""

    def register(f):
        name = f.__name__.rstrip("_")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_inputs(sql)
        return f

    return register
