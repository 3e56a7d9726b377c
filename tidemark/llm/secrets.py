"""Secret scan with corpus-wide ownership frequency.

Candidates are found in whole texts; each value is hashed at once and never leaves the scan in the
clear. Over the corpus a hash is counted by distinct repositories (documents) and owners (sources).
A value that several owners hold, or that is spread over many repositories of whatever owner, is a widely
copied example; one that is specific to its owner, in few repositories, and that looks random is live. The
verdict adds spans: a bare token that equals a live assigned value is a finding too, whatever marks of
punctuation or padding end it. Copies of one document count as repositories of their own, so near copies
are best removed before.

Null texts have no findings, a null owner counts as one owner, a null doc_id as one repository. Very long texts
are scanned whole, one at a time; ties in place are ordered by kind; repeated rows give repeated results,
texts without candidates give zeros, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import map_arrow, materialize, own_text_exchange

#: Fixed patterns of the base findings: kind, pattern, group of the value, its least length.
BASE_PATTERNS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: Bare tokens that may repeat a value assigned elsewhere, and what may end a value without being part of it.
BARE, LEAST_BARE, TAIL = r"[A-Za-z0-9+/_.-]{8,}", 8, ".="
KINDS = ("assign", "access", "hex", "bare")
#: Owners (all, where the corpus has fewer) and repositories from which on a value is a copied example; bits of
#: entropy a character that a live one has at least.
EXAMPLE_OWNERS, EXAMPLE_REPOS, LIVE_BITS = 3, 25, 2.5


def scan(text: str, rules, bare) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) in code points; leftmost and non-overlapping within each kind."""
    out = []
    for kind, pattern, group, least in rules:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end(), m.group(group)))
    taken = sorted((s, e) for _, s, e, _ in out)
    at = far = 0  # findings that start before a token, and the furthest end of those
    for m in bare.finditer(text):
        v = m.group().rstrip(TAIL)
        start, end = m.start(), m.start() + len(v)
        while at < len(taken) and taken[at][0] < end:
            far = max(far, taken[at][1])
            at += 1
        if len(v) >= LEAST_BARE and far <= start and any(c.isdigit() for c in v) and any(c.isalpha() for c in v):
            out.append(("bare", start, end, v))
    return out


def looks_live(value: str) -> bool:
    """Random enough: bits a character over its own frequencies, and no run of one character as in placeholders."""
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in map(value.count, set(value)))
    return bits >= LIVE_BITS and not re.search(r"(.)\1{5}|(?i:example|placeholder|changeme|your)", value)


CAND = "array<struct<kind:string,start:bigint,end:bigint,h:string,live:boolean>>"


def candidates(docs: DataFrame, *keys: str) -> DataFrame:
    """The columns ``keys`` of each document and its candidates ``cands``."""

    def find(batches):
        rules = [(k, re.compile(p, re.ASCII), g, n) for k, p, g, n in BASE_PATTERNS]
        rules[2] = ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32)  # the same spans: a run is taken from its first character
        bare = re.compile(BARE)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("h", pa.string()), ("live", pa.bool_())]))
        for batch in batches:
            cands = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                cands.append([{"kind": k, "start": s, "end": e, "h": hashlib.sha256(v.rstrip(TAIL).encode("utf-8", "surrogatepass")).hexdigest()[:32], "live": looks_live(v)} for k, s, e, v in (scan(text, rules, bare) if text else [])])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(cands, kind)], names=[*batch.schema.names[:-1], "cands"])

    rows = docs.select(*keys, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return map_arrow(rows, find, f"{schema}, cands {CAND}")


def ownership(found: DataFrame, repo: str, owner: str) -> DataFrame:
    """For each candidate hash: distinct repositories and owners, and whether it is assigned or of a fixed form anywhere.

    Counts are partial sums over (hash, owner) first, so a value that a third of all rows hold is no hot key.
    """
    owners = max(2, found.select(owner).distinct().limit(EXAMPLE_OWNERS).count())
    each = found.select(F.col(repo).alias("_r"), F.col(owner).alias("_o"), F.explode("cands").alias("c"))
    each = each.groupBy(F.col("c.h").alias("h"), "_o", "_r").agg(F.max((F.col("c.kind") != "bare").cast("int")).alias("base"), F.max(F.col("c.live").cast("int")).alias("live"))
    by_owner = each.groupBy("h", "_o").agg(F.count(F.lit(1)).alias("repos"), F.max("base").alias("base"), F.max("live").alias("live"))
    per = by_owner.groupBy("h").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"), F.max("base").alias("base"), F.max("live").alias("live"))
    copied = (F.col("n_owners") >= min(EXAMPLE_OWNERS, owners)) | (F.col("n_repos") >= EXAMPLE_REPOS)
    return per.where("base = 1").select("h", "n_repos", "n_owners", (~copied & (F.col("live") == 1)).alias("is_live"))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def findings(docs: DataFrame, repo: str = "doc_id", owner: str = "source", *keys: str) -> DataFrame:
    """One row per document: its keys and ``found``, the spans with kind, place, hash, owners and verdict."""
    cols = list(dict.fromkeys((repo, owner, *keys)))
    found = materialize(candidates(docs, *cols).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    verdicts = ownership(found, repo, owner)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("c.kind"))
    each = found.select("_row", F.explode("cands").alias("c")).select("_row", "c", F.col("c.h").alias("h"))
    each = each.join(verdicts.select(own_text_exchange("h"), *[c for c in verdicts.columns if c != "h"]), "h", "left")
    keep = (F.col("c.kind") != "bare") | F.coalesce(F.col("is_live"), F.lit(False))
    span = F.struct(F.col("c.start").alias("start"), rank.cast("int").alias("rank"), F.col("c.kind").alias("kind"), F.col("c.end").alias("end"), "h", F.coalesce("n_owners", F.lit(0)).alias("n_owners"), F.coalesce("n_repos", F.lit(0)).alias("n_repos"), F.coalesce("is_live", F.lit(False)).alias("is_live"))
    spans = each.where(keep).groupBy("_row").agg(F.collect_list(span).alias("found"))
    return found.select("_row", *cols).join(spans, "_row", "left").drop("_row").withColumn("found", F.coalesce("found", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,h:string,n_owners:bigint,n_repos:bigint,is_live:boolean>>")))


def digest(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans of every document."""
    f = findings(docs)
    of = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] != "bare")
    return f.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), F.size(F.filter("found", lambda s: s["is_live"])).cast("long").alias("n_live"), of("bare").alias("n_added"))


def mask_spans(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """``text`` with each of the ascending spans replaced; those that overlap share one mask. One pass, whatever their number."""
    out, at = [], 0
    for start, end in spans:
        if end > at:
            if start >= at:
                out += [text[at:start], mask]
            at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with live findings masked in ``text`` (and ``n_chars`` counted anew where it exists); copied examples stay."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "source", "text", F.xxhash64("text").alias("key")).alias("d")
    found = findings(keyed.select("doc_id", "source", "text", "key"), "doc_id", "source", "key")
    spans = F.transform(F.array_sort(F.filter("found", lambda s: s["is_live"])), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    live = found.select("doc_id", "key", spans.alias("cut")).where(F.size("cut") > 0).dropDuplicates(["doc_id", "key"]).alias("l")
    got = keyed.join(live, F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.key") == F.col("l.key")), "left").select("d.doc", "d.text", "l.cut")

    @F.pandas_udf("string")
    def masked(text: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or c is None else mask_spans(t, [(s["start"], s["end"]) for s in c], mask) for t, c in zip(text, cuts, strict=True)])

    text = masked(F.when(F.col("cut").isNotNull(), F.col("text")), "cut")  # only texts with live findings go to Python
    got = got.withColumn("text", F.when(F.col("cut").isNotNull(), text).otherwise(F.col("text")))
    out = {c: F.col(f"doc.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in out:
        out["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return got.select(*[x.alias(c) for c, x in out.items()])
