"""Scalar expressions; everything stays in the JVM except ``query_shape``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

UNITS = ("B", "K", "M", "G", "T")


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- hashes and codecs ---


def encoded(x: str) -> Column:
    """A value as text with its length before it, so that values put together can be told apart; null is a dash."""
    text = F.col(x).cast("string")
    return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))


def row_hash(*cols: str) -> Column:
    """md5 over the columns in this order."""
    return F.md5(F.concat(F.lit(""), *[encoded(x) for x in cols]))


def row_hash_unordered(*cols: str) -> Column:
    """The same for any order of the columns: names and values are sorted first."""
    return F.md5(F.array_join(F.array_sort(F.array(*[F.concat(F.lit(f"{len(x)}:{x}="), encoded(x)) for x in cols])), ""))


def row_bytes(*cols: str) -> Column:
    """Bytes of the row as text: what a copy of it has to carry."""
    return sum((F.coalesce(F.octet_length(F.col(x).cast("string")), F.lit(0)) for x in cols), F.lit(0)).cast("long")


def hash64(text) -> Column:
    """The first eight bytes of the md5 as a signed 64-bit number."""
    return F.conv(F.substring(F.md5(c(text)), 1, 16), 16, -10).cast("long")


def base64_url(raw) -> Column:
    return F.regexp_replace(F.translate(F.base64(c(raw)), "+/", "-_"), "=", "")


def base32(raw) -> Column:
    """The bits of the bytes in fives, each a letter, filled up with ``=`` to eight."""
    nibbles = F.regexp_extract_all(F.hex(c(raw)), F.lit("[0-9A-F]"), F.lit(0))
    bits = F.array_join(F.transform(nibbles, lambda h: F.lpad(F.conv(h, 16, 2), 4, "0")), "")
    fives = F.regexp_extract_all(F.rpad(bits, F.ceil(F.length(bits) / 5).cast("int") * 5, "0"), F.lit("[01]{5}"), F.lit(0))
    letters = F.array_join(F.transform(fives, lambda f: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.conv(f, 2, 10).cast("int") + 1, F.lit(1))), "")
    return F.rpad(letters, F.ceil(F.length(letters) / 8).cast("int") * 8, "=")


#: Fixed: seconds of a year, and years that expiry is put off while data moves.
YEAR_SECONDS, EXTENDED_YEARS = 31_536_000, 50


def extended_ttl(seconds) -> Column:
    """The expiry that an index gets while data moves: fifty years where it has one, null where it has none."""
    return F.when(c(seconds).isNotNull(), F.lit(YEAR_SECONDS * EXTENDED_YEARS)).cast("long")


def uuid_text(raw, legacy: bool = False) -> Column:
    """A 16-byte value as a UUID; ``legacy`` values have the first three groups in little-endian order."""
    h = F.lower(F.hex(c(raw)))
    pick = lambda *at: F.concat(*[F.substring(h, i, 2) for i in at])
    if not legacy:
        groups = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    else:
        groups = [pick(7, 5, 3, 1), pick(11, 9), pick(15, 13), F.substring(h, 17, 4), F.substring(h, 21, 12)]
    return F.when(F.length(c(raw)) == 16, F.concat_ws("-", *groups))


# --- names ---


def ns_db(ns) -> Column:
    """The database: what stands before the first dot; null without a dot."""
    return F.when(F.instr(c(ns), ".") > 0, F.substring_index(c(ns), ".", 1))


def ns_collection(ns) -> Column:
    return F.when(F.instr(c(ns), ".") > 0, F.regexp_extract(c(ns), r"^.*?\.(.*)$", 1))


def is_system_db(db) -> Column:
    x = c(db)
    return x.isin("admin", "config", "local", "system") | x.startswith("__mdb_internal") | x.contains("$")


def bucket_to_view(ns) -> Column:
    return F.regexp_replace(c(ns), r"^([^.]*)\.system\.buckets\.", "$1.")


def view_to_bucket(ns) -> Column:
    return F.when(c(ns).rlike(r"^[^.]*\.system\.buckets\."), c(ns)).otherwise(F.regexp_replace(c(ns), r"^([^.]*)\.", "$1.system.buckets."))


def client_ip(client) -> Column:
    """Up to the last colon."""
    return F.regexp_extract(c(client), "^(.*):[^:]*$", 1)


def shard_name(host) -> Column:
    return F.lower(F.regexp_extract(c(host), r"(?i)(shard[-_]?\d+)", 1))


def strip_number(name) -> Column:
    return F.regexp_replace(c(name), r"_\d+$", "")


def mask_credentials(uri) -> Column:
    return F.regexp_replace(c(uri), "://[^@]+@", "://*****@")


def shorten(text, n: int, dots: str = "...") -> Column:
    return F.when(F.length(c(text)) > n, F.concat(F.substring(c(text), 1, n - len(dots)), F.lit(dots))).otherwise(c(text))


# --- numbers and times ---


def pretty_bytes(n, last: str = UNITS[-1]) -> Column:
    """Bytes in the largest unit up to ``last`` that they fill."""
    x = c(n).cast("double")
    out = F.format_string("%.2fB", x)
    for i, unit in enumerate(UNITS[1 : UNITS.index(last) + 1], 1):
        out = F.when(x >= 1024.0**i, F.format_string(f"%.2f{unit}", x / 1024.0**i)).otherwise(out)
    return out


def parse_bytes(text) -> Column:
    """``10MB`` as a number of bytes; null where it has no such form."""
    form = r"^\s*([0-9]+)\s*([KMGT]?)B?\s*$"
    t = F.upper(c(text))
    scale = F.element_at(F.create_map(*[x for i, u in enumerate(("", *UNITS[1:])) for x in (F.lit(u), F.lit(1024**i))]), F.regexp_extract(t, form, 2))
    return F.when(t.rlike(form), F.regexp_extract(t, form, 1).cast("long") * scale)


def gigabytes(n) -> Column:
    return c(n) / F.lit(1024.0**3)


def ratio(a, b) -> Column:
    return F.coalesce(F.try_divide(c(a).cast("double"), c(b).cast("double")), F.lit(0.0))


def midpoint(lo, hi) -> Column:
    """The middle of two long keys; a null end is open and counts as the type's least or greatest value."""
    low, high = F.coalesce(c(lo), F.lit(-(1 << 63))), F.coalesce(c(hi), F.lit((1 << 63) - 1))
    # halves first: the difference of open ends does not fit
    return F.shiftright(low, 1) + F.shiftright(high, 1) + F.shiftright((low.bitwiseAND(F.lit(1)) + high.bitwiseAND(F.lit(1))).cast("long"), 1)


def per_hour(amount, seconds) -> Column:
    """Gigabytes an hour from bytes and seconds of running; 0 where either is missing or no time has passed."""
    return F.when(F.coalesce(c(seconds), F.lit(0)) > 0, F.coalesce(gigabytes(amount), F.lit(0.0)) / (c(seconds) / 3600.0)).otherwise(0.0)


def stored_size(json) -> Column:
    """Estimated bytes of a stored document: the binary form takes about 0.65 of its JSON."""
    return F.floor(F.octet_length(c(json)) * 0.65).cast("long")


def minutes_between(since, now) -> Column:
    """Whole minutes; null where it never happened."""
    return F.floor((F.unix_micros(c(now).cast("timestamp")) - F.unix_micros(c(since).cast("timestamp"))) / 60_000_000).cast("long")


def key_pattern(names, kinds) -> Column:
    """An index key as JSON, in order; numbers bare, kinds such as hashed or text quoted."""
    bare = lambda x: F.when(x.rlike(r"^-?\d+(\.\d+)?$"), x).otherwise(F.concat(F.lit('"'), x, F.lit('"')))
    pair = F.zip_with(c(names), c(kinds), lambda n, k: F.concat(F.lit('"'), n, F.lit('": '), bare(k)))
    return F.concat(F.lit("{"), F.array_join(pair, ", "), F.lit("}"))


def normal_key(pattern) -> Column:
    """A key pattern with whole numbers in one form: 1, 1.0 and 1.00 are the same direction."""
    return F.regexp_replace(F.regexp_replace(c(pattern), r"\s+", ""), r"(:-?\d+)\.0+(?=[,}])", "$1")


#: Fixed phrase of a log that a coordinator waits for.
TRIGGER = "READY_FOR_PAUSE"


def is_trigger(line) -> Column:
    return c(line).contains(TRIGGER)


def driver_text(meta) -> Column:
    """Name and version of the driver in a session's JSON metadata; null without a name."""
    name, version = F.get_json_object(c(meta), "$.driver.name"), F.get_json_object(c(meta), "$.driver.version")
    return F.when(name.isNotNull(), F.concat_ws(" ", name, version))


def first_user(session) -> Column:
    """The user of a session: the first effective one, else the one named directly."""
    return F.coalesce(F.get_json_object(c(session), "$.effectiveUsers[0].user"), F.get_json_object(c(session), "$.user"))


#: Fixed ranks of value kinds where kinds differ; numbers of all kinds compare by value, at the rank of 64-bit ones.
KIND_RANK = {"null": -2, "min": -1, "string": 2, "object": 3, "array": 4, "binary": 5, "id": 7, "bool": 8, "date": 9, "number": 18, "max": 99}


def kind_rank(kind) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in KIND_RANK.items() for x in kv]), c(kind))


def log_seconds(ts64) -> Column:
    """Seconds of a 64-bit log time whose lower half is a counter."""
    return F.shiftright(c(ts64), 32)


def log_time(text) -> Column:
    """``seconds,increment`` as a struct."""
    parts = F.split(c(text), ",")
    return F.struct(F.trim(parts[0]).cast("int").alias("t"), F.trim(parts[1]).cast("int").alias("i"))


def iso_utc(ts) -> Column:
    return F.date_format(c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def bucket5_ceil(ts) -> Column:
    """Seconds dropped, then up to the next multiple of five minutes."""
    minute = F.date_trunc("minute", c(ts))
    return (minute + F.make_interval(mins=(65 - F.minute(minute)) % 5)).cast("timestamp_ntz")


def ttl_text(seconds) -> Column:
    s = c(seconds)
    part = lambda n, unit: F.when(n > 0, F.concat(n.cast("string"), F.lit(unit))).otherwise("")
    return F.when(s == 0, "PT0S").otherwise(F.concat(F.lit("PT"), part(F.floor(s / 3600), "H"), part(F.floor(s % 3600 / 60), "M"), part(s % 60, "S")))


def truthy(x) -> Column:
    return F.coalesce(c(x).cast("double") != 0, F.lit(False))


# --- shapes of predicates ---

LOGICAL = ("$and", "$or", "$nor")


def shape_of(text: str | None) -> str | None:
    """Literal values become 1, keys are sorted, lists of logical operators keep their order; with the fields used."""
    import json

    if text is None:
        return None
    try:
        doc = json.loads(text)
    except ValueError:
        return None
    if not isinstance(doc, dict):
        return None
    fields: set[str] = set()

    def walk(d: dict) -> dict:
        out = {}
        for k, v in d.items():
            if k.strip().lower() in LOGICAL:
                out[k] = [walk(x) for x in v if isinstance(x, dict)] if isinstance(v, list) else 1
            else:
                out[k] = walk(v) if isinstance(v, dict) else 1
                if not k.startswith("$") and k != "find":
                    fields.add(k)
        return dict(sorted(out.items()))

    shape = walk(doc)
    return json.dumps({"shape": shape, "fields": sorted(fields)}, separators=(",", ":"))


@F.pandas_udf(StringType())
def query_shape(text: pd.Series) -> pd.Series:
    return text.map(shape_of)
