"""Keys of mixed types as bytes whose order is the order of the values.

A value is extended JSON text, as the readers of dumps give it. The bytes can be range-partitioned, sorted, joined and
compared by Spark like any binary column, so a table whose keys are numbers, texts, documents and arrays needs no comparison
in Python beyond the encoding, and no task that sees all keys.

The order: no value, least key, then by rank of type and by value, greatest key. Numbers of all kinds compare by value
(integers and decimals exactly, -0.0 before 0.0, NaN last) and have the rank of 64-bit integers; texts compare by UTF-16 units, documents
by their sorted names and then values, with fewer names first, arrays by element and then length, binary values by
signed bytes, and a document's null has a rank of its own.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
from decimal import Decimal
from fractions import Fraction

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.sources.bson import millis

#: Fixed ranks of types where types differ.
RANK = {"string": 2, "object": 3, "array": 4, "binary": 5, "undefined": 6, "id": 7, "bool": 8, "date": 9, "null": 10, "regex": 11, "code": 13, "symbol": 14, "time": 17, "number": 18}
MISSING, LEAST, GREATEST = b"\x00", b"\x01", b"\xff"


def tag(kind: str) -> bytes:
    return bytes([0x10 + RANK[kind]])


def ended(raw: bytes) -> bytes:
    """Bytes with a mark of their end that is less than any byte that may follow in a longer value."""
    return raw.replace(b"\x00", b"\x00\xff") + b"\x00\x00"


def text(x: str) -> bytes:
    return ended_units(x.encode("utf-16-be", "surrogatepass"))


def ended_units(raw: bytes) -> bytes:
    """The same for 16-bit units: a zero unit is followed by the greatest, the end by another zero."""
    return b"".join(raw[i : i + 2] if raw[i : i + 2] != b"\0\0" else b"\0\0\xff\xff" for i in range(0, len(raw), 2)) + b"\0\0\0\0"


def ordered_double(x: float) -> bytes:
    """The bits of a double in the order of values: all bits of a negative one are turned, of others the sign."""
    (bits,) = struct.unpack(">Q", struct.pack(">d", x if x == x else float("nan")))
    return struct.pack(">Q", bits ^ (0xFFFFFFFFFFFFFFFF if bits >> 63 and x == x else 1 << 63))


def number(x: int | float | Decimal) -> bytes:
    """The nearest double, then the nearest double to what is left, twice: exact for 159 bits."""
    if isinstance(x, float) or isinstance(x, Decimal) and not x.is_finite():
        return tag("number") + ordered_double(float(x)) + 2 * ordered_double(0.0)
    out, left = tag("number"), Fraction(x)
    for _ in range(3):
        try:
            near = float(left)
        except OverflowError:
            near = float("inf") if left > 0 else float("-inf")
        out += ordered_double(near + 0.0)
        left = left - Fraction(near) if abs(near) != float("inf") else Fraction(0)
    return out


def signed(x: int) -> bytes:
    return struct.pack(">Q", (x + (1 << 63)) & 0xFFFFFFFFFFFFFFFF)


def special(v: dict) -> bytes | None:
    """The key of a typed value in extended JSON; None for a plain document."""
    name = next(iter(v))
    x = v[name]
    if name in ("$numberInt", "$numberLong"):
        return number(int(x))
    if name == "$numberDouble":
        return number(float(x))
    if name == "$numberDecimal":
        return number(Decimal(x))
    if name == "$oid":
        return tag("id") + bytes.fromhex(x)
    if name == "$date":
        return tag("date") + signed(millis(x))
    if name == "$timestamp":
        return tag("time") + struct.pack(">II", x["t"], x["i"])
    if name in ("$binary", "$uuid"):
        raw = base64.b64decode(x["base64"]) if name == "$binary" else uuid.UUID(x).bytes
        return tag("binary") + ended(bytes(b ^ 0x80 for b in raw))
    if name == "$regularExpression":
        return tag("regex") + text(x["pattern"]) + text(x["options"])
    if name in ("$code", "$symbol"):
        return tag(name[1:]) + text(x)
    if name == "$undefined":
        return tag("undefined")
    if name == "$minKey":
        return LEAST
    if name == "$maxKey":
        return GREATEST
    return None


def key_of(v) -> bytes:
    if v is None:
        return tag("null")
    if isinstance(v, bool):
        return tag("bool") + bytes([v])
    if isinstance(v, (int, float)):
        return number(v)
    if isinstance(v, str):
        return tag("string") + text(v)
    if isinstance(v, list):
        return tag("array") + b"".join(b"\x01" + key_of(x) for x in v) + b"\x00"
    found = special(v) if v and next(iter(v)).startswith("$") else None
    if found is not None:
        return found
    names = sorted((k.encode("utf-16-be", "surrogatepass"), k) for k in v)
    return tag("object") + b"".join(b"\x01" + ended_units(raw) + key_of(v[k]) for raw, k in names) + b"\x00"


@F.pandas_udf(BinaryType())
def typed_key(value: pd.Series) -> pd.Series:
    """The key of extended JSON text; a null is no value. Text that is no JSON raises an error."""
    return value.map(lambda t: MISSING if t is None else key_of(json.loads(t)))
