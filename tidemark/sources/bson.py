"""Decoding of binary documents: little-endian, length-prefixed, typed elements."""

from __future__ import annotations

import base64
import datetime as dt
import struct
import uuid
from collections.abc import Iterator
from decimal import Decimal

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def documents(raw: bytes) -> Iterator[dict]:
    """Every top-level document of a dump; a truncated tail raises ValueError."""
    at = 0
    while at < len(raw):
        if len(raw) - at < 5:
            raise ValueError("truncated document")
        (size,) = struct.unpack_from("<i", raw, at)
        if size < 5 or at + size > len(raw) or raw[at + size - 1]:
            raise ValueError("broken document length")
        yield _document(raw, at)
        at += size


def _document(raw: bytes, at: int) -> dict:
    end = at + struct.unpack_from("<i", raw, at)[0] - 1
    at += 4
    out: dict = {}
    while at < end:
        kind = raw[at]
        stop = raw.index(0, at + 1)
        name = raw[at + 1 : stop].decode()
        out[name], at = _value(raw, stop + 1, kind)
    return out


def _value(raw: bytes, at: int, kind: int):
    if kind == 0x01:
        return struct.unpack_from("<d", raw, at)[0], at + 8
    if kind in (0x02, 0x0D, 0x0E):  # string, code, symbol
        (n,) = struct.unpack_from("<i", raw, at)
        return raw[at + 4 : at + 3 + n].decode(), at + 4 + n
    if kind in (0x03, 0x04):
        (n,) = struct.unpack_from("<i", raw, at)
        doc = _document(raw, at)
        return (doc if kind == 3 else list(doc.values())), at + n
    if kind == 0x05:
        (n,) = struct.unpack_from("<i", raw, at)
        return raw[at + 5 : at + 5 + n].hex(), at + 5 + n
    if kind == 0x07:
        return raw[at : at + 12].hex(), at + 12
    if kind == 0x08:
        return bool(raw[at]), at + 1
    if kind == 0x09:
        (ms,) = struct.unpack_from("<q", raw, at)
        return (dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)).isoformat(timespec="milliseconds") + "Z", at + 8
    if kind in (0x06, 0x0A):
        return None, at
    if kind == 0x10:
        return struct.unpack_from("<i", raw, at)[0], at + 4
    if kind == 0x11:
        i, t = struct.unpack_from("<II", raw, at)
        return {"t": t, "i": i}, at + 8
    if kind == 0x12:
        return struct.unpack_from("<q", raw, at)[0], at + 8
    if kind == 0x13:
        return raw[at : at + 16].hex(), at + 16
    if kind in (0x7F, 0xFF):
        return {"$maxKey": 1} if kind == 0x7F else {"$minKey": 1}, at
    raise ValueError(f"unknown element type {kind:#x}")


# --- typed form: extended JSON that keeps every type ---

#: Types of elements that ``typed`` knows.
KINDS = (0x01, 0x02, 0x03, 0x04, 0x05, 0x06, 0x07, 0x08, 0x09, 0x0A, 0x0B, 0x0D, 0x0E, 0x10, 0x11, 0x12, 0x13, 0x7F, 0xFF)
SINGLE = {0x06: {"$undefined": True}, 0x0A: None, 0x7F: {"$maxKey": 1}, 0xFF: {"$minKey": 1}}


def checked(raw: bytes) -> None:
    """Raises ValueError or IndexError unless ``raw`` is one whole document, well formed to its last element."""
    typed(raw)


def typed(raw: bytes) -> dict:
    """One document as extended JSON values: 32-bit integers and finite doubles are plain numbers, all else is marked by type."""
    try:
        out, at = _typed_document(raw, 0)
    except (struct.error, UnicodeDecodeError, OverflowError) as e:
        raise ValueError(str(e)) from e
    if at != len(raw):
        raise ValueError("document ends early")
    return out


def _typed_document(raw: bytes, at: int) -> tuple[dict, int]:
    (size,) = struct.unpack_from("<i", raw, at)
    end = at + size - 1
    if size < 5 or end >= len(raw) or raw[end]:
        raise ValueError("broken document length")
    at += 4
    out: dict = {}
    while at < end:
        kind = raw[at]
        stop = raw.index(0, at + 1)
        name = raw[at + 1 : stop].decode()
        out[name], at = _typed_value(raw, stop + 1, kind)
    if at != end:
        raise ValueError("element beyond its document")
    return out, end + 1


def _sized(raw: bytes, at: int, least: int) -> int:
    (n,) = struct.unpack_from("<i", raw, at)
    if n < least or at + 4 + n > len(raw):
        raise ValueError("broken length")
    return n


def _typed_value(raw: bytes, at: int, kind: int):
    if kind == 0x01:
        (x,) = struct.unpack_from("<d", raw, at)
        if x - x == 0:
            return x, at + 8
        return {"$numberDouble": "NaN" if x != x else "Infinity" if x > 0 else "-Infinity"}, at + 8
    if kind == 0x10:
        return struct.unpack_from("<i", raw, at)[0], at + 4
    if kind in (0x09, 0x12):
        (x,) = struct.unpack_from("<q", raw, at)
        return ({"$date": {"$numberLong": str(x)}} if kind == 0x09 else {"$numberLong": str(x)}), at + 8
    if kind in SINGLE:
        return (dict(SINGLE[kind]) if SINGLE[kind] else None), at
    if kind in (0x02, 0x0D, 0x0E):
        n = _sized(raw, at, 1)
        if raw[at + 3 + n]:
            raise ValueError("text without end")
        x = raw[at + 4 : at + 3 + n].decode()
        return (x if kind == 0x02 else {"$code": x} if kind == 0x0D else {"$symbol": x}), at + 4 + n
    if kind in (0x03, 0x04):
        doc, at = _typed_document(raw, at)
        return (doc if kind == 0x03 else list(doc.values())), at
    if kind == 0x05:
        n = _sized(raw, at, 0)
        if at + 5 + n > len(raw):
            raise ValueError("broken length")
        return {"$binary": {"base64": base64.b64encode(raw[at + 5 : at + 5 + n]).decode(), "subType": f"{raw[at + 4]:02x}"}}, at + 5 + n
    if kind == 0x07:
        if at + 12 > len(raw):
            raise ValueError("broken length")
        return {"$oid": raw[at : at + 12].hex()}, at + 12
    if kind == 0x08:
        if raw[at] > 1:
            raise ValueError("neither true nor false")
        return raw[at] == 1, at + 1
    if kind == 0x0B:
        mid = raw.index(0, at)
        stop = raw.index(0, mid + 1)
        return {"$regularExpression": {"pattern": raw[at:mid].decode(), "options": raw[mid + 1 : stop].decode()}}, stop + 1
    if kind == 0x11:
        i, t = struct.unpack_from("<II", raw, at)
        return {"$timestamp": {"t": t, "i": i}}, at + 8
    if kind == 0x13:
        return {"$numberDecimal": decimal_text(int.from_bytes(raw[at : at + 16], "little"))}, at + 16
    raise ValueError(f"unknown element type {kind:#x}")


def decimal_text(bits: int) -> str:
    """The text of a 128-bit decimal in its binary-integer form."""
    sign, top = "-" if bits >> 127 else "", bits >> 122 & 31
    if top >= 30:
        return "NaN" if top == 31 else f"{sign}Infinity"
    if bits >> 125 & 3 == 3:  # coefficients that need more bits are beyond the format and count as zero
        exponent, digits = (bits >> 111 & 0x3FFF) - 6176, 0
    else:
        exponent, digits = (bits >> 113 & 0x3FFF) - 6176, bits & ((1 << 113) - 1)
        digits = digits if digits < 10**34 else 0
    return str(Decimal((bits >> 127, tuple(map(int, str(digits))), exponent)))


def decimal_bits(text: str) -> int:
    d = Decimal(text)
    sign, digits, exponent = d.as_tuple()
    if not d.is_finite():
        return sign << 127 | (31 if d.is_nan() else 30) << 122
    n = int("".join(map(str, digits)))
    while n and n % 10 == 0 and (n >= 10**34 or exponent < -6176):
        n, exponent = n // 10, exponent + 1
    while exponent > 6111 and n < 10**33:
        n, exponent = n * 10, exponent - 1
    if n >= 10**34 or not -6176 <= exponent <= 6111:
        raise ValueError(f"{text} does not fit 128 bits")
    return sign << 127 | (exponent + 6176) << 113 | n


def encode(doc: dict) -> bytes:
    """The bytes of a document of extended JSON values; integers take 32 bits where they fit."""
    out = [b"", *[_element(k, v) for k, v in doc.items()], b"\x00"]
    out[0] = struct.pack("<i", sum(map(len, out)) + 4)
    return b"".join(out)


def _element(name: str, v) -> bytes:
    if "\x00" in name:
        raise ValueError("a name with a zero in it cannot be written")
    kind, body = _encoded(v)
    return b"%c%b\x00%b" % (kind, name.encode(), body)


def _text(x: str) -> bytes:
    raw = x.encode()
    return struct.pack("<i", len(raw) + 1) + raw + b"\x00"


def _encoded(v) -> tuple[int, bytes]:
    if v is None:
        return 0x0A, b""
    if isinstance(v, bool):
        return 0x08, bytes([v])
    if isinstance(v, int):
        return (0x10, struct.pack("<i", v)) if -(1 << 31) <= v < 1 << 31 else (0x12, struct.pack("<q", v))
    if isinstance(v, float):
        return 0x01, struct.pack("<d", v)
    if isinstance(v, str):
        return 0x02, _text(v)
    if isinstance(v, list):
        return 0x04, encode({str(i): x for i, x in enumerate(v)})
    name = next(iter(v), "")
    if not name.startswith("$"):
        return 0x03, encode(v)
    x = v[name]
    match name:
        case "$numberLong":
            return 0x12, struct.pack("<q", int(x))
        case "$numberInt":
            return 0x10, struct.pack("<i", int(x))
        case "$numberDouble":
            return 0x01, struct.pack("<d", float(x))
        case "$numberDecimal":
            return 0x13, decimal_bits(x).to_bytes(16, "little")
        case "$oid":
            return 0x07, bytes.fromhex(x)
        case "$date":
            return 0x09, struct.pack("<q", millis(x))
        case "$timestamp":
            return 0x11, struct.pack("<II", x["i"], x["t"])
        case "$binary":
            raw = base64.b64decode(x["base64"])
            return 0x05, struct.pack("<iB", len(raw), int(x["subType"], 16)) + raw
        case "$uuid":
            return 0x05, struct.pack("<iB", 16, 4) + uuid.UUID(x).bytes
        case "$regularExpression":
            return 0x0B, x["pattern"].encode() + b"\x00" + x["options"].encode() + b"\x00"
        case "$code":
            return 0x0D, _text(x)
        case "$symbol":
            return 0x0E, _text(x)
        case "$undefined":
            return 0x06, b""
        case "$maxKey":
            return 0x7F, b""
        case "$minKey":
            return 0xFF, b""
    return 0x03, encode(v)


def millis(x) -> int:
    """Milliseconds since 1970 of an extended date: a number, its text, or ISO text."""
    if isinstance(x, dict):
        return int(x["$numberLong"])
    if isinstance(x, int):
        return x
    at = dt.datetime.fromisoformat(x.replace("Z", "+00:00"))
    since = (at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)) - EPOCH
    return (since.days * 86400 + since.seconds) * 1000 + since.microseconds // 1000


# --- export form ---


def java_legacy_uuid(raw: bytes) -> str:
    """The text of a UUID whose halves were stored with their bytes in reverse."""
    return str(uuid.UUID(bytes=raw[7::-1] + raw[:7:-1]))


def iso_text(ms: int) -> str:
    """UTC time without a fraction where it has none."""
    at = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)
    return at.isoformat(timespec="milliseconds" if ms % 1000 else "seconds") + "Z"


def exported(v):
    """Values of extended JSON as an export writes them: numbers plain, identifiers, decimals, times, symbols and binary values as text, UUIDs in their own form."""
    if isinstance(v, list):
        return [exported(x) for x in v]
    if not isinstance(v, dict):
        return v
    name = next(iter(v), "")
    if not name.startswith("$"):
        return {k: exported(y) if isinstance(y, (dict, list)) else y for k, y in v.items()}
    x = v[name]
    match name:
        case "$numberInt" | "$numberLong":
            return int(x)
        case "$date":
            return iso_text(millis(x))
        case "$oid" | "$numberDecimal" | "$symbol" | "$uuid":
            return x
        case "$timestamp":
            return {"t": x["t"], "i": x["i"]}
        case "$binary":
            raw, kind = base64.b64decode(x["base64"]), int(x["subType"], 16)
            if kind in (3, 4) and len(raw) == 16:
                return str(uuid.UUID(bytes=raw)) if kind == 4 else java_legacy_uuid(raw)
            return x["base64"]
    return v
