"""Values in the packed binary forms of a source's log. Bit fields are column expressions; decimals, geometry and binary
JSON, which have no counterpart among Spark's functions, are Arrow UDFs over whole batches."""

from __future__ import annotations

import base64
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.ddl.types import POINT


def bits_of(c: Column, first: int, count: int, width: int) -> Column:
    """`count` bits of a bigint of `width` bits, the first bit being the highest."""
    return F.shiftrightunsigned(c, width - first - count).bitwiseAND(F.lit((1 << count) - 1))


def sign_extended(c: Column, bits: int) -> Column:
    """An unsigned value of `bits` bits as the signed one."""
    return F.when(c >= F.lit(1 << (bits - 1)), c - F.lit(1 << bits)).otherwise(c)


def unsigned_of_bytes(b: Column, size: int, little: bool = True) -> Column:
    """The first `size` bytes of a binary as an unsigned integer; below 8 bytes a bigint, else DECIMAL(20,0)."""
    part = F.substring(b, 1, size)
    ordered = F.unhex(F.array_join(F.reverse(F.regexp_extract_all(F.hex(part), F.lit("(..)"))), "")) if little else part
    number = F.conv(F.hex(ordered), 16, 10)
    return number.cast("bigint" if size < 8 else "decimal(20,0)")


def date3(packed: Column) -> Column:
    """A 24-bit date (15 bits year, 4 month, 5 day); null where a part is 0 or the date doesn't exist."""
    year, month, day = bits_of(packed, 0, 15, 24), bits_of(packed, 15, 4, 24), bits_of(packed, 19, 5, 24)
    text = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when((year > 0) & (month > 0) & (day > 0), text.try_cast("date"))


def datetime5(packed: Column, micros: Column | None = None) -> Column:
    """A 40-bit time (sign, 17 bits year * 13 + month, 5 day, 5 hour, 6 minute, 6 second); null where it doesn't exist."""
    ym = bits_of(packed, 1, 17, 40)
    parts = [bits_of(packed, a, n, 40) for a, n in ((18, 5), (23, 5), (28, 6), (34, 6))]
    text = F.format_string("%04d-%02d-%02d %02d:%02d:%02d.%06d", F.floor(ym / 13).cast("bigint"), ym % 13, *parts, F.lit(0) if micros is None else micros)
    return text.try_cast("timestamp_ntz")


def packed_datetime5(t: Column) -> Column:
    """The inverse of datetime5, without fractions."""
    ym = (F.year(t) * 13 + F.month(t)).cast("bigint")
    low = F.dayofmonth(t) * 131072 + F.hour(t) * 4096 + F.minute(t) * 64 + F.second(t)
    return F.lit(1 << 39) + ym * F.lit(1 << 22) + low.cast("bigint")


def time_micros(packed: Column, fraction_digits: int) -> Column:
    """A signed time of 24 bits and a fraction of 0, 2, 4 or 6 digits kept in 0, 8, 16 or 24 bits more, in microseconds.

    The sign belongs to all bits together: the value is stored with 0x80… added.
    """
    extra = (fraction_digits + 1) // 2 * 8
    value = packed - F.lit(1 << (23 + extra))
    size, whole = F.abs(value), 24
    at = lambda a, n: bits_of(size, a, n, whole + extra)
    seconds = at(2, 10) * 3600 + at(12, 6) * 60 + at(18, 6)
    fraction = at(24, extra) * F.lit(10 ** (6 - (fraction_digits + 1) // 2 * 2)) if extra else F.lit(0)
    micros = seconds * F.lit(1_000_000) + fraction
    return F.when(value < 0, -micros).otherwise(micros)


def bit_string(c: Column, width: int) -> Column:
    """The lowest `width` bits as text of 0 and 1, the highest first."""
    return F.lpad(F.bin(c.cast("bigint")), width, "0")


#: Bytes that so many decimal digits take.
_DIGIT_BYTES = (0, 1, 1, 2, 2, 3, 3, 4, 4, 4)


def decimal_size(precision: int, scale: int) -> int:
    """Bytes of a packed decimal."""
    return sum(n // 9 * 4 + _DIGIT_BYTES[n % 9] for n in (precision - scale, scale))


def decimal_text(data: bytes | None, precision: int, scale: int) -> str | None:
    """A packed decimal (9 digits in 4 bytes, the top bit set for positive numbers) as text."""
    if data is None:
        return None
    whole = precision - scale
    head, tail = whole % 9, scale % 9
    negative = not data[0] & 0x80
    raw = bytearray(data)
    raw[0] ^= 0x80
    if negative:
        raw = bytearray(b ^ 0xFF for b in raw)
    sizes = [(_DIGIT_BYTES[head], head)] * bool(head) + [(4, 9)] * (whole // 9 + scale // 9) + [(_DIGIT_BYTES[tail], tail)] * bool(tail)
    digits, at = "", 0
    for size, n in sizes:
        digits += str(int.from_bytes(raw[at : at + size], "big")).zfill(n)
        at += size
    left, right = digits[:whole].lstrip("0") or "0", digits[whole:]
    return ("-" if negative and digits.strip("0") else "") + left + ("." + right if right else "")


def packed_decimal(text: str, precision: int, scale: int) -> bytes:
    """The inverse of decimal_text."""
    negative, body = text.startswith("-"), text.lstrip("+-")
    left, _, right = body.partition(".")
    whole = precision - scale
    left, right = left.zfill(whole), right.ljust(scale, "0")
    head, out = whole % 9, b""
    groups = ([left[:head]] if head else []) + [left[i : i + 9] for i in range(head, whole, 9)] + [right[i : i + 9] for i in range(0, scale, 9)]
    for g in groups:
        out += int(g).to_bytes(_DIGIT_BYTES[len(g)], "big")
    raw = bytearray(b ^ 0xFF for b in out) if negative else bytearray(out)
    raw[0] ^= 0x80
    return bytes(raw)


def decimals(c: Column, precision: int, scale: int) -> Column:
    """Packed decimals as DECIMAL(precision, scale); as text beyond 38 digits."""

    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        return s.map(lambda b: decimal_text(b, precision, scale), na_action="ignore")

    return text(c).cast(f"decimal({precision},{scale})") if precision <= 38 else text(c)


def _wkb(data: bytes | None, kind: int) -> list | tuple | None:
    """A geometry of the given kind, with or without the four bytes of its reference system before it."""
    if data is None:
        return None
    at = 0 if len(data) >= 5 and data[0] in (0, 1) and struct.unpack_from("<>"[data[0] ^ 1] + "I", data, 1)[0] == kind and len(data) != 25 else 4
    return _geometry(data, at, kind)[0]


def _geometry(data: bytes, at: int, kind: int) -> tuple[list | tuple, int]:
    order = "<" if data[at] else ">"
    (found,) = struct.unpack_from(order + "I", data, at + 1)
    if found != kind:
        raise ValueError(f"geometry of kind {found}, not {kind}")
    at += 5
    if kind == 1:
        return struct.unpack_from(order + "2d", data, at), at + 16
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    if kind == 6:
        parts = []
        for _ in range(n):
            part, at = _geometry(data, at, 3)
            parts.append(part)
        return parts, at
    rings = []
    for _ in range(n):
        (m,) = struct.unpack_from(order + "I", data, at)
        flat = struct.unpack_from(f"{order}{2 * m}d", data, at + 4)
        rings.append(list(zip(flat[::2], flat[1::2], strict=True)))
        at += 4 + 16 * m
    return (rings[0] if rings else []), at  # the outer ring; holes are left out


def point(c: Column) -> Column:
    """A WKB point as struct<x, y>; null gives (0, 0)."""

    @F.pandas_udf(POINT)
    def read(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_wkb(b, 1) or (0.0, 0.0) for b in s], columns=["x", "y"], dtype="float32")

    return read(c)


def _point_list(flat: list[float], ends: list[int]) -> pa.Array:
    """Lists of points from all points' coordinates one after another and each list's end."""
    xy = np.array(flat, np.float32).reshape(-1, 2)
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), points)


def _extend(flat: list[float], ends: list[int], ring: list[tuple[float, float]]) -> None:
    for p in ring:
        flat += p
    ends.append(len(flat) // 2)


def polygon(c: Column) -> Column:
    """The outer ring of a WKB polygon, the closing point kept; null gives no point."""

    @F.arrow_udf("array<struct<x:float,y:float>>")
    def read(column: pa.Array) -> pa.Array:
        flat: list[float] = []
        ends: list[int] = []
        for b in column.to_pylist():
            _extend(flat, ends, _wkb(b, 3) or [])
        return _point_list(flat, ends)

    return read(c)


def multipolygon(c: Column) -> Column:
    """The outer rings of a WKB multipolygon; null gives none."""

    @F.arrow_udf("array<array<struct<x:float,y:float>>>")
    def read(column: pa.Array) -> pa.Array:
        flat: list[float] = []
        ends: list[int] = []
        outer = [0]
        for b in column.to_pylist():
            for ring in _wkb(b, 6) or []:
                _extend(flat, ends, ring)
            outer.append(len(ends))
        return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), _point_list(flat, ends))

    return read(c)


#: The type bytes of binary JSON.
_SMALL_OBJECT, _LARGE_OBJECT, _SMALL_ARRAY, _LARGE_ARRAY, _LITERAL, _STRING, _OPAQUE = 0, 1, 2, 3, 4, 12, 15
_NUMBERS = {5: "<h", 6: "<H", 7: "<i", 8: "<I", 9: "<q", 10: "<Q", 11: "<d"}
_LITERALS = {0: None, 1: True, 2: False}
#: Column types that binary JSON keeps as they are.
_DECIMAL_FIELD, _DATE_FIELD, _TIME_FIELD, _DATETIME_FIELDS = 246, 10, 11, (7, 12)


def binary_json(data: bytes) -> object:
    """The value of a document in the source's binary JSON; no bytes are null."""
    return _json_value(data[0], data, 1) if data else None


def _length(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if b < 0x80:
            return n, at


def _json_value(kind: int, data: bytes, at: int) -> object:
    if kind in _NUMBERS:
        return struct.unpack_from(_NUMBERS[kind], data, at)[0]
    if kind == _LITERAL:
        return _LITERALS[data[at]]
    if kind == _STRING:
        n, at = _length(data, at)
        return data[at : at + n].decode("utf-8", "replace")
    if kind == _OPAQUE:
        field = data[at]
        n, at = _length(data, at + 1)
        return _opaque(field, data[at : at + n])
    if kind > _LARGE_ARRAY:
        raise ValueError(f"binary JSON of type {kind}")
    small = kind in (_SMALL_OBJECT, _SMALL_ARRAY)
    size, word = (2, "<H") if small else (4, "<I")
    read = lambda p: struct.unpack_from(word, data, p)[0]
    count, keyed = read(at), kind in (_SMALL_OBJECT, _LARGE_OBJECT)
    keys, values = at + 2 * size, at + 2 * size + (count * (size + 2) if keyed else 0)
    out = []
    for i in range(count):
        entry = values + i * (1 + size)
        inner = data[entry]
        inline = inner in (4, 5, 6) or not small and inner in (7, 8)
        out.append(_json_value(inner, data, entry + 1 if inline else at + read(entry + 1)))
    if not keyed:
        return out
    names = []
    for i in range(count):
        entry = keys + i * (size + 2)
        start = at + read(entry)
        names.append(data[start : start + struct.unpack_from("<H", data, entry + size)[0]].decode("utf-8", "replace"))
    return dict(zip(names, out, strict=True))


#: Operations of a partial JSON update.
_REPLACE, _INSERT, _REMOVE = 0, 1, 2
_LEG = re.compile(r'\.(?:"((?:[^"\\]|\\.)*)"|([^.\[]+))|\[(\d+)\]')


def _coded_length(data: bytes, at: int) -> tuple[int, int]:
    first = data[at]
    size = {252: 2, 253: 3, 254: 8}.get(first, 0)
    return (int.from_bytes(data[at + 1 : at + 1 + size], "little") if size else first), at + 1 + size


def json_diffs(data: bytes) -> list[tuple[int, str, object]]:
    """(operation, path, value) of each step of a partial JSON update."""
    out, at = [], 0
    while at < len(data):
        what = data[at]
        n, at = _coded_length(data, at + 1)
        path, at, value = data[at : at + n].decode(), at + n, None
        if what != _REMOVE:
            n, at = _coded_length(data, at)
            value, at = binary_json(data[at : at + n]), at + n
        out.append((what, path, value))
    return out


def json_changed(document: object, diffs: list[tuple[int, str, object]]) -> object:
    """The document after the steps: a value replaced, a key or element inserted, or removed. A path that leads nowhere
    raises ValueError, since the document isn't the one that was changed. The document given isn't kept as it was."""
    for what, path, value in diffs:
        legs = [json.loads(f'"{m[1]}"') if m[1] is not None else m[2] if m[2] is not None else int(m[3]) for m in _LEG.finditer(path, 1)]
        if not legs:
            document = value
            continue
        try:
            inner = document
            for leg in legs[:-1]:
                inner = inner[leg]
            last = legs[-1]
            if what == _REMOVE:
                del inner[last]
            elif what == _INSERT and isinstance(inner, list):
                inner.insert(last, value)
            elif what == _REPLACE and not isinstance(inner, list) and last not in inner:
                raise KeyError(last)
            else:
                inner[last] = value
        except (KeyError, IndexError, TypeError) as e:
            raise ValueError(f"no {path} in the document that a partial update changes") from e
    return document


class _Number(str):
    """A number whose digits are written as they are."""


def _opaque(field: int, data: bytes) -> object:
    if field == _DECIMAL_FIELD:
        return _Number(decimal_text(data[2:], data[0], data[1]))
    if field in (_TIME_FIELD, _DATE_FIELD, *_DATETIME_FIELDS):
        (packed,) = struct.unpack("<q", data)
        sign, value = "-" if packed < 0 else "", abs(packed)
        micros, high = value & 0xFFFFFF, value >> 24
        if field == _TIME_FIELD:
            return f"{sign}{high >> 12 & 0x3FF:02d}:{high >> 6 & 63:02d}:{high & 63:02d}.{micros:06d}"
        ym, day = high >> 22, high >> 17 & 31
        text = f"{ym // 13:04d}-{ym % 13:02d}-{day:02d}"
        return text if field == _DATE_FIELD else f"{text} {high >> 12 & 31:02d}:{high >> 6 & 63:02d}:{high & 63:02d}.{micros:06d}"
    return f"base64:type{field}:{base64.b64encode(data).decode()}"


def _written(value: object) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ", ".join(f"{json.dumps(k, ensure_ascii=False)}: {_written(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ", ".join(map(_written, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def json_documents(c: Column) -> Column:
    """Binary JSON as text, in the layout {"k": v, "l": [1, 2]}. Null gives null, broken documents raise."""

    @F.pandas_udf("string")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda b: _written(binary_json(bytes(b))), na_action="ignore")

    return read(c)
