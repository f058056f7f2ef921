"""Binary log files of a source, decoded offline.

format("tidelog_binlog"), once sources.register() made it known, reads a file or a folder of files, a task per file, as a table or a stream, into rows: file_no, log_pos (end of the event),
row_no, logged_at, event, server_id, db_name, table_name, op ('U' written, 'D' deleted, 'Q' statement, null otherwise), text (a
statement, a transaction id, the next file's name), before and after (JSON object of the row's values, by column name where
the log has names, else by c0, c1, …), ok (whether the checksum is right, null without one).

The format is the public one of version 4: 19-byte headers, row events of versions 1 and 2 with full or partial images, JSON
columns updated in part, table maps with optional metadata. Events it has no use for come out as their name only. Paths may be of any file system
that sources.files knows.
"""

from __future__ import annotations

import base64
import datetime
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, In, InputPartition

from tidelog.functions.normalize import CHARSETS, collation_charset
from tidelog.functions.packed import _written, binary_json, decimal_size, decimal_text, json_changed, json_diffs
from tidelog.operators.gtid import GtidSet
from tidelog.sources import files

SCHEMA = (
    "file_no bigint, log_pos bigint, row_no int, logged_at timestamp, event string, server_id bigint, db_name string, table_name string, "
    "op string, text string, before string, after string, ok boolean"
)
MAGIC = b"\xfebin"

#: Event codes.
EVENTS = {
    2: "query", 3: "stop", 4: "rotate", 5: "intvar", 13: "rand", 14: "user_var", 15: "format_description", 16: "xid", 17: "begin_load_query",
    18: "execute_load_query", 19: "table_map", 23: "write_rows", 24: "update_rows", 25: "delete_rows", 27: "heartbeat", 29: "rows_query",
    30: "write_rows", 31: "update_rows", 32: "delete_rows", 33: "gtid", 34: "anonymous_gtid", 35: "previous_gtids", 38: "xa_prepare",
    39: "partial_update_rows", 160: "annotate_rows", 161: "binlog_checkpoint", 162: "mariadb_gtid", 163: "mariadb_gtid_list", 164: "start_encryption",
}
#: Column type codes.
(TINY, SHORT, LONG, FLOAT, DOUBLE, NULL, TIMESTAMP, LONGLONG, INT24, DATE, TIME, DATETIME, YEAR, NEWDATE, VARCHAR, BIT) = range(1, 17)
TIMESTAMP2, DATETIME2, TIME2 = 17, 18, 19
JSON, NEWDECIMAL, ENUM, SET, TINY_BLOB, MEDIUM_BLOB, LONG_BLOB, BLOB, VAR_STRING, STRING, GEOMETRY = 245, 246, 247, 248, 249, 250, 251, 252, 253, 254, 255
_INT_SIZE = {TINY: 1, SHORT: 2, INT24: 3, LONG: 4, LONGLONG: 8}
_NUMERIC = {TINY, SHORT, INT24, LONG, LONGLONG, FLOAT, DOUBLE, NEWDECIMAL}
_TEXTS = {VARCHAR, VAR_STRING, STRING, TINY_BLOB, MEDIUM_BLOB, LONG_BLOB, BLOB}
_EPOCH = datetime.datetime(1970, 1, 1)
#: Fixed value: the collation of bytes that are no text.
_BINARY = 63


class Cursor:
    """Reading along bytes."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        part = self.data[self.at : self.at + n]
        if len(part) < n:
            raise EOFError(f"{n} bytes wanted, {len(part)} left")
        self.at += n
        return part

    def uint(self, n: int, order: str = "little", signed: bool = False) -> int:
        return int.from_bytes(self.take(n), order, signed=signed)

    def coded(self) -> int:
        """A length-coded integer."""
        first = self.uint(1)
        return first if first < 251 else self.uint({252: 2, 253: 3, 254: 8}[first])

    def left(self) -> int:
        return len(self.data) - self.at


@dataclass
class Column:
    kind: int
    meta: int = 0
    name: str = ""
    unsigned: bool = False
    labels: list[str] = field(default_factory=list)
    collation: int = 0  # 0: not told
    geometry: int = 0
    visible: bool = True
    nullable: bool = True


@dataclass
class TableMap:
    db: str
    table: str
    columns: list[Column]
    key: list[tuple[int, int]] = field(default_factory=list)  # (column, length of its prefix or 0)


def table_map(body: Cursor) -> tuple[int, TableMap]:
    number = body.uint(6)
    body.take(2)
    db = body.take(body.uint(1)).decode()
    body.take(1)
    table = body.take(body.uint(1)).decode()
    body.take(1)
    columns = [Column(k) for k in body.take(body.coded())]
    meta = Cursor(body.take(body.coded()))
    for c in columns:
        if c.kind in (VARCHAR, BIT, VAR_STRING):
            c.meta = meta.uint(2)
        elif c.kind in (STRING, NEWDECIMAL, ENUM, SET):
            c.meta = meta.uint(2, "big")
            if c.kind == STRING and c.meta >> 8 in (ENUM, SET):
                c.kind, c.meta = c.meta >> 8, c.meta & 0xFF
            elif c.kind == STRING:
                # Two bits of a length above 255 are kept inverted in the type's byte.
                c.meta = ((c.meta >> 4) & 0x300 ^ 0x300) + (c.meta & 0xFF)
        elif c.kind in (FLOAT, DOUBLE, BLOB, JSON, GEOMETRY, TIMESTAMP2, DATETIME2, TIME2):
            c.meta = meta.uint(1)
    nullable, key = body.take((len(columns) + 7) // 8), []
    for i, c in enumerate(columns):
        c.nullable = _bit(nullable, i)
    texts, named = [c for c in columns if c.kind in _TEXTS], [c for c in columns if c.kind in (ENUM, SET)]
    while body.left() > 1:
        what, value = body.uint(1), Cursor(body.take(body.coded()))
        if what == 1:  # signedness of numeric columns, a bit each
            bits = value.data
            for i, c in enumerate(c for c in columns if c.kind in _NUMERIC):
                c.unsigned = bool(bits[i // 8] & (0x80 >> i % 8))
        elif what == 4:  # names
            for c in columns:
                c.name = value.take(value.coded()).decode()
        elif what in (5, 6):  # labels of sets, of enums
            for c in (c for c in columns if c.kind == (SET if what == 5 else ENUM)):
                c.labels = [value.take(value.coded()).decode("utf-8", "replace") for _ in range(value.coded())]
        elif what in (2, 10):  # the collation that most text (enum) columns have, and those that have another
            those, most = (texts if what == 2 else named), value.coded()
            for c in those:
                c.collation = most
            while value.left():
                i = value.coded()
                those[i].collation = value.coded()
        elif what in (3, 11):  # the collation of each text (enum) column
            for c in texts if what == 3 else named:
                c.collation = value.coded()
        elif what == 7:
            for c in (c for c in columns if c.kind == GEOMETRY):
                c.geometry = value.coded()
        elif what in (8, 9):  # the key, of whole columns or of prefixes
            while value.left():
                key.append((value.coded(), value.coded() if what == 9 else 0))
        elif what == 12:
            for i, c in enumerate(columns):
                c.visible = bool(value.data[i // 8] & (0x80 >> i % 8))
    return number, TableMap(db, table, columns, key)


def _fraction(body: Cursor, digits: int) -> int:
    size = (digits + 1) // 2
    return body.uint(size, "big") * 10 ** (6 - 2 * size) if size else 0


def _clock(micros: int) -> str:
    sign, micros = "-" if micros < 0 else "", abs(micros)
    s, part = divmod(micros, 1_000_000)
    return f"{sign}{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}" + (f".{part:06d}" if part else "")


def _stamp(y: int, mo: int, d: int, h: int = 0, mi: int = 0, s: int = 0, us: int = 0) -> str | None:
    """Null for a date that doesn't exist, such as one with a zero in it."""
    try:
        return str(datetime.datetime(y, mo, d, h, mi, s, us))
    except ValueError:
        return None


def _text(data: bytes, collation: int = 0) -> str:
    """Bytes in the column's own character set; without one, or for plain bytes, UTF-8 where they are that, else base64."""
    if collation not in (0, _BINARY):
        return data.decode(CHARSETS.get(collation_charset(collation), "utf-8"), "replace")
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return "base64:" + base64.b64encode(data).decode()


def value(body: Cursor, c: Column) -> Any:
    """One column's value as JSON can hold it."""
    k = c.kind
    if k in _INT_SIZE:
        return body.uint(_INT_SIZE[k], signed=not c.unsigned)
    if k == FLOAT:
        return struct.unpack("<f", body.take(4))[0]
    if k == DOUBLE:
        return struct.unpack("<d", body.take(8))[0]
    if k == NEWDECIMAL:
        precision, scale = c.meta >> 8, c.meta & 0xFF
        return decimal_text(body.take(decimal_size(precision, scale)), precision, scale)
    if k == YEAR:
        y = body.uint(1)
        return y + 1900 if y else 0
    if k in (DATE, NEWDATE):
        n = body.uint(3)
        got = _stamp(n >> 9, n >> 5 & 15, n & 31)
        return got and got[:10]
    if k == TIME:
        n = body.uint(3, signed=True)
        a = abs(n)
        return _clock((1 if n >= 0 else -1) * (a // 10000 * 3600 + a // 100 % 100 * 60 + a % 100) * 1_000_000)
    if k == TIME2:
        size = (c.meta + 1) // 2
        n = body.uint(3 + size, "big") - (1 << (23 + 8 * size))
        a, sign = abs(n), -1 if n < 0 else 1
        high, low = a >> (8 * size), a & ((1 << 8 * size) - 1)
        micros = ((high >> 12 & 0x3FF) * 3600 + (high >> 6 & 63) * 60 + (high & 63)) * 1_000_000 + low * 10 ** (6 - 2 * size)
        return _clock(sign * micros)
    if k == DATETIME:
        n = body.uint(8)
        day, clock = divmod(n, 1_000_000)
        return _stamp(day // 10000, day // 100 % 100, day % 100, clock // 10000, clock // 100 % 100, clock % 100)
    if k == DATETIME2:
        n = body.uint(5, "big") - (1 << 39)
        ym, micros = n >> 22, _fraction(body, c.meta)
        return _stamp(ym // 13, ym % 13, n >> 17 & 31, n >> 12 & 31, n >> 6 & 63, n & 63, micros)
    if k == TIMESTAMP:
        s = body.uint(4)
        return str(_EPOCH + datetime.timedelta(seconds=s)) if s else None
    if k == TIMESTAMP2:
        s, micros = body.uint(4, "big"), _fraction(body, c.meta)
        return str(_EPOCH + datetime.timedelta(seconds=s, microseconds=micros)) if s or micros else None
    if k == ENUM:
        i = body.uint(c.meta & 0xFF or 1)
        return c.labels[i - 1] if 0 < i <= len(c.labels) else i
    if k == SET:
        mask = body.uint(c.meta & 0xFF or 1)
        return ",".join(x for i, x in enumerate(c.labels) if mask >> i & 1) if c.labels else mask
    if k == BIT:
        bits = (c.meta >> 8) * 8 + (c.meta & 0xFF)
        return format(body.uint((bits + 7) // 8, "big"), f"0{bits}b")
    if k in (VARCHAR, VAR_STRING, STRING):
        return _text(body.take(body.uint(2 if c.meta > 255 else 1)), c.collation)
    if k in (BLOB, GEOMETRY, JSON, TINY_BLOB, MEDIUM_BLOB, LONG_BLOB):
        data = body.take(body.uint(c.meta or 2))
        if k == JSON:
            return json.loads(_written(binary_json(data)))
        return base64.b64encode(data).decode() if k == GEOMETRY else _text(data, c.collation)
    if k == NULL:
        return None
    raise ValueError(f"column type {k}")


def _bit(bits: bytes, i: int) -> bool:
    return bool(bits[i // 8] >> i % 8 & 1)


def _image(body: Cursor, t: TableMap, present: bytes, before: dict[str, Any] | None = None) -> dict[str, Any]:
    """A row's values by column name. With before it is the image after a partial update, whose JSON columns may be given as
    changes to what they were."""
    partial = iter(())
    if before is not None and body.coded() & 1:
        documents = sum(c.kind == JSON for c in t.columns)
        bits = body.take((documents + 7) // 8)
        partial = iter([_bit(bits, i) for i in range(documents)])
    changed = {i: next(partial, False) for i, c in enumerate(t.columns) if c.kind == JSON}
    here = [i for i in range(len(t.columns)) if _bit(present, i)]
    nulls = body.take((len(here) + 7) // 8)
    out: dict[str, Any] = {}
    for n, i in enumerate(here):
        c = t.columns[i]
        name = c.name or f"c{i}"
        if _bit(nulls, n):
            out[name] = None
        elif changed.get(i):
            steps = json_diffs(body.take(body.uint(c.meta or 4)))
            if before is None or name not in before:
                raise ValueError(f"a partial update of {name}, whose value before isn't in the log")
            out[name] = json.loads(_written(json_changed(json.loads(json.dumps(before[name])), steps)))
        else:
            out[name] = value(body, c)
    return out


def rows(code: int, body: Cursor, maps: dict[int, TableMap]) -> tuple[TableMap, list[tuple[dict | None, dict | None]]]:
    """(table, (before, after) of each row). Raises ValueError where the log's part at hand lacks the table's map: its rows
    can't be read, and leaving them out would lose changes."""
    number = body.uint(6)
    t = maps.get(number)
    if t is None:
        raise ValueError(f"rows of table {number}, whose map isn't in the log before them")
    body.take(2)
    if code in (30, 31, 32, 39):
        body.take(body.uint(2) - 2)
    n = body.coded()
    first = body.take((n + 7) // 8)
    second = body.take((n + 7) // 8) if code in (24, 31, 39) else b""
    out: list[tuple[dict | None, dict | None]] = []
    while body.left():
        one = _image(body, t, first)
        out.append((one, _image(body, t, second, one if code == 39 else None)) if second else (None, one) if code in (23, 30) else (one, None))
    return t, out


def _sid(data: bytes) -> str:
    return str(uuid.UUID(bytes=data))


def _user_value(body: Cursor) -> str:
    if body.uint(1):
        return "NULL"
    kind, collation = body.uint(1), body.uint(4)  # 0 text, 1 real, 2 integer, 4 decimal
    data = body.take(body.uint(4))
    if kind == 1:
        return repr(struct.unpack("<d", data)[0])
    if kind == 2:
        return str(int.from_bytes(data, "little", signed=not (body.left() and body.uint(1) & 1)))
    if kind == 4:
        return decimal_text(data[2:], data[0], data[1]) or ""
    return json.dumps(_text(data, collation), ensure_ascii=False)


def _loading(code: int, body: Cursor) -> tuple[str | None, str | None]:
    """LOAD DATA by blocks: (None, file number and size of the first block), or the database and the statement."""
    if code == 17:
        return None, f"file {body.uint(4)}, {body.left()} bytes"
    body.take(8)
    schema, status = body.uint(1), (body.take(2), body.uint(2))[1]
    body.take(4 + 4 + 4 + 1 + status)
    db = body.take(schema).decode("utf-8", "replace")
    body.take(1)
    return db, body.take(body.left()).decode("utf-8", "replace")


def _plain(code: int, body: Cursor, server: int = 0) -> tuple[str | None, str | None]:
    """(database, text) of an event without rows."""
    if code == 2:
        body.take(8)
        schema, status = body.uint(1), (body.take(2), body.uint(2))[1]
        body.take(status)
        db = body.take(schema).decode("utf-8", "replace")
        body.take(1)
        return db, body.take(body.left()).decode("utf-8", "replace")
    if code == 4:
        body.take(8)
        return None, body.take(body.left()).decode()
    if code == 16:
        return None, str(body.uint(8))
    if code in (33, 34):
        body.take(1)
        sid = _sid(body.take(16))
        return None, f"{sid}:{body.uint(8)}"
    if code == 35:
        sets = []
        for _ in range(body.uint(8)):
            sid = _sid(body.take(16))
            spans = [(body.uint(8), body.uint(8)) for _ in range(body.uint(8))]
            sets.append(sid + "".join(f":{a}-{b - 1}" for a, b in spans))
        return None, ",".join(sets)
    if code == 162:
        number, domain = body.uint(8), body.uint(4)
        return None, f"{domain}-{server}-{number}"
    if code == 163:  # the low 28 bits count, the others are flags
        sets = [(body.uint(4), body.uint(4), body.uint(8)) for _ in range(body.uint(4) & 0xFFFFFFF)]
        return None, ",".join(f"{d}-{s}-{n}" for d, s, n in sets)
    if code == 5:
        return None, f"{ {1: 'LAST_INSERT_ID', 2: 'INSERT_ID'}.get(kind := body.uint(1), str(kind)) }={body.uint(8)}"
    if code == 13:
        return None, f"RAND_SEED1={body.uint(8)},RAND_SEED2={body.uint(8)}"
    if code == 14:
        name = body.take(body.uint(4)).decode("utf-8", "replace")
        return None, f"@{name}={_user_value(body)}"
    if code == 38:
        one_phase, form, first, second = body.uint(1), body.uint(4), body.uint(4), body.uint(4)
        return None, f"{'one phase ' if one_phase else ''}{form}:{body.take(first).hex()}:{body.take(second).hex()}"
    if code == 161:
        return None, body.take(body.uint(4)).decode("utf-8", "replace")
    if code in (17, 18):
        return _loading(code, body)
    if code == 29:
        body.take(1)
        return None, body.take(body.left()).decode("utf-8", "replace")
    if code == 160:
        return None, body.take(body.left()).decode("utf-8", "replace")
    return None, None


def decode(data: bytes, file_no: int, after: int = 0, until: int | None = None, ending: float | None = None, known: GtidSet | None = None) -> Iterator[tuple]:
    """The rows of SCHEMA of one file. Events that end at or before `after` only keep the table maps up to date; the first that
    ends behind `until`, or was logged at `ending` (seconds since 1970) or later, ends the reading. Transactions that `known`
    holds are left out, statements and rows alike."""
    if data[:4] != MAGIC:
        raise ValueError("not a binary log")
    at, checked, maps, skipped = 4, False, {}, False
    while at + 19 <= len(data):
        stamp, code, server, size, end, _ = struct.unpack_from("<IBIIIH", data, at)
        if size < 19 or at + size > len(data):
            return  # the writer hasn't finished this event
        if until is not None and at + size > until or ending is not None and stamp and stamp >= ending:
            return
        raw = data[at : at + size]
        if code == 15:
            # The last five bytes before the end tell which checksum follows every event.
            checked = size > 24 and raw[-5] == 1
        ok = zlib.crc32(raw[:-4]) == int.from_bytes(raw[-4:], "little") if checked else None
        body = Cursor(raw[19 : -4 if checked else None])
        at += size
        end = end or at
        logged = datetime.datetime.fromtimestamp(stamp, datetime.UTC) if stamp else None
        name = EVENTS.get(code, f"event_{code}")
        if code == 19:
            number, t = table_map(body)
            maps[number] = t
            if end > after and not skipped:
                yield (file_no, end, 0, logged, name, server, t.db, t.table, None, None, None, None, ok)
            continue
        if code == 4:
            maps.clear()
        if end <= after:
            continue
        if code in (23, 24, 25, 30, 31, 32, 39):
            if skipped:
                continue
            t, changed = rows(code, body, maps)
            for i, (before, now) in enumerate(changed):
                yield (file_no, end, i, logged, name, server, t.db, t.table, "D" if now is None else "U", None, _dumped(before), _dumped(now), ok)
            continue
        db, text = _plain(code, body, server)
        if code in (33, 34):
            skipped = code == 33 and known is not None and GtidSet.parse(text) in known
        if skipped:
            continue
        yield (file_no, end, 0, logged, name, server, db, None, "Q" if code == 2 else None, text, None, None, ok)


def _dumped(row: dict | None) -> str | None:
    return None if row is None else json.dumps(row, ensure_ascii=False)


def complete(path: str, start: int = 4) -> int:
    """Where the last whole event of a file ends, from the end `start` of one; headers are read, bodies skipped."""
    length = files.size(path)
    with files.reading(path) as data:
        at = start
        while at + 19 <= length:
            data.seek(at)
            step = int.from_bytes(data.read(13)[9:], "little")
            if step < 19 or at + step > length:
                break
            at += step
    return at


def _previous(path: str) -> GtidSet | None:
    """The transactions before a file, from its first events; None where it doesn't tell."""
    with files.reading(path) as f:
        head = f.read(1 << 20)
    for row in decode(head, 0):
        if row[4] == "previous_gtids":
            return GtidSet.parse(row[9])
        if row[4] not in ("format_description", "rotate"):
            break
    return None


@dataclass
class _File(InputPartition):
    path: str
    number: int
    after: int = 0
    until: int | None = None


@dataclass
class _Bounds:
    """What of the log is read: from (file, position), to (file, position) or a time, without known transactions and
    without ignored databases and tables."""

    path: str
    after: tuple[int, int] = (0, 0)
    until: tuple[int, int] | None = None
    before: float | None = None
    known: GtidSet | None = None
    ignored: dict[str, set[str]] = field(default_factory=dict)

    @staticmethod
    def of(options: Any) -> _Bounds:
        at = lambda f, p, empty: (int(options[f]), int(options.get(p, empty))) if f in options else None
        listed = lambda o: {x.strip() for x in options.get(o, "").split(",") if x.strip()}
        before = options.get("endTime")
        when = before and datetime.datetime.fromisoformat(before)
        return _Bounds(
            options["path"], at("startFile", "startPos", 0) or (0, 0), at("endFile", "endPos", 2**62),
            when and when.replace(tzinfo=when.tzinfo or datetime.UTC).timestamp(),
            GtidSet.parse(options["startGtid"]) if options.get("startGtid") else None,
            {"db_name": listed("ignoreDatabases"), "table_name": listed("ignoreTables")},
        )

    def files(self) -> list[tuple[int, str]]:
        """Numbers and paths in order. By transactions, reading starts at the last file before which only known ones lie."""
        names = [self.path] if files.is_file(self.path) else [files.joined(self.path, n) for n in files.file_names(self.path)]
        found = sorted((int(m[1]), n) for n in names if (m := re.search(r"\.?(\d+)$", n)))
        if self.known is not None:
            for i in range(len(found) - 1, 0, -1):
                held = _previous(found[i][1])
                if held is not None and held in self.known:
                    return found[i:]
        return found

    def rows(self, part: _File) -> Iterator[tuple]:
        with files.reading(part.path) as f:
            data = f.read()
        for row in decode(data, part.number, part.after, part.until, self.before, self.known):
            if row[6] not in self.ignored.get("db_name", ()) and row[7] not in self.ignored.get("table_name", ()):
                yield row


class _Reader(DataSourceReader):
    def __init__(self, bounds: _Bounds) -> None:
        self.bounds, self.wanted = bounds, {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in (("db_name",), ("table_name",), ("event",), ("op",), ("file_no",)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], values) & values
            elif isinstance(f, GreaterThan) and f.attribute == ("file_no",):
                self.bounds.after = max(self.bounds.after, (f.value, 2**62))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        b, keep = self.bounds, self.wanted.get("file_no")
        last = b.until or (2**62, 0)
        return [
            _File(n, i, b.after[1] if i == b.after[0] else 0, last[1] if i == last[0] else None)
            for i, n in b.files()
            if b.after[0] <= i <= last[0] and (keep is None or i in keep)
        ]

    def read(self, partition: _File) -> Iterator[tuple]:
        checks = [(6, "db_name"), (7, "table_name"), (4, "event"), (8, "op")]
        checks = [(i, self.wanted[n]) for i, n in checks if n in self.wanted]
        for row in self.bounds.rows(partition) if partition else ():
            if all(row[i] in values for i, values in checks):
                yield row


class _Stream(DataSourceStreamReader):
    """An offset is a file and the end of its last whole event, so events never fall between two batches."""

    def __init__(self, bounds: _Bounds, most: int, checkpoint: str | None) -> None:
        if most and not checkpoint:
            raise ValueError("maxFilesPerTrigger needs the query's checkpointLocation as option checkpoint")
        self.bounds, self.most, self.checkpoint = bounds, most, checkpoint

    def initialOffset(self) -> dict:  # noqa: N802
        first = self.bounds.after
        if self.bounds.known is not None and (listed := self.bounds.files()):
            first = max(first, (listed[0][0], 0))
        return {"file": first[0], "pos": first[1]}

    def latestOffset(self) -> dict:  # noqa: N802
        b = self.bounds
        listed = [(i, n) for i, n in b.files() if b.until is None or i <= b.until[0]]
        at = (files.planned(self.checkpoint) if self.checkpoint else None) or self.initialOffset()
        ahead = [(i, n) for i, n in listed if i >= at["file"]]
        # A file that was read to its end doesn't count; it is told from one that has grown by its length alone.
        if self.most and ahead:
            started = ahead[0][0] == at["file"] and at["pos"] >= complete(ahead[0][1])
            listed = ahead[: self.most + started]
        if not listed:
            return at
        number, path = listed[-1]
        end = complete(path)
        return {"file": number, "pos": min(end, b.until[1]) if b.until and number == b.until[0] else end}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [
            _File(n, i, start["pos"] if i == start["file"] else 0, end["pos"] if i == end["file"] else None)
            for i, n in self.bounds.files()
            if start["file"] <= i <= end["file"]
        ]

    def read(self, partition: _File) -> Iterator[tuple]:
        return self.bounds.rows(partition) if partition else iter(())


class BinlogSource(DataSource):
    """Options: path (a file or folder); startFile and startPos, endFile and endPos, the positions to read from and to;
    endTime, an ISO time (UTC without zone) at which reading ends; startGtid, a set of transactions already taken, which
    chooses the first file and is left out; ignoreDatabases and ignoreTables, names separated by commas; for streams
    maxFilesPerTrigger and with it checkpoint, the query's checkpointLocation (a run that triggers availableNow takes one such
    batch)."""

    @classmethod
    def name(cls) -> str:
        return "tidelog_binlog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: Any) -> DataSourceReader:
        return _Reader(_Bounds.of(self.options))

    def streamReader(self, schema: Any) -> DataSourceStreamReader:  # noqa: N802
        return _Stream(_Bounds.of(self.options), int(self.options.get("maxFilesPerTrigger", 0)), self.options.get("checkpoint"))
