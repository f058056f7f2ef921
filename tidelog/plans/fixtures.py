"""Binary logs written from tables, for the queries that read them back: the public format's header, table map and row
events, a file per task."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.functions.packed import packed_decimal
from tidelog.sources import binlog, files

LABELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CREATE = (
    "CREATE TABLE customer (id BIGINT PRIMARY KEY, name VARCHAR(100), nation INT, balance DOUBLE, price DECIMAL(18,2), segment ENUM("
    + ",".join(f"'{x}'" for x in LABELS)
    + "), extra JSON)"
)
_NAMES = ("id", "name", "nation", "balance", "price", "segment", "extra")
_ROWS = 200


def _coded(n: int) -> bytes:
    return bytes([n]) if n < 251 else b"\xfc" + struct.pack("<H", n)


def _json(n: int) -> bytes:
    """{"n": n} in binary JSON: an object with one key, its number stored behind it."""
    body = struct.pack("<HH", 1, 16) + struct.pack("<HH", 11, 1) + bytes([7]) + struct.pack("<H", 12) + b"n" + struct.pack("<i", n)
    return b"\0" + body


class _Log:
    def __init__(self) -> None:
        self.data = binlog.MAGIC
        self.event(15, struct.pack("<H50sIB", 4, b"8.0.0", 0, 19) + bytes(40) + b"\1")  # ends in the kind of checksum

    def event(self, code: int, body: bytes) -> None:
        size = 23 + len(body)
        raw = struct.pack("<IBIIIH", 1_700_000_000, code, 1, size, len(self.data) + size, 0) + body
        self.data += raw + struct.pack("<I", zlib.crc32(raw))

    def statement(self, db: str, sql: str) -> None:
        self.event(2, struct.pack("<IIBHH", 1, 0, len(db), 0, 0) + db.encode() + b"\0" + sql.encode())

    def table(self, db: str, name: str) -> None:
        kinds = [(binlog.LONGLONG, b""), (binlog.VARCHAR, struct.pack("<H", 400)), (binlog.LONG, b""), (binlog.DOUBLE, b"\x08"), (binlog.NEWDECIMAL, bytes([18, 2])), (binlog.STRING, bytes([binlog.ENUM, 1])), (binlog.JSON, b"\4")]
        meta, listed = b"".join(m for _, m in kinds), b"".join(_coded(len(n)) + n.encode() for n in _NAMES)
        labels = _coded(len(LABELS)) + b"".join(_coded(len(x)) + x.encode() for x in LABELS)
        body = (1).to_bytes(6, "little") + b"\1\0" + bytes([len(db)]) + db.encode() + b"\0" + bytes([len(name)]) + name.encode() + b"\0"
        body += _coded(len(kinds)) + bytes(k for k, _ in kinds) + _coded(len(meta)) + meta + b"\x7f"
        self.event(19, body + b"\4" + _coded(len(listed)) + listed + b"\6" + _coded(len(labels)) + labels)

    def rows(self, images: list[bytes]) -> None:
        self.event(30, (1).to_bytes(6, "little") + b"\0\0" + struct.pack("<H", 2) + b"\7\x7f" + b"".join(images))


def _image(row: dict) -> bytes:
    name, extra = (row["c_name"] or "").encode(), _json(row["c_nationkey"])
    return (
        bytes([2 if row["c_name"] is None else 0]) + struct.pack("<q", row["c_custkey"]) + (b"" if row["c_name"] is None else struct.pack("<H", len(name)) + name)
        + struct.pack("<i", row["c_nationkey"]) + struct.pack("<d", row["c_acctbal"]) + packed_decimal(f"{row['c_acctbal']:.2f}", 18, 2)
        + bytes([LABELS.index(row["c_mktsegment"]) + 1]) + struct.pack("<I", len(extra)) + extra
    )


def _writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, log, images, n = TaskContext.get().partitionId() + 1, _Log(), [], 0
        log.statement("shop", CREATE)
        log.table("shop", "customer")
        for batch in batches:
            for row in batch.to_pylist():
                images.append(_image(row))
                n += 1
                if len(images) == _ROWS:
                    log.rows(images)
                    images = []
        if images:
            log.rows(images)
        with files.writing(files.joined(folder, f"bin.{number:06d}")) as out:
            out.write(log.data)
        yield pa.record_batch([pa.array([number], pa.int64()), pa.array([n], pa.int64())], ["number", "rows"])

    return run


def write_customers(customers: DataFrame, folder: str) -> int:
    """Writes customer rows to bin.000001, … in a folder; returns how many rows."""
    written = customers.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").mapInArrow(_writer(folder), "number long, rows long")
    return sum(r["rows"] for r in written.collect())  # a number per file


