"""Queues and binary logs, the latter from logs written here by the public format."""

import datetime
import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.functions.packed import packed_decimal
from tidelog.operators import changefeed
from tidelog.session import shared_dir
from tidelog.sources import binlog, queue


def coded(n):
    return bytes([n]) if n < 251 else b"\xfc" + struct.pack("<H", n)


class Writer:
    """A binary log with checksums."""

    def __init__(self, checked=True):
        self.data, self.checked = binlog.MAGIC, checked
        body = struct.pack("<H50sIB", 4, b"8.0.0", 0, 19) + bytes(40) + bytes([int(checked)])
        self.event(15, body, force=True)

    def event(self, code, body, force=False, stamp=1_700_000_000):
        tail = 4 if self.checked or force else 0
        size = 19 + len(body) + tail
        raw = struct.pack("<IBIIIH", stamp, code, 7, size, len(self.data) + size, 0) + body
        self.data += raw + (struct.pack("<I", zlib.crc32(raw)) if tail else b"")
        return len(self.data)

    def query(self, db, sql):
        return self.event(2, struct.pack("<IIBHH", 1, 0, len(db), 0, 0) + db.encode() + b"\0" + sql.encode())

    def table(self, number, db, name, columns, names=None, extra=b""):
        """columns: (type, metadata bytes, unsigned or labels)."""
        body = number.to_bytes(6, "little") + b"\1\0" + bytes([len(db)]) + db.encode() + b"\0" + bytes([len(name)]) + name.encode() + b"\0"
        meta = b"".join(m for _, m in columns)
        body += coded(len(columns)) + bytes(t for t, _ in columns) + coded(len(meta)) + meta + bytes((len(columns) + 7) // 8)
        if names:
            listed = b"".join(coded(len(n.encode())) + n.encode() for n in names)
            body += b"\4" + coded(len(listed)) + listed
        return self.event(19, body + extra)

    def rows(self, code, number, n, images, present=None):
        bits = present or bytes([(1 << min(8, n - 8 * i)) - 1 for i in range((n + 7) // 8)])
        body = number.to_bytes(6, "little") + b"\0\0" + struct.pack("<H", 2) + coded(n) + bits * (2 if code == 31 else 1)
        return self.event(code, body + b"".join(images))


def image(values):
    """values: bytes or None for null, column by column."""
    nulls = sum(1 << i for i, v in enumerate(values) if v is None)
    return nulls.to_bytes((len(values) + 7) // 8, "little") + b"".join(v for v in values if v is not None)


def a_log(checked=True):
    w = Writer(checked)
    w.event(33, b"\0" + bytes(range(16)) + struct.pack("<Q", 5))
    w.query("shop", "CREATE TABLE t (id int unsigned primary key, name varchar(300))")
    w.table(1, "shop", "t", [(binlog.LONG, b""), (binlog.VARCHAR, struct.pack("<H", 300))], ["id", "name"], b"\1\1\x80")
    w.rows(30, 1, 2, [image([struct.pack("<I", 4294967290), struct.pack("<H", 3) + "zoë".encode()[:3]]), image([struct.pack("<I", 2), None])])
    w.rows(31, 1, 2, [image([struct.pack("<I", 2), None]), image([struct.pack("<I", 2), struct.pack("<H", 1) + b"x"])])
    w.rows(32, 1, 2, [image([struct.pack("<I", 4294967290), None])])
    w.event(16, struct.pack("<Q", 99))
    w.event(4, struct.pack("<Q", 4) + b"bin.000002")
    return w.data


@pytest.mark.parametrize("checked", [True, False])
def test_decodes_events(checked):
    rows = list(binlog.decode(a_log(checked), 1))
    assert [r[4] for r in rows] == ["format_description", "gtid", "query", "table_map", "write_rows", "write_rows", "update_rows", "delete_rows", "xid", "rotate"]
    assert all(r[12] is (True if checked else None) for r in rows[1:])
    assert rows[1][9].endswith(":5") and rows[2][6] == "shop" and rows[2][8] == "Q" and rows[2][9].startswith("CREATE TABLE t") and rows[9][9] == "bin.000002"
    assert json.loads(rows[4][11])["id"] == 4294967290 and json.loads(rows[5][11]) == {"id": 2, "name": None} and rows[5][2] == 1
    assert json.loads(rows[6][10]) == {"id": 2, "name": None} and json.loads(rows[6][11]) == {"id": 2, "name": "x"} and rows[7][8] == "D"


def test_broken_checksum_and_unfinished_tail():
    data = bytearray(a_log())
    data[-8] ^= 1
    rows = list(binlog.decode(bytes(data), 1))
    assert [r[12] for r in rows].count(False) == 1
    assert len(list(binlog.decode(a_log()[:-5], 1))) == 9
    with pytest.raises(ValueError):
        list(binlog.decode(b"nope", 1))


def test_column_types():
    w = Writer()
    dec = packed_decimal("-42000.123456", 16, 6)
    when = datetime.datetime(2024, 2, 29, 10, 11, 12)
    packed_when = (1 << 39) | ((2024 * 13 + 2) << 22) | (29 << 17) | (10 << 12) | (11 << 6) | 12
    clock = (1 << 23) - ((3 << 12) | (4 << 6) | 5)
    columns = [
        (binlog.TINY, b"", b"\xfe", -2), (binlog.SHORT, b"", struct.pack("<h", -300), -300), (binlog.INT24, b"", b"\xff\xff\xff", -1), (binlog.LONGLONG, b"", struct.pack("<q", -5), -5),
        (binlog.FLOAT, b"\4", struct.pack("<f", 1.5), 1.5), (binlog.DOUBLE, b"\x08", struct.pack("<d", -2.25), -2.25), (binlog.NEWDECIMAL, bytes([16, 6]), dec, "-42000.123456"), (binlog.YEAR, b"", b"\x7c", 2024),
        (binlog.DATE, b"", ((2024 << 9) | (2 << 5) | 29).to_bytes(3, "little"), "2024-02-29"), (binlog.DATE, b"", b"\0\0\0", None), (binlog.DATETIME2, b"\3", packed_when.to_bytes(5, "big") + struct.pack(">H", 1230), f"{when}.123000"),
        (binlog.DATETIME, b"", struct.pack("<Q", 20240229101112), str(when)), (binlog.TIMESTAMP2, b"\0", struct.pack(">I", 1709201472), str(when)), (binlog.TIMESTAMP, b"", struct.pack("<I", 0), None), (binlog.TIME2, b"\0", clock.to_bytes(3, "big"), "-03:04:05"),
        (binlog.TIME, b"", (123456).to_bytes(3, "little"), "12:34:56"), (binlog.BIT, bytes([2, 1]), b"\x02\x05", "1000000101"), (binlog.STRING, bytes([binlog.ENUM, 1]), b"\2", 2), (binlog.STRING, bytes([binlog.SET, 1]), b"\5", 5),
        (binlog.STRING, bytes([254, 20]), b"\2hi", "hi"), (binlog.BLOB, b"\2", struct.pack("<H", 2) + b"\xff\xfe", "base64://4="), (binlog.JSON, b"\4", struct.pack("<I", 3) + b"\4\1\0"[:2] + b"", True), (binlog.VARCHAR, struct.pack("<H", 40), b"\3abc", "abc"),
    ]
    columns[-2] = (binlog.JSON, b"\4", struct.pack("<I", 2) + b"\4\1", True)
    w.table(9, "d", "all", [(t, m) for t, m, *_ in columns])
    w.rows(30, 9, len(columns), [image([v for _, _, v, _ in columns])])
    got = json.loads(list(binlog.decode(w.data, 1))[-1][11])
    assert [got[f"c{i}"] for i in range(len(columns))] == [x for *_, x in columns]


def test_enum_and_set_labels():
    w = Writer()
    labels = b"\6\x06\2\1a\2bb\5\x05\2\1x\1y"
    w.table(3, "d", "e", [(binlog.STRING, bytes([binlog.ENUM, 1])), (binlog.STRING, bytes([binlog.SET, 1]))], ["e", "s"], labels)
    w.rows(30, 3, 2, [image([b"\2", b"\3"])])
    assert json.loads(list(binlog.decode(w.data, 1))[-1][11]) == {"e": "bb", "s": "x,y"}


def test_binlog_source(spark, tmp_path):
    for n in (9, 10):
        (tmp_path / f"bin.{n:06d}").write_bytes(a_log())
    spark.dataSource.register(binlog.BinlogSource)
    read = lambda **o: spark.read.format("tidelog_binlog").options(path=str(tmp_path), **o).load()
    assert read().count() == 20
    changed = read().where("db_name = 'shop' AND op IN ('U', 'D')")
    assert changed.count() == 8 and {r.file_no for r in changed.collect()} == {9, 10}
    pos = read().where("event = 'query'").first().log_pos
    assert read(startFile=9, startPos=pos).where("file_no = 9").count() == 7 and read(startFile=10).count() == 10
    final = read().where("op IN ('U', 'D')").groupBy(F.get_json_object(F.coalesce("after", "before"), "$.id").alias("id"))
    assert {r.id: r.op for r in final.agg(F.max_by("op", F.struct("file_no", "log_pos", "row_no")).alias("op")).collect()} == {"4294967290": "D", "2": "U"}


def events(n, start=0):
    return [{"transaction_id": {"file_name": "b.1", "log_pos": start + i}, "event_type": 1, "table_name": "u", "records": [[i, "v"]]} for i in range(n)]


def test_queue_files_and_filters(spark, tmp_path):
    root = str(tmp_path)
    assert queue.append_events(root, "d1", events(25), rows_per_file=10) == [1, 2, 3] and queue.append_events(root, "d2", events(3)) == [1]
    assert queue.append_events(root, "d1", events(2, 100)) == [4]
    spark.dataSource.register(queue.QueueSource)
    df = spark.read.format("tidelog_queue").option("path", root).load()
    assert df.count() == 30 and df.where("db_name = 'd2'").count() == 3
    layouts = spark.createDataFrame([("u", ["id", "v"], ["id"])], "table_name string, table_fields array<string>, primary_keys array<string>")
    state = changefeed.live(changefeed.apply_changes(changefeed.changes(df, layouts), shared_dir(spark, "q"), 2))
    assert {(r.db_name, r.record_key): r.log_pos for r in state.collect()}[("d1", "0")] == 100
    os.utime(tmp_path / "d1" / "1.jsonl", (0, 0))
    assert [os.path.basename(p) for p in queue.remove_old(root, 60, keep=2)] == ["1.jsonl"]


def test_queue_stream(spark, tmp_path):
    root = str(tmp_path / "q")
    queue.append_events(root, "d", events(4))
    spark.dataSource.register(queue.QueueSource)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        s = spark.readStream.format("tidelog_queue").option("path", root).load().select("db_name", "transaction_id.log_pos")
        s.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 4
    queue.append_events(root, "d", events(3, 50))
    assert run() == 7 and run() == 7


def _gtid(w, n, previous=False):
    sid = bytes(range(16))
    if previous:
        return w.event(35, struct.pack("<Q", 1) + sid + struct.pack("<QQQ", 1, 1, n))
    return w.event(33, b"\0" + sid + struct.pack("<Q", n))


def _row(w, number, n):
    w.table(number, "shop", "t", [(binlog.LONG, b"")], ["id"])
    w.rows(30, number, 1, [image([struct.pack("<i", n)])])
    return w.event(16, struct.pack("<Q", n), stamp=1_700_000_000 + n)


def three_files(folder):
    """Transactions 1 to 6, two a file."""
    os.makedirs(folder, exist_ok=True)
    ends = []
    for k in range(3):
        w = Writer()
        if k:
            _gtid(w, 2 * k + 1, previous=True)
        for n in (2 * k + 1, 2 * k + 2):
            _gtid(w, n)
            ends.append((k + 1, _row(w, 5, n)))
        with open(f"{folder}/bin.{k + 1:06d}", "wb") as f:
            f.write(w.data)
    return ends


SID = "00010203-0405-0607-0809-0a0b0c0d0e0f"


def ids(df):
    return [json.loads(r.after)["id"] for r in df.where("op = 'U'").orderBy("file_no", "log_pos").collect()]


def test_binlog_bounds(spark, tmp_path):
    ends = three_files(tmp_path / "log")
    spark.dataSource.register(binlog.BinlogSource)
    read = lambda **o: ids(spark.read.format("tidelog_binlog").options(path=f"file://{tmp_path}/log", **o).load())
    assert read() == [1, 2, 3, 4, 5, 6]
    assert read(startFile=ends[0][0], startPos=ends[0][1]) == [2, 3, 4, 5, 6]
    assert read(endFile=ends[2][0], endPos=ends[2][1]) == [1, 2, 3] and read(endFile=2) == [1, 2, 3, 4]
    assert read(startGtid=f"{SID}:1-3") == [4, 5, 6] and read(startGtid=f"{SID}:2:5") == [1, 3, 4, 6] and read(startGtid=f"{SID}:1-9") == []
    assert read(ignoreDatabases="shop") == [] and read(ignoreTables="x, t") == [] and read(ignoreTables="x") == [1, 2, 3, 4, 5, 6]
    assert read(endTime="2023-11-14T22:13:24") == [1, 2, 3, 4, 5]  # the commit of 4 is of that time and ends file 2, that of 5 file 3


def test_binlog_stream_follows_a_growing_file(spark, tmp_path):
    folder = tmp_path / "log"
    three_files(folder)
    spark.dataSource.register(binlog.BinlogSource)
    whole = (folder / "bin.000003").read_bytes()
    (folder / "bin.000003").write_bytes(whole[:-20])  # the last event is still being written
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = spark.readStream.format("tidelog_binlog").option("path", str(folder)).option("maxFilesPerTrigger", 1).option("checkpoint", cp).load()
        stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.parquet(out)

    first = run()
    events = first.count()
    assert set(ids(first)) <= {1, 2, 3, 4, 5, 6}
    (folder / "bin.000003").write_bytes(whole)
    again = run()
    while again.count() > events:
        events, again = again.count(), run()
    assert ids(again) == [1, 2, 3, 4, 5, 6] and again.where("event = 'xid'").count() == 6
    assert again.groupBy("file_no", "log_pos", "row_no").count().where("count > 1").count() == 0


def test_rows_without_their_map_raise():
    w = Writer()
    w.rows(30, 77, 1, [image([b"\1"])])
    with pytest.raises(ValueError, match="table 77"):
        list(binlog.decode(w.data, 1))


def test_table_map_metadata():
    w = Writer()
    extra = b"\2\5\x08\1\xfc\x33\0" + b"\7\1\3" + b"\x08\1\0" + b"\x0c\1\xa0"  # latin1, but cp1251 for the second text; a polygon; key; visibility
    w.table(4, "d", "m", [(binlog.VARCHAR, struct.pack("<H", 40)), (binlog.VARCHAR, struct.pack("<H", 40)), (binlog.GEOMETRY, b"\2")], ["a", "b", "g"], extra)
    w.rows(30, 4, 3, [image([b"\1\xe9", b"\1\xe6", struct.pack("<H", 1) + b"x"])])
    number, t = binlog.table_map(binlog.Cursor(w.data[w.data.index(b"\4\0\0\0\0\0\1\0\1d") : w.data.index(extra) + len(extra)] + b"\0"))
    assert [c.collation for c in t.columns[:2]] == [8, 51] and t.columns[2].geometry == 3 and t.key == [(0, 0)] and [c.visible for c in t.columns] == [True, False, True]
    got = json.loads(list(binlog.decode(w.data, 1))[-1][11])
    assert got["a"] == "é" and got["b"] == "ж"


def test_other_events():
    w = Writer()
    w.event(5, b"\2" + struct.pack("<Q", 7))
    w.event(13, struct.pack("<QQ", 3, 4))
    w.event(14, struct.pack("<I", 1) + b"v" + b"\0\2" + struct.pack("<II", 63, 8) + struct.pack("<q", -5) + b"\0")
    w.event(14, struct.pack("<I", 1) + b"t" + b"\0\0" + struct.pack("<II", 8, 1) + b"\xe9")
    w.event(162, struct.pack("<QI", 9, 1) + b"\0" * 6)
    w.event(163, struct.pack("<IIIQIIQ", 2, 0, 1, 5, 1, 2, 6))
    w.event(161, struct.pack("<I", 10) + b"bin.000004")
    w.event(17, struct.pack("<I", 3) + b"abcd")
    texts = [r[9] for r in binlog.decode(w.data, 1)][1:]
    assert texts == ["INSERT_ID=7", "RAND_SEED1=3,RAND_SEED2=4", "@v=-5", '@t="é"', "1-7-9", "0-1-5,1-2-6", "bin.000004", "file 3, 4 bytes"]


def test_queue_written_by_spark(spark, tmp_path):
    spark.dataSource.register(queue.QueueSource)
    root = f"file://{tmp_path}/q"
    rows = [(f"d{i % 2}", (f"bin.{1 + i // 50:06d}", i), 1 + i % 2, "t", json.dumps([[i]])) for i in range(120)] + [(None, None, 0, None, None)]
    df = spark.createDataFrame(rows, "db_name string, transaction_id struct<file_name:string,log_pos:bigint>, event_type int, table_name string, records string")
    df.coalesce(1).write.format("tidelog_queue").option("path", root).option("rowsPerFile", 25).mode("append").save()
    read = lambda **o: spark.read.format("tidelog_queue").options(path=root, **o).load()
    assert queue.numbers(f"{root}/d0") == [1, 2, 3] and read().count() == 121 and read().where("db_name = '_'").count() == 1
    assert [r.p for r in read().where("db_name = 'd1'").orderBy("file_num", "line_no").selectExpr("transaction_id.log_pos AS p").collect()] == list(range(1, 120, 2))
    assert queue.last_transaction(root, "d0") == (3, 118) and queue.last_transaction(root, "none") is None
    assert [queue.file_of(root, "d0", p) for p in ((0, 0), (1, 0), (1, 49), (2, 51), (9, 9))] == [0, 1, 1, 2, 3]
    assert sorted(r.p for r in read(afterFile=2, afterPos=98).where("db_name = 'd0'").selectExpr("transaction_id.log_pos AS p").collect()) == list(range(100, 120, 2))
    with pytest.raises(Exception, match="only appended"):
        df.write.format("tidelog_queue").option("path", root).mode("overwrite").save()
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = spark.readStream.format("tidelog_queue").option("path", root).option("maxFilesPerTrigger", 1).option("checkpoint", cp).load()
    query = stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(processingTime="0 seconds").start(out)
    query.processAllAvailable()
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    assert sum(sizes) == 121 and max(sizes) <= 51


def _int_json(n):
    return b"\5" + struct.pack("<h", n)


def _doc():
    """{"a": 1, "b": [true, null]} in binary JSON."""
    keys = struct.pack("<HHHH", 18, 1, 19, 1)
    values = b"\5" + struct.pack("<h", 1) + b"\2" + struct.pack("<H", 20)
    inner = struct.pack("<HH", 2, 10) + b"\4\1\0" + b"\4\0\0"
    return b"\0" + struct.pack("<HH", 2, 30) + keys + values + b"ab" + inner


def test_partial_json_updates():
    from tidelog.functions.packed import binary_json, json_changed, json_diffs

    assert binary_json(_doc()) == {"a": 1, "b": [True, None]}
    step = lambda what, path, v=None: bytes([what, len(path)]) + path.encode() + (bytes([len(v)]) + v if v is not None else b"")
    diff = step(0, "$.a", _int_json(7)) + step(1, "$.b[1]", _int_json(5)) + step(2, "$.b[0]") + step(1, '$."x y"', _int_json(-3))
    w = Writer()
    w.table(6, "d", "j", [(binlog.LONG, b""), (binlog.JSON, b"\4"), (binlog.JSON, b"\4")], ["id", "doc", "other"])
    document = struct.pack("<I", len(_doc())) + _doc()
    plain = struct.pack("<I", 3) + _int_json(9)
    before = image([struct.pack("<i", 1), document, plain])
    after = b"\1" + b"\1" + image([struct.pack("<i", 1), struct.pack("<I", len(diff)) + diff, plain])  # options, then a bit per JSON column
    body = (6).to_bytes(6, "little") + b"\0\0" + struct.pack("<H", 2) + b"\3\7\7"
    w.event(39, body + before + after + before + b"\0" + image([struct.pack("<i", 1), None, plain]))
    rows = [r for r in binlog.decode(w.data, 1) if r[4] == "partial_update_rows"]
    assert [json.loads(r[11]) for r in rows] == [{"id": 1, "doc": {"a": 7, "b": [5, None], "x y": -3}, "other": 9}, {"id": 1, "doc": None, "other": 9}]
    assert json.loads(rows[0][10])["doc"] == {"a": 1, "b": [True, None]} and rows[0][8] == "U"
    assert json_changed([1], json_diffs(step(0, "$", _int_json(4)))) == 4
    with pytest.raises(ValueError, match="no \\$.z"):
        json_changed({}, json_diffs(step(2, "$.z")))
