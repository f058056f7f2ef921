import struct

import pytest
from pyspark.sql import functions as F

from tidelog import config
from tidelog.functions import names, normalize, packed


def one(spark, value, kind, *exprs):
    row = spark.createDataFrame([(value,)], f"c {kind}").select(*[e.alias(f"r{i}") for i, e in enumerate(exprs)]).first()
    return row[0] if len(exprs) == 1 else tuple(row)


C = None


@pytest.fixture(autouse=True)
def column(spark):
    global C
    C = F.col("c")


@pytest.mark.parametrize(("v", "bits", "want"), [(-15536, 16, 50000), (-6, 8, 250), (-16, 24, 16777200), (-6, 32, 4294967290), (-30, 64, 18446744073709551586), (5, 8, 5), (None, 64, None)])
def test_unsigned(spark, v, bits, want):
    assert one(spark, v, "bigint", normalize.unsigned(C, bits)) == want


def test_labels(spark):
    got = [one(spark, v, "bigint", normalize.enum_label(C, ["New", "OLD"])) for v in (0, 1, 2, 3, -1, None)]
    assert got == ["0", "new", "old", "3", "-1", None]
    assert [one(spark, v, "string", normalize.enum_text(C, ["New"])) for v in ("NEW", "x", None)] == ["new", "x", None]
    assert [one(spark, v, "bigint", normalize.set_labels(C, list("1234567"))) for v in (21, 26, 0, None)] == ["1,3,5", "2,4,5", "", None]


def test_years_uuid_dates(spark):
    assert [one(spark, v, "string", normalize.year(C)) for v in ("2024", "1800", "9999", "x", None)] == [2024, 1901, 2155, None, None]
    u = "6ccd780c-baba-1026-9564-5b8c656024db"
    assert one(spark, u.upper().replace("-", ""), "string", normalize.uuid_text(C)) == u and one(spark, "short", "string", normalize.uuid_text(C)) is None
    for v, reason in (("0000-00-00 00:00:00", "zero_date"), ("2015-00-21", "invalid_date"), (None, "null"), ("2015-05-05 10:00:00", None)):
        got = one(spark, v, "string", normalize.null_reason(C, normalize.moment(C)), normalize.moment_or_epoch(C))
        assert got[0] == reason and (str(got[1]) == "1970-01-01 00:00:00") == (reason is not None)


@pytest.mark.parametrize(
    ("seconds", "want"),
    [(838 * 3600 + 59 * 60 + 59, "34 days, 22:59:59"), (-(838 * 3600 + 59 * 60 + 59), "-35 days, 1:00:01"), (3 * 3600 + 245, "3:04:05"), (26 * 3600 + 184.12, "1 day, 2:03:04.120000"), (-1, "-1 day, 23:59:59"), (0, "0:00:00"), (None, None)],
)
def test_timedelta(spark, seconds, want):
    assert one(spark, None if seconds is None else round(seconds * 1_000_000), "bigint", normalize.timedelta_text(C)) == want


def test_decoding(spark):
    assert one(spark, "Hällo".encode("cp1252"), "binary", normalize.decoded(C, "latin1")) == "Hällo"
    assert one(spark, "привет".encode("cp1251"), "binary", normalize.decoded(C, "cp1251")) == "привет"
    for charset, text, codec in (("koi8r", "Ж", "koi8-r"), ("cp850", "Å", "cp850"), ("sjis", "日本", "shift_jis"), ("gbk", "中文", "gbk"), ("utf16", "aЖ", "utf-16-be"), ("utf8mb4", "😀", "utf-8"), ("greek", "ω", "iso8859-7")):
        assert one(spark, text.encode(codec), "binary", normalize.decoded(C, charset)) == text
    assert one(spark, b"a\xff", "binary", normalize.decoded(C, "utf8")) == "a\ufffd" and one(spark, b"\x81", "binary", normalize.decoded(C, "latin1")) == "\x81"
    assert one(spark, None, "binary", normalize.decoded(C, "sjis")) is None
    assert [normalize.collation_charset(n) for n in (8, 33, 45, 51, 63, 255, 9999)] == ["latin1", "utf8mb3", "utf8mb4", "cp1251", "binary", "utf8mb4", "utf8mb4"]
    assert one(spark, 95, "int", normalize.charset_of(C)) == "cp932"
    assert one(spark, '{"b": 1,\n "a":[1, 2]}', "string", normalize.json_text(C)) in ('{"b":1,"a":[1,2]}', '{"a":[1,2],"b":1}')
    assert one(spark, "{no", "string", normalize.json_text(C)) is None


def test_packed_fields(spark):
    assert [one(spark, v, "bigint", packed.sign_extended(C, 24)) for v in (16777215, 8388607, 8388608, 8, 16777208, 0)] == [-1, 8388607, -8388608, 8, -8, 0]
    assert [str(one(spark, (y << 9) | (m << 5) | d, "bigint", packed.date3(C))) for y, m, d in ((2024, 2, 29), (0, 1, 21), (2015, 0, 21), (2015, 5, 0), (2023, 2, 30))] == ["2024-02-29"] + ["None"] * 4
    time = lambda micros, digits: (1 << (23 + (digits + 1) // 2 * 8)) + micros
    assert one(spark, time(-((1 << 12) | 5), 0), "bigint", packed.time_micros(C, 0)) == -3605_000_000
    whole = ((2 << 12 | 3 << 6 | 4) << 24) + 120_000
    assert [one(spark, time(s * whole, 6), "bigint", packed.time_micros(C, 6)) for s in (1, -1)] == [7384_120_000, -7384_120_000]
    assert one(spark, 0b100010, "bigint", packed.bit_string(C, 8)) == "00100010"
    assert one(spark, b"\x01\x02\x03", "binary", packed.unsigned_of_bytes(C, 3), packed.unsigned_of_bytes(C, 3, False)) == (0x030201, 0x010203)


@pytest.mark.parametrize(("text", "p", "s"), [("4.20", 4, 2), ("42000.123456", 16, 6), ("-42000.123456", 16, 6), ("9000000123.0000012345", 20, 10), ("12345678912345678912345", 30, 0), ("-1234567891234567891234", 30, 0), ("0.00", 3, 2), ("-0.01", 3, 2)])
def test_decimals_round_trip(spark, text, p, s):
    data = packed.packed_decimal(text, p, s)
    assert packed.decimal_text(data, p, s) == text
    assert str(one(spark, data, "binary", packed.decimals(C, p, s))) == text and one(spark, None, "binary", packed.decimals(C, p, s)) is None


def test_geometry(spark):
    little = bytes.fromhex("010100000000000000000024400000000000003440")
    big = struct.pack(">BI2d", 0, 1, 10.0, 20.0)
    for data in (little, b"\0\0\0\0" + little, big):
        assert tuple(one(spark, data, "binary", packed.point(C))) == (10.0, 20.0)
    assert tuple(one(spark, None, "binary", packed.point(C))) == (0.0, 0.0)
    ring = [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]
    poly = struct.pack("<BII", 1, 3, 2) + (struct.pack("<I", 3) + b"".join(struct.pack("<2d", *p) for p in ring)) * 2
    assert [tuple(p) for p in one(spark, poly, "binary", packed.polygon(C))] == ring and one(spark, None, "binary", packed.polygon(C)) == []
    multi = struct.pack("<BII", 1, 6, 2) + poly + poly
    assert [len(r) for r in one(spark, b"\0\0\0\0" + multi, "binary", packed.multipolygon(C))] == [3, 3]


def small_object(entries):
    """Binary JSON of an object of small values, each (key, type, inline 2 bytes or data)."""
    keys, values, data = b"", b"", b""
    head = 4 + len(entries) * 7
    key_bytes = "".join(k for k, *_ in entries).encode()
    at = head
    for k, *_ in entries:
        keys += struct.pack("<HH", at, len(k.encode()))
        at += len(k.encode())
    for _, kind, payload in entries:
        if kind in (4, 5, 6):
            values += bytes([kind]) + payload
        else:
            values += bytes([kind]) + struct.pack("<H", at + len(data))
            data += payload
    body = keys + values + key_bytes + data
    return struct.pack("<HH", len(entries), 4 + len(body)) + body


def test_binary_json(spark):
    inner = small_object([("bar", 5, struct.pack("<h", 10)), ("kro", 5, struct.pack("<h", -22))])
    amount = packed.packed_decimal("99.99", 4, 2)
    when = struct.pack("<q", (((2023 * 13 + 9) << 22) | (24 << 17) | (18 << 12) | (54 << 6) | 12) << 24)
    doc = b"\0" + small_object(
        [("foo", 0, inner), ("t", 4, b"\1\0"), ("n", 4, b"\0\0"), ("q\"", 12, b"\x03a\xc3\xab"), ("d", 11, struct.pack("<d", 1.5)), ("big", 10, struct.pack("<Q", 2**64 - 1)), ("l", 12, b"\xa4\x0d" + b"x" * 1700),
         ("amount", 15, bytes([246, len(amount) + 2, 4, 2]) + amount), ("at", 15, bytes([12, 8]) + when)]
    )
    got = one(spark, doc, "binary", packed.json_documents(C))
    assert got == '{"foo": {"bar": 10, "kro": -22}, "t": true, "n": null, "q\\"": "aë", "d": 1.5, "big": 18446744073709551615, "l": "' + "x" * 1700 + '", "amount": 99.99, "at": "2023-09-24 18:54:12.000000"}'
    assert one(spark, b"", "binary", packed.json_documents(C)) == "null" and one(spark, None, "binary", packed.json_documents(C)) is None
    array = b"\x02" + struct.pack("<HH", 2, 0) + b"\x0c" + struct.pack("<H", 10) + b"\x04\x02\x00" + b"\x03foo"
    assert one(spark, array, "binary", packed.json_documents(C)) == '["foo", false]'


def test_names(spark):
    assert [one(spark, v, "string", names.plain_name(C)) for v in (" `Ab`\t", "x y", "", None)] == ["ab", "x y", "", None]
    assert [one(spark, v, "string", names.file_number(C)) for v in ("/a/b.000123", "B.01000003", "x", "", None, "b.99999999999999999999")] == [123, 1000003, None, None, None, None]


@pytest.mark.parametrize("name", ["test_table_2", "test_table_15", "test_table_142", "a.b", "A", "", "x[y", "line\nbreak"])
@pytest.mark.parametrize("patterns", ["*", "", [], "test_table_1*", ["test_table_2", "*42"], "a?b", "[!a]*", "x[[]y", "[a-z].*", "li*"])
def test_globs_agree_with_plain_matching(spark, name, patterns):
    assert one(spark, name, "string", config.selected(C, patterns)) == config.matches(name, patterns)


def test_settings():
    s = config.Settings.load(
        "databases: ['a*', b]\nexclude_tables: '*_tmp'\ntarget_databases: {a1: t, b: t, c: u}\norder_bys: [{value: [ts], databases: a*, tables: [x]}]\nsource: {host: h, port: 3307}", {"SOURCE_PASSWORD": "p", "SOURCE_PORT": "99"}
    )
    assert s.source == config.Connection("h", 99, "root", "p") and s.shared_targets() == ["t"] and s.scoped("order_bys", "a1", "x") == [["ts"]] and s.scoped("order_bys", "b", "x") == []
    for bad in ("surprise: 1", "source: {port: 0}", "log_level: loud", "source_timezone: Mars/Base", "rows_per_file: -1"):
        with pytest.raises(ValueError):
            config.Settings.load(bad, {})


def test_routing(spark):
    s = config.Settings(databases=["d*"], exclude_databases="dx", target_databases={"d1": "t"}, target_tables={"d1.a": "a_new"})
    df = spark.createDataFrame([("d1", "a"), ("d2", "a"), ("dx", "a"), (None, "a")], "db string, tbl string")
    rows = df.where(s.database_selected("db")).select(s.target_database("db").alias("x"), s.target_table("db", "tbl").alias("y")).collect()
    assert [tuple(r) for r in rows] == [("t", "a_new"), ("d2", "a")]
