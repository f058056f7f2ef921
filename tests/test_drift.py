import datetime
import json

from pyspark.sql import functions as F

from tidelog.operators import drift

S = "structure_no bigint, db_name string, table_name string, file_no int, exported_at timestamp_ntz, table_fields array<struct<field_name:string,field_type:string,parameters:string>>, primary_keys array<string>, charset_name string"
R = "file_row_no bigint, db_name string, table_name string, file_no int, line_no int, payload string"
T = datetime.datetime(2024, 1, 1)


def data(spark, files, table="T"):
    """files: (fields {name: type}, key, rows) from file 1 on."""
    structures, rows = [], []
    for n, (fields, key, records) in enumerate(files, 1):
        listed = [(k, v, None) for k, v in fields.items()]
        structures += [(n, "D", f" `{table}`", n, T, listed, key, None), (n + 100, "d", table.lower(), n, T, [(k.upper() + " ", v.upper().replace("(", " ("), "x") for k, v in fields.items()][::-1], key, "u")]
        for i, r in enumerate(records):
            rows += [(n * 1000 + i, "d", table, n, i, r if isinstance(r, str) or r is None else json.dumps(r))] * 2
    return spark.createDataFrame(structures, S), spark.createDataFrame(rows, R)


def found(spark, files):
    changes, _ = drift.changes(*data(spark, files))
    return {(r.file_no, r.change_kind, r.field_name) for r in changes.collect()}


INT = {"id": "int", "a": "int", "b": "varchar(10)"}


def test_kinds_of_change(spark):
    rows = [{"id": i, "a": i * 2, "b": f"x{i}"} for i in range(5)]
    moved = [{"ID": r["id"], "c": str(r["a"]), "b": r["b"], "n": 1} for r in rows]
    got = found(spark, [
        (INT, ["id"], rows),
        ({"b": "varchar(10)", "id": "INT", "c": "bigint", "n": "int"}, ["id", "c"], moved),
        ({"id": "int", "c": "bigint", "n": "int"}, ["id"], [{"id": r["ID"], "c": r["c"], "n": 1} for r in moved]),
    ])
    assert got == {(2, "renamed", "c"), (2, "type_changed", "c"), (2, "added", "n"), (2, "key_changed", "id,c"), (3, "removed", "b"), (3, "key_changed", "id")}


def test_one_differing_value_is_no_rename(spark):
    got = found(spark, [(INT, ["id"], [{"id": 1, "a": 1, "b": None}, {"id": 2, "a": 2}]), ({"id": "int", "z": "int", "b": "varchar(10)"}, ["id"], [{"id": 1, "z": 1}, {"id": 2, "z": 3}, {"id": 9, "z": 4}])])
    assert got == {(2, "added", "z"), (2, "removed", "a")}


def test_key_follows_a_rename_and_null_values_match(spark):
    got = found(spark, [(INT, ["id", "a"], [{"id": 1, "a": 7, "b": None}, {"id": 2, "a": 8}]), ({"id": "int", "k": "int", "b2": "varchar(10)"}, ["id", "k"], [{"id": 1, "k": 7}, {"id": 2, "k": 8, "b2": None}])])
    assert got == {(2, "renamed", "k"), (2, "renamed", "b2")}


def test_no_common_record_no_rename_and_gap(spark):
    assert found(spark, [(INT, ["id"], [{"id": 1, "a": 1}]), ({"id": "int", "q": "int", "b": "varchar(10)"}, ["id"], [{"id": 2, "q": 1}])]) == {(2, "added", "q"), (2, "removed", "a")}
    s, r = data(spark, [(INT, ["id"], []), (INT, ["id"], []), ({"id": "int"}, ["id"], [])])
    assert drift.changes(s.where("file_no <> 2"), r)[0].count() == 0


def test_unreadable_and_empty(spark):
    assert found(spark, [(INT, ["id"], [None, "", "[1]", "{bad", {"a": 1}]), (INT, ["id"], [None])]) == set()
    s, r = data(spark, [(INT, ["id"], [])])
    assert drift.changes(s.limit(0), r.limit(0))[0].count() == 0
    nulls = spark.createDataFrame([(1, None, None, 1, None, None, None, None)], S)
    assert drift.changes(nulls, r)[0].count() == 0


def test_ingest_keeps_every_value(spark):
    s, r = data(spark, [(INT, ["id"], [{"id": 1, "a": "x1", "b": "far too long a text", "zz": 5}, {"id": 2, "a": 3, "A": 4}])])
    out = {x.id: x for x in drift.ingest(drift.file_records(r), drift.structures(s)).collect()}
    assert out["1"].typed == {"id": "1", "a": None, "b": None} and json.loads(out["1"].rescued) == {"a": "x1", "b": "far too long a text", "zz": "5"}
    assert out["2"].typed == {"id": "2", "a": "3", "b": None} and out["2"].rescued is None


def test_promote_replays_what_fits(spark):
    s, r = data(spark, [({"id": "int"}, ["id"], [{"id": 1, "n": "5"}, {"id": 2, "n": "five"}])])
    held = drift.ingest(drift.file_records(r), drift.structures(s))
    approved = spark.createDataFrame([("d", "t", 1, "n", "count", "int")], "db_name string, table_name string, file_no int, name string, target_name string, target_type string")
    out = {x.id: (x.typed, x.rescued) for x in drift.promote(held, approved).collect()}
    assert out == {"1": ({"id": "1", "count": "5"}, None), "2": ({"id": "2"}, '{"n":"five"}')}


def test_consistent_table(spark):
    s, r = data(spark, [(INT, ["id"], [{"id": 1, "a": 1, "b": "x"}, {"id": 2, "a": 2, "b": "y"}]), ({"id": "int", "c": "int"}, ["id"], [{"id": 1, "c": 1}, {"id": 2, "c": 2}])])
    out = {(x.file_no, x.id): (x.typed, x.rescued) for x in drift.consistent_table(s, r).collect()}
    assert out[(1, "2")] == ({"c": "2", "id": "2"}, '{"b":"y"}') and out[(2, "1")] == ({"c": "1", "id": "1"}, None)


def test_what_types_hold(spark):
    cases = [("5", "tinyint", True), ("128", "tinyint", False), ("255", "tinyintunsigned", True), ("-1", "intunsigned", False), ("6401.0", "int", True), ("1.5", "int", False),
             ("18446744073709551615", "bigintunsigned", True), ("18446744073709551616", "bigintunsigned", False), ("x", "double", False), ("1e5", "double", True), ("2024-02-30", "date", False),
             ("2024-02-29 10:00:00", "datetime(3)", True), ("LOW", "enum('low','mid')", True), ("no", "enum('low','mid')", False), ("abc", "varchar(2)", False), ("abc", "text", True), (None, "int", True), ("x", "", True),
             ("xyz", "year", False), ("1901", "year", True), ("1900", "year", False), ("99", "year(4)", True), ("zz", "json", False), ('{"a":[1]}', "json", True), ("12:99:99", "time", False),
             ("-838:59:59", "time", True), ("839:00:00", "time", False), ("08:30:00.5", "time(1)", True), ("123456789.99", "decimal(5,2)", False), ("123.45", "decimal(5,2)", True), ("1.234", "decimal(5,2)", False),
             ("1.230", "decimal(5,2)", True), ("-0.5", "decimal(5,2)unsigned", False), ("1e2", "decimal(5,2)", True), ("10.5", "decimal", False), ("12345678901234567890.5", "decimal(30,10)", True),
             ("a b", "enum('a b','c')", True), ("ab", "enum('a b','c')", False), ("it's", "enum('it''s')", True), ("a,c", "set('a','b','c')", True), ("a,x", "set('a','b','c')", False), ("", "set('a')", True),
             ("0101", "bit(4)", True), ("01012", "bit(8)", False), ("11", "bit", False), ("é", "binary(1)", False), ("é", "char(1)", True), ("0000-00-00 00:00:00", "datetime", False), ("2024", "date", False),
             ("nan", "double", False), ("x" * 256, "tinytext", False), ("True", "bool", True), ("2", "boolean", False), ("interesting", "interval", True), ("1.50", "doubleprecision", True),
             ("550e8400-e29b-41d4-a716-446655440000", "uuid", True), ("550e", "uuid", False)]
    df = spark.createDataFrame([(v, k) for v, k, _ in cases], "v string, k string").coalesce(1)
    assert [r.h for r in df.select(drift.holds(F.col("v"), F.col("k")).alias("h")).collect()] == [w for *_, w in cases]


def test_typed_columns(spark):
    fields = {"id": "int", "a": "BIGINT UNSIGNED", "d": "decimal(10, 3)", "f": "double", "t": "datetime(3)", "e": "ENUM('x y', 'z')"}
    rows = [{"id": 1, "a": "18446744073709551615", "d": "1.50", "f": 2, "t": "2024-01-02 03:04:05.678", "e": "X y"}, {"id": 2, "a": -1, "d": 1.2345, "f": "no", "t": "0000-00-00", "e": "xy"}]
    s, r = data(spark, [({**fields, "d": "double"}, ["id"], rows[:1]), (fields, ["id"], rows)])
    whole = drift.consistent_table(s, r)
    out = {(x.file_no, x.id): x for x in whole.collect()}
    for n in (1, 2):  # the earlier file's rows too, under the types of the last
        x = out[(n, "1")]
        assert x.whole == {"id": 1, "a": 18446744073709551615} and {k: str(v) for k, v in x.number.items()} == {"d": "1.5000000000"} and x.approx == {"f": 2.0}
        assert x["at"] == {"t": datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)} and x.text == {"e": "X y"} and x.rescued is None
    bad = out[(2, "2")]
    assert bad.whole == {"id": 2} and not (bad.number or bad.approx or bad["at"] or bad.text)
    assert json.loads(bad.rescued) == {"a": "-1", "d": "1.2345", "f": "no", "t": "0000-00-00", "e": "xy"}
    typed = drift.wide(whole, "d", "t", list(fields.items()))
    assert dict(typed.dtypes)["a"] == "decimal(20,0)" and dict(typed.dtypes)["t"] == "timestamp_ntz" and {str(x.d) for x in typed.collect()} == {"1.500", "None"}
