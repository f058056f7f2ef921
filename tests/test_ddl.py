import pytest
from pyspark.sql import types as T

from tidelog.ddl import lexer
from tidelog.ddl.schema import Registry, parse
from tidelog.ddl.types import SourceType, default_of


@pytest.mark.parametrize(
    ("sql", "mark", "want"),
    [
        ("a int, b text", ",", ["a int", "b text"]), ("p decimal(8,3), q set('u','v')", ",", ["p decimal(8,3)", "q set('u','v')"]),
        ("n char(9) default 'one,two', m int", ",", ["n char(9) default 'one,two'", "m int"]), (r"n text default 'it\'s, so', m int", ",", [r"n text default 'it\'s, so'", "m int"]),
        ("c check (f(a, g(b, 1)) > 0), d int", ",", ["c check (f(a, g(b, 1)) > 0)", "d int"]), ("x 'q'';', y; z", ";", ["x 'q'';', y", "z"]), (" , a,, b ,", ",", ["a", "b"]), ("", ",", []), ("`k,l` int, m int", ",", ["`k,l` int", "m int"]),
    ],
)
def test_split_top(sql, mark, want):
    assert lexer.split_top(sql, mark) == want


@pytest.mark.parametrize(
    ("sql", "want"),
    [
        ("id int COMMENT 'a ''b'', c', n int", "id int , n int"), ('id int comment "x ""y""" , n int', "id int  , n int"), ("id int COMMENT = 'k'", "id int "), ("`comment` int COMMENT 'c'", "`comment` int "),
        ("n text default 'COMMENT ''x'''", "n text default 'COMMENT ''x'''"), ("id int COMMENT 'two\nlines', comment int", "id int , comment int"), (r"a int COMMENT 'x\'y' not null", "a int  not null"), ("a int COMMENT ''", "a int "),
    ],
)
def test_comment_clauses(sql, want):
    assert lexer.without_comment_clauses(sql) == want


def test_scan_is_lossless_and_comments_go():
    sql = "/* a */ select 'x -- y', `b#c` -- end\n from t # last"
    assert "".join(t.text for t in lexer.scan(sql)) == sql
    assert lexer.without_comments(sql).split() == ["select", "'x", "--", "y',", "`b#c`", "from", "t"]


@pytest.mark.parametrize(
    ("sql", "want"),
    [
        ("CREATE TABLE `shop`.`cart` (id int)", "shop"), ("create table cart (id int)", ""), ("ALTER TABLE shop . cart ADD x int", "shop"), ('alter table "shop"."cart" add x int', "shop"),
        ("CREATE TABLE IF NOT EXISTS\n`my-shop`\n.\n`cart`(id int)", "my-shop"), ("DROP DATABASE shop", ""), ("BEGIN", ""), ("", ""), ("create table shopcart (id int)", ""),
    ],
)
def test_database_of(sql, want):
    assert lexer.database_of(sql) == want


def test_labels():
    assert lexer.enum_labels("ENUM('a', \"b,c\", `d`, 'it''s', 'x\\ty')") == ["a", "b,c", "d", "it's", "x\ty"]
    for bad in ("enum", "enum('a'", "enum('a',)", "enum('a' 'b')", "enum(,'a')", "int(5)"):
        with pytest.raises(ValueError):
            lexer.enum_labels(bad)


@pytest.mark.parametrize(
    ("text", "parameters", "want"),
    [
        ("INT(11)", "unsigned NOT NULL", T.LongType()), ("int", "", T.IntegerType()), ("BIGINT UNSIGNED", "", T.DecimalType(20, 0)), ("tinyint(1)", "", T.BooleanType()), ("tinyint(4)", "", T.ByteType()),
        ("mediumint", "unsigned", T.IntegerType()), ("smallint", "unsigned", T.IntegerType()), ("bit(1)", "", T.BooleanType()), ("bit(9)", "", T.StringType()), ("numeric(5, 2)", "", T.DecimalType(5, 2)), ("decimal", "", T.DecimalType(10, 0)),
        ("decimal(60,5)", "", T.StringType()), ("datetime(3)", "", T.TimestampNTZType()), ("timestamp(6)", "", T.TimestampType()), ("time", "", T.StringType()), ("year", "", T.IntegerType()), ("year(4)", "", T.IntegerType()),
        ("set('float','int')", "", T.StringType()), ("enum('date')", "", T.StringType()), ("DOUBLE PRECISION", "", T.DoubleType()), ("varbinary(16)", "", T.BinaryType()), ("longtext", "", T.StringType()), ("json", "", T.StringType()),
    ],
)
def test_types(text, parameters, want):
    assert SourceType.parse(text, parameters).spark() == want


def test_type_mapping_and_unknown():
    assert SourceType.parse("char(36)").spark({"char(36)": "uuid"}) == T.StringType()
    assert SourceType.parse("decimal(9,2)").spark(compat_decimal=True) == T.DoubleType()
    with pytest.raises(ValueError, match="linestring"):
        SourceType.parse("linestring").spark()
    assert [default_of(x) for x in (T.IntegerType(), T.StringType(), T.BooleanType(), T.DecimalType(5, 2))] == [0, "", False, 0]
    assert default_of(T.StringType(), ("Red", "Blue")) == "red"


CREATE = """CREATE TABLE `orders` (`id` bigint unsigned NOT NULL AUTO_INCREMENT COMMENT 'the "key", unique', note varchar(80) DEFAULT 'a, b', state enum('New','Old'),
  key_count int NOT NULL, at datetime(6), total decimal(12, 4), PRIMARY KEY (`id`, `key_count`), UNIQUE KEY u (note), KEY `k` (at), INDEX i (total), FULLTEXT KEY f (note), SPATIAL INDEX s (p),
  CONSTRAINT c FOREIGN KEY (state) REFERENCES x (y), CHECK (total > 0)) ENGINE=InnoDB DEFAULT CHARSET=latin1"""


def test_create():
    t = parse(CREATE, "d").body
    assert [f.name for f in t.fields] == ["id", "note", "state", "key_count", "at", "total"]
    assert t.key == ("id", "key_count") and t.charset == "latin1" and not t.field("id").nullable and t.field("note").nullable and t.field("state").type.labels == ("New", "Old")
    assert parse("create table t (a int, b int primary key)").body.key == ("b",)
    assert parse("create table t (Id int, b int)").body.key == ("Id",)
    with pytest.raises(ValueError, match="primary key"):
        parse("create table t (a int)")
    with pytest.raises(ValueError, match="one statement"):
        parse("create table t (id int); drop table t")


def registry(*statements):
    r = Registry()
    for s in statements:
        r.apply(s, "d")
    return r


def names(r, table="t"):
    return [f.name for f in r.tables[("d", table)].fields]


def test_alter_positions_and_ids():
    r = registry("create table t (id int, a int)", "ALTER TABLE t ADD c1 INT FIRST, ADD COLUMN c2 varchar(5) AFTER c1, DROP a", "alter table t add index (c1), add constraint x unique (c1), drop index y, rename index a to b")
    assert names(r) == ["c1", "c2", "id"]
    r.apply("ALTER TABLE d.t CHANGE c2 `c three` bigint NOT NULL AFTER id, MODIFY c1 smallint unsigned, RENAME COLUMN id TO pk, ADD (x int, y int), ALTER COLUMN x SET DEFAULT 1, AUTO_INCREMENT = 5, CONVERT TO CHARACTER SET utf8mb4", "d")
    t = r.tables[("d", "t")]
    assert names(r) == ["c1", "pk", "c three", "x", "y"] and t.key == ("pk",) and t.field("pk").id == "c0001" and str(t.field("c1").type) == "smallint unsigned" and not t.field("c three").nullable
    with pytest.raises(KeyError):
        r.apply("alter table t drop column nope", "d")


def test_tables_come_go_and_swap():
    r = registry("create table t (id int, a int)", "create table n like t", "alter table n add b int", "rename table t to o, n to t", "drop table if exists o, nothing", "create temporary table q (id int)", "alter database d collate x", "truncate t")
    assert set(r.tables) == {("d", "t")} and names(r) == ["id", "a", "b"]
    r.apply("create table u (id int)", "d")
    with pytest.raises(ValueError, match="exists"):
        r.apply("rename table u to t", "d")
    assert set(r.tables) == {("d", "t"), ("d", "u")}
    with pytest.raises(ValueError, match="another database"):
        r.apply("rename table d.t to e.t")
    with pytest.raises(KeyError):
        r.apply("drop table gone", "d")
    r.apply("alter table u rename to w", "d")
    assert ("d", "w") in r.tables


def test_replay_and_json():
    r = Registry()
    log = [((1, 4), "create table t (id int)"), ((1, 9), "alter table t add a enum('x','it''s')")]
    for _ in range(2):
        for pos, sql in log:
            r.apply(sql, "d", pos)
    assert names(r) == ["id", "a"] and Registry.from_json(r.to_json()).tables == r.tables and r.version == 2


def test_differences():
    a, b = (parse(s, "d").body for s in ("create table t (id int, a int)", "create table t (id int, a bigint, b int) charset=utf8"))
    assert a.differences(a) == [] and len(a.differences(b)) == 3


def test_projection_over_stored_rows(spark):
    r = registry("create table t (id int, a varchar(9), b int)")
    stored = r.tables[("d", "t")].store(spark.createDataFrame([(1, "7", None), (2, "x", 5)], "id int, a string, b int"))
    r.apply("alter table t modify a int, modify b int not null, add c datetime not null first, add e enum('P','q') not null", "d")
    rows = {x.id: (x.a, x.b, str(x.c), x.e) for x in r.tables[("d", "t")].project(stored).collect()}
    assert rows == {1: (7, 0, "1970-01-01 00:00:00", "p"), 2: (None, 5, "1970-01-01 00:00:00", "p")}


def test_database_of_statements_with_comments(spark):
    import __spark_entry__ as entry
    from tidelog.session import shared_dir

    root = shared_dir(spark, "ddl")
    said = ["/* a.b */ CREATE TABLE `Shop`.t (id int)", "ALTER -- x.y\n TABLE shop.t ADD c int", "CREATE TABLE t (id int) /* c.d */", "ALTER TABLE shop.t ADD c int"]
    rows = [(i, 3, text) for i, text in enumerate(said)] + [(9, 1, "/* no statement */")]
    spark.createDataFrame(rows, "delivery_no bigint, event_type int, records string").write.parquet(f"{root}/log_events.parquet")
    got = {r.delivery_no: r.db for r in entry.queries()["db_name_from_ddl"](spark, root).collect()}
    assert got == {0: "shop", 1: "shop", 2: "", 3: "shop"}
