"""A log with statements among its rows, applied in batches, against what the source's table would hold."""

import json

import pytest
from pyspark.sql import functions as F

from tidelog.config import Scoped, Settings
from tidelog.session import shared_dir
from tidelog.streaming.replicate import Replica

LOG = "file_no bigint, log_pos bigint, row_no int, db_name string, table_name string, op string, text string, before string, after string"


class Log:
    """Builds rows as a binary log gives them."""

    def __init__(self):
        self.rows, self.pos = [], 0

    def say(self, sql, db="shop"):
        self.pos += 10
        self.rows.append((1, self.pos, 0, db, None, "Q", sql, None, None))
        return self

    def put(self, table, *pairs, db="shop"):
        """pairs of (before, after), None for none."""
        self.pos += 10
        for i, (b, a) in enumerate(pairs):
            self.rows.append((1, self.pos, i, db, table, "U" if a else "D", None, json.dumps(b) if b else None, json.dumps(a) if a else None))
        return self

    def df(self, spark, low=0, high=10**9):
        return spark.createDataFrame([r for r in self.rows if low < r[1] <= high], LOG)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def evolving():
    log = Log().say("CREATE TABLE `t` (id INT NOT NULL PRIMARY KEY, name VARCHAR(50), age INT UNSIGNED, mood ENUM('Low','High'))")
    log.put("t", (None, {"id": 1, "name": "Ivan", "age": 42, "mood": 1}), (None, {"id": 2, "name": "Peter", "age": -1, "mood": "HIGH"}))
    log.say("ALTER TABLE t ADD last_name VARCHAR(30) AFTER name, ADD price DECIMAL(10,2) NOT NULL")
    log.put("t", (None, {"id": 3, "name": "Mary", "last_name": "Smith", "age": 30, "price": "12.50", "mood": None}))
    log.say("/* widen */ ALTER TABLE `shop`.`t` CHANGE COLUMN name first_name VARCHAR(80), MODIFY age BIGINT")
    log.put("t", ({"id": 1, "first_name": "Ivan"}, {"id": 1, "first_name": "Ivana", "last_name": None, "age": 5000000000, "price": "1", "mood": 2}))
    log.say("ALTER TABLE t DROP COLUMN last_name")
    log.put("t", ({"id": 2}, None), (None, {"id": 4, "first_name": "Zoë", "age": 1, "price": "x", "mood": 9}))
    return log


WANT = [(1, "Ivana", 5000000000, "high", "1.00"), (3, "Mary", 30, None, "12.50"), (4, "Zoë", 1, "9", "0.00")]


@pytest.mark.parametrize("cuts", [[], [20], [10, 30, 40, 70], [5, 15, 25, 35, 45, 55, 65, 75]])
def test_statements_are_barriers_wherever_batches_end(spark, cuts):
    replica, log = Replica(spark, shared_dir(spark, "replica")), evolving()
    edges = [0, *cuts, 10**9]
    for n, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        replica.apply(log.df(spark, low, high), n)
        if n % 2 == 0:
            replica.apply(log.df(spark, low, high), n)  # the batch runs again
    got = replica.read("shop", "t")
    assert got.columns == ["id", "first_name", "age", "mood", "price"] and dict(got.dtypes)["age"] == "bigint"
    assert rows(got.withColumn("price", F.col("price").cast("string")), "id", "first_name", "age", "mood", "price") == WANT
    replica.optimize()
    assert rows(Replica(spark, replica.root).read("shop", "t"), "id") == [(1,), (3,), (4,)]


def test_key_changes_truncate_rename_and_drop(spark):
    replica, log = Replica(spark, shared_dir(spark, "replica")), Log()
    log.say("create table a (k1 int, k2 varchar(9), v text, primary key (k2, k1))").say("create table b like a")
    log.put("a", (None, {"k1": 1, "k2": "x", "v": "old"}), ({"k1": 1, "k2": "x", "v": "old"}, {"k1": 1, "k2": "y", "v": "moved"}), (None, {"k1": 2, "k2": "x", "v": "q"}))
    log.put("b", (None, {"k1": 9, "k2": "z", "v": "gone"}))
    log.say("TRUNCATE TABLE b").put("b", (None, {"k1": 8, "k2": "z", "v": "stays"}))
    log.say("RENAME TABLE a TO c, b TO a").put("a", (None, {"k1": 7, "k2": "z", "v": "new"})).put("unknown", (None, {"id": 1}))
    log.say("this is no statement").say("drop table if exists nothing")
    replica.apply(log.df(spark), 0)
    assert rows(replica.read("shop", "c"), "k1", "k2", "v") == [(1, "y", "moved"), (2, "x", "q")]
    assert rows(replica.read("shop", "a"), "k1", "k2", "v") == [(7, "z", "new"), (8, "z", "stays")]
    later = Log()
    later.pos = log.pos
    replica.apply(later.say("drop table c").say("create table c (id int primary key)").put("c", (None, {"id": 5})).df(spark), 1)
    assert rows(replica.read("shop", "c"), "id") == [(5,)]
    assert replica.read("shop", "a").count() == 2


def test_snapshot_then_log_with_settings(spark):
    settings = Settings(databases="shop", exclude_tables="*_tmp", order_bys=[Scoped(["v"], "shop", "t")], indexes=[Scoped("v")], types_mapping={"char(36)": "uuid"}, version_initial_value=0)
    replica = Replica(spark, shared_dir(spark, "replica"), settings)
    replica.create("create table t (id int primary key, v varchar(20), u char(36))", "shop")
    replica.snapshot("shop", "t", spark.createDataFrame([(1, "a", None), (2, "b", "550E8400E29B41D4A716446655440000")], "ID int, v string, u string"))
    log = Log().put("t", (None, {"id": 2, "v": "B", "u": None}), (None, {"id": 3, "v": "c", "u": None}))
    log.say("create table x_tmp (id int primary key)", "shop").put("x_tmp", (None, {"id": 1})).put("t", (None, {"id": 1, "v": "other"}), db="elsewhere")
    replica.apply(log.df(spark), 0)
    assert rows(replica.read("shop", "t"), "id", "v") == [(1, "a"), (2, "B"), (3, "c")] and replica.store("shop", "t").order_by == ["c0002"]
    replica.optimize()
    assert replica.read("shop", "t").count() == 3
    with pytest.raises(KeyError):
        replica.read("elsewhere", "t")


def test_a_stream_with_restarts(spark, tmp_path):
    log, src = evolving(), str(tmp_path / "in")
    for low, high in ((0, 30), (30, 60), (60, 10**9)):
        log.df(spark, low, high).coalesce(1).write.mode("append").parquet(src)
        replica = Replica(spark, f"file://{tmp_path}/replica")
        stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(src)
        replica.start(stream, str(tmp_path / "cp")).awaitTermination()
    assert rows(replica.read("shop", "t").withColumn("price", F.col("price").cast("string")), "id", "first_name", "age", "mood", "price") == WANT


def test_empty_batches_and_nothing_known(spark):
    replica = Replica(spark, shared_dir(spark, "replica"))
    replica.apply(spark.createDataFrame([], LOG), 0)
    replica.apply(Log().put("t", (None, {"id": 1})).df(spark), 1)
    assert replica.registry.tables == {} and replica.optimize() == []
