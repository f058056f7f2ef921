"""Folding, storing, streaming, positions."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import gtid, latest, monitor, ordered, snapshot
from tidelog.session import shared_dir
from tidelog.store.publish import Published
from tidelog.store.table import Store
from tidelog.streaming.apply import Rollup, apply_stream, windowed_counts

CHANGES = "k bigint, v string, _version bigint, _deleted boolean"


def random_changes(seed, n=300):
    rng = random.Random(seed)
    return [(rng.choice([0, 0, 0, rng.randint(1, 20), None]), f"v{i}", i, rng.random() < 0.3) for i in range(n)]


def folded(rows):
    out = {}
    for k, v, _, gone in sorted(rows, key=lambda r: r[2]):
        out.pop(k, None)
        if not gone:
            out[k] = v
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_in_any_parts(spark, seed):
    rows = random_changes(seed)
    df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)) + rows[:50], CHANGES)
    for f in (latest.newest, latest.newest_by_window):
        assert {r.k: r.v for r in f(df, ["k"], ["_version"]).where("NOT _deleted").collect()} == folded(rows)
    parts = [latest.newest(df.where(F.col("_version") % 3 == i), ["k"], ["_version"]) for i in range(3)]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert {r.k: r.v for r in latest.current(both, ["k"], ["_version"], "_deleted").collect()} == folded(rows)
    assert latest.current(df.limit(0), ["k"], ["_version"], "_deleted").count() == 0


def test_store_batches_compaction_and_replay(spark):
    rows = random_changes(3)
    store = Store(spark, shared_dir(spark, "s"), ["k"], "k bigint, v string")
    assert store.read().count() == 0 and store.max_version() is None
    df = spark.createDataFrame(rows, CHANGES)
    for b in range(3):
        store.append(df.where(F.col("_version") % 3 == b), b)
    state = lambda: {r.k: r.v for r in store.read().collect()}
    assert state() == folded(rows)
    store.optimize()
    store.append(df.where("_version % 3 = 1"), 1)  # a batch delivered again after compaction
    assert state() == folded(rows) and store.max_version() == 299
    store.append(spark.createDataFrame([(99, "new", 400, None)], CHANGES).drop("_deleted"), 9)
    store.optimize()
    assert state() == folded(rows) | {99: "new"} and store.read(where="k = 99").count() == 1
    store.truncate(350)
    assert state() == {99: "new"}
    assert store.published.current()["number"] == 3


@pytest.mark.parametrize("seed", [3, 4])
def test_changes_that_come_after_compaction_count(spark, seed):
    rows = random_changes(seed)
    store = Store(spark, shared_dir(spark, "s"), ["k"], "k bigint, v string")
    df = spark.createDataFrame(rows, CHANGES)
    batch = lambda b: store.append(df.where(F.col("_version") % 4 == b), b)
    state = lambda: {r.k: r.v for r in store.read().collect()}
    for done, b in enumerate((3, 1, 0, 2), 1):  # a batch, compacted, the next with versions among and below those held
        batch(b)
        store.optimize()
        assert state() == folded([r for r in rows if r[2] % 4 in (3, 1, 0, 2)[:done]])
    batch(3)
    assert state() == folded(rows)
    store.optimize(safe=299)  # nothing is late any more: tombstones go, and a replay still brings nothing back
    assert store.read(final=False).where("_deleted").count() == 0
    batch(0)
    assert state() == folded(rows)


def test_a_batch_that_comes_while_compacting_stays(spark, monkeypatch):
    rows = random_changes(8)
    store = Store(spark, shared_dir(spark, "s"), ["k"], "k bigint, v string", indexes=["k", "v"])
    df = spark.createDataFrame(rows, CHANGES)
    store.append(df.where("_version < 200"), 0)
    write = store._snapshot
    monkeypatch.setattr(store, "_snapshot", lambda *a: (write(*a), store.append(df.where("_version >= 200"), 1)))
    store.optimize()
    assert {r.k: r.v for r in store.read().collect()} == folded(rows) and store._batches() == ["batch=1"]


def test_snapshot_files_follow_the_bytes(spark, monkeypatch):
    from tidelog.store import table as t

    store = Store(spark, shared_dir(spark, "s"), ["k"], "k bigint, v string", order_by=["v"])
    store.append(spark.range(2000).selectExpr("id AS k", "uuid() AS v", "id AS _version"), 0)
    monkeypatch.setattr(t, "FILE_BYTES", store._bytes(["log/batch=0"]) // 4)
    store.optimize()
    files = spark.read.parquet(f"{store.published.root}/{store.published.current()['version']}").inputFiles()
    assert 4 <= len(files) <= 6 and store.read().count() == 2000


def test_publish_is_all_or_nothing(spark):
    p = Published(spark, shared_dir(spark, "p"))
    assert p.current() is None and p.read() is None
    spark.range(3).write.parquet(f"{p.root}/{(v := p.stage())}")
    p.publish(v, note="a")
    spark.range(9).write.parquet(f"{p.root}/{p.stage()}")  # a writer that died before publishing
    assert p.read().count() == 3 and p.current()["note"] == "a" and p.vacuum() == 1 and p.vacuum() == 0


def test_stream_restarts_where_it_stopped(spark):
    rows = random_changes(5)
    src, root = shared_dir(spark, "in"), shared_dir(spark, "out")
    store, rollup = Store(spark, f"{root}/store", ["k"], "k bigint, v string"), Rollup(f"{root}/rollup", {"gone": "_deleted"})
    for part in (rows[:100], rows[100:]):
        spark.createDataFrame(part, CHANGES).coalesce(2).write.mode("append").parquet(src)
        stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(src)
        apply_stream(stream, store, f"{root}/cp", also=rollup.add).awaitTermination()
    assert {r.k: r.v for r in store.read().collect()} == folded(rows)
    assert {r.gone: r.n for r in rollup.read(spark).collect()} == {g: sum(r[3] == g for r in rows) for g in (True, False)}


def test_windowed_counts(spark):
    src = shared_dir(spark, "w")
    spark.sql("SELECT timestamp'2024-01-01 00:00:10' AS at UNION ALL SELECT timestamp'2024-01-01 00:01:10' UNION ALL SELECT timestamp'2024-01-01 00:00:20'").write.parquet(src)
    q = windowed_counts(spark.readStream.schema("at timestamp").parquet(src), "at", "1 minute", "5 minutes").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("w").collect()) == [1, 2]


def test_truncate_and_segments(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", 1, False)], "s string, n bigint, cut boolean")
    assert {(r.s, r.n) for r in latest.after_truncate(df, ["s"], "n", "cut").collect()} == {("a", 3), ("b", 1)}
    assert [p.count() for p in latest.segments(df, "n", [2])] == [2, 1]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_aggregates_across_parts(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), i, rng.choice([None, rng.randint(-5, 5)])) for i in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        laid = ordered.laid_out(spark.createDataFrame(rows, "g string, n bigint, v bigint"), ["g"], ["n"])
        for how in ("sum", "max", "last"):
            for inclusive in (True, False):
                got = {(r.g, r.n): r.x for r in ordered.running(laid, ["g"], ["n"], "x", F.col("v"), how, inclusive).collect()}
                for g in {r[0] for r in rows}:
                    seen = []
                    for _, n, v in [r for r in rows if r[0] == g]:
                        before = [x for x in [*seen, *([v] if inclusive else [])] if x is not None]
                        want = None if not before else {"sum": sum(before), "max": max(before), "last": before[-1]}[how]
                        assert got[(g, n)] == want, (how, inclusive, g, n)
                        seen.append(v)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert laid.count() == 400


SID, OTHER = "57b70f4e-20d3-11e5-a393-4a63946f7eac", "11111111-20d3-11e5-a393-4a63946f7eac"


def test_gtid_sets():
    g = lambda t: gtid.GtidSet.parse(f"{SID}:{t}")
    spans = lambda s: s.servers.get(SID, [])
    assert spans(g("5-56") + g("57-58")) == [(5, 59)] and spans(g("5-56") + g("1-2")) == [(1, 3), (5, 57)] and spans(g("1-4:7-10") + g("5-6")) == [(1, 11)] and spans(g("1-56") + g("58-59")) == [(1, 57), (58, 60)]
    assert [spans(g("1-56") - g(x)) for x in ("1-5", "55-56", "25-26", "1-56")] == [[(6, 57)], [(1, 55)], [(1, 25), (27, 57)], []]
    assert g("3-4") in g("1-5") and g("3-9") not in g("1-5") and gtid.GtidSet() in g("1")
    both = gtid.GtidSet.parse(f"{SID}:1-5:9,\n {OTHER.upper()}:3")
    assert str(both) == f"{OTHER}:3,{SID}:1-5:9" and gtid.GtidSet.decode(both.encode()) == both
    assert g("1-3") <= g("1-5") and g("1-3") < g("1-5") and not g("1-5") < g("1-5") and not g("1-3") <= g("2-9") and not g("2-9") <= g("1-3")
    assert g("1-5").overlaps(g("5-9")) and not g("1-5").overlaps(g("6-9")) and len(g("1-5:9")) == 6 and not gtid.GtidSet()
    for bad in ("x:1", SID, f"{SID}:", f"{SID}:5-3", f"{SID}:0", f"{SID}:a", f"{SID}:1-2-3", f"{SID}:-1"):
        with pytest.raises(ValueError):
            gtid.GtidSet.parse(bad)


def test_gtid_frames_agree_with_sets(spark, monkeypatch):
    monkeypatch.setattr(gtid, "STRETCH", 8)
    rng = random.Random(4)
    side = lambda: [(rng.choice(["p", "q"]), s := rng.randint(1, 60), s + rng.randint(1, 9)) for _ in range(25)]
    a, b = side(), side()
    frame = lambda rows: spark.createDataFrame(rows, "sid string, start bigint, end bigint")

    def as_set(rows):
        out = gtid.GtidSet()
        for sid, s, e in rows:
            out = out + gtid.GtidSet({sid: [(s, e)]})
        return out

    def collected(df):
        out = {}
        for r in df.orderBy("sid", "start").collect():
            out.setdefault(r.sid, []).append((r.start, r.end))
        return out

    assert collected(gtid.coalesced(frame(a))) == as_set(a).servers
    assert collected(gtid.subtracted(gtid.coalesced(frame(a)), gtid.coalesced(frame(b)))) == (as_set(a) - as_set(b)).servers
    want = {s for s in {r[0] for r in b} if gtid.GtidSet({s: as_set(b).servers[s]}) in as_set(a)}
    assert {r.sid for r in gtid.contained(gtid.coalesced(frame(a)), gtid.coalesced(frame(b))).collect()} == want


def test_positions(spark):
    files, wanted = spark.createDataFrame([(1, 10), (2, 20), (10, 100)], "file_no int, first_pos bigint"), spark.createDataFrame([(5,), (10,), (25,), (500,)], "pos bigint")
    assert {r.pos: r.file_no for r in monitor.as_of_file(files, wanted).collect()} == {5: None, 10: 1, 25: 2, 500: 10}
    assert monitor.lag_report("b.001000", spark.createDataFrame([("x", "b.999"), ("y", None)], "name string, file string")).collect()[0].files_behind == 1
    diff = monitor.missing_and_extra(spark.createDataFrame([("a",), ("b",)], "n string"), spark.createDataFrame([("b",), ("c",)], "n string"), "n")
    assert {tuple(r) for r in diff.collect()} == {("a", "start"), ("c", "stop")}


def test_pages_and_shards(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(50)], "a bigint, b bigint")
    seen, last = [], None
    while rows := snapshot.page(df, ["a", "b"], 7, last).collect():
        seen += [tuple(r) for r in rows]
        last = tuple(rows[-1])
    assert seen == sorted((i % 5, i) for i in range(50))
    plan = df.where(snapshot.after_key(["a", "b"], [3, 4]))._jdf.queryExecution().optimizedPlan().toString()
    assert "a#" in plan
    one = spark.createDataFrame([(10, "20"), (None, "x")], "a int, b string").select(snapshot.shard(["a", "b"], 4).alias("s"), F.crc32(F.lit("10|20")).alias("c")).collect()
    assert one[0].s == 3 and one[0].c == 1007315811 and one[1].s is not None
    total = sum(df.where(snapshot.shard(["a", "b"], 3) == i).count() for i in range(3))
    assert total == 50


def test_every_position_is_looked_up(spark):
    import __spark_entry__ as entry

    root = shared_dir(spark, "events")
    rows = [(i % 7, i, "view", 1.0, "{}") for i in range(5, 9000, 4)]
    spark.createDataFrame(rows, "user_id bigint, event_id bigint, event_type string, value double, props string").write.parquet(f"{root}/events.parquet")
    got = {r.pos: r.file_no for r in entry.queries()["asof_file_lookup"](spark, root).collect()}
    assert got == {i: i // 1000 for i in range(5, 9000, 4)}
    low, high = 5, 8997
    middle = {r.event_id for r in entry.queries()["bounded_replay"](spark, root).collect()}
    assert middle == {i for i in range(5, 9000, 4) if low + 2248 < i < high - 2248}


def test_catalogue_of_a_source(spark):
    from tidelog.config import Settings
    from tidelog.ddl.schema import parse
    from tidelog.sources import catalog

    tables = spark.createDataFrame([("shop", "t", "BASE TABLE"), ("shop", "v", "VIEW"), ("shop", "t_tmp", "base table"), ("mysql", "user", "BASE TABLE"), ("crm", "c", "BASE TABLE")], "TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string")
    settings = Settings(databases=["shop", "c*"], exclude_tables="*_tmp")
    assert {tuple(r) for r in catalog.base_tables(tables, settings).collect()} == {("shop", "t"), ("crm", "c")}
    assert {tuple(r) for r in catalog.databases(tables).collect()} == {("shop", 2), ("crm", 1)}
    logs = spark.createDataFrame([("bin.1000000", 5), ("bin.999999", 7)], "Log_name string, File_size int")
    assert [r.file_no for r in catalog.log_files(logs).collect()] == [999999, 1000000]
    columns = spark.createDataFrame([("shop", "t", "b`c", "enum('x','y')", "YES", "", 2), ("shop", "t", "id", "int unsigned", "NO", "PRI", 1)], "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, COLUMN_TYPE string, IS_NULLABLE string, COLUMN_KEY string, ORDINAL_POSITION int")
    made = parse(catalog.create_text(columns, "shop", "t"))
    assert made.db == "shop" and made.body.key == ("id",) and [(f.name, str(f.type), f.nullable) for f in made.body.fields] == [("id", "int unsigned", False), ("b`c", "enum('x','y')", True)]
    assert list(catalog.pending(catalog.base_tables(tables), spark.createDataFrame([("crm", "c")], "db_name string, table_name string"))) == [("shop", "t"), ("shop", "t_tmp")]
