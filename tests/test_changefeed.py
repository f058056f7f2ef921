"""The change feed against a fold in plain Python, in any order, in parts, and on awkward input."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions.sqltext import truncated
from tidelog.operators import changefeed as cf
from tidelog.session import shared_dir

LOG = "delivery_no bigint, transaction_id struct<file_name:string,log_pos:bigint>, event_type int, db_name string, table_name string, records string, extra string"
KEYS = [("t", ["v", "a", "b"], ["a", "b"]), ("u", ["id", "v"], ["id"])]


def layouts(spark):
    return spark.createDataFrame(KEYS, "table_name string, table_fields array<string>, primary_keys array<string>")


def event(n, pos, kind, table, rows, db="d", file="bin.000001"):
    return (n, (file, pos) if pos is not None else None, kind, db, table, rows if isinstance(rows, str) or rows is None else json.dumps(rows), "x")


def fold(events):
    """What must come out: events by position, each once."""
    at = {}
    for e in events:
        if e[1]:
            at[(int("".join(c for c in e[1][0].split(".")[-1] if c.isdigit())), e[1][1])] = e
    state, keys = {}, {k[0]: k for k in KEYS}
    for pos in sorted(at):
        _, _, kind, db, table, records, _ = at[pos]
        if kind in (1, 2):
            _, fields, pk = keys[table.lower().strip("` \t")]
            for row in json.loads(records):
                key = (db, table.lower().strip("` \t"), "|".join("" if row[fields.index(k)] is None else str(row[fields.index(k)]) for k in pk))
                if kind == 1:
                    state[key] = pos
                else:
                    state.pop(key, None)
        elif kind == 3 and records.startswith("TRUNCATE"):
            gone = records.split()[-1]
            state = {k: v for k, v in state.items() if k[1] != gone}
    return state


def applied(spark, events, root=None, **kw):
    feed = cf.changes(spark.createDataFrame(events, LOG), layouts(spark))
    state = cf.live(cf.apply_changes(feed, root or shared_dir(spark, "t"), **kw))
    return {(r.db_name, r.table_name, r.record_key): (r.file_no, r.log_pos) for r in state.collect()}


def random_log(rng, n):
    out = []
    for i in range(n):
        file = f"bin.{rng.choice([999999, 1000000]):06d}"
        table = rng.choice(["t", "u"])
        if rng.random() < 0.05:
            out.append(event(i, i, 3, None, f"TRUNCATE TABLE {table}", file=file))
            continue
        rows = [[rng.randint(0, 9), rng.randint(0, 3), rng.choice(["x", "X", "y|", None])] if table == "t" else [rng.randint(0, 5), "v"] for _ in range(rng.randint(1, 3))]
        out.append(event(i, i, rng.choice([1, 1, 2]), rng.choice([table, f" `{table.upper()}`"]), rows, file=file))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_repeats(spark, seed):
    rng = random.Random(seed)
    log = random_log(rng, 120)
    again = log + rng.sample(log, 60)
    rng.shuffle(again)
    assert applied(spark, again, buckets=3) == fold(log)


def test_in_parts_is_the_same(spark):
    rng = random.Random(7)
    log = random_log(rng, 90)
    rng.shuffle(log)
    root = shared_dir(spark, "parts")
    for part in (log[:30], log[30:60], log[20:40], log[60:]):
        got = applied(spark, part, root, buckets=2)
    assert got == fold(log)


def test_late_change_does_not_revive_a_deleted_key(spark):
    root = shared_dir(spark, "late")
    applied(spark, [event(1, 10, 2, "u", [[1, None]])], root, buckets=1)
    assert applied(spark, [event(2, 5, 1, "u", [[1, "a"]])], root) == {}
    applied(spark, [event(3, 20, 3, None, "truncate u")], root)
    assert applied(spark, [event(4, 15, 1, "u", [[1, "a"]]), event(5, 25, 1, "u", [[2, "b"]])], root) == {("d", "u", "2"): (1, 25)}


def test_one_key_with_most_changes(spark):
    log = [event(i, i, 1, "u", [[1, str(i)]]) for i in range(3000)] + [event(3000 + i, 3000 + i, 1, "u", [[i + 2, "z"]]) for i in range(5)]
    got = applied(spark, log, buckets=4)
    assert got[("d", "u", "1")] == (1, 2999) and len(got) == 6


def test_batches_with_and_without_repeats(spark):
    log = [event(i, i, 1, "u", [[i % 3 if 100 <= i < 200 else i, str(i)]]) for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")
    try:
        feed = cf.changes(spark.createDataFrame(log, LOG).coalesce(1), layouts(spark))
        state = cf.live(cf.apply_changes(feed, shared_dir(spark, "mixed"), 3))
        assert {(r.db_name, r.table_name, r.record_key): (r.file_no, r.log_pos) for r in state.collect()} == fold(log)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_last_row_of_an_event_wins_and_payload(spark):
    log = [event(1, 1, 1, "u", [[1, "a"], [1, "b"]])]
    feed = cf.changes(spark.createDataFrame(log, LOG), layouts(spark), payload=True)
    rows = cf.live(cf.apply_changes(feed, shared_dir(spark, "p"), 1)).collect()
    assert [json.loads(r.payload) for r in rows] == [["1", "b"]]


def test_numbers_and_texts_are_the_same_key(spark):
    log = [event(1, 1, 1, "u", '[[8,"a"]]'), event(2, 2, 1, "u", '[ ["8" , "\\u00eb"] ]')]
    assert applied(spark, log, buckets=1) == {("d", "u", "8"): (1, 2)}


def test_nulls_empty_and_unreadable(spark):
    log = [
        event(1, None, 0, None, None), event(2, 3, 1, "u", None), event(3, 4, 1, "u", ""), event(4, 5, 1, "u", "{no json"), event(5, 6, 1, "unknown", [[1]]),
        event(6, 7, 1, None, [[1, 2]]), event(7, 8, 1, "u", [[None, "k"]]), event(8, 9, 1, "u", [[9, "y" * 100_000]], db=None), event(9, 10, 3, "", None),
        event(10, 11, 1, "u", [[1, 2]], file="nonumber"),
    ]
    assert applied(spark, log, buckets=2) == {("d", "u", ""): (1, 8), (None, "u", "9"): (1, 9)}
    assert applied(spark, spark.createDataFrame([], LOG).collect() or [event(1, None, 0, None, None)], buckets=2) == {}


@pytest.mark.parametrize(
    ("sql", "want"),
    [
        ("TRUNCATE TABLE `A`.`B`", ("a", "b")), ("truncate b;", ("d", "b")), ("  Truncate\n Table `a` . `b` ;", ("a", "b")), ("/* x */ TRUNCATE b", ("d", "b")),
        ("-- note\ntruncate `b`", ("d", "b")), ("# note\ntruncate b", ("d", "b")), ("TRUNCATE /* truncate */ TABLE b -- end", ("d", "b")), ("-- truncate b\nALTER TABLE b ADD c int", None),
        ("ALTER TABLE b COMMENT = 'x'; truncate table b", None), ("ALTER TABLE b COMMENT = '-- \ntruncate b'", None), ("/* TRUNCATE b */ BEGIN", None), ("truncated b", None), ("", None), (None, None),
    ],
)
def test_truncate_statements(spark, sql, want):
    got = spark.createDataFrame([(sql,)], "s string").select(truncated(F.col("s"), F.lit("`D`")).alias("t")).first().t
    assert (tuple(got) if got else None) == want


def _arrow(changes):
    import pyarrow as pa

    rows = [{"db_name": "=d", "table_name": "=t", "record_key": f"={k}", "file_no": 1, "log_pos": pos, "row_no": 0, "kind": kind, "payload": f"p{pos}"} for k, pos, kind in changes]
    return pa.Table.from_pylist(rows, schema=cf._ARROW)


def test_the_stored_row_decides_each_conflict(monkeypatch):
    monkeypatch.setattr(cf, "CHUNK_ROWS", 10)
    rng = random.Random(3)
    stored = [(k, rng.randint(1, 500), 1) for k in range(0, 60, 2)]
    feed = [(rng.randint(0, 59), rng.randint(1, 1000), rng.choice([1, 1, 2])) for _ in range(400)]
    bucket = cf._Bucket()
    bucket.load(_arrow(stored))
    state, taken, refused = {k: (pos, kind) for k, pos, kind in stored}, 0, 0
    for at in range(0, len(feed), 10):
        part = {}
        for k, pos, kind in feed[at : at + 10]:
            part[k] = max(part.get(k, (0, 0)), (pos, kind))
        newer = {k: v for k, v in part.items() if k not in state or v > state[k]}
        refused += len(part) - len(newer)
        assert bucket.upsert(_arrow(feed[at : at + 10])) == len(newer)
        taken += sum(k in state for k in newer)
        state |= newer
    assert taken > 50 and refused > 50  # both outcomes of the conflict clause
    assert {(r["record_key"], r["log_pos"], r["kind"], r["payload"]) for r in bucket.export().to_pylist()} == {(f"={k}", pos, kind, f"p{pos}") for k, (pos, kind) in state.items()}


def test_only_buckets_that_are_met_are_written(spark):
    root = shared_dir(spark, "met")
    applied(spark, [event(i, i, 1, "u", [[i, "a"]]) for i in range(60)], root, buckets=8)
    before = cf.State(spark, root).facts["places"]
    assert len(before) == 8
    got = applied(spark, [event(100, 100, 1, "u", [[3, "b"]])], root)
    after = cf.State(spark, root).facts["places"]
    assert sum(before[n] != after[n] for n in before) == 1 and len(got) == 60 and got[("d", "u", "3")] == (1, 100)
    assert applied(spark, [event(101, 50, 3, None, "TRUNCATE u")], root) == {k: p for k, p in got.items() if p[1] >= 50}
    assert cf.State(spark, root).facts["places"] == after


def test_buckets_are_dealt_anew_when_they_have_grown(spark, monkeypatch):
    monkeypatch.setattr(cf, "BUCKET_ROWS", 10)
    root, log = shared_dir(spark, "grown"), [event(i, i, 1 if i % 5 else 2, "u", [[i % 90, str(i)]]) for i in range(300)]
    applied(spark, log[:15], root, buckets=1)
    got = applied(spark, log[15:], root)
    assert got == fold(log) and cf.State(spark, root).facts["buckets"] > 8


def test_an_empty_feed_changes_nothing(spark):
    root, none = shared_dir(spark, "none"), cf.changes(spark.createDataFrame([], LOG), layouts(spark))
    assert cf.apply_changes(none, root, 2).count() == 0
    applied(spark, [event(1, 1, 1, "u", [[1, "a"]])], root)
    assert cf.live(cf.apply_changes(none, root)).count() == 1
