from tidelog.operators import messages as m
from tidelog.session import shared_dir

LOG = "source_id string, transaction_id struct<file_name:string,log_pos:bigint>, received_at timestamp_ntz, delivery_no bigint, records string, file_no string"


def at(s):
    import datetime

    return datetime.datetime(2024, 1, 1, 0, 0, s)


def log(spark, rows):
    return spark.createDataFrame([(s, f and (f, p), r, n, str(n), "clash") for s, f, p, r, n in rows], LOG)


ROWS = [
    ("a", "x.000007", 1, at(5), 1), ("a", "./X.7", 1, at(3), 2), ("a", "X.0000007", 1, None, 3), ("a", "x.7", 2, None, 4), ("b", "x.7", 1, at(1), 5),
    ("c", "x.7", 1, at(2), 7), ("c", "x.7", 1, at(2), 6), ("a", None, None, at(1), 8), ("a", "x", 3, at(1), 9), (None, "x.1", 1, at(1), 10), (None, "x.1", 1, at(1), 10),
]


def test_first_copy_by_arrival(spark):
    got = {(r.source_id, r.file_no, r.log_pos): r.delivery_no for r in m.first_copies(log(spark, ROWS)).collect()}
    assert got == {("a", 7, 1): 2, ("a", 7, 2): 4, ("b", 7, 1): 5, ("c", 7, 1): 6, (None, 1, 1): 10}


def test_repeated(spark):
    got = {tuple(r) for r in m.repeated_messages(log(spark, ROWS)).collect()}
    assert got == {("a", 7, 1), ("c", 7, 1), (None, 1, 1)}
    assert m.repeated_messages(log(spark, ROWS[:0])).count() == 0


def test_many_copies_are_cut_before_the_shuffle(spark):
    many = log(spark, [("a", "x.1", 1, at(i % 60), i) for i in range(2000)])
    plan = m.first_copies(many)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert m.first_copies(many).count() == 1


def test_batches_add_each_message_once(spark):
    root = shared_dir(spark, "seen")
    assert m.append_new(log(spark, ROWS[:4]), root).count() == 2
    assert m.append_new(log(spark, ROWS[:4]), root).count() == 0
    assert {r.source_id for r in m.append_new(log(spark, ROWS[2:7]), root).collect()} == {"b", "c"}
    assert m.append_new(log(spark, ROWS), root).count() == 1 and m.append_new(log(spark, ROWS[::-1]), root).count() == 0


def test_identifiers_are_put_together_and_rows_stay(spark, monkeypatch):
    monkeypatch.setattr(m, "COMPACTED", 3)
    root = shared_dir(spark, "seen")
    for i in range(7):
        added = m.append_new(log(spark, [("a", f"x.{i}", n, at(n), n) for n in range(3)] + ROWS[:1]), root)
    from tidelog.store.publish import Published

    assert len(Published(spark, root).current()["ids"]) <= 3
    assert m.stored_messages(spark, root, added.schema).count() == 22  # 7 files of 3 and one repeated message, x.7 not among the files
    assert m.append_new(log(spark, [("a", "x.3", 1, None, 1), ("a", "x.99", 1, None, 1)]), root).count() == 1
