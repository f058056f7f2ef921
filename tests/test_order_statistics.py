import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import order_statistics as o


def ranks():
    return {"first": F.lit(1), "lower_median": F.ceil(F.col("known") / 2), "p90": F.ceil(F.col("known") * 0.9), "last": F.col("known"), "beyond": F.lit(10**9)}


@pytest.mark.parametrize("bins", [2, 7, 256])
def test_against_sorting(spark, bins):
    rng = random.Random(bins)
    rows = [("hot", rng.choice([5, 5, 5, rng.randint(-(10**15), 10**15)])) for _ in range(900)]
    rows += [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(-50, 50)])) for _ in range(200)] + [("wide", -(2**63)), ("wide", 2**63 - 1), ("wide", 0), ("none", None)]
    got = {r.k: r for r in o.order_statistics(spark.createDataFrame(rows, "k string, v bigint"), ["k"], "v", ranks(), bins).collect()}
    for k in {k for k, _ in rows}:
        held, known = [v for x, v in rows if x == k], sorted(v for x, v in rows if x == k and v is not None)
        assert (got[k]["rows"], got[k].known) == (len(held), len(known))
        if known:
            n = len(known)
            want = [known[0], known[-(-n // 2) - 1], known[-(-9 * n // 10) - 1], known[-1], known[-1]]
            assert [got[k][c] for c in ("first", "lower_median", "p90", "last", "beyond")] == want
        else:
            assert got[k].first is None


def test_salted_path_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(o, "BROADCAST_ROWS", 0)
    df = spark.createDataFrame([("a", i * i) for i in range(300)] + [("b", -1)], "k string, v bigint")
    assert {(r.k, r.lower_median) for r in o.order_statistics(df, ["k"], "v", ranks()).collect()} == {("a", 149 * 149), ("b", -1)}


def test_empty_and_clashing_names(spark):
    assert o.order_statistics(spark.createDataFrame([], "k string, v bigint"), ["k"], "v", ranks()).count() == 0
    with pytest.raises(ValueError, match="clash"):
        o.order_statistics(spark.createDataFrame([], "rows string, v bigint"), ["rows"], "v", ranks())


def test_heavy_keys_count_all_rows(spark):
    import datetime

    t = datetime.datetime(2024, 1, 1)
    rows = [(f"D{'x' * 0}", "`T`", t)] * 5 + [("d", " t", None)] * 5 + [(f"d{i}", "t", t) for i in range(85)] + [(None, None, None)] * 5
    log = spark.createDataFrame(rows, "db_name string, table_name string, logged_at timestamp_ntz")
    assert {tuple(r)[:2] for r in o.heavy_keys(log).collect()} == {("d", "t")}
    assert o.heavy_keys(log.limit(0)).count() == 0


def test_many_intervals_of_few_values(spark, monkeypatch):
    monkeypatch.setattr(o, "BROADCAST_ROWS", 0)
    rows = [("hot", i % 3) for i in range(3000)] + [(f"k{i % 50}", i) for i in range(400)]
    got = {r.k: r.lower_median for r in o.order_statistics(spark.createDataFrame(rows, "k string, v bigint"), ["k"], "v", ranks()).collect()}
    assert got["hot"] == 1 and got["k7"] == sorted(i for i in range(400) if i % 50 == 7)[3]


def test_heavy_keys_at_the_edge_of_the_share(spark):
    log = spark.createDataFrame([("d", "a", None)] * 2 + [("d", "b", None)] * 1 + [("d", f"t{i}", None) for i in range(37)], "db_name string, table_name string, logged_at timestamp_ntz")
    assert {r.table_name for r in o.heavy_keys(log).collect()} == {"a"}
    assert {(r.table_name, r.rows) for r in o.heavy_keys(log, 0.04).collect()} == {("a", 2)}
    assert o.heavy_keys(log, 1.0).count() == 0
