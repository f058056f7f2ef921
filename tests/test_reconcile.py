import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.functions import field61
from tidelog.operators import reconcile as r

COLS = "db_name string, table_name string, id bigint, name string, v string, ver bigint"


def test_field_arithmetic():
    rng = random.Random(1)
    a, b = ([rng.choice([0, 1, field61.P - 1, rng.randrange(field61.P)]) for _ in range(500)] for _ in range(2))
    got = field61.mul(np.array(a, np.uint64), np.array(b, np.uint64))
    assert got.tolist() == [x * y % field61.P for x, y in zip(a, b, strict=True)]
    roots = rng.sample(range(1, 10**12), 9)
    f = [1]
    for x in roots:
        f = field61.times(f, [-x % field61.P, 1])
    assert sorted(field61.roots(f)) == sorted(roots)
    assert field61.roots(field61.times(f, [-roots[0] % field61.P, 1])) is None
    assert field61.solved([[1, 1, 3], [1, 1, 4]]) is None


@pytest.mark.parametrize("only", [(0, 0), (1, 0), (0, 3), (4, 4), (5, 3), (5, 4), (9, 0)])
def test_recovers_what_differs(only):
    rng = random.Random(sum(only))
    pick = lambda n: [rng.randrange(r._FIRST_HASH, field61.P) for _ in range(n)]
    both, a, b = pick(30), pick(only[0]), pick(only[1])
    bound = 8

    def sketch(h):
        values = [1] * (bound + r.CHECKS)
        for x in h:
            values = [y * (z - x) % field61.P for z, y in enumerate(values, 1)]
        return len(h), values

    got = r.recovered(sketch(both + a), sketch(both + b), bound)
    if sum(only) <= bound:
        assert sorted(got[0]) == sorted(a) and sorted(got[1]) == sorted(b)
    else:
        assert got is None


def layouts(spark):
    return spark.createDataFrame([("t", ["id", "name", "v"], ["id"]), ("u", ["id", "name", "v"], ["id", "name"])], "table_name string, table_fields array<string>, primary_keys array<string>")


def compared(spark, a, b):
    values = {"id": F.col("id").cast("string"), "name": F.col("name"), "v": F.col("v")}
    sides = [r.canonical(spark.createDataFrame(x, COLS), layouts(spark), values, "ver") for x in (a, b)]
    return {(x.db_name, x.table_name, x.record_key, x.field_name) for x in r.differences(*sides).collect()}


def expected(a, b):
    def side(rows):
        out = {}
        for db, t, i, name, v, ver in rows:
            t = t.strip("` \t").lower()
            key = (db.lower(), t, str(i) if t == "t" else f"{'' if i is None else i}|{name or ''}")
            cells = {"name": name, "v": v} if t == "t" else {"v": v}
            if key not in out or (ver or 0) > out[key][0]:
                out[key] = (ver or 0, cells)
        return {k: c for k, (_, c) in out.items()}

    x, y, out = side(a), side(b), set()
    for k in x.keys() | y.keys():
        if k not in x or k not in y:
            out.add((*k, "missing_in_source" if k not in x else "missing_in_target"))
        else:
            out |= {(*k, c) for c in x[k] if x[k][c] != y[k][c]}
    return out


@pytest.mark.parametrize("share", [0.0, 0.02, 0.3, 1.0])
def test_against_a_full_join(spark, share):
    rng = random.Random(int(share * 100))
    a = [("D", rng.choice(["t", " `T`", "u"]), i, f"n{i}", rng.choice(["", None, "v"]), 1) for i in range(700)]
    b = [("d", t, i, n, v, 2) for _, t, i, n, v, _ in a]
    for k in range(len(b)):
        if rng.random() < share:
            db, t, i, n, v, ver = b[k]
            b[k] = rng.choice([(db, t, i + 10_000, n, v, ver), (db, t, i, n, "changed", ver), (db, t, i, "other", v, ver)])
    old = [("d", t, i, n, "old", 1) for _, t, i, n, _, _ in b[::7]]
    assert compared(spark, a + a[::3], b + old + b[::5]) == expected(a, b)


def test_beyond_the_last_degree_and_one_side_empty(spark, monkeypatch):
    monkeypatch.setattr(r, "LAST_DEGREE", 8)
    rows = [("d", "t", i, "n", "v", 1) for i in range(120)]
    assert len(compared(spark, rows, [])) == 120 and len(compared(spark, [], rows[:3])) == 3 and compared(spark, [], []) == set()


def test_nulls_empty_long_and_unknown_tables(spark):
    long = "x" * 200_000
    a = [("d", "u", None, None, "1", None), ("d", "t", 1, None, "", None), ("d", "t", 2, long, None, 1), ("d", "unknown", 5, "a", "b", 1), ("d", "unknown", 5, "a", "b", 1), ("d", "unknown", 6, "a", None, 1), ("d", "unknown", 7, "a", "b", 1)]
    b = [("d", "unknown", 7, "a", "b", 4), ("d", "u", None, "", "1", None), ("d", "t", 1, None, None, None), ("d", "t", 2, long + "y", None, 1)]
    assert compared(spark, a, b) == {("d", "t", "1", "v"), ("d", "t", "2", "name"), ("d", "unknown", "5|a|b", "missing_in_target"), ("d", "unknown", "6|a|", "missing_in_target")}


def test_ties_and_many_versions_of_one_key(spark, monkeypatch):
    monkeypatch.setattr(r, "HELD", 64)
    a = [("d", "t", 1, "n", f"v{i}", i) for i in range(500)] + [("d", "t", 2, "n", "x", 1), ("d", "t", 2, "n", "y", 1), ("d", "t", 3, "n", "z", 1), ("d", "t", 4, "n", "p", 1)]
    b = [("d", "t", 1, "n", "v499", None), ("d", "t", 2, "n", "x", 7), ("d", "t", 3, "n", "a", 2), ("d", "t", 3, "n", "z", 2), ("d", "t", 4, "n", "p", 1), ("d", "t", 4, "n", "p", 0)]
    assert compared(spark, a, b) == {("d", "t", "2", "v")}  # of unequal rows of one version the greatest counts


def test_newest_per_key():
    rng = np.random.default_rng(1)
    key, version, h = rng.integers(0, 20, 400), rng.integers(0, 5, 400), rng.integers(0, 9, 400)
    k, v, hh, tied = r._newest(key, version, h)
    for x in range(20):
        top = version[key == x].max()
        held = set(h[(key == x) & (version == top)].tolist())
        assert set(v[k == x].tolist()) == {top} and sorted(hh[k == x].tolist()) == sorted({min(held), max(held)}) and set(tied[k == x].tolist()) == {len(held) > 1}
