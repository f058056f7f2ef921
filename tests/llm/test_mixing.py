import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import mixing as m


def test_rounding_keeps_mass_and_expectation():
    size = np.array([5.0, 1, 1, 2, 9, 3, 30, 2])
    start = np.array([0.3, 0.5, 0.9, 0.2, 0.25, 1.0, 0.6, 0.0])
    ends = []
    for s in range(4000):
        p = m.paired_off(start, size, np.random.default_rng(s))
        assert ((p > 0) & (p < 1)).sum() <= 1 and abs((p * size).sum() - (start * size).sum()) < 1e-9
        ends.append(p)
    assert np.abs(np.mean(ends, axis=0) - start).max() < 0.03
    assert m.paired_off(np.array([]), np.array([]), np.random.default_rng(0)).tolist() == [] and m.paired_off(np.array([0.5]), np.array([2.0]), np.random.default_rng(0)).tolist() == [0.5]


def sizes(spark, n=3000, huge=False):
    rows = [(i, "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "tiny" if i < 500 else "unlisted", 5 + i * 7919 % 90) for i in range(n)]
    rows += [(n, "big", 0), (n + 1, "mid", 0), (n + 2, None, 50)] + ([(n + 3, "tiny", 100_000)] if huge else [])
    return spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")


def targets(spark):
    return spark.createDataFrame([("Big", 0.5, 1), (" mid ", 0.3, 3), ("TINY", 0.1, 4), ("absent", 0.1, 5), ("none", 0.0, 1), (None, None, None)], "source string, target_share double, max_repeats int")


@pytest.mark.parametrize("chunk", [50, 20_000])
def test_shares_and_caps(spark, monkeypatch, chunk):
    monkeypatch.setattr(m, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(m, "FAN", 3)
    chosen, report = m.mixture(sizes(spark), targets(spark))
    rows = {r.source: r for r in report.collect()}
    assert set(rows) == {"big", "mid", "tiny", "absent"} and rows["absent"].tokens == 0
    for s, share in (("big", 0.5 / 0.9), ("mid", 0.3 / 0.9), ("tiny", 0.1 / 0.9)):
        assert abs(rows[s].actual_share - share) < 0.01 and rows[s].most_copies <= rows[s].max_repeats
        assert abs(rows[s].tokens - rows[s].mean_copies * rows[s].available) <= 95
    got = chosen.collect()
    assert len({r.doc_id for r in got}) == len(got) and {r.source for r in got} == {"big", "mid", "tiny"} and all(r.tokens > 0 and r.copies >= 1 for r in got)
    by = {s: sum(r.tokens * r.copies for r in got if r.source == s) for s in rows}
    assert by == {s: r.tokens for s, r in rows.items()}
    monkeypatch.undo()
    limits = {r.source: r.mean_copies for r in rows.values()}
    assert all(int(limits[r.source]) <= r.copies <= int(limits[r.source]) + 1 for r in got)


def test_same_mixture_however_the_data_lie(spark):
    a, _ = m.mixture(sizes(spark, 400).repartition(7), targets(spark))
    b, _ = m.mixture(sizes(spark, 400).coalesce(1).orderBy(F.desc("tokens")), targets(spark))
    assert sorted(a.collect()) == sorted(b.collect())
    c, _ = m.mixture(sizes(spark, 400), targets(spark), seed=1)
    assert sorted(a.collect()) != sorted(c.collect())


def test_given_total_and_capped_source(spark):
    _, report = m.mixture(sizes(spark), targets(spark), total=1_000_000.0)
    rows = {r.source: r for r in report.collect()}
    assert rows["big"].mean_copies == 1.0 and rows["big"].tokens == rows["big"].available and rows["tiny"].most_copies <= 4


def test_empty_ties_and_repeated_ids(spark):
    none = sizes(spark).limit(0)
    chosen, report = m.mixture(none, targets(spark))
    assert chosen.count() == 0 and report.count() == 4 and all(r.actual_share == 0.0 for r in report.collect())
    same = spark.createDataFrame([(1, "big", 10)] * 6 + [(None, "big", 10)] * 4 + [(2, "mid", 4)] * 3, "doc_id bigint, source string, tokens bigint")
    chosen, report = m.mixture(same, targets(spark).where("max_repeats = 1 OR max_repeats = 3"))
    rows = {r.source: r for r in report.collect()}
    assert abs(rows["big"].tokens - rows["big"].mean_copies * 100) <= 10 and abs(rows["mid"].tokens - rows["mid"].mean_copies * 12) <= 4
    assert m.mixture(same, targets(spark).limit(0))[0].count() == 0


@pytest.mark.skipif(not os.path.exists(m.TOKENIZER), reason="no tokenizer here")
def test_token_counts(spark):
    docs = [(1, "Hello, hello world 12 <|endoftext|>\n\n  x = y", "A b"), (2, None, None), (3, "", "a-B "), (4, "é" * 50_000, "a_b")]
    df = spark.createDataFrame(docs, "doc_id int, text string, source string").withColumn("tokens", F.lit("clash"))
    got = {r.doc_id: (r.source, r.tokens) for r in m.token_counts(df).collect()}
    encode = m._encoding(m.TOKENIZER)
    for i, text, _ in docs:
        ids = encode.encode_ordinary(text or "")
        assert got[i][1] == len(ids) and encode.decode(ids) == (text or "")
    assert [got[i][0] for i in (1, 2, 3, 4)] == ["a_b", None, "a_b", "a_b"]


@pytest.mark.parametrize("seed", range(6))
def test_what_is_left_is_short(seed):
    rng = np.random.default_rng(seed)
    size = np.sort(rng.lognormal(6, 1 + seed / 6, 2000).astype(int) + 1)[::-1]
    for p in (0.15, 0.3, 0.5, 0.8):
        out = m.settled(p, size, rng)
        open_ = np.flatnonzero((out > 0) & (out < 1))
        assert len(open_) <= 1 and abs((out * size).sum() - p * size.sum()) < 1e-6 * size.sum()
        assert all(size[open_] <= np.median(size)) and set(np.delete(out, open_)) <= {0.0, 1.0}


def test_settled_keeps_expectations():
    rng, size = np.random.default_rng(1), np.array([900, 500, 300, 200, 90, 80, 70, 60, 50, 40, 30, 20, 10, 9, 8, 7, 6, 5, 4, 3])
    mean = sum(m.settled(0.3, size, rng) for _ in range(6000)) / 6000
    assert np.abs(mean - 0.3).max() < 0.03
    assert m.settled(0.3, np.array([5]), rng).tolist() == [0.3] and len(m.settled(0.3, np.array([], int), rng)) == 0
    giant = m.settled(0.5, np.array([10_000, 3, 2, 1]), rng)
    assert ((giant > 0) & (giant < 1)).sum() <= 1
