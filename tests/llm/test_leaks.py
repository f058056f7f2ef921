import random

import numpy as np
import pytest

from tidelog.llm import leaks as L

VOCAB = [f"w{i}" for i in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def brute(docs, items, w=L.WINDOW):
    held = {}
    for i, t in items:
        x = L.words(t)
        for k in range(len(x) - w + 1):
            held.setdefault(tuple(x[k : k + w]), set()).add(i)
    out = set()
    for d, t in docs:
        x = L.words(t)
        for k in range(len(x) - w + 1):
            out |= {(d, i) for i in held.get(tuple(x[k : k + w]), ())}
    return out


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")


def test_words_and_hashes():
    texts = ["Hello, WORLD-2x! é a_b", None, "", "…", "KK 9", "a" * 5000 + " b"]
    hashes, begins = L.word_hashes(texts)
    assert np.diff(begins).tolist() == [len(L.words(t)) for t in texts] == [5, 0, 0, 0, 2, 2]
    again, _ = L.word_hashes(["2x b " + "a" * 5000])
    assert again[0] == hashes[2] and again[1] == hashes[4] and again[2] == hashes[7] and len(set(hashes.tolist())) == 8


def test_fingerprints_by_definition():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 60).astype(np.uint64)
    s = L.shingle_hashes(h)
    got = L.fingerprints(h)
    for k in range(len(h) - L.WINDOW + 1):
        bits = np.unpackbits(s[k : k + 21].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0)
        assert np.packbits(bits > 10.5).view(np.uint64)[0] == got[k]
    assert len(got) == 36 and len(L.fingerprints(h[:24])) == 0


def test_all_pairs_within_the_radius_are_candidates():
    rng = np.random.default_rng(2)
    index = L.ItemIndex(np.array([1]), rng.integers(0, 2**63, 300).astype(np.uint64), np.zeros(300, int), np.zeros(300, int), np.empty(0, np.uint64), radius=4)
    prints = np.concatenate([index.prints ^ sum((np.uint64(1) << np.uint64(b) for b in rng.choice(64, k, replace=False)), np.uint64(0)) for k in range(7)])
    left, right = index.candidates(prints)
    want = {(i, j) for i, p in enumerate(prints.tolist()) for j, q in enumerate(index.prints.tolist()) if (p ^ q).bit_count() <= 4}
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == want


@pytest.mark.parametrize("part", [64, 1 << 17])
def test_found_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(L, "_PART", part)
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.choice([10, 24, 25, 26, 80]))) for i in range(40)] + [(90, None), (91, ""), (92, sentence(rng, 30))]
    items.append((93, items[-1][1]))
    docs = [(d, sentence(rng, rng.randint(0, 200))) for d in range(60)]
    for d, n in ((100, 24), (101, 25), (102, 40), (103, 400)):
        w = L.words(items[rng.choice([k for k in range(40) if len(items[k][1].split()) == 80])][1])
        at = rng.randint(0, max(0, len(w) - n))
        docs.append((d, sentence(rng, 50) + ", (" + " ** ".join(w[at : at + n]).upper() + ")\n" + sentence(rng, 50)))
    docs += [(200, None), (201, ""), (202, items[-1][1]), (202, items[-1][1]), (203, sentence(rng, 100_000) + " " + items[-1][1])]
    found = L.leaks(*frames(spark, docs, items)).select("doc_id", "item_id").collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == brute(docs, items) and any(r.doc_id == 203 for r in found)


def test_items_in_several_passes_and_none(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, sentence(rng, 30)) for i in range(6)]
    docs = [(i, t) for i, t in items]
    monkeypatch.setattr(L, "PASS_WORDS", 65)
    assert {tuple(r)[:2] for r in L.leaks(*frames(spark, docs, items)).collect()} == {(i, i) for i in range(6)}
    assert L.leaks(*frames(spark, docs, items[:0])).count() == 0 and L.leaks(*frames(spark, docs[:0], items)).count() == 0


def test_near_passages_are_verified(spark):
    rng = random.Random(5)
    text = sentence(rng, 60)
    w = text.split()
    swapped = " ".join([*w[:40], "other", *w[41:]])
    got = {r.doc_id: r.similarity for r in L.leaks(*frames(spark, [(1, swapped), (2, text), (3, sentence(rng, 60))], [(7, text)]), exact=False).collect()}
    assert got == {1: 1.0, 2: 1.0}  # 40 words in a row stand unchanged
    a, b = (L.word_hashes([t])[0] for t in ("a b c d e f g h", "a b c d e f g x"))
    assert L.similarity(a, b) == 3 / 5 and L.similarity(a, a) == 1.0 and L.similarity(a[:3], a) == 0.0


def brute_near(docs, items, least=0.8, w=L.WINDOW):
    windows = lambda t: [h[k : k + w] for h in [L.word_hashes([t])[0]] for k in range(len(h) - w + 1)]
    out = {}
    for i, t in items:
        for j, u in docs:
            s = max((L.similarity(a, b) for a in windows(u) for b in windows(t)), default=0.0)
            if s >= least:
                out[(j, i)] = s
    return out


def altered(rng, text, every):
    """The text with a word replaced after each run of `every`."""
    w = text.split()
    for k in range(rng.randrange(every + 1), len(w), every + 1):
        w[k] = f"x{k}"
    return " ".join(w)


@pytest.mark.parametrize("part", [40, 1 << 17])
def test_near_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(L, "_PART", part)
    rng = random.Random(6)
    items = [(i, sentence(rng, rng.choice([24, 25, 26, 50]))) for i in range(8)] + [(8, "a b " * 20 + "c"), (9, "0 " * 40)]
    docs = [(10 * n + i, altered(rng, t, n)) for n in (20, 22, 23) for i, t in items]
    docs += [(900, "a b " * 30), (901, "0 " * 27 + "1 " + "0 " * 12), (902, sentence(rng, 60)), (903, "b a " * 11 + "c a b a"), (904, None)]
    want = brute_near(docs, items)
    assert {(r.doc_id, r.item_id): r.similarity for r in L.leaks(*frames(spark, docs, items), exact=False).collect()} == want
    assert any(s < 1 for s in want.values())


def test_near_recall_on_runs_of_23_and_24_words():
    rng = random.Random(7)
    items = [(i, sentence(rng, 100)) for i in range(100)]
    index = L.ItemIndex.build(items)
    for every in (23, 24):
        found = {(t, k) for t, k, s in L.matches(index, [altered(rng, t, every) for _, t in items], False, 0.8)}
        assert {(i, i) for i in range(100)} <= found


def test_repeated_windows_make_few_pairs():
    import tracemalloc

    zeros = L.ItemIndex.build([(1, "0 " * 200), (2, "0 1 " * 100)])
    assert len(zeros.at) == 3
    tracemalloc.start()
    for exact in (True, False):
        assert sorted((t, k) for t, k, _ in L.matches(zeros, ["0 " * 100_000, "0 1 " * 50_000, "1 2 " * 500], exact, 0.8)) == [(0, 0), (1, 1)]
    assert tracemalloc.get_traced_memory()[1] < 1 << 30
    tracemalloc.stop()


def test_pairs_come_in_pieces(monkeypatch):
    import random

    monkeypatch.setattr(L, "_PIECE", 7)
    rng = random.Random(2)
    item = " ".join(rng.choice("abcdefgh") for _ in range(300))
    index = L.ItemIndex.build([(i, item) for i in range(5)])
    assert sorted(L.matches(index, ["x " + item + " y", item[:40], item[20:400]], True, 0.8)) == [(t, k, 1.0) for t in (0, 2) for k in range(5)]


def test_items_shorter_than_a_window(spark):
    short, tiny, long = "the quick brown fox jumps over the lazy dog", "one two three", " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(1, short), (2, tiny), (3, long), (4, ""), (5, None)], "item_id bigint, item_text string")
    docs = spark.createDataFrame([(1, f"a b. {short.upper()}! c"), (2, "the quick brown fox"), (3, f"{tiny} {long}"), (4, "x the quick brown fox jumps over the lazy cat")], "doc_id bigint, text string")
    got = lambda **kw: {(r.doc_id, r.item_id) for r in L.leaks(docs, items, **kw).collect()}
    assert got() == {(3, 3)}
    assert got(exact=False) == {(1, 1), (3, 3)}
