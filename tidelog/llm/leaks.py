"""Passages of held-out test items inside training documents.

Both sides are cut into windows of as many words as a leaked passage has, one starting at each word. A window's
fingerprint is the SimHash of its word shingles. Fingerprints are split into blocks, one more than bits may differ: two
fingerprints within that radius agree in at least one whole block, so looking up a document window's blocks among those
of the items' windows finds every pair within the radius. Each such pair is then verified on the words themselves.

Windows that are only similar may differ in many bits of their fingerprints, so these are looked up by their shingles
instead: the similarity asked for says how many shingles a pair shares, so document windows with fewer shingles that
occur in any item are out, and of the others a few rare shingles are enough to meet each similar item window.

The items are a stated, small set: their index is a few arrays that every task gets, after its size was checked. Larger
sets are taken in parts of bounded size, a pass over the documents each, so no pair is lost.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import spread

#: Words of a window and of a shingle, bits that may differ, bits of a fingerprint.
WINDOW, SHINGLE, RADIUS, BITS = 25, 5, 2, 64
#: Words of items that one pass may hold (16 bytes a word travel to each task); more items take more passes.
PASS_WORDS = 2_000_000
#: Words that are fingerprinted at once.
_PART = 1 << 17

_WORD = re.compile(r"[a-z0-9]+")


def words(text: str | None) -> list[str]:
    """The runs of a-z and 0-9 after lower-casing. Null gives none."""
    return _WORD.findall(text.lower()) if text else []


_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of each word of all texts in order, for each text the place where its words begin, and the end)."""
    coded = [t.lower().encode("utf-8", "replace") + b" " if t else b" " for t in texts]
    data = np.frombuffer(b"".join(coded), np.uint8)
    inside = _ALNUM[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    first, last = edge[::2], edge[1::2]  # each text ends with a blank, so every word has its end
    begins = np.searchsorted(first, np.concatenate(([0], np.cumsum([len(c) for c in coded]))))
    if not len(first):
        return np.empty(0, np.uint64), begins
    length = last - first
    place = np.flatnonzero(inside)
    within = np.arange(len(place)) - np.repeat(np.cumsum(length) - length, length)
    powers = np.cumprod(np.full(int(length.max()), _MIX, np.uint64))
    sums = np.add.reduceat((data[place].astype(np.uint64) + np.uint64(1)) * powers[within], np.cumsum(length) - length)
    return _mixed(sums ^ length.astype(np.uint64)), begins


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of each run of `size` words; order counts."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ h[k : len(h) - size + 1 + k]) * _MIX
        out ^= out >> np.uint64(29)
    return _mixed(out)


def fingerprints(h: np.ndarray, window: int = WINDOW, size: int = SHINGLE) -> np.ndarray:
    """The SimHash of the shingles of each window of `window` words; words are given by their hashes."""
    shingles = shingle_hashes(h, size)
    span = window - size + 1
    if len(shingles) < span:
        return np.empty(0, np.uint64)
    n = len(shingles) - span + 1
    kind = np.uint8 if span < 128 else np.uint16
    power = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1).astype(kind, copy=False)
    ones, done, size_ = np.zeros((n, BITS), kind), 0, 1
    while True:  # the sum over a span from sums over spans of 1, 2, 4, ...
        if span & size_:
            ones += power[done : done + n]
            done += size_
        if done == span:
            break
        power = power[:-size_] + power[size_:]
        size_ *= 2
    return np.packbits(ones * kind(2) > kind(span), axis=1).view(np.uint64).ravel()


def _membership(keys: np.ndarray) -> np.ndarray:
    """By low bits, whether a key with these occurs: most lookups end here. Its size follows the number of keys."""
    held = np.zeros(1 << min(24, max(10, int(len(keys)).bit_length() + 5)), bool)
    held[keys & keys.dtype.type(len(held) - 1)] = True
    return held


def _hits(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(held[keys & keys.dtype.type(len(held) - 1)])


def _first_of(text: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Of entries equal in both, the place of the first, in order."""
    _, first = np.unique(np.stack([text.astype(np.uint64), content.astype(np.uint64)], axis=1), axis=0, return_index=True)
    return np.sort(first)


def _expanded(lo: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, lo[i] + step) for each i and each step below count[i]."""
    who = np.repeat(np.arange(len(lo)), count)
    return who, np.repeat(lo, count) + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)


def _span_sums(values: np.ndarray, span: int) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))
    return sums[span:] - sums[:-span]


class ShingleLookup:
    """The places of each shingle of the items, and for each place the item windows that hold it."""

    def __init__(self, index: ItemIndex) -> None:
        self.span = index.window - SHINGLE + 1
        self.shingles = shingle_hashes(index.hashes)
        inside = np.zeros(len(self.shingles), bool)
        if len(index.at):
            edges = np.zeros(len(self.shingles) + 1, np.int64)
            np.add.at(edges, index.at, 1)
            np.add.at(edges, index.at + self.span, -1)
            inside = np.cumsum(edges)[:-1] > 0
            # Of an item's windows with the same shingles one is enough.
            sums = _span_sums(self.shingles, self.span)[index.at]
            self.windows = _first_of(index.item, sums)
        else:
            self.windows = np.empty(0, np.int64)
        self.at = index.at[self.windows]
        places = np.flatnonzero(inside)
        self.order = places[np.argsort(self.shingles[places], kind="stable")]
        self.keys = self.shingles[self.order]
        self.held = _membership(self.keys)

    def counts(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where its places begin in `order`, how many they are) of each shingle."""
        lo, count = np.zeros(len(shingles), np.int64), np.zeros(len(shingles), np.int64)
        maybe = _hits(self.held, shingles)
        lo[maybe] = np.searchsorted(self.keys, shingles[maybe], side="left")
        count[maybe] = np.searchsorted(self.keys, shingles[maybe], side="right") - lo[maybe]
        return lo, count


@dataclass
class ItemIndex:
    """Windows of items; the lookup of their fingerprints' blocks is built where it is first used."""

    item_ids: np.ndarray
    prints: np.ndarray
    item: np.ndarray  # of each window: place in item_ids
    at: np.ndarray  # of each window: first word in `hashes`
    hashes: np.ndarray
    radius: int = RADIUS
    window: int = WINDOW
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    lookup: ShingleLookup | None = None

    @staticmethod
    def build(items: list[tuple[int, str | None]], window: int = WINDOW, radius: int = RADIUS) -> ItemIndex:
        hashes, begins = word_hashes([text for _, text in items])
        prints, at = fingerprints(hashes, window), np.arange(max(0, len(hashes) - window + 1))
        item = np.searchsorted(begins, at, side="right") - 1
        at = np.flatnonzero(at + window <= begins[item + 1]) if len(at) else at
        # A window that an item repeats counts once.
        at = at[_first_of(item[at], shingle_hashes(hashes, window)[at])] if len(at) else at
        ids = np.array([i for i, _ in items], np.int64)
        return ItemIndex(ids, prints[at], item[at], at, hashes, radius, window)

    def block(self, prints: np.ndarray, b: int) -> np.ndarray:
        n = self.radius + 1
        low, high = BITS * b // n, BITS * (b + 1) // n
        return ((prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)).astype(np.int64)

    def lookups(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per block: which values occur, the values in order, and the windows in that order."""
        if not self.tables:
            for b in range(self.radius + 1):
                keys = self.block(self.prints, b)
                order = np.argsort(keys, kind="stable")
                self.tables.append((_membership(keys), keys[order], order))
        return self.tables

    def met(self, prints: np.ndarray) -> np.ndarray:
        """Places in prints, one of whose blocks occurs among the windows'."""
        places = [_hits(held, self.block(prints, b)) for b, (held, _, _) in enumerate(self.lookups())]
        return np.unique(np.concatenate(places))

    def pairs(self, prints: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in prints, window) of all pairs within the radius, in pieces; a pair may come once per block."""
        for b, (_, keys, order) in enumerate(self.lookups()):
            mine = self.block(prints[places], b)
            lo, hi = (np.searchsorted(keys, mine, side=s) for s in ("left", "right"))
            cuts = np.searchsorted(np.cumsum(hi - lo), np.arange(_PIECE, int((hi - lo).sum()) + _PIECE, _PIECE), side="right")
            for first, last in zip([0, *cuts], [*cuts, len(places)], strict=True):
                # A window that meets more than a piece makes one by itself.
                who, at = _expanded(lo[first:last], (hi - lo)[first:last])
                window, who = order[at], places[first:last][who]
                near = np.bitwise_count(prints[who] ^ self.prints[window]) <= self.radius
                yield who[near], window[near]

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs() of these prints at once, for few of them."""
        parts = list(self.pairs(prints, self.met(prints))) or [(np.empty(0, np.int64),) * 2]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def similarity(a: np.ndarray, b: np.ndarray, size: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of the shingles of two word sequences, a shingle weighing as often as it occurs."""
    x, n = np.unique(shingle_hashes(a, size), return_counts=True)
    y, m = np.unique(shingle_hashes(b, size), return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    total = int(n.sum() + m.sum()) - both
    return both / total if total else 0.0


#: Pairs of windows that are compared at once, by shingles and by fingerprints.
_PAIRS, _PIECE = 1 << 12, 1 << 16


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many shingles the rows of a and b share pairwise, each as often as both have it."""
    earlier = np.tril(np.ones((a.shape[1], a.shape[1]), bool), -1)
    nth = ((a[:, :, None] == a[:, None, :]) & earlier).sum(axis=2)
    return (nth < (a[:, :, None] == b[:, None, :]).sum(axis=2)).sum(axis=1)


def near(index: ItemIndex, part: np.ndarray, text: np.ndarray, whole: np.ndarray, least: float, best: dict[tuple[int, int], float]) -> None:
    """Raises best[text, item] to the similarity of their most similar windows, where that is at least `least`.

    part: word hashes; text: of each window of it the text; whole: whether it lies within one text. Nothing is missed:
    two windows of n shingles with similarity s share at least 2ns / (1 + s) of them.
    """
    if index.lookup is None:
        index.lookup = ShingleLookup(index)
    look = index.lookup
    shingles, span = shingle_hashes(part), look.span
    if len(shingles) < span or not len(look.at):
        return
    need = max(1, math.ceil(2 * span * least / (1 + least) - 1e-9))
    lo, count = look.counts(shingles)
    known = _span_sums((count > 0).astype(np.int64), span)
    at = np.flatnonzero((known >= need) & whole)
    if not len(at):
        return
    at = at[_first_of(text[at], _span_sums(shingles, span)[at])]
    steps = np.arange(span)
    for start in range(0, len(at), 256):
        mine = at[start : start + 256]
        # Of the shingles that items have, all but need - 1 are looked up, the rarest: a similar window has one of them.
        held = count[mine[:, None] + steps]
        rare = np.argsort(np.where(held > 0, held, np.iinfo(np.int64).max), axis=1, kind="stable")
        taken = np.arange(span) < (known[mine] - need + 1)[:, None]
        row, col = np.nonzero(taken)
        place = mine[row] + rare[row, col]
        for a in range(0, len(place), 64):
            who, where = _expanded(lo[place[a : a + 64]], count[place[a : a + 64]])
            who, where = row[a : a + 64][who], look.order[where]
            begin, end = np.searchsorted(look.at, where - span + 1, side="left"), np.searchsorted(look.at, where, side="right")
            pair, window = _expanded(begin, end - begin)
            coded = np.unique(who[pair].astype(np.int64) * len(look.at) + window)
            doc, window = mine[coded // len(look.at)], coded % len(look.at)
            item = index.item[look.windows[window]]
            if best:
                open_ = np.array([best.get(k, 0.0) < 1.0 for k in zip(text[doc].tolist(), item.tolist(), strict=True)], bool)
                doc, window, item = doc[open_], window[open_], item[open_]
            for b in range(0, len(doc), _PAIRS):
                d, w = doc[b : b + _PAIRS], window[b : b + _PAIRS]
                both = _shared(shingles[d[:, None] + steps], look.shingles[look.at[w][:, None] + steps])
                similar = both / (2 * span - both)
                for k in np.flatnonzero(similar >= least):
                    key = (int(text[d[k]]), int(item[b + k]))
                    best[key] = max(best.get(key, 0.0), float(similar[k]))


def matches(index: ItemIndex, texts: list[str | None], exact: bool, least: float) -> Iterator[tuple[int, int, float]]:
    """(place of the text, place of the item, best similarity) of each pair with a verified window.

    Of windows that a text repeats one is looked at, so pairs are as many as different windows of both sides that meet.
    """
    hashes, begins = word_hashes(texts)
    best: dict[tuple[int, int], float] = {}
    w, span = index.window, np.arange(index.window)
    for start in range(0, max(0, len(hashes) - w + 1), _PART):
        part = hashes[start : start + _PART + w - 1]
        at = np.arange(start, start + len(part) - w + 1)
        text = np.searchsorted(begins, at, side="right") - 1
        whole = at + w <= begins[text + 1]
        prints = fingerprints(part, w)
        met = index.met(prints)
        met = met[whole[met]]
        if len(met):
            met = met[_first_of(text[met], shingle_hashes(part, w)[met])]
        for here, window in index.pairs(prints, met):
            same = part[here] == index.hashes[index.at[window]]
            here, window = here[same], window[same]
            equal = (part[here[:, None] + span] == index.hashes[index.at[window][:, None] + span]).all(axis=1)
            best |= dict.fromkeys(zip(text[here[equal]].tolist(), index.item[window[equal]].tolist(), strict=True), 1.0)
        if not exact:
            near(index, part, text, whole, least, best)
    for (t, k), s in best.items():
        yield t, k, s


def _scan(shared: Broadcast, exact: bool, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                for index in shared.value:
                    found = list(matches(index, batch.column(1).to_pylist(), exact, least))
                    yield pa.record_batch(
                        [
                            batch.column(0).take(pa.array([t for t, _, _ in found], pa.int64())),
                            pa.array(index.item_ids[[k for _, k, _ in found]], pa.int64()),
                            pa.array([s for _, _, s in found], pa.float64()),
                        ],
                        ["doc_id", "item_id", "similarity"],
                    )

    return run


def leaks(docs: DataFrame, items: DataFrame, exact: bool = True, least: float = 0.8, window: int = WINDOW, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity) of the documents and items that share a passage of `window` words.

    exact: a window of the item stands in the document word for word (similarity 1), whose fingerprints are looked up within
    `radius` bits; else a window of it is at least `least` (above 0) similar to one of the document in its weighted
    five-word shingles, whatever the fingerprints; the best is given.
    An item of fewer than `window` words has no passage of that many, so it shares nothing with exact; without, its windows
    are the whole item, from SHINGLE words on. Null and empty texts and texts without such a window share nothing. Rows with the same doc_id count as one document
    each; pairs come once. The items are read in parts of PASS_WORDS words; documents are never moved.
    """
    spark = docs.sparkSession
    slim = spread(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL"))
    sized = items.select("item_id", F.col("item_text").cast("string").alias("item_text"), F.size(F.split("item_text", "[^A-Za-z0-9]+")).alias("n"))
    schema = f"doc_id {dict(slim.dtypes)['doc_id']}, item_id bigint, similarity double"
    found, part, held = None, [], 0

    def scanned(rows: list[tuple[int, str | None]]) -> DataFrame:
        sized = [(min(window, len(words(text))), item, text) for item, text in rows]
        least_words = window if exact else SHINGLE
        built = [ItemIndex.build([(i, t) for n, i, t in sized if n == size], size, radius) for size in sorted({n for n, _, _ in sized if n >= least_words})]
        return slim.mapInArrow(_scan(spark.sparkContext.broadcast(built), exact, least), schema)

    for row in sized.where("item_text IS NOT NULL").orderBy("item_id").toLocalIterator():
        if part and held + row["n"] > PASS_WORDS:
            found = scanned(part) if found is None else found.unionByName(scanned(part))
            part, held = [], 0
        part.append((row["item_id"], row["item_text"]))
        held += row["n"]
    if part:
        found = scanned(part) if found is None else found.unionByName(scanned(part))
    if found is None:
        return spark.createDataFrame([], schema)
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))
