"""Comparing two copies of a dataset by what differs, not by all that is there.

Each row gets a hash in the field of 2**61 - 1 and a bucket by the hash of its key. Input tasks send these hashes only, for
each key those of its highest version; rows themselves stay where they are. Per bucket and side the characteristic
polynomial, the product of (z - hash), is evaluated at a few points. The ratio of both sides' values is a rational
function whose numerator and denominator are made of the hashes found on one side only, so as many values as there are
differences suffice to recover them, however large the bucket is. The number of differences isn't known: the degree bound
starts low and doubles in the buckets where further points don't verify the result. Only rows with a differing hash are
then fetched and compared field by field.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import field61
from tidelog.functions.names import plain_name
from tidelog.session import all_kept, bounded, kept

#: Rows a bucket is sized for, the first degree bound, the points beyond the bound that verify it, buckets in a group.
BUCKET_ROWS, FIRST_DEGREE, CHECKS, GROUP = 24, 8, 2, 2048
#: Buckets that a task solves, and hashes that an input task holds before it passes its part on.
SOLVED, HELD = 1_000, 1 << 20
#: Beyond this bound a bucket's differing hashes are found by taking one set from the other: its rows differ almost everywhere.
LAST_DEGREE = 64
#: Points of evaluation are 1, 2, 3, …; hashes are above them all, so that no value is 0.
_FIRST_HASH = 1 << 20
_KEY = ["db_name", "table_name", "record_key"]


def canonical(rows: DataFrame, layouts: DataFrame, values: dict[str, Column], version: str | None = None) -> DataFrame:
    """Each row as db_name, table_name, record_key, cells (name and text of each field outside the key), version.

    values gives each field as the text in which it is compared. layouts: table_name, table_fields, primary_keys. The key
    of a table without layout is all fields, so that each of its rows is compared as a whole. Of rows with the same key
    the one with the highest version counts (null below all); with equal versions, or none, repeated rows are one, and of
    unequal ones the greatest in the order of its cells counts; differences() decides that. A null key value is empty
    text in record_key. Names are plain.
    """
    names = list(values)
    lists = layouts.select(plain_name("table_name").alias("table_name"), F.col("primary_keys").alias("_key"), F.col("table_fields").alias("_fields"))
    keyed = rows.select(
        plain_name("db_name").alias("db_name"), plain_name("table_name").alias("table_name"),
        F.array(*[F.struct(F.lit(n).alias("name"), values[n].alias("value")) for n in names]).alias("_cells"),
        F.coalesce((F.col(version) if version else F.lit(None)).cast("bigint"), F.lit(-(2**63))).alias("version"),
    ).join(bounded(lists), "table_name", "left")
    keyed = keyed.withColumns({"_key": F.coalesce("_key", F.array(*map(F.lit, names))), "_fields": F.coalesce("_fields", F.lit(None).cast("array<string>"))})
    value = lambda k: F.coalesce(F.get(F.filter("_cells", lambda c: c["name"] == k)["value"], F.lit(0)), F.lit(""))
    cells = F.filter("_cells", lambda c: ~F.array_contains("_key", c["name"]) & F.coalesce(F.array_contains("_fields", c["name"]), F.lit(True)))
    return keyed.select("db_name", "table_name", F.array_join(F.transform("_key", value), "|").alias("record_key"), cells.alias("cells"), "version")


def _hashed(side: DataFrame, buckets: int) -> DataFrame:
    """side with key (the key's hash), bucket (by that hash) and hash (of the key and the cells, whatever the version)."""
    same = [F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in _KEY]
    key, raw = F.xxhash64(*same), F.pmod(F.xxhash64(*same, F.to_json("cells")), F.lit(field61.P - _FIRST_HASH))
    return side.withColumns({"key": key, "bucket": F.pmod(key, F.lit(buckets)), "hash": raw + F.lit(_FIRST_HASH)})


def _newest(key: np.ndarray, version: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, versions, hashes, whether tied): of each key its highest version's hash; where that version has several, the
    least and the greatest, tied."""
    order = np.lexsort((h, version, key))
    key, version, h = key[order], version[order], h[order]
    if not len(key):
        return key, version, h, np.empty(0, bool)
    last = np.flatnonzero(np.r_[key[1:] != key[:-1], True])
    group = np.cumsum(np.r_[False, key[1:] != key[:-1]])
    top = np.flatnonzero(version == version[last][group])
    first = top[np.flatnonzero(np.r_[True, group[top][1:] != group[top][:-1]])]
    tied = h[first] != h[last]
    keep = np.sort(np.r_[last, first[tied]])
    return key[keep], version[keep], h[keep], tied[group[keep]]


_HASHES = "g long, keys array<long>, versions array<long>, hashes array<long>"


def _sender(buckets: int, group: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What an input task sends: a hash per key, however many rows and versions of it the task meets, in a row per group of
    buckets."""

    def packed(key: np.ndarray, version: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        g = np.mod(key, buckets) // group
        order = np.argsort(g, kind="stable")
        numbers, count = np.unique(g, return_counts=True)
        ends = np.cumsum(count)
        return pa.record_batch([pa.array(numbers, pa.int64()), *[_lists(x[order], ends) for x in (key, version, h)]], ["g", "keys", "versions", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("key", "version", "hash")))
            if sum(len(x[0]) for x in held) >= HELD:
                part = _newest(*map(np.concatenate, zip(*held, strict=True)))[:3]
                held = [part]
                if len(part[0]) > HELD // 2:
                    yield packed(*part)
                    held = []
        if held:
            yield packed(*_newest(*map(np.concatenate, zip(*held, strict=True)))[:3])

    return run


def _values(first: np.ndarray, count: np.ndarray, h: np.ndarray, points: int) -> np.ndarray:
    """The values at 1..points of each bucket's characteristic polynomial; a bucket's hashes are h[first : first + count]."""
    z = np.arange(1, points + 1, dtype=np.uint64)
    product = np.ones((len(first), points), np.uint64)
    for k in range(int(count.max(initial=0))):
        has = np.flatnonzero(count > k)
        product[has] = field61.mul(product[has], field61.minus(np.broadcast_to(z, (len(has), points)), h[first[has] + k].astype(np.uint64)[:, None]))
    return product.astype(np.int64)


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat, pa.int64()))


_SKETCH = "bucket long, n long, values array<long>, hashes array<long>, tied array<long>"


def _sketcher(points: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    """For a group of buckets a row each: the number of hashes, the polynomial's values, the hashes, and the keys that are
    tied, whose hashes aren't among them."""

    def run(table: pa.Table) -> pa.Table:
        key, _, h, tied = _newest(*[pc.list_flatten(table[c]).to_numpy() for c in ("keys", "versions", "hashes")])
        bucket = np.mod(key, buckets)
        numbers = np.unique(bucket)
        order = np.argsort(bucket, kind="stable")
        key, h, tied, bucket = key[order], h[order], tied[order], bucket[order]

        def placed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            begin = np.searchsorted(bucket[x], numbers, side="left")
            return begin, np.searchsorted(bucket[x], numbers, side="right")

        (first, end), (_, tied_end) = placed(~tied), placed(tied)
        h = h[~tied]
        values = _values(first, end - first, h, points)
        return pa.table(
            {"bucket": numbers, "n": end - first, "values": _lists(values.ravel(), np.arange(1, len(numbers) + 1) * points), "hashes": _lists(h, end), "tied": _lists(key[tied], tied_end)}
        )

    return run


def _further(points: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sketches with more points, from the hashes that they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hashes")
            h, ends = hashes.flatten().to_numpy(), np.cumsum(hashes.value_lengths().to_numpy())
            first = np.r_[0, ends[:-1]].astype(np.int64)
            values = _lists(_values(first, ends - first, h, points).ravel(), np.arange(1, batch.num_rows + 1) * points)
            yield pa.record_batch([batch.column("bucket"), batch.column("n"), values, hashes, batch.column("tied")], ["bucket", "n", "values", "hashes", "tied"])

    return run


def sketches(side: DataFrame, buckets: int) -> DataFrame:
    """A row per bucket, as _sketcher gives it, of rows with key, version and hash. One shuffle, of hashes only."""
    tasks = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = max(1, min(GROUP, buckets // (2 * tasks)))
    sent = side.select("key", "version", "hash").mapInArrow(_sender(buckets, group), _HASHES)
    return sent.groupBy("g").applyInArrow(_sketcher(FIRST_DEGREE + CHECKS, buckets), _SKETCH)


@lru_cache
def _powers(z: int) -> list[int]:
    return [pow(z, k, field61.P) for k in range(LAST_DEGREE + 1)]


def recovered(a: tuple[int, list[int]], b: tuple[int, list[int]], bound: int) -> tuple[list[int], list[int]] | None:
    """The hashes only in a and only in b, from (count, values at 1..bound + CHECKS); None if they are more than bound."""
    n_a, n_b = a[0], b[0]
    gap = n_a - n_b
    if abs(gap) > bound:
        return None
    top = bound - (bound - gap) % 2  # the degrees' sum has the gap's parity
    d_a, d_b = (top + gap) // 2, (top - gap) // 2
    p, q = ([1], [1])
    ratio = [x * pow(y, -1, field61.P) % field61.P for x, y in zip(a[1], b[1], strict=True)]
    if d_a + d_b:
        rows = []
        for z, r in enumerate(ratio[: d_a + d_b], 1):
            powers = _powers(z)
            rows.append(powers[:d_a] + [-r * x % field61.P for x in powers[:d_b]] + [(r * powers[d_b] - powers[d_a]) % field61.P])
        found = field61.solved(rows)
        if found is None:
            return None
        p, q = found[:d_a] + [1], found[d_a:] + [1]
        shared = field61.common(p, q)
        p, q = field61.divided(p, shared)[0], field61.divided(q, shared)[0]
    for z, r in list(enumerate(ratio, 1))[d_a + d_b :]:
        if field61.value(p, z) != r * field61.value(q, z) % field61.P:
            return None
    in_a, in_b = field61.roots(p), field61.roots(q)
    if in_a is None or in_b is None or min([*in_a, *in_b], default=_FIRST_HASH) < _FIRST_HASH:
        return None
    return in_a, in_b


def _solver(bound: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"bucket": [], "side": [], "hash": []}
            for row in batch.to_pylist():
                a, b = (row["n"] or 0, row["values"]), (row["m"] or 0, row["others"])
                ones = [1] * (bound + CHECKS)
                got = recovered((a[0], a[1] or ones), (b[0], b[1] or ones), bound)
                hashes = [("?", None)] if got is None else [("a", h) for h in got[0]] + [("b", h) for h in got[1]]
                for side, h in hashes:
                    out["bucket"].append(row["bucket"])
                    out["side"].append(side)
                    out["hash"].append(h)
            yield pa.record_batch([pa.array(out["bucket"], pa.int64()), pa.array(out["side"], pa.string()), pa.array(out["hash"], pa.int64())], ["bucket", "side", "hash"])

    return run


def differing_hashes(a: DataFrame, b: DataFrame, buckets: int) -> DataFrame:
    """(bucket, side, hash) of the hashes found on one side only; a and b as from sketches(), buckets of them."""
    bound, parts = FIRST_DEGREE, []
    while True:
        both = a.select("bucket", "n", "values").join(b.select("bucket", F.col("n").alias("m"), F.col("values").alias("others")), "bucket", "full")
        unlike = both.where(~(F.col("n").eqNullSafe(F.col("m")) & F.col("values").eqNullSafe(F.col("others"))))
        # Solving is arithmetic on a few numbers per bucket; small as they are, they are spread over tasks by number.
        tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-buckets // SOLVED))
        result = kept(unlike.repartition(tasks, "bucket").mapInArrow(_solver(bound), "bucket long, side string, hash long"), "differing")
        parts.append(result.where("side <> '?'"))
        open_ = result.where("side = '?'").select("bucket")
        buckets = open_.count()
        if not buckets:
            break
        a, b = (x.join(bounded(open_), "bucket", "left_semi") for x in (a, b))
        if bound >= LAST_DEGREE:
            none = F.array().cast("array<long>")
            met = a.select("bucket", F.col("hashes").alias("x")).join(b.select("bucket", F.col("hashes").alias("y")), "bucket", "full")
            only = lambda x, y, s: met.select("bucket", F.lit(s).alias("side"), F.explode(F.array_except(F.coalesce(x, none), F.coalesce(y, none))).alias("hash"))
            parts += [only("x", "y", "a"), only("y", "x", "b")]
            break
        bound *= 2
        a, b = all_kept(*[(x.mapInArrow(_further(bound + CHECKS), _SKETCH), "open-buckets") for x in (a, b)])
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _fetched(side: DataFrame, found: DataFrame, tied: DataFrame | None) -> DataFrame:
    """The row that counts of each key that has a differing hash or is tied on either side."""
    rows = side.join(bounded(found), ["bucket", "hash"], "left_semi").select(*_KEY, "cells", "version")
    if tied is not None:
        rows = rows.unionByName(side.join(tied, "key", "left_semi").select(*_KEY, "cells", "version"))
    newest = F.max(F.struct("version", "cells")).alias("_m")
    return rows.groupBy(*_KEY).agg(newest).select(*_KEY, "_m.cells")


def differences(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("missing_in_source", "missing_in_target")) -> DataFrame:
    """(db_name, table_name, record_key, field_name, a_value, b_value) of all that differs between canonical() sides.

    A key on one side only gives one row, whose field_name is names[0] where a lacks it and names[1] where b does. Else
    each field whose values differ gives a row; null equals only null. Two empty sides give no row. Both sides are read
    twice, once for their hashes and once for the rows that differ; neither is written or shuffled as a whole.
    """
    buckets = max(1, -(-max(a.count(), b.count()) // BUCKET_ROWS))
    a, b = _hashed(a, buckets), _hashed(b, buckets)
    left, right = all_kept((sketches(a, buckets), "side-a"), (sketches(b, buckets), "side-b"))
    found = kept(differing_hashes(left, right, buckets), "found")
    # Keys whose highest version has several rows are compared in any case.
    tied = left.select(F.explode("tied").alias("key")).union(right.select(F.explode("tied").alias("key"))).distinct()
    tied = bounded(tied) if tied.limit(1).count() else None
    left, right = (_fetched(x, found.where(F.col("side") == s).select("bucket", "hash"), tied) for x, s in ((a, "a"), (b, "b")))
    left, right = left.withColumnRenamed("cells", "a_cells"), right.withColumnRenamed("cells", "b_cells")
    tag = lambda x: x.select(F.struct(*_KEY).alias("k"), F.lit(True).alias("here"), F.col(x.columns[-1]))
    left, right = tag(left), tag(right).withColumnRenamed("here", "there")
    met = left.join(right, left["k"].eqNullSafe(right["k"]), "full").select(
        F.coalesce(left["k"], right["k"]).alias("k"), "here", "there", F.coalesce("a_cells", F.array().cast(_cells())).alias("a_cells"), F.coalesce("b_cells", F.array().cast(_cells())).alias("b_cells")
    )
    row = lambda n, x, y: F.struct(n.alias("field_name"), x.alias("a_value"), y.alias("b_value"))
    none = F.lit(None).cast("string")
    of = lambda cells, n: F.get(F.filter(cells, lambda c: c["name"] == n)["value"], F.lit(0))
    fields = F.array_union(F.transform("a_cells", lambda c: c["name"]), F.transform("b_cells", lambda c: c["name"]))
    unlike = F.filter(
        F.transform(fields, lambda n: row(n, of("a_cells", n), of("b_cells", n))), lambda r: ~r["a_value"].eqNullSafe(r["b_value"])
    )
    rows = F.when(F.col("here").isNull(), F.array(row(F.lit(names[0]), none, none))).when(F.col("there").isNull(), F.array(row(F.lit(names[1]), none, none))).otherwise(unlike)
    return met.select("k.*", F.explode(rows).alias("r")).select(*_KEY, "r.*")


def _cells() -> str:
    return "array<struct<name:string,value:string>>"


def copies(source: DataFrame, target: DataFrame, layouts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both copies in canonical form: enum labels in lower case, amounts as numbers, times to the microsecond, zero dates null."""
    number = F.col("amount").cast("decimal(24,6)").cast("string")
    text = {c: F.col(c) for c in ("display_name", "field1")} | {"id": F.col("id").cast("string"), "age": F.col("age").cast("string")}
    text |= {"kind": F.lower("kind"), "amount": number}
    moment = lambda t: F.unix_micros(t.cast("timestamp")).cast("string")
    a = canonical(source, layouts, text | {"created_at": moment(F.col("created_at").try_cast("timestamp_ntz"))})
    b = canonical(target, layouts, text | {"created_at": moment(F.col("created_at"))}, "_version")
    return a, b
