"""A table kept as a snapshot and a log of changes, merged when it is read.

root/CURRENT names the snapshot (a v-… folder, '' for none); root/log has one folder per batch. A batch written twice
replaces itself, so replaying it changes nothing. Compaction publishes a new snapshot, which keeps each key's version and
tombstone, and retires the batches that it holds. Rows that come later, replayed or late, are judged by their own key's
version, so that a deleted key isn't brought back and no change is lost for being late. Tombstones go, and rows up to
there are ignored, only up to a version that the caller declares safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.latest import newest
from tidelog.store.publish import Published

VERSION, DELETED = "_version", "_deleted"
#: Bytes of batches and snapshot that one file of a new snapshot is sized for.
FILE_BYTES = 256 << 20


class Store:
    """key: the key columns; schema: DDL text of the data columns, which every batch is brought to.

    order_by: the columns a snapshot is sorted and ranged by, the key where none are given. indexes: columns with a Bloom
    filter, the key's first where none are given.
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], schema: str, order_by: Sequence[str] = (), indexes: Sequence[str] = ()) -> None:
        self.spark, self.key, self.order_by, self.indexes = spark, list(key), list(order_by), list(indexes)
        self.published = Published(spark, root)
        self.schema = spark.createDataFrame([], f"{schema}, {VERSION} bigint, {DELETED} boolean").schema

    def _facts(self) -> dict:
        return self.published.current() or {"version": "", "upto": -1, "truncated": -1}

    def append(self, rows: DataFrame, batch: int | str) -> None:
        """Adds changes: data columns, _version (bigint, unique per key) and optionally _deleted."""
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema])
        reduced = newest(typed, self.key, [VERSION])
        reduced.write.mode("overwrite").parquet(f"{self.published.root}/log/batch={batch}")

    def erase(self, keys: DataFrame, version: int, batch: int | str) -> None:
        """Tombstones for the given keys."""
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name not in (*self.key, VERSION, DELETED)]
        self.append(keys.select(*self.key, *rest, F.lit(version).alias(VERSION), F.lit(True).alias(DELETED)), batch)

    def truncate(self, version: int) -> None:
        """Nothing up to this version counts any longer."""
        facts = self._facts()
        self.published.publish(facts["version"], upto=facts["upto"], truncated=max(version, facts["truncated"]))

    def _batches(self) -> list[str]:
        fs, path = self.published._fs(), self.published._path("log")
        return sorted(e.getPath().getName() for e in fs.listStatus(path)) if fs.exists(path) else []

    def _log(self, above: int, batches: Sequence[str]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.published.root}/log/{b}" for b in batches])
        return rows.where(F.col(VERSION) > above)

    def read(self, final: bool = True, where: str | None = None) -> DataFrame:
        """The current rows; with final=False every version held, tombstones included.

        where filters the result; conditions on key columns reach the scan of snapshot and log.
        """
        rows = self._held(self._facts(), self._batches())
        if final:
            rows = newest(rows, self.key, [VERSION]).where(f"NOT {DELETED}").drop(DELETED)
        return rows.where(where) if where else rows

    def _held(self, facts: dict, batches: Sequence[str]) -> DataFrame:
        rows = self._log(max(facts["upto"], facts["truncated"]), batches)
        if facts["version"]:
            kept = self.spark.read.schema(self.schema).parquet(f"{self.published.root}/{facts['version']}")
            rows = kept.where(F.col(VERSION) > facts["truncated"]).unionByName(rows)
        return rows

    def _bytes(self, names: Sequence[str]) -> int:
        fs = self.published._fs()
        return sum(fs.getContentSummary(self.published._path(n)).getLength() for n in names)

    def max_version(self) -> int | None:
        """The highest version held, None in an empty table."""
        return self.read(final=False).agg(F.max(VERSION)).first()[0]

    def optimize(self, files: int | None = None, safe: int = -1) -> dict:
        """Writes the newest row of each key as the new snapshot, clustered by key, and drops what it replaces.

        The batches at hand when it starts are folded, and only these are removed: one that is appended meanwhile stays in
        the log. safe: a version up to which no change will come any more but replays. Tombstones up to it are dropped.
        Files are as many as the folded bytes need at FILE_BYTES each.
        """
        facts, batches = self._facts(), self._batches()
        upto = max(facts["upto"], safe)
        final = newest(self._held(facts, batches), self.key, [VERSION]).where(F.expr(f"NOT coalesce({DELETED}, false)") | (F.col(VERSION) > upto))
        folded = [f"log/{b}" for b in batches] + ([facts["version"]] if facts["version"] else [])
        n = files or max(1, -(-self._bytes(folded) // FILE_BYTES))
        version = self.published.stage()
        self._snapshot(final, n, version)
        # What was truncated while the snapshot was written stays truncated.
        now = self.published.publish(version, upto=upto, truncated=max(facts["truncated"], self._facts()["truncated"]))
        for b in batches:
            self.published._fs().delete(self.published._path(f"log/{b}"), True)
        self.published.vacuum()
        return now

    def _snapshot(self, final: DataFrame, files: int, version: str) -> None:
        """Ranges of the layout's order, one file each; a Bloom filter on each indexed column."""
        order = self.order_by or self.key
        writer = final.repartitionByRange(files, *order).sortWithinPartitions(*order).write
        for c in self.indexes or self.key[:1]:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(f"{self.published.root}/{version}")
