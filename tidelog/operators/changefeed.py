"""Applying inserts, updates and deletes, repeated and in any order, to the current state of tables.

Every change becomes a row (table, record key, position, kind). Rows are spread by a hash of their key over buckets, and
the state is stored by bucket. Inside a bucket an embedded DuckDB holds one row per key with the position that last
touched it: the bucket's stored rows are loaded first, then changes come in small statements, INSERT ... ON CONFLICT DO
UPDATE, each taken only where its position is above the stored one. A delete stays as a tombstone, so that a change that
comes late can't bring the key back. TRUNCATE is a marker per table, kept beside the buckets. Buckets that no change
meets keep their files; those that are met are written to a fresh folder, and all are published together by one rename
(store.publish).

The same upsert runs first inside each input task, so that a key with very many changes sends one row per task. The
database holds keys and positions and the place of each row; the rows themselves stay in Arrow.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.names import file_number, plain_name
from tidelog.functions.sqltext import truncated
from tidelog.session import all_kept, bounded, spread
from tidelog.store.publish import Published

WRITE, DELETE, TRUNCATE = 1, 2, 3
STATE = "db_name string, table_name string, record_key string, file_no bigint, log_pos bigint, row_no int, kind tinyint, payload string"
#: Rows and bytes of payload that one bucket is sized for, and that a task holds before it passes its part on.
BUCKET_ROWS, BUCKET_BYTES = 200_000, 64 << 20
#: Changes of one statement, and how often a key may stand in a batch (10,000 rows by Spark's default) that isn't reduced.
CHUNK_ROWS, REPEATS = 2_000, 16

_ARROW = pa.schema(
    [
        ("db_name", pa.string()), ("table_name", pa.string()), ("record_key", pa.string()), ("file_no", pa.int64()),
        ("log_pos", pa.int64()), ("row_no", pa.int32()), ("kind", pa.int8()), ("payload", pa.string()),
    ]
)

_CREATE = """
CREATE TABLE state (
    db_name VARCHAR, table_name VARCHAR, record_key VARCHAR, file_no BIGINT, log_pos BIGINT, row_no INTEGER,
    kind TINYINT, slot BIGINT, PRIMARY KEY (record_key, table_name, db_name))
"""
_LOAD = "INSERT INTO state SELECT db_name, table_name, record_key, file_no, log_pos, row_no, kind, slot FROM incoming"
#: A statement may touch a key once, so of a chunk's changes to a key it brings the newest; the stored row decides the rest.
_UPSERT = """
INSERT INTO state
SELECT db_name, table_name, record_key, newest.file_no, newest.log_pos, newest.row_no, newest.kind, newest.slot
FROM (
    SELECT db_name, table_name, record_key,
        arg_max({'file_no': file_no, 'log_pos': log_pos, 'row_no': row_no, 'kind': kind, 'slot': slot},
                (file_no, log_pos, row_no, kind)) AS newest
    FROM incoming GROUP BY ALL)
ON CONFLICT DO UPDATE SET
    file_no = excluded.file_no, log_pos = excluded.log_pos, row_no = excluded.row_no,
    kind = excluded.kind, slot = excluded.slot
WHERE (excluded.file_no, excluded.log_pos, excluded.row_no, excluded.kind)
    > (state.file_no, state.log_pos, state.row_no, state.kind)
"""


class _Bucket:
    """The embedded database of one bucket. It never spills to a disk: what it holds is bounded by the bucket's rows."""

    def __init__(self) -> None:
        import duckdb

        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        self.con.execute(_CREATE)
        self.held: list[pa.Table] = []
        self.rows = self.bytes = 0

    def _run(self, sql: str, rows: pa.Table) -> int:
        slots = pa.array(range(self.rows, self.rows + rows.num_rows), pa.int64())
        self.con.register("incoming", rows.drop_columns(["payload"]).append_column("slot", slots))
        changed = self.con.execute(sql).fetchall()[0][0]
        self.con.unregister("incoming")
        self.held.append(rows)
        self.rows += rows.num_rows
        self.bytes += rows["payload"].nbytes
        return changed

    def load(self, stored: pa.Table) -> None:
        """The rows that the bucket held so far, one per key."""
        if stored.num_rows:
            self._run(_LOAD, stored.select(_ARROW.names).cast(_ARROW))

    def upsert(self, rows: pa.Table) -> int:
        """Takes changes, a statement for each CHUNK_ROWS of them; returns how many rows were inserted or updated."""
        rows = rows.select(_ARROW.names).cast(_ARROW)
        return sum(self._run(_UPSERT, rows.slice(at, CHUNK_ROWS)) for at in range(0, rows.num_rows, CHUNK_ROWS))

    def export(self) -> pa.Table:
        """The newest row of each key; the database ends."""
        slots = self.con.sql("SELECT slot FROM state ORDER BY slot").to_arrow_table()["slot"]
        self.con.close()
        return pa.concat_tables(self.held).take(slots) if self.held else _ARROW.empty_table()


def _repeats(batch: pa.RecordBatch) -> bool:
    """Whether the batch holds a key so often, or so many keys twice, that bringing it to one row per key pays."""
    counts = pc.value_counts(pc.binary_join_element_wise(batch["db_name"], batch["table_name"], batch["record_key"], "\0"))
    return 2 * len(counts) < batch.num_rows or (pc.max(counts.field("counts")).as_py() or 0) > REPEATS


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The upsert inside an input task: of batches with repeated keys one row per key goes on, or a few where a task holds
    more than a bucket's rows. Batches without pass as they are: a key sends at most REPEATS rows in each of them."""
    bucket: _Bucket | None = None
    for batch in batches:
        if not _repeats(batch):
            yield pa.RecordBatch.from_arrays(batch.columns, schema=_ARROW)  # one schema for what passes and what is exported
            continue
        bucket = bucket or _Bucket()
        bucket.upsert(pa.Table.from_batches([batch]))
        if bucket.rows >= BUCKET_ROWS or bucket.bytes >= BUCKET_BYTES:
            yield from bucket.export().to_batches()
            bucket = None
    if bucket:
        yield from bucket.export().to_batches()


def _numbered(key: tuple[Any, ...], rows: pa.Table) -> pa.Table:
    number = key[0].as_py() if hasattr(key[0], "as_py") else key[0]
    return rows.append_column("bucket", pa.array([number] * rows.num_rows, pa.int32()))


def _fresh_bucket(key: tuple[Any, ...], feed: pa.Table) -> pa.Table:
    bucket = _Bucket()
    bucket.upsert(feed)
    return _numbered(key, bucket.export())


def _held_bucket(key: tuple[Any, ...], feed: pa.Table, stored: pa.Table) -> pa.Table:
    bucket = _Bucket()
    bucket.load(stored)
    bucket.upsert(feed)
    return _numbered(key, bucket.export())


def changes(log: DataFrame, layouts: DataFrame, payload: bool = False) -> DataFrame:
    """The changes that a log of events holds, a row each, in the columns of STATE.

    log: event_type (1 write, 2 delete, 3 statement), transaction_id<file_name, log_pos>, db_name, table_name, records.
    layouts: table_name, table_fields, primary_keys. Names count in their plain form. record_key joins the key's values
    by '|', a null value being empty. With payload, a write carries its row as JSON list of texts.

    Rows without position, of unknown tables, with unreadable records, and statements other than TRUNCATE change
    nothing and give no row. An empty log gives no row. Extra columns are ignored.
    """
    keyed = layouts.select(
        plain_name("table_name").alias("table_name"),
        F.transform("primary_keys", lambda k: F.array_position(F.col("table_fields"), k).cast("int") - 1).alias("at"),
    )
    placed = log.select(
        "event_type",
        plain_name("db_name").alias("db_name"),
        plain_name("table_name").alias("table_name"),
        file_number("transaction_id.file_name").alias("file_no"),
        F.col("transaction_id.log_pos").alias("log_pos"),
        "records",
    ).where("file_no IS NOT NULL AND log_pos IS NOT NULL")
    rows = (
        spread(placed.where(F.col("event_type").isin(WRITE, DELETE)))
        .join(bounded(keyed), "table_name")
        .select("*", F.posexplode(F.from_json("records", "array<array<string>>")).alias("row_no", "row"))
        .where("row IS NOT NULL")
    )
    text = F.to_json("row") if payload else F.lit(None).cast("string")
    writes = rows.select(
        "db_name",
        "table_name",
        F.array_join(F.transform("at", lambda i: F.coalesce(F.get("row", i), F.lit(""))), "|").alias("record_key"),
        "file_no",
        "log_pos",
        "row_no",
        F.col("event_type").cast("tinyint").alias("kind"),
        F.when(F.col("event_type") == WRITE, text).alias("payload"),
    )
    named = placed.where(F.col("event_type") == TRUNCATE).select(
        truncated(F.col("records"), F.col("db_name")).alias("t"), "file_no", "log_pos"
    )
    markers = (
        named.where("t.db IS NOT NULL")
        .select(F.col("t.db").alias("db_name"), F.col("t.tbl").alias("table_name"), F.struct("file_no", "log_pos").alias("at"))
        .join(bounded(keyed.select("table_name")), "table_name", "left_semi")
        .groupBy("db_name", "table_name")
        .agg(F.max("at").alias("at"))
    )
    return writes.unionByName(
        markers.select(
            "db_name", "table_name", F.lit("").alias("record_key"), "at.file_no", "at.log_pos",
            F.lit(2**31 - 1).alias("row_no"), F.lit(TRUNCATE).cast("tinyint").alias("kind"), F.lit(None).cast("string").alias("payload"),
        )
    )


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("db_name", "table_name", "record_key"), F.lit(n)).cast("int")


_TABLE = ["db_name", "table_name"]


def _cut(rows: DataFrame, markers: DataFrame) -> DataFrame:
    """rows with those before their table's TRUNCATE as tombstones. Markers are one row per table at most."""
    at = markers.select(*[F.col(c).alias(f"_{c}") for c in _TABLE], F.struct("file_no", "log_pos").alias("_cut"))
    gone = F.coalesce(F.struct("file_no", "log_pos") < F.col("_cut"), F.lit(False))
    joined = rows.join(bounded(at), [F.col(c) == F.col(f"_{c}") for c in _TABLE], "left")
    return joined.withColumns(
        {"kind": F.when(gone, F.lit(DELETE)).otherwise(F.col("kind")).cast("tinyint"), "payload": F.when(~gone, F.col("payload"))}
    ).select(rows.columns)


class State:
    """What apply_changes() has published at root: rows by bucket, in the folder of the application that last met each
    bucket, and the newest TRUNCATE of each table."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.store = spark, Published(spark, root)
        self.facts = self.store.current()

    def rows(self, wanted: set[int] | None = None) -> DataFrame:
        """The stored rows with their bucket, of the wanted buckets or all."""
        out = self.spark.createDataFrame([], f"{STATE}, bucket int")
        by_version: dict[str, list[int]] = {}
        for number, (version, _) in (self.facts["places"] if self.facts else {}).items():
            by_version.setdefault(version, []).append(int(number))
        for version, numbers in by_version.items():
            mine = [n for n in numbers if wanted is None or n in wanted]
            if mine:
                part = self.spark.read.schema(out.schema).parquet(f"{self.store.root}/{version}").select(out.columns)
                out = out.unionByName(part.where(F.col("bucket").isin(mine)))
        return out

    def markers(self) -> DataFrame:
        schema = "db_name string, table_name string, file_no bigint, log_pos bigint"
        name = self.facts and self.facts["markers"]
        return self.spark.read.schema(schema).parquet(f"{self.store.root}/{name}") if name else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """All rows, tombstones (kind 2) beside living ones (kind 1); live() takes the latter."""
        return _cut(self.rows().drop("bucket"), self.markers())


def apply_changes(feed: DataFrame, root: str, buckets: int | None = None) -> DataFrame:
    """Applies feed (columns of STATE) to the state published at root, publishes the new state and returns it.

    The returned rows hold tombstones (kind 2) beside living records (kind 1); live() takes the latter. Applying the same
    changes again, in another order or in other parts, gives the same state. Only buckets that the feed meets are read
    and written again.

    buckets is chosen at the first call (by BUCKET_ROWS and BUCKET_BYTES, at least the session's shuffle partitions) and
    kept with the state until buckets would pass twice their size, when all are dealt anew. Null in db_name or
    table_name makes a table of that name; a null record_key counts as ''. An empty feed changes nothing.
    """
    spark = feed.sparkSession
    state = State(spark, root)
    now, store = state.facts, state.store
    # DuckDB's key takes no null, hence the first character.
    tag = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(c)
    tagged = feed.select(
        tag("db_name"), tag("table_name"), F.concat(F.lit("="), F.coalesce("record_key", F.lit(""))).alias("record_key"),
        "file_no", "log_pos", "row_no", "kind", "payload",
    )
    said = tagged.where(F.col("kind") == TRUNCATE).select(*_TABLE, "file_no", "log_pos").unionByName(state.markers())
    markers = said.groupBy(*_TABLE).agg(F.max(F.struct("file_no", "log_pos")).alias("m")).select(*_TABLE, "m.*")
    reduced, markers = all_kept((tagged.where(F.col("kind") != TRUNCATE).mapInArrow(_combine, STATE), "changefeed"), (markers, "markers"))
    rows, size = reduced.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0))).first()
    row_bytes = max(now["row_bytes"] if now else 0, -(-size // rows) if rows else 0)
    total = rows + (sum(n for _, n in now["places"].values()) if now else 0)
    fitting = max(1, -(-total // BUCKET_ROWS), -(-total * row_bytes // BUCKET_BYTES))
    if now is None:
        buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), fitting)
        dealt_anew = False
    else:
        dealt_anew = fitting > 2 * now["buckets"]
        buckets = fitting if dealt_anew else now["buckets"]
    placed = reduced.withColumn("bucket", _bucket(buckets))
    everything = now is None or dealt_anew
    met = set() if everything else {r.bucket for r in placed.select("bucket").distinct().collect()}  # numbers below `buckets`
    # By number, so that small buckets aren't put together into long tasks.
    by_bucket = lambda df: df.repartition(buckets, "bucket").groupBy("bucket")
    schema = f"{STATE}, bucket int"
    if now is None:
        result = by_bucket(placed).applyInArrow(_fresh_bucket, schema)
    else:
        stored = state.rows(None if everything else met).withColumn("bucket", _bucket(buckets))
        result = by_bucket(placed).cogroup(by_bucket(stored)).applyInArrow(_held_bucket, schema)
    version, cuts = store.stage(), store.stage()
    markers.coalesce(1).write.parquet(f"{store.root}/{cuts}")
    _cut(result, markers).write.partitionBy("bucket").parquet(f"{store.root}/{version}")
    counts = spark.read.schema(schema).parquet(f"{store.root}/{version}").groupBy("bucket").count().collect()  # a number per bucket
    places = {} if everything else {n: p for n, p in now["places"].items() if int(n) not in met}
    places |= {str(r["bucket"]): (version, r["count"]) for r in counts}
    parts = sorted({v for v, _ in places.values()} | {cuts})
    store.publish(version, buckets=buckets, places=places, markers=cuts, parts=parts, row_bytes=row_bytes)
    return State(spark, root).read()


def live(state: DataFrame) -> DataFrame:
    """The living records of a state, names as they were given."""
    untag = lambda c: F.when(F.col(c) != "", F.expr(f"substring({c}, 2)")).alias(c)
    return state.where(F.col("kind") == WRITE).select(
        untag("db_name"), untag("table_name"), F.expr("substring(record_key, 2)").alias("record_key"),
        "file_no", "log_pos", "row_no", "payload",
    )
