"""From a change log to tables: rows of a binary log (or a queue brought to the same columns), batch by batch, with the
schema statements among them as barriers.

A batch is cut at its schema statements. Rows before one are stored under the schema before it, rows after it under the
one after it. Values are stored as the log delivers them, by lasting column id, so a statement never rewrites a file: what a
column is called, where it stands and what type it has is decided when the table is read, by the registry, which is
published after the batch's rows, together with the position that the batch came to. What lies at or before that position
has been applied, whether it is delivered again by a restarted reader or in a batch that runs again; a batch that didn't
come to its end replaces its own parts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.config import Settings
from tidelog.ddl.convert import raw_values, typed
from tidelog.ddl.schema import Registry, Statement, Table
from tidelog.operators.latest import newest
from tidelog.store.publish import Published
from tidelog.store.table import DELETED, VERSION, Store

#: How statements begin that may change a schema or empty a table, after comments.
_SCHEMA = r"(?is)^\s*(?:/\*.*?\*/\s*|--[^\n]*\n\s*|#[^\n]*\n\s*)*(?:create|alter|drop|rename|truncate)\b"
#: Tables whose rows are appended at the same time.
WIDTH = 8
#: Columns of the rows taken; any others are ignored.
COLUMNS = ["file_no", "log_pos", "row_no", "db_name", "table_name", "op", "text", "before", "after"]


def _position(file_no: SparkColumn, log_pos: SparkColumn) -> SparkColumn:
    """One number per event: the file, then the place of its end, which fits 32 bits."""
    return F.shiftleft(file_no.cast("bigint"), 32).bitwiseOR(log_pos)


class Replica:
    """Tables at root: root/registry (schemas, where each table's rows are, the last position), root/tables/<number>.

    settings selects and routes databases and tables, and gives layouts: order_bys (a list of columns), indexes (a column or
    a list), types_mapping, ignore_deletes, source_timezone. A table is opened by the names of its target.
    """

    def __init__(self, spark: SparkSession, root: str, settings: Settings | None = None) -> None:
        self.spark, self.root, self.settings = spark, root.rstrip("/"), settings or Settings()
        self.published = Published(spark, f"{self.root}/registry")
        self._load()

    def _load(self) -> None:
        facts = self.published.current()
        self.registry = Registry.from_json(facts["registry"]) if facts else Registry()
        self.places: dict[tuple[str, str], int] = {tuple(k): v for k, v in facts["places"]} if facts else {}
        self.next = facts["next"] if facts else 1
        self.seen = facts["seen"] if facts else -1

    def _save(self, version: str) -> None:
        self.published.publish(version, registry=self.registry.to_json(), places=[[list(k), v] for k, v in self.places.items()], next=self.next, seen=self.seen)

    def create(self, sql: str, db: str) -> None:
        """Makes a table known from the source's own CREATE statement, as before a snapshot."""
        self._place(self.registry.apply(sql, db))
        self._save("")

    def _place(self, s: Statement) -> None:
        """Follows a statement with the places of tables: a new table gets one, a renamed one keeps it."""
        if s.kind in ("create", "like") and (s.db, s.table) in self.registry.tables and (s.db, s.table) not in self.places:
            self.places[(s.db, s.table)] = self.next
            self.next += 1
        elif s.kind == "drop":
            for name in s.body:
                self.places.pop(tuple(name), None)
        elif s.kind == "rename":
            held = [(b, self.places.pop((s.db, a), None)) for a, b in s.body]
            self.places |= {(s.db, b): n for b, n in held if n}
        elif s.kind == "alter":
            for op in s.body:
                if op[0] == "to" and (s.db, s.table) in self.places:
                    self.places[(s.db, op[1])] = self.places.pop((s.db, s.table))

    def store(self, db: str, table: str) -> Store:
        t = self.registry.tables[(db, table)]
        ids = {f.name: f.id for f in t.fields}
        listed = lambda x: [x] if isinstance(x, str) else list(x)
        named = lambda what: [ids[c] for v in self.settings.scoped(what, db, table) for c in listed(v) if c in ids]
        schema = ", ".join(f"{f.id} string" for f in t.fields)
        return Store(self.spark, f"{self.root}/tables/{self.places[(db, table)]}", [ids[t.field(k).name] for k in t.key], schema, named("order_bys"), named("indexes"))

    def read(self, db: str, table: str) -> DataFrame:
        """The living rows under the present schema."""
        t = self.registry.tables[(db, table)]
        rows = self.store(db, table).read()
        return rows.select(*[typed(F.col(f.id), f, self.settings.types_mapping, self.settings.source_timezone).alias(f.name) for f in t.fields])

    def sql(self, text: str) -> DataFrame:
        """A query over the tables as they are now, each known as <database>_<table>."""
        for db, table in self.places:
            self.read(db, table).createOrReplaceTempView(f"{db}_{table}")
        return self.spark.sql(text)

    def snapshot(self, db: str, table: str, rows: DataFrame) -> None:
        """Stores rows copied from the source, under their names, below every change of the log."""
        t = self.registry.tables[(db, table)]
        held = {c.lower(): c for c in rows.columns}
        texts = [(F.col(f"`{held[f.name.lower()]}`") if f.name.lower() in held else F.lit(None)).cast("string").alias(f.id) for f in t.fields]
        self.store(db, table).append(rows.select(*texts, F.lit(self.settings.version_initial_value).cast("bigint").alias(VERSION)), "snapshot")

    def apply(self, rows: DataFrame, number: int | str) -> None:
        """One batch, or any part of the log behind the last. Statements of a batch are few and come to the driver; rows don't."""
        self._load()
        wanted = self.settings.database_selected("db_name") & (F.col("table_name").isNull() | self.settings.table_selected("table_name"))
        rows = rows.select(*COLUMNS).where(wanted & (_position(F.col("file_no"), F.col("log_pos")) > self.seen)).persist()
        try:
            reached = rows.agg(F.max(_position(F.col("file_no"), F.col("log_pos")))).first()[0]
            if reached is None:
                return
            said = rows.where((F.col("op") == "Q") & F.col("text").rlike(_SCHEMA)).select("file_no", "log_pos", "db_name", "text").orderBy("file_no", "log_pos").collect()
            changes = rows.where(F.col("op").isin("U", "D")).withColumn(VERSION, _position(F.col("file_no"), F.col("log_pos")))
            met = {(r.db_name, r.table_name) for r in changes.select("db_name", "table_name").distinct().collect()}
            low = -1
            for i, statement in enumerate([*said, None]):
                high = 2**63 - 1 if statement is None else (statement.file_no << 32) | statement.log_pos
                part = changes.where((F.col(VERSION) > low) & (F.col(VERSION) < high)) if said else changes
                self._append(part, [k for k in met if k in self.places], f"{number}-{i}")
                if statement is not None:
                    self._obey(statement, high)
                low = high
            self.seen = reached
            self._save("")
        finally:
            rows.unpersist()

    def _obey(self, statement, version: int) -> None:  # noqa: ANN001
        """A statement that can't be read or names what isn't there changes nothing, as one of another server's objects."""
        position, before = (statement.file_no, statement.log_pos), self.registry.applied
        try:
            s = self.registry.apply(statement.text, statement.db_name or "", position)
        except (ValueError, KeyError):
            return
        if position <= before:
            return
        if s.kind == "truncate" and (s.db, s.table) in self.places:
            self.store(s.db, s.table).truncate(version)
        self._place(s)

    def _append(self, changes: DataFrame, tables: Sequence[tuple[str, str]], batch: str) -> None:
        def one(k: tuple[str, str]) -> None:
            mine = changes.where((F.col("db_name") == k[0]) & (F.col("table_name") == k[1]))
            self.store(*k).append(self._stored(mine, self.registry.tables[k]), batch)

        if tables:
            with ThreadPoolExecutor(min(WIDTH, len(tables))) as pool:
                list(pool.map(one, tables))

    def _stored(self, changes: DataFrame, t: Table) -> DataFrame:
        """Store rows: the newest image of each key of each event, and a tombstone for the old key of a row whose key changed."""
        key = [t.field(k) for k in t.key]
        images = changes.select(VERSION, "row_no", "op", raw_values(F.col("before")).alias("b"), raw_values(F.col("after")).alias("a"))
        of = lambda side, f: F.try_element_at(side, F.lit(f.name))
        columns = lambda side, fields: [of(side, f).alias(f.id) if f in fields else F.lit(None).cast("string").alias(f.id) for f in t.fields]
        written = images.where("op = 'U'").select(*columns(F.col("a"), t.fields), VERSION, F.lit(False).alias(DELETED), (F.col("row_no") * 2 + 1).alias("_at"))
        if self.settings.ignore_deletes:
            gone = images.limit(0)
        else:
            same = [of(F.col("a"), f).eqNullSafe(of(F.col("b"), f)) for f in key]
            moved = F.col("b").isNotNull() & ~F.expr("true") if not same else F.col("b").isNotNull() & ~_all(same)
            gone = images.where((F.col("op") == "D") | moved)
        tombs = gone.select(*columns(F.col("b"), key), VERSION, F.lit(True).alias(DELETED), (F.col("row_no") * 2).alias("_at"))
        ids = [f.id for f in key]
        return newest(written.unionByName(tombs), ids, [VERSION, "_at"]).drop("_at")

    def start(self, rows: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        """Applies a stream of such rows. Without an interval it takes what is there now and ends."""
        writer = rows.writeStream.foreachBatch(lambda df, n: self.apply(df, n)).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

    def optimize(self, safe: int = -1) -> list[tuple[str, str]]:
        """Compacts every table; returns their names."""
        for k in self.places:
            self.store(*k).optimize(safe=safe)
        return list(self.places)


def _all(conditions: Sequence[SparkColumn]) -> SparkColumn:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def is_schema_statement(sql: str) -> bool:
    return re.match(_SCHEMA, sql) is not None
