"""A queue of change events in files: root/<database>/<number>.jsonl, one event per line.

format("tidelog_queue"), once sources.register() made it known, reads it as a table or a stream of db_name, file_num, line_no, transaction_id<file_name, log_pos>,
event_type, table_name, records, and writes rows with these columns (file_num and line_no aside) behind what is there.
Files are complete once they have their name (they are written elsewhere and renamed), and numbers grow, so a stream's
offset is a file number per database. Filters on db_name choose folders before any is read. Paths may be of any file
system that sources.files knows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

from tidelog.sources import files

SCHEMA = (
    "db_name string, file_num int, line_no int, transaction_id struct<file_name: string, log_pos: bigint>, "
    "event_type int, table_name string, records string"
)
SUFFIX, PART = ".jsonl", ".part"
ROWS_PER_FILE = 100_000


def numbers(folder: str) -> list[int]:
    """The numbers of the files there, in numeric order."""
    return sorted(int(n[: -len(SUFFIX)]) for n in files.file_names(folder) if n.endswith(SUFFIX) and n[: -len(SUFFIX)].isdigit())


class _Roll:
    """Writes events of one database to part files of at most `rows` lines."""

    def __init__(self, root: str, db: str, rows: int) -> None:
        self.root, self.db, self.rows, self.out, self.made, self.held = root, db, rows, None, [], 0

    def add(self, event: dict[str, Any]) -> None:
        if self.out is None:
            self.made.append(files.joined(self.root, self.db, f"{uuid.uuid4().hex}{PART}"))
            self.out, self.held = files.writing(self.made[-1]), 0
        self.out.write((json.dumps(event, ensure_ascii=False) + "\n").encode())
        self.held += 1
        if self.held >= self.rows:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _numbered(root: str, parts: Iterable[tuple[str, str]]) -> list[int]:
    """Gives part files (database, path) the numbers behind those there, in the order given. One writer at a time."""
    made, last = [], {}
    for db, path in parts:
        number = last[db] = last.get(db, (numbers(files.joined(root, db)) or [0])[-1]) + 1
        files.moved(path, files.joined(root, db, f"{number}{SUFFIX}"))
        made.append(number)
    return made


def append_events(root: str, db: str, events: Iterable[dict[str, Any]], rows_per_file: int = ROWS_PER_FILE) -> list[int]:
    """Adds events of one process as new files behind the last one; returns their numbers."""
    roll = _Roll(root, db, rows_per_file)
    for e in events:
        roll.add(e)
    roll.close()
    return _numbered(root, [(db, p) for p in roll.made])


def remove_old(root: str, seconds: float, keep: int = 6, now: float | None = None) -> list[str]:
    """Removes files older than that, but for each database's newest `keep`; returns their paths."""
    gone, limit = [], (time.time() if now is None else now) - seconds
    for db in files.folder_names(root):
        for n in numbers(files.joined(root, db))[:-keep]:
            path = files.joined(root, db, f"{n}{SUFFIX}")
            if files.modified(path) < limit:
                files.removed(path)
                gone.append(path)
    return gone


def _events(path: str) -> Iterator[dict[str, Any]]:
    with files.reading(path) as data:
        for line in data.read().decode().split("\n"):
            if line:
                yield json.loads(line)


def _position(event: dict[str, Any]) -> tuple[int, int] | None:
    t = event.get("transaction_id")
    digits = "".join(c for c in t["file_name"].rsplit(".", 1)[-1] if c.isdigit()) if t and t["file_name"] else ""
    return (int(digits), t["log_pos"]) if digits else None


def last_transaction(root: str, db: str) -> tuple[int, int] | None:
    """The position of the last event in the queue that has one, read from its newest files; null in an empty queue."""
    folder = files.joined(root, db)
    for n in reversed(numbers(folder)):
        known = [p for e in _events(files.joined(folder, f"{n}{SUFFIX}")) if (p := _position(e))]
        if known:
            return known[-1]
    return None


def file_of(root: str, db: str, position: tuple[int, int]) -> int:
    """The number of the last file that begins at or before a position, by halving; 0 where none does."""
    folder, low = files.joined(root, db), 0
    listed = numbers(folder)
    high = len(listed)
    while low < high:
        middle = (low + high) // 2
        first = next((p for e in _events(files.joined(folder, f"{listed[middle]}{SUFFIX}")) if (p := _position(e))), None)
        if first is None or first <= position:
            low = middle + 1
        else:
            high = middle
    return listed[low - 1] if low else 0


class _File(InputPartition):
    def __init__(self, path: str, db: str, number: int) -> None:
        self.path, self.db, self.number = path, db, number


def _rows(part: _File, after: tuple[int, int] | None = None) -> Iterator[tuple]:
    for i, e in enumerate(_events(part.path)):
        t, r = e.get("transaction_id"), e.get("records")
        if after and (at := _position(e)) and at <= after:
            continue
        yield (
            part.db, part.number, i, (t["file_name"], t["log_pos"]) if t else None, e.get("event_type"), e.get("table_name"),
            r if r is None or isinstance(r, str) else json.dumps(r, ensure_ascii=False),
        )


class _Reader(DataSourceReader):
    def __init__(self, root: str, after: tuple[int, int] | None) -> None:
        self.root, self.after, self.dbs = root, after, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("db_name",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.dbs = wanted if self.dbs is None else self.dbs & wanted
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        dbs = [d for d in files.folder_names(self.root) if self.dbs is None or d in self.dbs]
        first = {d: file_of(self.root, d, self.after) if self.after else 0 for d in dbs}
        listed = [(d, n) for d in dbs for n in numbers(files.joined(self.root, d)) if n >= first[d]]
        return [_File(files.joined(self.root, d, f"{n}{SUFFIX}"), d, n) for d, n in listed]

    def read(self, partition: _File) -> Iterator[tuple]:
        return _rows(partition, self.after) if partition else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, root: str, start: dict[str, int], most: int, checkpoint: str | None) -> None:
        if most and not checkpoint:
            raise ValueError("maxFilesPerTrigger needs the query's checkpointLocation as option checkpoint")
        self.root, self.start, self.most, self.checkpoint = root, start, most, checkpoint

    def initialOffset(self) -> dict:  # noqa: N802
        return {"files": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        last = {d: (numbers(files.joined(self.root, d)) or [0])[-1] for d in files.folder_names(self.root)}
        if self.most:
            at = (files.planned(self.checkpoint) or self.initialOffset())["files"]
            last = {d: min(n, at.get(d, 0) + self.most) for d, n in last.items()}
        return {"files": last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        out = []
        for d, last in end["files"].items():
            first = start["files"].get(d, 0)
            out += [_File(files.joined(self.root, d, f"{n}{SUFFIX}"), d, n) for n in numbers(files.joined(self.root, d)) if first < n <= last]
        return out

    def read(self, partition: _File) -> Iterator[tuple]:
        return _rows(partition) if partition else iter(())


@dataclass
class _Written(WriterCommitMessage):
    parts: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    """Each task writes part files; the commit gives them numbers, in the order of tasks, so events keep the order that the
    written DataFrame's partitions have."""

    def __init__(self, root: str, rows: int) -> None:
        self.root, self.rows = root, rows

    def write(self, iterator: Iterator[Any]) -> WriterCommitMessage:
        rolls: dict[str, _Roll] = {}
        for row in iterator:
            t, records = row["transaction_id"], row["records"]
            event = {
                "transaction_id": {"file_name": t["file_name"], "log_pos": t["log_pos"]} if t else None, "event_type": row["event_type"],
                "table_name": row["table_name"], "records": records,
            }
            db = row["db_name"] or "_"
            rolls.setdefault(db, _Roll(self.root, db, self.rows)).add(event)
        for roll in rolls.values():
            roll.close()
        return _Written([(db, p) for db, roll in rolls.items() for p in roll.made])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        _numbered(self.root, [p for m in messages if m for p in m.parts])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            for _, path in m.parts if m else ():
                files.removed(path)


class QueueSource(DataSource):
    """Options: path (the root). Reading: afterFile and afterPos, a transaction's log file number and position, to read only
    events behind it. Streams: startingFiles, JSON of the last file number already taken per database;
    maxFilesPerTrigger, files of each database that a batch takes at most, and with it checkpoint, the query's
    checkpointLocation (a run that triggers availableNow takes one such batch). Writing: rowsPerFile. Events of a null or
    empty database are written to the database '_'."""

    @classmethod
    def name(cls) -> str:
        return "tidelog_queue"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: Any) -> DataSourceReader:
        o = self.options
        return _Reader(o["path"], (int(o["afterFile"]), int(o.get("afterPos", 0))) if "afterFile" in o else None)

    def streamReader(self, schema: Any) -> DataSourceStreamReader:  # noqa: N802
        o = self.options
        return _Stream(o["path"], json.loads(o.get("startingFiles", "{}")), int(o.get("maxFilesPerTrigger", 0)), o.get("checkpoint"))

    def writer(self, schema: Any, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a queue is only appended to")
        return _Writer(self.options["path"], int(self.options.get("rowsPerFile", ROWS_PER_FILE)))
