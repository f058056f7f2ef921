"""Settings: what is replicated, where it goes and how it is laid out."""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from zoneinfo import ZoneInfo

import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(name: str, patterns: str | Sequence[str]) -> bool:
    """Whether a name fits a glob pattern or one of several. No pattern, '' and '*' fit every name."""
    return not patterns or any(p in ("", "*") or fnmatch.fnmatchcase(name, p) for p in _listed(patterns))


def selected(c: Column | str, include: str | Sequence[str] = "*", exclude: str | Sequence[str] = ()) -> Column:
    """The same as a predicate on a column of names; what is excluded stays out even where it is included.

    A null name is selected by no pattern.
    """
    c = F.col(c) if isinstance(c, str) else c
    wanted = c.isNotNull() if not include else c.rlike(_regex(include))
    return F.coalesce(wanted & ~c.rlike(_regex(exclude)) if exclude else wanted, F.lit(False))


def _listed(patterns: str | Sequence[str]) -> Sequence[str]:
    return [patterns] if isinstance(patterns, str) else patterns


def _regex(patterns: str | Sequence[str]) -> str:
    """One anchored regular expression for all patterns, in the syntax that the JVM knows."""
    parts = []
    for p in _listed(patterns):
        out, i = "", 0
        while i < len(p):
            ch = p[i]
            close = p.find("]", i + 2) if ch == "[" else -1
            if ch == "[" and close > 0:
                inside = p[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
                out += "[" + ("^" + inside[1:] if inside[0] == "!" else inside.replace("^", "\\^", 1) if inside[0] == "^" else inside) + "]"
                i = close
            else:
                out += ".*" if ch == "*" or not p else "." if ch == "?" else re.escape(ch)
            i += 1
        parts.append(out if p else ".*")
    return "(?s)^(?:" + "|".join(parts) + ")$"


@dataclass
class Scoped:
    """A setting for the tables whose database and table fit the patterns."""

    value: object
    databases: str | list[str] = "*"
    tables: str | list[str] = "*"


@dataclass
class Connection:
    host: str = "localhost"
    port: int = 3306
    user: str = "root"
    password: str = ""
    charset: str = "utf8mb4"

    def checked(self, what: str) -> None:
        if not isinstance(self.port, int) or not 0 < self.port < 65536:
            raise ValueError(f"{what}: port {self.port!r} is no port")
        if not isinstance(self.host, str) or not self.host:
            raise ValueError(f"{what}: host {self.host!r} is no host name")


@dataclass
class Settings:
    source: Connection = field(default_factory=Connection)
    databases: str | list[str] = "*"
    tables: str | list[str] = "*"
    exclude_databases: str | list[str] = ""
    exclude_tables: str | list[str] = ""
    target_databases: dict[str, str] = field(default_factory=dict)
    target_tables: dict[str, str] = field(default_factory=dict)
    types_mapping: dict[str, str] = field(default_factory=dict)
    partition_bys: list[Scoped] = field(default_factory=list)
    order_bys: list[Scoped] = field(default_factory=list)
    indexes: list[Scoped] = field(default_factory=list)
    post_commands: list[Scoped] = field(default_factory=list)
    ignore_deletes: bool = False
    skip_snapshot: bool = False
    version_initial_value: int = 0
    source_timezone: str = "UTC"
    snapshot_partitions: int = 0
    flush_seconds: float = 1.0
    rows_per_file: int = 100_000
    retention_seconds: int = 43_200
    optimize_seconds: int = 86_400
    log_level: str = "info"
    root: str = "tidelog-data"

    def __post_init__(self) -> None:
        self.source.checked("source")
        for name in ("rows_per_file", "retention_seconds", "optimize_seconds", "flush_seconds"):
            if not isinstance(getattr(self, name), (int, float)) or getattr(self, name) <= 0:
                raise ValueError(f"{name} must be above 0")
        if self.log_level not in ("critical", "error", "warning", "info", "debug"):
            raise ValueError(f"unknown log level {self.log_level!r}")
        try:
            ZoneInfo(self.source_timezone)
        except Exception as e:
            raise ValueError(f"unknown time zone {self.source_timezone!r}") from e

    @staticmethod
    def load(text: str, env: Mapping[str, str] = os.environ) -> Settings:
        """From YAML text. Unknown keys are an error; SOURCE_HOST, SOURCE_PORT, … in env replace the connection's values."""
        data = yaml.safe_load(text) or {}
        unknown = set(data) - {f.name for f in fields(Settings)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        wanted = dict(data.pop("source", {}))
        for f in fields(Connection):
            if value := env.get(f"SOURCE_{f.name.upper()}"):
                wanted[f.name] = int(value) if f.name == "port" else value
        for name in ("partition_bys", "order_bys", "indexes", "post_commands"):
            data[name] = [Scoped(**x) for x in data.get(name, [])]
        return Settings(source=Connection(**wanted), **data)

    def database_selected(self, c: Column | str) -> Column:
        return selected(c, self.databases, self.exclude_databases)

    def table_selected(self, c: Column | str) -> Column:
        return selected(c, self.tables, self.exclude_tables)

    def scoped(self, what: str, db: str, table: str) -> list[object]:
        return [s.value for s in getattr(self, what) if matches(db, s.databases) and matches(table, s.tables)]

    def target_database(self, c: Column | str) -> Column:
        return routed(c, self.target_databases)

    def target_table(self, db: Column | str, table: Column | str) -> Column:
        db, table = (F.col(x) if isinstance(x, str) else x for x in (db, table))
        return F.coalesce(*[F.when(F.concat_ws(".", db, table) == k, F.lit(v)) for k, v in self.target_tables.items()], table)

    def shared_targets(self) -> list[str]:
        """Target databases that more than one source database is routed to."""
        names = list(self.target_databases.values())
        return sorted({n for n in names if names.count(n) > 1})


def routed(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """The name that mapping gives, else the name itself."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in mapping.items()], c)
