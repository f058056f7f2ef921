"""Schemas of tables as they change: columns with lasting ids, statements that change them, a versioned registry.

A column's id never changes, whatever it is called and wherever it stands, so stored files stay readable: renaming,
moving and dropping columns are edits of the registry, and a change of type is a cast when reading.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.ddl.lexer import Token, meaningful, scan, split_top, unquoted, without_comment_clauses, without_comments
from tidelog.ddl.types import SourceType, default_of


@dataclass(frozen=True)
class Field:
    name: str
    type: SourceType
    nullable: bool = True
    id: str = ""
    parameters: str = ""

    def spark(self, mapping: dict[str, str] | None = None) -> T.DataType:
        return self.type.spark(mapping)


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    charset: str = ""
    next_id: int = 1

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name.lower() == name.lower():
                return f
        raise KeyError(f"table {self.name} has no column {name}")

    def has(self, name: str) -> bool:
        return any(f.name.lower() == name.lower() for f in self.fields)

    def added(self, new: Field, place: str | None = None) -> Table:
        """With a new column at the end, FIRST (place '') or AFTER place."""
        if self.has(new.name):
            raise ValueError(f"table {self.name} has a column {new.name}")
        new, fields = replace(new, id=f"c{self.next_id:04d}"), list(self.fields)
        at = len(fields) if place is None else 0 if not place else fields.index(self.field(place)) + 1
        fields.insert(at, new)
        return replace(self, fields=tuple(fields), next_id=self.next_id + 1)

    def dropped(self, name: str) -> Table:
        gone = self.field(name)
        return replace(self, fields=tuple(f for f in self.fields if f is not gone), key=tuple(k for k in self.key if k.lower() != name.lower()))

    def changed(self, name: str, new: Field, place: str | None = None) -> Table:
        """The column gets new's name, type and nullability and keeps its id and, without place, its position."""
        old = self.field(name)
        new = replace(new, id=old.id)
        fields = [new if f is old else f for f in self.fields]
        if place is not None:
            fields.remove(new)
            fields.insert(0 if not place else [f.name.lower() for f in fields].index(place.lower()) + 1, new)
        key = tuple(new.name if k.lower() == name.lower() else k for k in self.key)
        return replace(self, fields=tuple(fields), key=key)

    def project(self, stored: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
        """Stored rows (columns named by id) under the present names, order and types; absent columns are NULL, or the
        default where the column takes no NULL."""
        return stored.select(*[self._column(f, stored, mapping) for f in self.fields])

    def _column(self, f: Field, stored: DataFrame, mapping: dict[str, str] | None) -> SparkColumn:
        kind = f.spark(mapping)
        c = F.col(f.id).try_cast(kind) if f.id in stored.columns and dict(stored.dtypes)[f.id] != kind.simpleString() else F.col(f.id) if f.id in stored.columns else F.lit(None).cast(kind)
        if not f.nullable and not isinstance(kind, (T.ArrayType, T.StructType)):
            c = F.coalesce(c, F.lit(default_of(kind, f.type.labels)).cast(kind))
        return c.alias(f.name)

    def store(self, rows: DataFrame) -> DataFrame:
        """Rows with present names as they are stored, by id."""
        return rows.select(*[F.col(f"`{f.name}`").alias(f.id) for f in self.fields])

    def differences(self, other: Table) -> list[str]:
        """What differs, in words, column by column in order; empty where both agree."""
        out = [f"{n}: {a!r} is not {b!r}" for n, a, b in (("name", self.name, other.name), ("charset", self.charset, other.charset), ("key", self.key, other.key)) if a != b]
        for i in range(max(len(self.fields), len(other.fields))):
            a, b = (t.fields[i] if i < len(t.fields) else None for t in (self, other))
            if a is None or b is None or (a.name, a.type, a.nullable) != (b.name, b.type, b.nullable):
                out.append(f"column {i + 1}: {a and f'{a.name} {a.type}'} is not {b and f'{b.name} {b.type}'}")
        return out


@dataclass(frozen=True)
class Statement:
    """kind: create, like, alter, drop, rename, truncate or other."""

    kind: str
    db: str = ""
    table: str = ""
    body: Any = None
    if_exists: bool = False


def _name(tokens: list[Token], i: int, db: str) -> tuple[str, str, int]:
    """(database, table, next place) of a name at tokens[i]."""
    if i + 2 < len(tokens) and tokens[i + 1].text == ".":
        return unquoted(tokens[i].text), unquoted(tokens[i + 2].text), i + 3
    return db, unquoted(tokens[i].text), i + 1


def _skip(tokens: list[Token], i: int, *words: str) -> int:
    while i < len(tokens) and tokens[i].is_(*words):
        i += 1
    return i


def parse(sql: str, db: str = "") -> Statement:
    """Reads one statement; db is its default database. Anything that changes no schema is of kind 'other'.

    A second statement after a semicolon is an error.
    """
    text = without_comments(sql).strip()
    tokens = meaningful(text)
    semicolons = [k for k, t in enumerate(tokens) if t.text == ";" and t.kind == "mark"]
    if semicolons and semicolons[0] != len(tokens) - 1:
        raise ValueError("one statement at a time")
    if semicolons:
        text, tokens = text[: tokens[-1].at], tokens[:-1]
    first = tokens[0].text.lower() if tokens else ""
    second = tokens[1].text.lower() if len(tokens) > 1 else ""
    if first == "truncate" and len(tokens) > 1:
        d, t, _ = _name(tokens, _skip(tokens, 1, "table"), db)
        return Statement("truncate", d, t)
    if second == "temporary":
        return Statement("other")
    if (first, second) == ("create", "table"):
        i = _skip(tokens, 2, "if", "not", "exists")
        d, t, i = _name(tokens, i, db)
        j = i + (i < len(tokens) and tokens[i].text == "(")
        if j < len(tokens) and tokens[j].is_("like"):
            return Statement("like", d, t, _name(tokens, j + 1, d)[:2])
        return Statement("create", d, t, _created(text, t), if_exists=tokens[2].is_("if"))
    if (first, second) == ("drop", "table"):
        i = _skip(tokens, 2, "if", "exists")
        names = []
        for part in split_top(text[tokens[i].at :]):
            names.append(_name(meaningful(part), 0, db)[:2])
        return Statement("drop", *names[0], names, tokens[2].is_("if"))
    if (first, second) == ("rename", "table"):
        pairs = []
        for part in split_top(text[tokens[2].at :]):
            own = meaningful(part)
            a, b, i = _name(own, 0, db)
            c, d, _ = _name(own, _skip(own, i, "to"), db)
            if a != c:
                raise ValueError("a table can't be renamed into another database")
            pairs.append((b, d))
        return Statement("rename", a, pairs[0][0], pairs)
    if (first, second) == ("alter", "table"):
        d, t, i = _name(tokens, 2, db)
        rest = text[tokens[i].at :] if i < len(tokens) else ""
        return Statement("alter", d, t, [op for part in split_top(rest) if (op := _alteration(part))])
    return Statement("other")


#: What begins a line of CREATE TABLE that is no column, and the object of an ADD or DROP that is none.
_NO_COLUMN = ("key", "index", "unique", "fulltext", "spatial", "constraint", "foreign", "primary", "check", "partition", "period")
#: Words that end a type and begin its parameters.
_PARAMETERS = ("not", "null", "default", "auto_increment", "comment", "primary", "unique", "key", "collate", "on", "first", "after", "check",
               "generated", "as", "virtual", "stored", "references", "character", "charset", "invisible", "visible", "unsigned", "zerofill")


def column(definition: str) -> tuple[Field, str | None]:
    """(the column, its place: None for the end, '' for FIRST, else the column it stands AFTER)."""
    tokens = meaningful(without_comment_clauses(definition))
    if len(tokens) < 2:
        raise ValueError(f"no column definition: {definition!r}")
    text = without_comment_clauses(definition)
    end = next((t.at for t in tokens[2:] if t.depth == 0 and t.is_(*_PARAMETERS)), len(text))
    kind, rest = text[tokens[1].at : end].strip(), text[end:].strip()
    place, own = None, [t for t in meaningful(rest) if t.depth == 0]
    if own and own[-1].is_("first"):
        place = ""
    elif len(own) > 1 and own[-2].is_("after"):
        place = unquoted(own[-1].text)
    words = [t.text.lower() for t in own if t.kind == "word"]
    required = any(pair == ("not", "null") for pair in zip(words, words[1:], strict=False)) or "primary" in words
    return Field(unquoted(tokens[0].text), SourceType.parse(kind, rest), not required, parameters=rest), place


def _created(text: str, name: str) -> Table:
    tokens = scan(text)
    opened = next(t for t in tokens if t.text == "(" and t.kind == "mark")
    closed = next((t for t in tokens if t.text == ")" and t.kind == "mark" and t.depth == opened.depth and t.at > opened.at), None)
    inner, options = text[opened.at + 1 : closed.at if closed else len(text)], meaningful(text[closed.at + 1 :]) if closed else []
    table, key = Table(name, (), ()), ()
    for line in split_top(inner):
        own = meaningful(line)
        if own[0].kind == "word" and own[0].text.lower() in _NO_COLUMN:
            at = next((i for i, t in enumerate(own) if t.is_("primary")), None)
            if at is not None and at + 1 < len(own) and own[at + 1].is_("key"):
                listed = line[next(t for t in own if t.text == "(").at + 1 : line.rindex(")")]
                key = tuple(unquoted(meaningful(k)[0].text) for k in split_top(listed))
            continue
        f, _ = column(line)
        table = table.added(f)
        words = [t.text.lower() for t in own if t.kind == "word"]
        if "primary" in words[1:] and not key:
            key = (f.name,)
    if not key and table.has("id"):
        key = (table.field("id").name,)
    if not key:
        raise ValueError(f"table {name} has no primary key")
    charset = ""
    for i, t in enumerate(options):
        if t.is_("charset") or t.is_("set") and i and options[i - 1].is_("character"):
            charset = unquoted(next(x.text for x in options[i + 1 :] if x.text != "="))
    lower = {k.lower() for k in key}
    fields = tuple(replace(f, nullable=f.nullable and f.name.lower() not in lower) for f in table.fields)
    return replace(table, fields=fields, key=key, charset=charset)


def _alteration(clause: str) -> tuple | None:
    """('add', field, place), ('drop', name), ('change', name, field, place), ('rename', name, name), ('to', name); None
    for what changes no column."""
    tokens = meaningful(clause)
    verb = tokens[0].text.lower()
    i = 1 + (len(tokens) > 1 and tokens[1].is_("column"))
    rest = clause[tokens[i].at :] if i < len(tokens) else ""
    explicit = i == 2
    if not explicit and len(tokens) > 1 and tokens[1].kind == "word" and tokens[1].text.lower() in _NO_COLUMN:
        return None
    if verb == "add":
        i = _skip(tokens, i, "if", "not", "exists")
        if tokens[i].text == "(":
            inner = clause[tokens[i].at + 1 : clause.rindex(")")]
            return ("several", [("add", *column(x)) for x in split_top(inner)])
        return ("add", *column(clause[tokens[i].at :]))
    if verb == "drop":
        return ("drop", unquoted(tokens[_skip(tokens, i, "if", "exists")].text))
    if verb == "modify":
        f, place = column(rest)
        return ("change", f.name, f, place)
    if verb == "change":
        f, place = column(clause[tokens[i + 1].at :])
        return ("change", unquoted(tokens[i].text), f, place)
    if verb == "rename":
        if explicit:
            return ("rename", unquoted(tokens[i].text), unquoted(tokens[_skip(tokens, i + 1, "to")].text))
        own = tokens[_skip(tokens, 1, "to", "as") :]
        return ("to", _name(own, 0, "")[1])
    return None  # ALTER, AUTO_INCREMENT, CONVERT, ENGINE, COMMENT, ORDER BY and the like


def altered(table: Table, operations: Iterable[tuple]) -> Table:
    """The table after the clauses of an ALTER, from left to right."""
    for op in operations:
        if op[0] == "several":
            table = altered(table, op[1])
        elif op[0] == "add":
            table = table.added(op[1], op[2])
        elif op[0] == "drop":
            table = table.dropped(op[1])
        elif op[0] == "change":
            table = table.changed(op[1], op[2], op[3])
        elif op[0] == "rename":
            table = table.changed(op[1], replace(table.field(op[1]), name=op[2]))
        elif op[0] == "to":
            table = replace(table, name=op[1])
    return table


@dataclass
class Registry:
    """The schemas of all tables, and the position of the last statement applied.

    Statements are applied once each, by position, so replaying a log changes nothing.
    """

    tables: dict[tuple[str, str], Table] = field(default_factory=dict)
    applied: tuple[int, int] = (-1, -1)
    version: int = 0

    def apply(self, sql: str, db: str = "", position: tuple[int, int] | None = None) -> Statement:
        """Applies a statement and returns it; one at or before the last position is read but not applied again."""
        s = parse(sql, db)
        if position is not None:
            if position <= self.applied:
                return s
            self.applied = position
        at = (s.db, s.table)
        before = dict(self.tables)
        if s.kind == "create" and not (s.if_exists and at in self.tables):
            self.tables[at] = s.body
        elif s.kind == "like":
            self.tables[at] = replace(self.tables[s.body], name=s.table)
        elif s.kind == "alter" and at in self.tables:
            new = altered(self.tables.pop(at), s.body)
            self.tables[(s.db, new.name)] = new
        elif s.kind == "drop":
            for name in s.body:
                if name not in self.tables and not s.if_exists:
                    raise KeyError(f"no table {name}")
                self.tables.pop(name, None)
        elif s.kind == "rename":  # all at once, as seen from before the statement
            for a, b in s.body:
                moved = self.tables.pop((s.db, a))
                if (s.db, b) in self.tables:
                    self.tables = before
                    raise ValueError(f"table {b} exists")
                self.tables[(s.db, b)] = replace(moved, name=b)
        self.version += self.tables != before
        return s

    def to_json(self) -> str:
        tables = [
            {"db": db, "name": t.name, "key": t.key, "charset": t.charset, "next_id": t.next_id,
             "fields": [{"name": f.name, "type": str(f.type), "nullable": f.nullable, "id": f.id, "parameters": f.parameters} for f in t.fields]}
            for (db, _), t in self.tables.items()
        ]
        return json.dumps({"applied": self.applied, "version": self.version, "tables": tables})

    @staticmethod
    def from_json(text: str) -> Registry:
        data = json.loads(text)
        out = Registry(applied=tuple(data["applied"]), version=data["version"])
        for t in data["tables"]:
            fields = tuple(Field(f["name"], SourceType.parse(f["type"]), f["nullable"], f["id"], f["parameters"]) for f in t["fields"])
            out.tables[(t["db"], t["name"])] = Table(t["name"], fields, tuple(t["key"]), t["charset"], t["next_id"])
        return out
