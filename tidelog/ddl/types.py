"""Source column types and the Spark types that hold them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tidelog.ddl.lexer import enum_labels, meaningful

POINT = T.StructType([T.StructField("x", T.FloatType()), T.StructField("y", T.FloatType())])

#: Bits of the integer types.
INT_BITS = {"tinyint": 8, "smallint": 16, "mediumint": 24, "int": 32, "integer": 32, "bigint": 64}
_SIGNED = {8: T.ByteType(), 16: T.ShortType(), 24: T.IntegerType(), 32: T.IntegerType(), 64: T.LongType()}
_UNSIGNED = {8: T.ShortType(), 16: T.IntegerType(), 24: T.IntegerType(), 32: T.LongType(), 64: T.DecimalType(20, 0)}
_PLAIN = {
    "double": T.DoubleType(), "real": T.DoubleType(), "float": T.FloatType(), "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "datetime": T.TimestampNTZType(), "timestamp": T.TimestampType(), "time": T.StringType(),
    "year": T.IntegerType(), "json": T.StringType(), "enum": T.StringType(), "set": T.StringType(), "uuid": T.StringType(),
    "point": POINT, "polygon": T.ArrayType(POINT), "multipolygon": T.ArrayType(T.ArrayType(POINT)),
    "char": T.StringType(), "varchar": T.StringType(), "tinytext": T.StringType(), "text": T.StringType(), "mediumtext": T.StringType(),
    "longtext": T.StringType(), "string": T.StringType(),
    "binary": T.BinaryType(), "varbinary": T.BinaryType(), "tinyblob": T.BinaryType(), "blob": T.BinaryType(), "mediumblob": T.BinaryType(),
    "longblob": T.BinaryType(),
}


@dataclass(frozen=True)
class SourceType:
    """A parsed type: its base name is lower case, so letter case and label texts can't be mistaken for a name."""

    base: str
    args: tuple[int, ...] = ()
    unsigned: bool = False
    labels: tuple[str, ...] = field(default=())

    @staticmethod
    def parse(text: str, parameters: str = "") -> SourceType:
        tokens = meaningful(text)
        if not tokens:
            raise ValueError("empty type")
        base = tokens[0].text.lower()
        words = {t.text.lower() for t in [*tokens, *meaningful(parameters)] if t.kind == "word"}
        if base in ("enum", "set"):
            return SourceType(base, labels=tuple(enum_labels(text)))
        if base == "double":
            return SourceType(base, unsigned="unsigned" in words)
        args = tuple(int(t.text) for t in tokens if t.kind == "word" and t.text.isdigit() and t.depth)
        return SourceType(base, args, "unsigned" in words)

    def spark(self, mapping: dict[str, str] | None = None, compat_decimal: bool = False) -> T.DataType:
        """The Spark type. mapping overrides by source type text, such as {'char(36)': 'uuid'}.

        Integers get the type that holds their range, unsigned bigint being DECIMAL(20,0). DECIMAL keeps precision and
        scale up to 38 digits and is text beyond; with compat_decimal it is DOUBLE. tinyint(1) and bit(1) are BOOLEAN,
        wider bits text of 0 and 1. Raises ValueError for a type it doesn't know.
        """
        if mapping and (name := mapping.get(str(self)) or mapping.get(self.base)):
            return SourceType.parse(name).spark()
        if self.base in ("decimal", "numeric", "dec", "fixed"):
            precision, scale = (*self.args, 0)[:2] if self.args else (10, 0)
            if compat_decimal:
                return T.DoubleType()
            return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
        if (self.base, self.args) in (("tinyint", (1,)), ("bit", (1,)), ("bit", ())):
            return T.BooleanType()
        if self.base == "bit":
            return T.StringType()
        if self.base in INT_BITS:
            return (_UNSIGNED if self.unsigned else _SIGNED)[INT_BITS[self.base]]
        if self.base in _PLAIN:
            return _PLAIN[self.base]
        raise ValueError(f"unknown source type {self.base!r}")

    def __str__(self) -> str:
        inner = ",".join(map(str, self.args)) or ",".join("'" + x.replace("'", "''") + "'" for x in self.labels)
        return self.base + (f"({inner})" if inner else "") + (" unsigned" if self.unsigned else "")


def default_of(kind: T.DataType, labels: tuple[str, ...] = ()) -> object:
    """What a NULL becomes in a column that takes none: 0, '', 1970-01-01, False, the first label, an empty list."""
    import datetime

    if isinstance(kind, T.BooleanType):
        return False
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return 0.0
    if isinstance(kind, T.NumericType):
        return 0
    if isinstance(kind, T.DateType):
        return datetime.date(1970, 1, 1)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return datetime.datetime(1970, 1, 1)
    if isinstance(kind, T.BinaryType):
        return b""
    return labels[0].lower() if labels else ""
