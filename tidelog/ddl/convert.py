"""From the texts that a log or a snapshot delivers to the columns of a table's schema: each field's source type selects
the rule, so that one projection serves whatever columns the table has at the time. Rules are column expressions."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.ddl.schema import Field, Table
from tidelog.ddl.types import INT_BITS, default_of
from tidelog.functions import normalize, packed

RAW = "map<string,string>"


def raw_values(image: SparkColumn) -> SparkColumn:
    """A row image (JSON object) as texts by column name; numbers keep their digits, JSON null is absent."""
    return F.from_json(image, RAW)


def _bytes(text: SparkColumn) -> SparkColumn:
    """What a log writes of bytes: text where they are text, else 'base64:…'."""
    return F.when(text.startswith("base64:"), F.unbase64(F.substring(text, 8, 2**31 - 1))).otherwise(F.encode(text, "UTF-8"))


def typed(text: SparkColumn, f: Field, mapping: dict[str, str] | None = None, zone: str = "UTC") -> SparkColumn:
    """A field's text as its Spark type; null where the text is null or the type can't hold it, and in a column that takes
    no null its default (0, '', 1970-01-01, the first label).

    zone: the time zone that texts of TIMESTAMP columns are written in (UTC in a log, the session's in a snapshot).
    """
    source, kind = f.type, f.spark(mapping)
    base, number = source.base, text.rlike(r"^\d+$")
    if isinstance(kind, T.BooleanType):
        out = F.when(F.lower(text).isin("true", "false"), F.lower(text) == "true").otherwise(text.try_cast("decimal(20,0)") != 0)
    elif base in INT_BITS and source.unsigned:
        # A log without signedness delivers the bits as a signed number.
        out = normalize.unsigned(text.try_cast("decimal(20,0)"), INT_BITS[base])
    elif base == "enum":
        out = F.when(number, normalize.enum_label(text.try_cast("bigint"), source.labels)).otherwise(normalize.enum_text(text, source.labels))
    elif base == "set":
        out = F.when(number, normalize.set_labels(text.try_cast("bigint"), source.labels)).otherwise(text)
    elif base == "year":
        out = normalize.year(text)
    elif base == "json":
        out = normalize.json_text(text)
    elif base == "uuid" or mapping and (mapping.get(str(source)) or mapping.get(base)) == "uuid":
        out = normalize.uuid_text(text)
    elif base == "timestamp":
        out = F.to_utc_timestamp(normalize.moment(text).cast("timestamp"), zone) if zone != "UTC" else normalize.moment(text)
    elif base in ("date", "datetime"):
        out = normalize.moment(text)
    elif base in ("point", "polygon", "multipolygon"):
        out = {"point": packed.point, "polygon": packed.polygon, "multipolygon": packed.multipolygon}[base](F.unbase64(text))
    elif isinstance(kind, T.BinaryType):
        out = _bytes(text)
    else:
        out = text
    if not isinstance(kind, (T.ArrayType, T.StructType)):
        out = out.try_cast(kind)
        if not f.nullable:
            out = F.coalesce(out, F.lit(default_of(kind, source.labels)).cast(kind))
    return out


def converted(raw: SparkColumn, table: Table, mapping: dict[str, str] | None = None, zone: str = "UTC") -> list[SparkColumn]:
    """The columns of `table`, in order, from a map of texts by column name; a column that the map lacks is null or default."""
    return [typed(F.try_element_at(raw, F.lit(f.name)), f, mapping, zone).alias(f.name) for f in table.fields]


def key_texts(raw: SparkColumn, table: Table) -> list[SparkColumn]:
    """The key-only projection: texts of the key columns, in the order of the key."""
    return [F.try_element_at(raw, F.lit(k)).alias(k) for k in table.key]
