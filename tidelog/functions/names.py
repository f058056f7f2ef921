"""Names of databases, tables, fields and log files in their plain form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_name(c: Column | str) -> Column:
    """Lower case without backticks, blanks and tabs around it; null stays null."""
    return F.btrim(F.lower(_col(c)), F.lit("` \t"))


def plain_type(c: Column | str) -> Column:
    """A column type without blanks and letter case. Null stays null."""
    return F.regexp_replace(F.lower(_col(c)), r"\s+", "")


def type_shape(c: Column | str) -> Column:
    """A column type in lower case without blanks, but for those inside its quoted labels. Null stays null."""
    return F.regexp_replace(F.lower(_col(c)), r"('(?:[^'\\]|\\.|'')*')|\s+", "$1")


def file_number(c: Column | str) -> Column:
    """The integer that ends a log file name: './binlog.000123' gives 123; null where there is none."""
    digits = F.regexp_extract(F.btrim(_col(c)), r"([0-9]+)$", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def state_name(*parts: Column | str) -> Column:
    """A name of fixed length for what belongs to a database and table: SHA-256 of the parts joined by a dot."""
    return F.sha2(F.concat_ws(".", *[_col(p) for p in parts]), 256)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
