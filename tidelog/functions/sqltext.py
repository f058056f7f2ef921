"""Reading statements kept as text in a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.names import plain_name

#: A quoted or bare name; blanks may stand between the quotes.
NAME = r"(`[^`]+`|[^\s`.;,]+)"
#: Comments: /* */, -- to the end of the line, # to the end of the line. Quoted texts are matched first and kept.
COMMENTED = r"""(?s)('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`)|/\*.*?(?:\*/|$)|--(?=\s|$)[^\n]*|#[^\n]*"""


def without_comments(c: Column) -> Column:
    """SQL text with each comment replaced by a blank; comment marks inside quotes stay. Null stays null."""
    return F.regexp_replace(c, COMMENTED, "$1 ")


def truncated(sql: Column, default_db: Column) -> Column:
    """struct<db, tbl> (plain forms) of the table that a TRUNCATE names; null for any other statement.

    The word TABLE is optional, comments do not count, the database is default_db where the statement names none.
    """
    text = without_comments(sql)
    shape = rf"(?is)^\s*truncate\s+(?:table\s+)?{NAME}(?:\s*\.\s*{NAME})?\s*;?\s*$"
    first, second = (plain_name(F.regexp_extract(text, shape, i)) for i in (1, 2))
    named = F.when(second == "", F.struct(plain_name(default_db).alias("db"), first.alias("tbl"))).otherwise(
        F.struct(first.alias("db"), second.alias("tbl"))
    )
    return F.when(F.coalesce(text.rlike(shape), F.lit(False)), named)
