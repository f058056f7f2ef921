"""Values as a source delivers them, brought to the types of the target: column expressions, no Python per row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Source character sets and the names Python knows them by; those of several bytes a
#: character. Sets without a codec (armscii8, geostd8, keybcs2, swe7, dec8) are missing.
CHARSETS = {
    "utf8": "utf-8", "utf8mb3": "utf-8", "utf8mb4": "utf-8", "ascii": "ascii", "binary": "latin-1", "latin1": "cp1252", "latin2": "iso8859-2",
    "latin5": "iso8859-9", "latin7": "iso8859-13", "cp1250": "cp1250", "cp1251": "cp1251", "cp1256": "cp1256", "cp1257": "cp1257",
    "cp850": "cp850", "cp852": "cp852", "cp866": "cp866", "koi8r": "koi8-r", "koi8u": "koi8-u", "greek": "iso8859-7", "hebrew": "iso8859-8",
    "tis620": "tis-620", "hp8": "hp-roman8", "macroman": "mac-roman", "macce": "mac-latin2", "cp932": "cp932", "sjis": "shift_jis", "ujis": "euc-jp",
    "eucjpms": "euc-jp", "big5": "big5", "gbk": "gbk", "gb2312": "gb2312", "gb18030": "gb18030", "euckr": "euc-kr", "ucs2": "utf-16-be",
    "utf16": "utf-16-be", "utf16le": "utf-16-le", "utf32": "utf-32-be",
}
_WIDE = ("cp932", "shift_jis", "euc-jp", "big5", "gbk", "gb2312", "gb18030", "euc-kr", "utf-16-be", "utf-16-le", "utf-32-be")
#: Character sets by ranges of collation numbers (first, last, set); collations() reads all from a source.
COLLATIONS = (
    (1, 1, "big5"), (2, 2, "latin2"), (3, 3, "dec8"), (4, 4, "cp850"), (5, 5, "latin1"), (6, 6, "hp8"), (7, 7, "koi8r"), (8, 8, "latin1"),
    (9, 9, "latin2"), (10, 10, "swe7"), (11, 11, "ascii"), (12, 12, "ujis"), (13, 13, "sjis"), (14, 14, "cp1251"), (15, 15, "latin1"),
    (16, 16, "hebrew"), (18, 18, "tis620"), (19, 19, "euckr"), (20, 20, "latin7"), (21, 21, "latin2"), (22, 22, "koi8u"), (23, 23, "cp1251"),
    (24, 24, "gb2312"), (25, 25, "greek"), (26, 26, "cp1250"), (27, 27, "latin2"), (28, 28, "gbk"), (29, 29, "cp1257"), (30, 30, "latin5"),
    (31, 31, "latin1"), (32, 32, "armscii8"), (33, 33, "utf8mb3"), (34, 34, "cp1250"), (35, 35, "ucs2"), (36, 36, "cp866"), (37, 37, "keybcs2"),
    (38, 38, "macce"), (39, 39, "macroman"), (40, 40, "cp852"), (41, 42, "latin7"), (43, 43, "macce"), (44, 44, "cp1250"), (45, 46, "utf8mb4"),
    (47, 49, "latin1"), (50, 52, "cp1251"), (53, 53, "macroman"), (54, 55, "utf16"), (56, 56, "utf16le"), (57, 57, "cp1256"), (58, 59, "cp1257"),
    (60, 61, "utf32"), (62, 62, "utf16le"), (63, 63, "binary"), (64, 64, "armscii8"), (65, 65, "ascii"), (66, 66, "cp1250"), (67, 67, "cp1256"),
    (68, 68, "cp866"), (69, 69, "dec8"), (70, 70, "greek"), (71, 71, "hebrew"), (72, 72, "hp8"), (73, 73, "keybcs2"), (74, 74, "koi8r"),
    (75, 75, "koi8u"), (76, 76, "utf8mb3"), (77, 77, "latin2"), (78, 78, "latin5"), (79, 79, "latin7"), (80, 80, "cp850"), (81, 81, "cp852"),
    (82, 82, "swe7"), (83, 83, "utf8mb3"), (84, 84, "big5"), (85, 85, "euckr"), (86, 86, "gb2312"), (87, 87, "gbk"), (88, 88, "sjis"),
    (89, 89, "tis620"), (90, 90, "ucs2"), (91, 91, "ujis"), (92, 93, "geostd8"), (94, 94, "latin1"), (95, 96, "cp932"), (97, 98, "eucjpms"),
    (99, 99, "cp1250"), (101, 124, "utf16"), (128, 151, "ucs2"), (159, 159, "ucs2"), (160, 183, "utf32"), (192, 215, "utf8mb3"),
    (223, 223, "utf8mb3"), (224, 247, "utf8mb4"), (248, 250, "gb18030"), (255, 323, "utf8mb4"),
)


def collation_charset(number: int) -> str:
    """The character set of a collation by its number; utf8mb4 for one that isn't known."""
    return next((name for first, last, name in COLLATIONS if first <= number <= last), "utf8mb4")


def charset_of(c: Column) -> Column:
    """The same for a column of collation numbers; null for null."""
    named = F.lit("utf8mb4")
    for first, last, name in COLLATIONS:
        named = F.when(c.between(first, last), name).otherwise(named)
    return F.when(c.isNotNull(), named)


def collations(rows: DataFrame) -> dict[int, str]:
    """Number and set of each row of a source's INFORMATION_SCHEMA.COLLATIONS (some hundred rows, whatever the data)."""
    return {r[0]: r[1] for r in rows.select(F.col("ID").cast("int"), F.lower("CHARACTER_SET_NAME")).collect()}


def decoded(c: Column, charset: str) -> Column:
    """Bytes as text; an unknown set is taken as UTF-8, a byte that is no character gives U+FFFD (in latin1 itself).

    Sets of one byte are decoded by expressions: each byte is a character of Latin-1 first, then translated. Sets of
    several bytes need Python's codecs, which run on Arrow batches. No setting of the session matters.
    """
    codec = CHARSETS.get(charset.lower(), "utf-8")
    if codec == "utf-8":
        return F.make_valid_utf8(c.cast("string"))
    if codec in _WIDE:

        @F.pandas_udf("string")
        def read(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in parts:
                yield s.map(lambda b: bytes(b).decode(codec, "replace"), na_action="ignore")

        return read(c)
    bytes_, chars = [], []
    for b in range(128, 256):
        there = bytes([b]).decode(codec, "replace")
        there = chr(b) if there == "\ufffd" and codec == "cp1252" else there
        if there != chr(b):
            bytes_.append(chr(b))
            chars.append(there)
    return F.translate(F.decode(c, "ISO-8859-1"), "".join(bytes_), "".join(chars))


def unsigned(c: Column, bits: int) -> Column:
    """A value read as signed, as the unsigned one with the same bits; 64 bits give DECIMAL(20,0)."""
    wide = c.cast("decimal(20,0)") if bits == 64 else c.cast("bigint")
    step = F.lit(str(2**bits)).cast("decimal(20,0)") if bits == 64 else F.lit(2**bits)
    return F.when(wide < 0, wide + step).otherwise(wide).cast("decimal(20,0)" if bits == 64 else "bigint")


def enum_label(c: Column, labels: Sequence[str]) -> Column:
    """The lower-case label of a 1-based index; '0' for 0 and the number as text beyond the labels. Null stays null."""
    listed = F.array(*[F.lit(x.lower()) for x in labels]) if labels else F.array().cast("array<string>")
    return F.when(c.isNotNull(), F.coalesce(F.when(c > 0, F.get(listed, c.cast("int") - 1)), c.cast("string")))


def enum_text(c: Column, labels: Sequence[str]) -> Column:
    """A label in lower case if it is one, whatever its letter case; other text is unchanged."""
    return F.when(F.lower(c).isin([x.lower() for x in labels]), F.lower(c)).otherwise(c)


def set_labels(mask: Column, labels: Sequence[str]) -> Column:
    """Labels of the bits that are set, in the order of definition, joined by commas; '' for 0."""
    picked = F.array(*[F.when(F.getbit(mask.cast("bigint"), F.lit(i)) == 1, F.lit(x)) for i, x in enumerate(labels)])
    return F.when(mask.isNotNull(), F.array_join(F.array_compact(picked), ","))


def year(c: Column) -> Column:
    """A year within what the source's type can hold, 1901 to 2155. Text that is no number gives null."""
    n = c.try_cast("int")
    return F.when(n.isNotNull(), F.greatest(F.lit(1901), F.least(F.lit(2155), n)))


def uuid_text(c: Column) -> Column:
    """36 characters in lower case, from text with or without dashes."""
    h = F.lower(F.replace(c, F.lit("-"), F.lit("")))
    return F.when(F.length(h) == 32, F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def uuid_bytes(c: Column) -> Column:
    return F.unhex(F.replace(c, F.lit("-"), F.lit("")))


def moment(c: Column) -> Column:
    """Text as a wall-clock time; a zero date or any other that doesn't exist gives null."""
    return c.try_cast("timestamp_ntz")


def moment_or_epoch(c: Column) -> Column:
    """The same for a column that takes no null: 1970-01-01 instead."""
    return F.coalesce(moment(c), F.lit("1970-01-01").cast("timestamp_ntz"))


def null_reason(c: Column, parsed: Column) -> Column:
    """Why a date is null: 'null', 'zero_date' or 'invalid_date'; null where it isn't."""
    zero = F.regexp_replace(F.substring(c, 1, 10), "[0-]", "") == ""
    return F.when(parsed.isNotNull(), F.lit(None)).when(c.isNull(), "null").when(zero, "zero_date").otherwise("invalid_date")


def timedelta_text(micros: Column) -> Column:
    """A duration in microseconds as '[D day[s], ]H:MM:SS[.ffffff]', days being rounded down as for negative times."""
    day = F.lit(86_400_000_000)
    days = F.floor(micros / day)
    # Division of bigints is inexact as double, but a source's times are below 839 hours.
    rest = micros - days * day
    text = F.format_string("%d:%02d:%02d", _div(rest, 3_600_000_000), _div(rest, 60_000_000) % 60, _div(rest, 1_000_000) % 60)
    part = rest % 1_000_000
    text = F.when(part == 0, text).otherwise(F.concat(text, F.format_string(".%06d", part)))
    return F.when(days == 0, text).otherwise(F.concat(days.cast("string"), F.when(F.abs(days) == 1, " day, ").otherwise(" days, "), text))


def _div(c: Column, n: int) -> Column:
    return F.floor(c / n).cast("bigint")


def filled(c: Column, default: object) -> Column:
    """A value for a column that takes no null."""
    return F.coalesce(c, F.lit(default))


def to_utc(c: Column, zone: str) -> Column:
    """A wall-clock time of a zone as wall-clock time of UTC."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), c)


def json_text(c: Column) -> Column:
    """JSON in one layout; text that isn't JSON gives null."""
    return F.to_json(F.try_parse_json(c))
