"""Text whose bytes were read in another encoding than they were written in: finding it and restoring it.

A stretch of text is a state; encoding it to bytes as the wrong encoding and decoding those as another gives further
states, and so does unescaping. The search always goes on from the state whose characters are the most plausible, keeps
the states it has met, and ends at the cheapest text in reach. A stretch is garbled where that text is clearly cheaper
than the stretch itself, or where it holds marks of bytes that no encoding brings back.
"""

from __future__ import annotations

import heapq
import html
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import spread

#: Encodings that bytes are wrongly read in, and encodings that text is written in besides UTF-8.
READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp1254", "cp437", "cp850", "cp866", "koi8-r", "mac-roman", "gbk", "cp932", "big5")
WRITTEN_IN = ("cp1251", "koi8-r", "cp866", "gbk", "cp932", "euc-jp", "big5", "euc-kr", "cp1252", "cp1250", "cp1253", "cp1254",
              "iso8859-2", "iso8859-5", "cp437", "mac-roman")
#: The letters of Russian from the most to the least frequent, in three groups; its vowels.
CYRILLIC = ("оеаинтсрвлкмдпу", "яыьгзбчйхж", "шюцщэфъё")
VOWELS = "аеёиоуыэюя"
#: The letters beyond a-z of languages written in Latin script.
ALPHABETS = (
    "àâæçéèêëîïôœùûüÿ", "äöüß", "áéíñóúü", "áâãàçéêíóôõúü", "àèéìíòóù", "àçèéíïòóúü", "ąćęłńóśźż", "áčďéěíňóřšťúůýž",
    "çğıöşüâîû", "åäöæøé", "áéíóöőúüű", "ăâîșşțţ", "áðéíóúýþæö", "čćđšž", "ąčęėįšųūž", "āčēģīķļņšūž", "äöõüšž", "éëïóöü",
)
#: Marks that are common in good text, besides letters.
MARKS = "“”‘’–—…•«»¿¡°±µ§©®£€→←↑↓≥≤≠×÷·″′№™✓✗★"
BOXES = ("─│┌┐└┘├┤┬┴┼", "═║╔╗╚╝╠╣╦╩╬")

#: What an operation costs on top of its result's characters, and what a stretch must gain to count as garbled,
#: and what a letter costs that the language fitting best doesn't have.
STEP, STEP_LEGACY, GAIN, SHARE, MIXED = 1.0, 1.5, 3.5, 0.25, 2.0
#: Cost by which two ways may differ for the other lines of a text to decide between them.
SAME = 1.0
#: Cost for each character beyond ASCII up to which text is plausible as it stands.
PLAUSIBLE = 1.15

# A character's class; its weight is the cost of one such character.
_WEIGHT = {
    "a": 0.0, "A": 0.0, "0": 0.0, ".": 0.0, " ": 0.0, "'": 0.0,
    "l": 0.9, "L": 1.1, "e": 0.9, "E": 1.1, "c": 0.4, "d": 1.2, "i": 2.4, "C": 0.7, "D": 1.6, "I": 2.8, "j": 2.0, "J": 2.6,
    "g": 0.8, "G": 1.2, "y": 2.5, "h": 1.1, "H": 3.2, "X": 4.5, "k": 0.9, "K": 3.5, "o": 1.6,
    "m": 2.0, "p": 1.0, "b": 0.0, "B": 0.0, "q": 2.0, "s": 2.5, "w": 0.4, "z": 6.0, "f": 7.0, "u": 7.0, "v": 2.0, ",": 0.5,
}
_LETTERS = "aAlLeEcdiCDIjJgGyhHXkKo"  # classes of letters
_LATIN, _CYR, _GREEK, _EAST = "aAlLeE", "cdiCDIjJ", "gGy", "hHXkKo"
# Neighbours that good text rarely has, and the cost of each such place.
_PAIRS = [
    (re.compile(f"(?=[{_LATIN}][{_CYR}{_GREEK}]|[{_CYR}][{_LATIN}{_GREEK}]|[{_GREEK}][{_LATIN}{_CYR}])"), 4.0),
    (re.compile("(?=[aAlLeE][hHXkKo]|[hHXkKo][lLeE])"), 1.0),
    (re.compile("(?=[ale][LE])"), 3.0),
    (re.compile("(?=[AL][le][AL])"), 3.0),
    (re.compile("(?=[le]A)"), 2.0),
    (re.compile("(?=[LE][psbwzv])"), 4.0),
    (re.compile(f"(?=[{_LETTERS}][sbzfv][{_LETTERS}])"), 3.0),
    (re.compile("(?=[lecdg][sbzv]|[sbzv][ale])"), 1.5),
    (re.compile("(?=[cdij][CDIJ])"), 3.0),
    (re.compile(f"(?=[{_LETTERS}][p][{_LETTERS}])"), 1.5),
    (re.compile("(?=[ps][ps])"), 1.0),
    (re.compile("(?=(?<![A-Za-z])[lLeEcdiCDIjJgGy](?![A-Za-z]))"), 1.5),
    # A combining mark stands behind the letter it belongs to.
    (re.compile(f"(?=(?<![{_LETTERS}m])m)"), 4.0),
    # A list of symbols with blanks between them is no garble.
    (re.compile("(?=(?<= )[sp](?= |$))"), -1.0),
    # A run of one kind of box drawing is one drawing; kinds don't mix, and letters don't touch it.
    (re.compile("b+"), 0.7),
    (re.compile("B+"), 0.9),
    (re.compile("(?=b[Bq]|B[bq]|q[bB])"), 2.0),
    (re.compile(f"(?=[bBq][0{_LETTERS}]|[{_LETTERS}][bBq])"), 2.0),
    (re.compile("(?=[lL][le][lLeE][lLeE])"), 2.5),
]


#: What Russian spelling doesn't allow, or hardly.
_SPELLING = [
    (re.compile("(?i)(?<![а-яё])[ьъы]"), 4.0),
    (re.compile(f"(?i)[{VOWELS}][ьъ]"), 4.0),
    (re.compile(f"(?i)(?<=[а-я])(?<![{VOWELS}])й"), 3.0),
    (re.compile(f"(?i)[^\\W\\d_a-z{VOWELS}йьъ]{{4,}}"), 3.0),
    (re.compile(f"(?i)[{VOWELS}]{{3,}}"), 2.0),
]


class _Classes(dict):
    def __missing__(self, code: int) -> str:
        self[code] = kind = _class_of(chr(code))
        return kind


def _level(char: str, codec: str, first: int, last: int, shift: int) -> bool:
    """Whether a national standard has the character among its common ones (rows first..last)."""
    try:
        coded = char.encode(codec)
    except UnicodeEncodeError:
        return False
    return len(coded) == 2 and first <= coded[0] - shift <= last


def _class_of(c: str) -> str:
    n = ord(c)
    if n < 128:
        return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "'" if c == "'" else " " if c.isspace() else "." if c.isprintable() else "z"
    if n < 0xA0:
        return "z"
    if n == 0xFFFD:
        return "f"
    if c == "’":  # the apostrophe; its left counterpart only opens a quotation
        return "'"
    if c in MARKS:
        return "p"
    if c in BOXES[0]:
        return "b"
    if c in BOXES[1]:
        return "B"
    if n in (0xA0, 0xAD, 0xFEFF, 0x200B):
        return "w"
    kind = unicodedata.category(c)
    if kind == "Mn" and n < 0x370:
        return "m"
    if kind in ("Cn", "Co", "Cs", "Cc", "Cf"):
        return "u"
    if 0x400 <= n < 0x460:
        low = c.lower()
        group = next((k for k, letters in enumerate(CYRILLIC) if low in letters), 3)
        return ("cdij" if c == low else "CDIJ")[group]
    if kind[0] == "L":
        if n < 0x100 and c not in "ªº":
            return "l" if c.islower() else "L"
        if n < 0x250:
            return "e" if c.islower() else "E"
        if 0x370 <= n < 0x400:
            return "g" if c.islower() else "G"
        if 0x3040 <= n < 0x3100:
            return "k"
        if 0xFF61 <= n < 0xFFA0:
            return "K"
        if 0xAC00 <= n < 0xD7A4:
            return "o"
        if 0x4E00 <= n < 0xA000:
            if _level(c, "gb2312", 16, 55, 0xA0) or _level(c, "euc-jp", 16, 47, 0xA0):
                return "h"
            return "H" if _level(c, "gb2312", 56, 87, 0xA0) or _level(c, "euc-jp", 48, 84, 0xA0) else "X"
        return "y" if n < 0x600 else "v"
    if 0x3000 <= n < 0x3040 or 0xFF00 <= n < 0xFF61:
        return ","
    if 0x2500 <= n < 0x25A0:
        return "q"
    return "s" if n < 0x2600 else "v"


_CLASSES = _Classes()


#: Characters up to which a text's result is remembered, so that a worker's memory doesn't follow the length of lines.
REMEMBERED = 400


def _remembered(size: int) -> Callable[[Callable[[str], Any]], Callable[[str], Any]]:
    """Remembers the results of a function of a text for the last `size` short ones."""

    def wrap(f: Callable[[str], Any]) -> Callable[[str], Any]:
        cached = lru_cache(maxsize=size)(f)

        @wraps(f)
        def call(text: str) -> Any:
            return cached(text) if len(text) <= REMEMBERED else f(text)

        return call

    return wrap


@_remembered(100_000)
def cost(text: str) -> float:
    """How implausible the characters of text are; 0 for plain ASCII."""
    classes = text.translate(_CLASSES)
    total = 0.0
    for kind in sorted(set(classes)):
        weight = _WEIGHT[kind]
        if weight:
            total += weight * classes.count(kind)
    for pattern, weight in _PAIRS:
        total += weight * sum(1 for _ in pattern.finditer(classes))
    special = re.findall(r"[\xc0-\xd6\xd8-\xf6\xf8-\u024f]", text)
    if len(special) > 1:
        special = [c.lower()[:1] for c in special]
        total += MIXED * min(sum(c not in letters for c in special) for letters in ALPHABETS)
    if "c" in classes or "C" in classes:
        for pattern, weight in _SPELLING:
            total += weight * sum(1 for _ in pattern.finditer(text))
    return total


def _lenient_tables() -> dict[str, dict[int, int]]:
    """For each single-byte encoding, its characters as code points below 256, undefined bytes standing for themselves."""
    out = {}
    for name in READ_AS:
        if name not in _WIDE:
            table = out[name] = {}
            for byte in range(128, 256):
                try:
                    table[ord(bytes([byte]).decode(name))] = byte
                except UnicodeDecodeError:
                    table[byte] = byte
    return out


_WIDE = ("gbk", "cp932", "big5")
_TABLES = _lenient_tables()
_REACH = {name: frozenset(map(chr, table)) for name, table in _TABLES.items()}
_FOREIGN = re.compile(r"[^\x00-\x7f]")


def _encoded(text: str, foreign: frozenset[str], name: str) -> bytes | None:
    if name in _WIDE:
        try:
            return text.encode(name)
        except UnicodeEncodeError:
            return None
    return text.translate(_TABLES[name]).encode("latin-1") if foreign <= _REACH[name] else None


def plausible(text: str) -> bool:
    return cost(text) <= PLAUSIBLE * len(_FOREIGN.findall(text))


_ESCAPED = re.compile(r"&(?:#\d+|#x[0-9a-fA-F]+|[A-Za-z]+\d?);")
#: A character reference, escaped once or oftener, that isn't one of markup itself; the same for the JVM.
REFERENCE = r"&(?:amp;)*(?:#[0-9]{2,7}|#[xX][0-9a-fA-F]{1,6}|(?!(?:lt|gt|amp|quot|apos|nbsp);)[A-Za-z]{2,8}[0-9]{0,2});"
_REFERENCE = re.compile(REFERENCE)


def silent(text: str) -> bool:
    """Whether nothing in the text can be garbled: ASCII without character references."""
    return text.isascii() and not _REFERENCE.search(text)


def shown(text: str) -> str:
    """The text without references, escaped however often."""
    while (plain := html.unescape(text)) != text:
        text = plain
    return text


def neighbours(text: str, legacy: bool) -> Iterator[tuple[float, str, str]]:
    """(cost of the operation, its name, the text it gives); with legacy also by encodings other than UTF-8."""
    if _ESCAPED.search(text):
        plain = html.unescape(text)
        if plain != text:
            yield STEP, "unescape", plain
            legacy = legacy and plain.isascii()  # what is still escaped is no text to judge yet
    foreign, raws = frozenset(_FOREIGN.findall(text)), {}
    for read in READ_AS:
        raw = _encoded(text, foreign, read)
        if raw is not None and raw not in raws and not raw.isascii():
            raws[raw] = read
    for raw, read in raws.items():
        try:
            yield STEP, f"{read}>utf-8", raw.decode("utf-8")
            legacy = False  # bytes that are UTF-8 are nothing else
        except UnicodeDecodeError:
            continue
    for raw, read in raws.items() if legacy else ():
        for written in WRITTEN_IN:
            if written != read:
                try:
                    yield STEP_LEGACY, f"{read}>{written}", raw.decode(written)
                except UnicodeDecodeError:
                    continue


@_remembered(50_000)
def search(text: str) -> tuple[str, tuple[str, ...]]:
    """The cheapest text in reach of `text` and the operations that lead there, none where `text` is it.

    A plausible state is left only by bytes that turn out to be UTF-8, which good text hardly ever forms by chance; so is
    one that was reached that way. Every operation costs something, so the search ends by itself, where no open state can
    lead below the best. References hide characters, so ASCII text is searched from what it shows.
    """
    begin = shown(text) if text.isascii() else text
    start = cost(begin)
    if begin != text and begin.isascii():
        return text, ()
    best, best_cost, best_path = begin, start, ()
    heap: list[tuple[float, int, str, tuple[str, ...], float]] = [(start, 0, begin, (), 0.0)]
    met, n = {begin}, 0
    while heap:
        total, _, state, path, spent = heapq.heappop(heap)
        if total > best_cost + STEP and path:
            break  # nothing that is left can lead below the best but by a worse text
        if spent >= best_cost:
            continue
        for step, name, other in neighbours(state, not plausible(state) and not is_utf8(path)):
            if other in met:
                continue
            met.add(other)
            n += 1
            reached = cost(other) + spent + step
            if reached < best_cost:
                best, best_cost, best_path = other, reached, (*path, name)
            # Unescaping shows characters that were hidden, so what it gives is looked at before it is judged.
            rank = total + step if name == "unescape" else reached
            heapq.heappush(heap, (rank, n, other, (*path, name), spent + step))
    if not best_path:
        return text, ()
    return best, ("unescape", *best_path) if begin != text else best_path


def gain_of(text: str, found: str) -> float:
    """How much less implausible found is than what text shows."""
    return cost(shown(text) if text.isascii() else text) - cost(found)


_LOST = re.compile(r"[^\W\d_]\ufffd|\ufffd[^\W\d_]|\s\ufffd\s|[\u0080-\u0084\u0086-\u009f]")


def weight(text: str, found: str, path: tuple[str, ...]) -> tuple[float, int]:
    """(what the way from text to found gains, letters beyond ASCII that found has inside words) if found is plausible and
    much cheaper, else (0, 0)."""
    gain = gain_of(text, found)
    if not path or path == ("unescape",) or gain < SHARE * (gain + cost(found)) or not plausible(found):
        return 0.0, 0
    runs = _WORDS.findall(found.translate(_CLASSES))
    return gain, sum(len(r) - r.count("a") - r.count("A") for r in runs)


def is_utf8(path: tuple[str, ...]) -> bool:
    return any(step.endswith("utf-8") for step in path) and all(step.endswith("utf-8") or step == "unescape" for step in path)


def accepted(text: str, found: str, path: tuple[str, ...]) -> bool:
    """Whether the way from text to found counts: bytes that turn out to be UTF-8 need little gain, others much."""
    if is_utf8(path):
        return gain_of(text, found) >= 0.5
    gain, letters = weight(text, found, path)
    if gain < GAIN or letters < LETTERS:
        return False
    # Between right marks each part may be UTF-8 by itself, which says more than a legacy way for all of it.
    parts = [m.group() for m in _FINE.finditer(text) if not silent(m.group())]
    return not parts or parts == [text] or not all(is_utf8(search(p)[1]) for p in parts)


#: Letters beyond ASCII that a way without UTF-8 must bring back, in a line or in all lines of a document together.
LETTERS = 3
_WORDS = re.compile(f"[{_LETTERS}]{{2,}}|b{{2,}}")


_QUOTES = "\"'`"
_TOKEN = re.compile(r"[^ \t\r]+")
_STRETCH = re.compile(rf"(?:[A-Za-z]|[^\x00-\x7f]|{REFERENCE})+")
#: Parts of a stretch between marks that may be right as they are, such as the apostrophe of l’Ã©tÃ©.
_FINE = re.compile(r"(?:[A-Za-z]|[^\x00-\x7f‘’“”–—…«»])+")
_RUN = re.compile(rf"(?:[^\x00-\x7f]|{REFERENCE})+")


def _one_script(text: str) -> bool:
    """Whether what text has beyond ASCII are letters of one script other than Latin. Words that are right form UTF-8 by
    chance in some encoding ('цен' in cp866), so these need more than a small gain, and a word by itself isn't enough to tell
    one of their legacy encodings from another."""
    kinds = set("".join(_FOREIGN.findall(text)).translate(_CLASSES))
    return any(kinds <= set(script) for script in (_CYR, _GREEK, _EAST))


def _exhibits(stretch: str, around: str, line: str = "") -> bool:
    """Whether every run beyond ASCII that could be restored is shown as an example: it fills a pair of quotes, or stands
    quoted or with an arrow or sign of equality next to its right form, in the stretch or the line that holds it."""
    line = line or stretch
    some, context = False, around + line
    for run in dict.fromkeys(m.group() for m in _RUN.finditer(stretch)):
        right, path = search(run)
        if not is_utf8(path) or right == run:
            continue
        quoted = any(f"{q}{run}{q}" in line for q in _QUOTES)
        pair = any(f"{a}{b}{x}{c}" in context for a, c in ((run, right), (right, run)) for b in ("", " ") for x in ("-> ", "→ ", "=> ", "= ", "== "))
        if not quoted and not pair:
            return False
        some = True
    return some


def _repaired_parts(parts: re.Pattern, text: str, line: str, around: str, legacy: bool) -> tuple[str, list[str]]:
    """text, which is `line` or what became of it, with each of its parts restored by itself, and the ways taken; without
    legacy by UTF-8 only."""
    ways: list[str] = []

    def restored(place: re.Match) -> str:
        part = place.group()
        if silent(part):
            return part
        found, path = search(part)
        utf8 = is_utf8(path)
        if not accepted(part, found, path) or not (legacy or utf8) or _exhibits(part, around + line, line):
            return part
        if _one_script(part) and not (utf8 and (gain_of(part, found) >= GAIN or not plausible(part))):
            return part
        ways.append(" ".join(path))
        return found

    return parts.sub(restored, text), ways


def repaired_line(line: str, around: str = "") -> tuple[str, list[str]]:
    """The line with what can be restored restored, and the ways taken ('lost' where bytes are gone for good).

    No way means that nothing in the line is garbled, or that it shows garbled text as an example, with its right form
    beside it in the line or in `around`, the lines before and after it.
    """
    if silent(line):
        return line, []
    if line.isascii():  # what its markup escapes stays escaped, so only the stretches with other references are looked at
        return _repaired_parts(_STRETCH, line, line, around, True)
    found, path = search(line)
    if accepted(line, found, path):
        if _exhibits(line, around):
            return line, []
        # What was restored may leave escaped words that are garbled as well.
        found, more = _repaired_parts(_STRETCH, found, found, around, False) if _REFERENCE.search(found) else (found, [])
        return found, [" ".join(path), *more]
    # However plausible the line is as a whole, each of its parts is looked at, first between blanks, then words alone.
    out, ways = _repaired_parts(_TOKEN, line, line, around, False)
    out, more = _repaired_parts(_STRETCH, out, line, around, plausible(line))
    ways += more
    out, more = _repaired_parts(_FINE, out, line, around, False)
    ways += more
    if not ways and _LOST.search(line):
        ways.append("lost")
    return out, ways


def repaired(text: str | None) -> tuple[str | None, list[str]]:
    """repaired_line over the lines of a text. Null and ASCII texts without references come back as they are.

    A way that is too weak in each line by itself counts where several different lines of the text together bear it out;
    where none does, the words of such lines are tried by themselves.
    """
    if text is None or silent(text):
        return text, []
    lines, ways, left = text.split("\n"), [], {}
    taken: dict[int, tuple[str, str]] = {}
    weak: dict[tuple[str, ...], None] = {}
    weak_lines: dict[str, None] = {}
    for i, line in enumerate(lines):
        if not silent(line):
            around = "\n".join([*lines[max(0, i - 1) : i], *lines[i + 1 : i + 2]]) + "\n"
            lines[i], more = repaired_line(line, around)
            ways += more
            if len(more) == 1 and " " not in more[0] and more[0] != "lost":
                taken[i] = line, more[0]
            if not more and not line.isascii() and not plausible(line):
                found, path = search(line)
                weak_lines[line], left[i] = None, around
                if len(path) == 1 and weight(line, found, path)[1]:
                    weak[path] = None
    # Between ways of about the same cost a line goes by the other lines of its text.
    usual, often = Counter(way for _, way in taken.values()).most_common(1)[0] if taken else ("", 0)
    for i, (line, way) in taken.items() if often > 1 else ():
        if way != usual and (other := step_of(line, usual)) and cost(other) <= cost(lines[i]) + SAME:
            lines[i] = other
            ways[ways.index(way)] = usual
    # What one line bears out by itself holds for lines that are too weak to.
    for i in list(left) if taken else ():
        if (other := step_of(lines[i], usual)) and weight(lines[i], other, (usual,))[1]:
            weak_lines.pop(lines[i], None)
            lines[i] = other
            ways.append(usual)
            del left[i]
    for path in weak:
        held = {x: (y, w) for x in weak_lines if (y := step_of(x, path[0])) and (w := weight(x, y, path))[1]}
        if len(held) > 1 and sum(g for _, (g, _) in held.values()) >= 1.5 * GAIN and sum(n for _, (_, n) in held.values()) >= 2 * LETTERS:
            lines = [held[x][0] if x in held else x for x in lines]
            ways.append(" ".join(path))
            break
    else:
        for i, around in left.items():
            lines[i], more = _repaired_parts(_STRETCH, lines[i], lines[i], around, True)
            ways += more
    return "\n".join(lines), ways


def step_of(text: str, name: str) -> str | None:
    """What one operation by name, such as 'cp1252>cp1250', makes of the text."""
    read, _, written = name.partition(">")
    raw = _encoded(text, frozenset(_FOREIGN.findall(text)), read) if written else None
    try:
        return raw.decode(written) if raw is not None else None
    except UnicodeDecodeError:
        return None


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, ways = [], [], []
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            restored, taken = repaired(text.as_py())
            if taken:
                ids.append(doc_id)
                texts.append(restored)
                ways.append(list(dict.fromkeys(taken)))
        yield pa.record_batch([pa.array([x.as_py() for x in ids], batch.column(0).type), pa.array(texts, pa.string()), pa.array(ways, pa.list_(pa.string()))], ["doc_id", "restored", "ways"])


def garbled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, restored, ways) of the documents with at least one garbled stretch.

    ways names the operations that restored a stretch, such as 'cp1252>utf-8', or 'lost' where bytes are gone; restored
    is the whole text, stretches that can't be restored being left as they are. Null and empty texts give no row, nor do
    ASCII texts without character references (no wrong decoding leaves ASCII alone, so these never reach Python). Repeated rows give repeated rows; extra columns
    are ignored. There is no shuffle: each document is judged by its own characters.
    """
    foreign = spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where(F.col("text").rlike(r"[^\x00-\x7F]|" + REFERENCE)))
    return foreign.mapInArrow(_run, f"doc_id {dict(foreign.dtypes)['doc_id']}, restored string, ways array<string>")
