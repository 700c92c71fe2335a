"""Cleaning of messy cell and line text."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white space character and the four separator control characters,
# spelled out: the regular-expression flag for Unicode classes is much slower.
SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACE_RUN = SPACE + "+"
NO_SPACE = f"[^{SPACE[1:]}"
SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if re.match(SPACE, chr(c)))

# Cells of printable characters without spaces are tidy already; most numbers are.
PLAIN = "^[!-~]*$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalized(value: Column | str) -> Column:
    """Null becomes '', every run of white space becomes one space, ends are trimmed."""
    text = F.coalesce(as_column(value).cast("string"), F.lit(""))
    tidied = F.trim(F.regexp_replace(text, SPACE_RUN, " "))
    return F.when(text.rlike(PLAIN), text).otherwise(tidied)


def text_or_null(value: Column | str) -> Column:
    """Blank cells become null; other cells keep their text as it is."""
    text = as_column(value).cast("string")
    # One character that is no white space tells it; only blank cells are tidied.
    return F.when(text.rlike(NO_SPACE) | (normalized(text) != ""), text)


def stripped(value: Column | str) -> Column:
    """White space of any kind removed from both ends only."""
    return F.trim(as_column(value), F.lit(SPACE_CHARS))


def _decompositions() -> tuple[dict[str, str], str]:
    """Every character that compatibility decomposition without marks changes, and the marks."""
    changed, marks = {}, []
    for code in range(0xA0, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.combining(char):
            marks.append(char)
        elif (parts := unicodedata.normalize("NFKD", char)) != char:
            changed[char] = "".join(p for p in parts if not unicodedata.combining(p))
    return changed, "".join(marks)


def _char_class(chars: Iterable[str], gap: int = 64) -> str:
    """A regular expression for some of whose matches are the characters: near ones are one run.

    What lies below them all, most of most texts, is ruled out by one comparison.
    """
    runs: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if runs and code - runs[-1][1] <= gap:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    spelled = "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in runs)
    return f"(?=[^\\x00-\\x{{{runs[0][0] - 1:x}}}])[{spelled}]"


def _pages(table: dict[str, str]) -> tuple[str, str]:
    """The table as two lists: the first cell of each page of 256 codes, and the cells. Pages
    without an entry share one of absent cells."""
    used = sorted({ord(c) >> 8 for c in table})
    starts = ["0"] * (used[-1] + 1)
    cells = [ABSENT] * 256
    for page in used:
        starts[page] = str(len(cells))
        cells += [table.get(chr(code), ABSENT) for code in range(page << 8, (page + 1) << 8)]
    return SPLIT.join(starts), SPLIT.join(cells)


ABSENT, SPLIT = "\x1e", "\x1f"
DECOMPOSED, _MARKS = _decompositions()
_ONE = {c: d for c, d in DECOMPOSED.items() if len(d) == 1}
_MANY = {c: d for c, d in DECOMPOSED.items() if len(d) != 1}
_MANY_CLASS = _char_class(_MANY)
_STARTS, _CELLS = _pages(_MANY)


def base_letters(value: Column | str) -> Column:
    """Characters that decompose to one base character as that character, without marks.

    What ``translate`` has no counterpart for, the marks, it deletes.
    """
    return F.translate(as_column(value), "".join(_ONE) + _MARKS, "".join(_ONE.values()))


def accent_free(value: Column | str) -> Column:
    """Compatibility decomposition without marks, for every character there is.

    Most texts hold only characters that become one character. The others are taken apart, and
    each of their characters is looked up by its code in a table of pages.
    """
    text = as_column(value)
    # Both lists are constants, split once when the plan is made.
    starts = F.split(F.lit(_STARTS), SPLIT, -1).cast("array<int>")
    cells = F.split(F.lit(_CELLS), SPLIT, -1)

    def plain(char: Column) -> Column:
        code = F.ascii(char)
        start = F.coalesce(F.get(starts, F.shiftright(code, 8)), F.lit(0))
        return F.coalesce(F.nullif(F.get(cells, start + code.bitwiseAND(255)), F.lit(ABSENT)), char)

    apart = F.array_join(F.transform(F.split(text, "", -1), plain), "")
    return base_letters(F.when(text.rlike(_MANY_CLASS), apart).otherwise(text))


def decodable(value: Column | str) -> Column:
    """Drop bytes that are not valid UTF-8."""
    text = as_column(value)
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.translate(F.make_valid_utf8(text), "�", "")
    )


def word(value: Column | str, position: int) -> Column:
    """The space-separated word at a 1-based position, '' when there is none."""
    parts = F.split(as_column(value), " ", -1)
    return F.trim(F.coalesce(F.get(parts, F.lit(position - 1)), F.lit("")))


def words_from(value: Column | str, position: int) -> Column:
    """All words from a 1-based position on, joined by single separators."""
    parts = F.split(as_column(value), " ", -1)
    return F.trim(F.array_join(F.slice(parts, position, F.size(parts)), " "))


def country_code(value: Column | str, default: str = "EE") -> Column:
    text = as_column(value)
    return F.substring(F.coalesce(F.nullif(text, F.lit("")), F.lit(default)), 1, 2)
