"""Patterns in ECMAScript notation as Java patterns that match the same text, and small text helpers."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\s\x{00A0}\x{FEFF}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def rx(pattern: str, fold: bool = True) -> str:
    """Word edges and classes count ASCII only, ``\\s`` has all Unicode spaces, ``$`` is the end, case folds beyond ASCII.

    ``[\\s\\S]`` is one range, as a class of all spaces is slow where most characters are none.
    """
    pattern = pattern.replace(r"[\s\S]", r"[\x{0}-\x{10FFFF}]")

    def edge(m: re.Match) -> str:
        before = pattern[: m.start()][-1:]
        return "(?<![A-Za-z0-9_])" if before in ("", "(", "|", ":") else "(?![A-Za-z0-9_])"

    out = re.sub(r"\\b", edge, pattern)
    out = re.sub(r"\[([^\]]*)\\s([^\]]*)\]", lambda m: f"[{m[1]}{SPACE}{m[2]}]", out)
    out = re.sub(r"(?<!\[)\\s", lambda m: f"[{SPACE}]" if "\\x{00A0}" not in out[max(0, m.start() - 1) : m.end() + 9] else m[0], out)
    out = re.sub(r"(?<!\\)\$", r"\\z", out)
    return ("(?iu)" if fold else "") + out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def like(text: Column, pattern: str, fold: bool = True) -> Column:
    """Whether a pattern in ECMAScript notation is found; a null text has nothing."""
    return F.coalesce(text.rlike(rx(pattern, fold)), F.lit(False))


def sub(text: Column, pattern: str, to: str, fold: bool = True) -> Column:
    """All matches replaced."""
    return F.regexp_replace(text, F.lit(rx(pattern, fold)), F.lit(to))


def first(text: Column, pattern: str, group: int = 1, fold: bool = True) -> Column:
    """A group of the first match, empty if there is none."""
    return F.coalesce(F.regexp_extract(text, rx(pattern, fold), group), F.lit(""))


def all_of(text: Column, pattern: str, group: int = 0, fold: bool = True) -> Column:
    """A group of every match, in order."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(rx(pattern, fold)), F.lit(group)), F.array().cast("array<string>"))


def trimmed(text: Column) -> Column:
    """Without white space at its ends, Unicode spaces included."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(sub(text, r"\s+", " "))


def blank_to_null(text: Column) -> Column:
    """The trimmed text; null where nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def pick(tags: Column, *keys: str) -> Column:
    """The first of several map entries that is not blank, trimmed; else empty."""
    return F.coalesce(*(blank_to_null(F.element_at(tags, k)) for k in keys), F.lit(""))


_MARKS = range(0x0300, 0x0370)
# characters that canonical decomposition turns into one other character and combining marks of that block
_PLAIN = {
    c: rest
    for c in map(chr, [*range(0x80, 0xD800), *range(0xF900, 0x10000)])
    if len(rest := "".join(x for x in unicodedata.normalize("NFD", c) if ord(x) not in _MARKS)) == 1 and rest != c
}
_FROM, _TO = "".join(_PLAIN), "".join(_PLAIN.values())


def strip_accents(text: Column) -> Column:
    """Lower case without accents, of Latin and other letters alike; combining marks go too.

    A letter that decomposes into several others, as Hangul does, stays whole.
    """
    return F.regexp_replace(F.translate(F.lower(text), _FROM, _TO), r"[\x{0300}-\x{036F}]", "")


def slug(text: Column) -> Column:
    """Lower case, letters a-z and digits only; accented letters go."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def csv_cell(value: Column) -> Column:
    """A cell that is quoted only if it has a quote, a comma or a line feed."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def percent_decoded(text: Column) -> Column:
    """URL escapes decoded, ``+`` left alone; null where an escape is broken."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
