"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters after which title casing starts a new word; an apostrophe is none.
WORD_BREAKS = r"""[\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""

# Fixed value: the characters that count as blanks at the ends of a text.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000"


def strip(c: Column) -> Column:
    """Remove blanks of any kind from both ends, not only spaces."""
    return F.btrim(c, F.lit(BLANKS))


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern`` or null (an empty text when only that group is empty)."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), group), F.lit(0))


def matches_whole(c: Column, pattern: str) -> Column:
    """True when the whole string matches, not only a part of it."""
    return c.rlike(f"^(?:{pattern})$")


def unquote(c: Column, quotes: str = "'") -> Column:
    """Drop quote characters and then blanks from both ends."""
    return strip(F.btrim(c, F.lit(quotes)))


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.regexp_replace(c, f"^{prefix}", "")


def strip_trailing_chars(c: Column, chars: str) -> Column:
    """Remove any of ``chars`` (a set, not a suffix) from the right end."""
    return F.rtrim(c, F.lit(chars))


def market_key(c: Column) -> Column:
    """Canonical category label: no quotes, no 'es_' prefix, lower case."""
    return F.lower(strip(strip_prefix(F.btrim(strip(c), F.lit("'\"")), "es_")))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every word, where blanks and most punctuation end a word."""
    # initcap only breaks at blanks: put a blank after each break, then take it out again
    marked = F.regexp_replace(c, f"({WORD_BREAKS})", "$1 \u0001")
    spaced = F.regexp_replace(marked, "\u0001", "")
    return F.regexp_replace(F.initcap(spaced), f"({WORD_BREAKS}) ", "$1")


def snake_case(c: Column, acronyms: tuple[str, ...] = ()) -> Column:
    """camelCase name to snake_case; acronyms stay one word ('EBITDAMargin' -> 'ebitda_margin')."""
    out = c
    for word in sorted(acronyms, key=len, reverse=True):
        out = F.regexp_replace(out, f"(?<![A-Z]){word}(?=[A-Z][a-z]|[^A-Za-z]|$)", f"_{word}_")
    out = F.regexp_replace(out, "([a-z0-9])([A-Z])", "$1_$2")
    out = F.regexp_replace(out, "([A-Z]+)([A-Z][a-z])", "$1_$2")
    return F.lower(F.btrim(F.regexp_replace(out, "_+", "_"), F.lit("_")))


def digit_count(c: Column) -> Column:
    """Number of characters of a number written as text."""
    return F.length(c.cast("string"))


def path_join(*parts: Column | str) -> Column:
    """Join with '/', null when any part is null."""
    cols: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            cols.append(F.lit("/"))
        cols.append(F.lit(part) if isinstance(part, str) else part)
    return F.concat(*cols)


def last_segment(c: Column) -> Column:
    """File name of a path or URL; trailing slashes are ignored."""
    return F.element_at(F.split(F.rtrim(c, F.lit("/")), "/"), -1)


def join_nonblank(parts: Column, separator: str = "\n\n") -> Column:
    """Join the non-empty elements of an array of strings."""
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), separator)
