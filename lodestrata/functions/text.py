"""Columns over text: lines, words, sentences. All are built from JVM expressions and need no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions import patterns as P


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


#: The characters of P.SPACE.
WHITE = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.btrim(c, F.lit(WHITE))


def blank(c: Column) -> Column:
    return ~c.rlike(P.NONSPACE)


def lines(c: Column) -> Column:
    """The lines of a text; a break at its end opens no further line. A text of no characters has none."""
    return let(F.split(c, P.LINE_BREAK, -1), lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, 1, F.size(x) - 1)).otherwise(x))


def word_count(c: Column) -> Column:
    """Runs of characters between white space; without a pattern, which takes several times as long."""
    plain = F.translate(c, WHITE, " " * len(WHITE))
    return F.size(F.array_remove(F.split(plain, " ", -1), ""))


def share(array: Column, test: Callable[[Column], Column]) -> Column:
    """The share of an array's elements that pass; null for an empty array."""
    return F.size(F.filter(array, test)) / F.nullif(F.size(array), F.lit(0))


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(pattern)


def sentences(paragraph: Column) -> Column:
    """A paragraph's sentences: cut at white space after a full stop, exclamation or question mark; a displayed formula is one."""
    text = strip(paragraph)
    parts = F.filter(F.transform(F.split(text, rf"(?<=[.!?]){P.SPACE}+"), strip), lambda x: x != "")
    return F.when(text.startswith("$$"), F.array(text)).otherwise(parts)


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, rf"\n{P.SPACE}*\n"), strip), lambda x: x != "")
