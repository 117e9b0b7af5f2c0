"""Repair of text extracted from page layouts, one column function an artefact, and all in their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions import patterns as P
from lodestrata.functions.text import let, lines, strip

HEADER_BELOW = 72


def span_tags(c: Column) -> Column:
    """Span tags go, what they hold stays."""
    return F.regexp_replace(c, P.SPAN_TAG, "")


def double_footnotes(c: Column) -> Column:
    """Footnote marks that were escaped twice."""
    return F.regexp_replace(c, P.DOUBLE_FOOTNOTE, "")


def left_footnotes(c: Column) -> Column:
    """The tail of an escaped footnote mark."""
    return F.regexp_replace(c, P.LEFT_FOOTNOTE, "")


def math_scripts(c: Column) -> Column:
    """Short raised or lowered text that is no number becomes a formula."""
    return F.regexp_replace(F.regexp_replace(c, P.MATH_SUP, r"\$^{$1}\$"), P.MATH_SUB, r"\$_{$1}\$")


def footnotes(c: Column) -> Column:
    """Raised numbers are footnote marks."""
    return F.regexp_replace(c, P.FOOTNOTE, "")


def page_images(c: Column) -> Column:
    """References to pictures cut from pages, without a caption."""
    return F.regexp_replace(c, P.PAGE_IMAGE, "")


def recognition_artefacts(c: Column) -> Column:
    """Remaining raised text, line tags, unseen characters, blanks that do not break."""
    c = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, P.ANY_SUP, ""), P.LINE_TAG, " "), P.UNSEEN, "")
    return F.replace(c, F.lit("\u00a0"), F.lit(" "))


def header_candidate(line: Column) -> Column:
    """Whether a trimmed line can be a running header."""
    return (line != "") & (F.length(line) < HEADER_BELOW) & ~line.rlike(P.NUMBERED_CODE)


def running_headers(all_lines: Column) -> Column:
    """Trimmed short lines that occur in at least a thirtieth of a document's lines, and three times.

    In the sorted candidates such a line stands at some place and again ``threshold - 1`` places on, so sorting
    finds them within the row.
    """
    threshold = F.greatest(F.lit(3), F.floor(F.size(all_lines) / 30).cast("int"))

    def repeated(ordered: Column) -> Column:
        last = F.size(ordered) - threshold
        at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        same = F.filter(at, lambda i: F.get(ordered, i) == F.get(ordered, i + threshold - 1))
        return F.array_distinct(F.transform(same, lambda i: F.get(ordered, i)))

    candidates = F.filter(F.transform(all_lines, strip), header_candidate)
    return F.filter(let(F.sort_array(candidates), repeated), lambda h: ~h.rlike(P.FORMULA_SIGN))


def page_artefacts(c: Column) -> Column:
    """Without page numbers and running headers; lines are joined by line feeds."""

    def without(all_lines: Column) -> Column:
        return let(running_headers(all_lines), lambda headers: F.filter(all_lines, lambda x: ~x.rlike(P.PAGE_NUMBER) & ~F.array_contains(headers, strip(x))))

    return F.array_join(let(lines(c), without), "\n")


STEPS = (span_tags, double_footnotes, left_footnotes, math_scripts, footnotes, page_images, recognition_artefacts, page_artefacts)


def clean(c: Column) -> Column:
    """All steps, each on what the one before left."""
    for step in STEPS:
        c = step(c)
    return c
