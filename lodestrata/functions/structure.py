"""Predicates on lines and chunks: headings, boilerplate, noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions import patterns as P
from lodestrata.functions.text import blank, let, lines, share, strip

MIN_PROSE_WORDS, MIN_WORDS_WITH_MATH = 25, 5


def is_boilerplate(heading: Column) -> Column:
    return strip(F.regexp_replace(heading, P.EMPHASIS, "")).rlike(P.BOILERPLATE)


def is_heading(line: Column) -> Column:
    """Whether a line is a heading; the first rule that applies decides."""

    def decide(s: Column) -> Column:
        content = F.regexp_replace(s, P.ATX_MARK, "")
        formula = content.startswith("$$") | content.startswith("\\[")
        letters = F.length(F.regexp_replace(s, r"[^\p{L}]", ""))
        return (
            F.when((s == "") | s.rlike(P.NUMBERED_CODE), False)
            .when(s.rlike(P.ATX), ~formula & content.rlike(P.PROSE_WORD) & ~content.rlike(P.PSEUDOCODE))
            .when(F.length(s) > 80, False)
            .when(s.rlike(P.NUMBERED_HEADING) | s.rlike(P.NAMED_HEADING), True)
            .when(strip(F.regexp_replace(s, P.EMPHASIS, "")).rlike(P.SECTION_NAME), True)
            .otherwise((letters >= 4) & (F.length(s) < 60) & (F.upper(s) == s))
        )

    return let(strip(line), decide)


def heading_text(line: Column) -> Column:
    """A heading line without its marks."""
    return F.regexp_replace(strip(line), P.ATX_MARK, "")


def heading_name(heading: Column) -> Column:
    """A heading without a page number that printing fused onto it."""
    return strip(F.regexp_replace(heading, P.HEADING_PAGE, ""))


def full_lines(c: Column) -> Column:
    return F.filter(lines(c), lambda x: ~blank(x))


def _dominated(c: Column, least: int, part: float, test) -> Column:
    return let(full_lines(c), lambda x: (F.size(x) >= least) & F.coalesce(share(x, test) >= part, F.lit(False)))


def table_dominated(c: Column) -> Column:
    return _dominated(c, 2, 0.5, lambda x: strip(x).startswith("|"))


def toc_dominated(c: Column) -> Column:
    return _dominated(c, 3, 0.5, lambda x: x.rlike(P.TOC_ENTRY))


def url_dominated(c: Column) -> Column:
    return _dominated(c, 2, 0.6, lambda x: x.rlike(P.BARE_URL))


def prose_words(c: Column) -> Column:
    """Words of three or more letters on lines outside code fences; a fence that is never closed runs to the end."""
    fence = lambda x: strip(x).startswith("```")
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).alias("n"))

    def step(state: Column, line: Column) -> Column:
        toggles = fence(line)
        counted = F.when(toggles | state["inside"], 0).otherwise(F.regexp_count(line, F.lit(P.PROSE_WORD)))
        return F.struct((state["inside"] != toggles).alias("inside"), (state["n"] + counted).alias("n"))

    return F.aggregate(lines(c), start, step, lambda s: s["n"])


def is_meaningful(c: Column) -> Column:
    """Whether a chunk is worth keeping: not mostly table rows, contents or links, and with enough prose, less if it has formulas."""
    enough = let(prose_words(c), lambda n: (n >= MIN_PROSE_WORDS) | ((n >= MIN_WORDS_WITH_MATH) & c.rlike(P.LATEX)))
    return ~table_dominated(c) & ~toc_dominated(c) & ~url_dominated(c) & enough
