"""Documents cut into sections, sentences and chunks within their row: no line leaves the task its document is in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import patterns as P
from lodestrata.functions.metadata import chunk_id
from lodestrata.functions.structure import heading_name, heading_text, is_boilerplate, is_heading, is_meaningful
from lodestrata.functions.text import let, lines, paragraphs, sentences, word_count

MAX_WORDS, OVERLAP = 500, 2


def sections(text: Column) -> Column:
    """An array of ``heading, lines``: a heading line opens the next section, and headings without lines vanish."""

    def cut(all_lines: Column) -> Column:
        count = F.size(all_lines)
        at = F.filter(F.transform(all_lines, lambda x, i: F.when(is_heading(x), i)), lambda i: i.isNotNull())

        def section(bounds: Column) -> Column:
            def part(start: Column, k: Column) -> Column:
                end = F.coalesce(F.get(bounds, k + 1), count)
                heading = F.when(start < 0, F.lit("")).otherwise(heading_text(F.get(all_lines, start)))
                return F.struct(heading.alias("heading"), F.slice(all_lines, start + 2, end - start - 1).alias("lines"))

            return F.transform(bounds, part)

        return let(F.concat(F.array(F.lit(-1)), at), section)

    return F.filter(let(lines(text), cut), lambda s: F.size(s["lines"]) > 0)


def code_fenced(all_lines: Column) -> Column:
    """The lines as text, each run of line-numbered code in a fence of its own."""
    ends = F.transform(all_lines, lambda x: F.when(x.rlike(P.NUMBERED_CODE), F.regexp_replace(x, rf"{P.SPACE}+\z", "")).otherwise(x))
    inner = P.SPACE.replace(r"\t-\r", r"\t\x0b-\r")  # white space within a line
    code = rf"{inner}*{P.DIGIT}{{2,5}}{inner}+[A-Za-z'`][^\n]*"
    return F.regexp_replace(F.array_join(ends, "\n"), rf"(?m)^({code}(?:\n{code})*)$", "```\n$1\n```")


def chunk_ranges(counts: Column, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> Column:
    """From the words of each sentence the chunks ``first, last`` (from 1): a chunk ends with the sentence that fills it, and the
    next begins with its last ``overlap`` sentences, or with all of it if it has no more."""
    empty = F.struct(F.lit(1).alias("start"), F.lit(0).alias("i"), F.lit(0).alias("words"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))

    def step(counts: Column, state: Column, n: Column) -> Column:
        i, words = state["i"] + 1, state["words"] + n
        full = words >= max_words
        moves = full & (i - state["start"] + 1 > overlap)
        start = F.when(moves, i - overlap + 1).otherwise(state["start"])
        kept = F.aggregate(F.slice(counts, i - overlap + 1, overlap), F.lit(0), lambda a, x: a + x)
        out = F.when(full, F.concat(state["out"], F.array(F.struct(state["start"].alias("first"), i.alias("last"))))).otherwise(state["out"])
        return F.struct(start.alias("start"), i.alias("i"), F.when(moves, kept).otherwise(words).alias("words"), out.alias("out"))

    def finish(state: Column) -> Column:
        rest = F.struct(state["start"].alias("first"), state["i"].alias("last"))
        done = F.coalesce(F.get(state["out"], F.size(state["out"]) - 1) == rest, F.lit(False))
        return F.when((state["i"] == 0) | done, state["out"]).otherwise(F.concat(state["out"], F.array(rest)))

    # bound once, as the counts would be taken anew for every chunk otherwise
    return let(counts, lambda c: F.aggregate(c, empty, lambda state, n: step(c, state, n), finish))


def join_orphans(chunks: Column, max_words: int = MAX_WORDS) -> Column:
    """Chunks whose opening refers to what came before joined to the chunk before, or, if that grows too long, given its last sentence."""

    def step(done: Column, chunk: Column) -> Column:
        before = F.get(done, F.size(done) - 1)
        orphan = F.coalesce(F.get(sentences(chunk), F.lit(0)).rlike(P.ORPHAN), F.lit(False)) & (F.size(done) > 0)
        joined = F.concat_ws(" ", before, chunk)
        fits = word_count(joined) <= int(max_words * 1.2)
        shown = let(sentences(before), lambda s: F.when(F.size(s) >= 2, F.concat_ws(" ", F.get(s, F.size(s) - 1), chunk)).otherwise(chunk))
        merged = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))
        return F.when(~orphan, F.concat(done, F.array(chunk))).when(fits, merged).otherwise(F.concat(done, F.array(shown)))

    return F.aggregate(chunks, F.array().cast("array<string>"), step)


def section_chunks(all_lines: Column, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> Column:
    """The chunks of one section's lines, before any filter."""
    flat = F.flatten(F.transform(paragraphs(code_fenced(all_lines)), sentences))

    def cut(all_sentences: Column) -> Column:
        ranges = chunk_ranges(F.transform(all_sentences, word_count), max_words, overlap)
        texts = F.transform(ranges, lambda r: F.array_join(F.slice(all_sentences, r["first"], r["last"] - r["first"] + 1), " "))
        return join_orphans(texts, max_words)

    return let(flat, cut)


def section_rows(rows: DataFrame, key: str, text: str, keep_boilerplate: bool = False) -> DataFrame:
    """``<key>, section_no, heading, lines``, numbered from 0; sections of boilerplate are left out unless wanted."""
    # outer, as otherwise a filter on the array's size would be inferred, pushed down, and do the work twice
    each = rows.select(F.col(key), F.posexplode_outer(sections(F.col(text))).alias("section_no", "s")).filter("section_no is not null")
    if not keep_boilerplate:
        each = each.filter(~is_boilerplate(F.col("s.heading")))
    return each.select(key, "section_no", F.col("s.heading").alias("heading"), F.col("s.lines").alias("lines"))


def smart_chunks(rows: DataFrame, key: str, text: str, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """``<key>, section_no, chunk_no, heading, body`` of the chunks worth keeping; chunk_no counts within the section.

    Every step is an expression over its row, so the plan has no shuffle. Null texts give no chunks.
    """
    named = section_rows(rows.select(key, text).filter(F.col(text).isNotNull()), key, text).withColumn("heading", heading_name(F.col("heading")))
    cut = named.select(key, "section_no", "heading", F.posexplode_outer(section_chunks(F.col("lines"), max_words, overlap)).alias("chunk_no", "chunk")).filter("chunk_no is not null")
    body = F.when(F.col("heading") == "", F.col("chunk")).otherwise(F.concat_ws("\n", "heading", "chunk"))
    return cut.select(key, "section_no", "chunk_no", "heading", body.alias("body")).filter(is_meaningful(F.col("body")))


def numbered_chunks(chunks: DataFrame, key: str, stem: Column) -> DataFrame:
    """Chunks with their index within the document, after filtering, and their id."""
    from pyspark.sql import Window

    index = F.row_number().over(Window.partitionBy(key).orderBy("section_no", "chunk_no")) - 1
    return chunks.withColumn("chunk_index", index).withColumn("id", chunk_id(stem, F.col("chunk_index")))
