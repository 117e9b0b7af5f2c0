"""Problem 7: items above a size limit cut into overlapping pieces at natural boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.text import let

BLANK, NON = r"[ \t\r\n]", r"[^ \t\r\n]"
#: A word with its blanks; a word of more than 4,000 characters goes in several, so one may be cut within as a last resort.
UNIT = rf"{NON}{{1,4000}}+{BLANK}*+"
SENTENCE_END = r"[.!?][\"')\]]{0,3}"
#: Words are counted in blocks of 32, 32 * 32, ...: so a match is no deeper than 32 for each power of 32 in the limit.
BASE = 32
#: The parts of the limit that can be kept free for an overlap; the least that holds any two sentences of the text is taken.
ROOMS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4)


def up_to(most: int) -> str:
    """As many units as there are up to ``most``, giving back one at a time.

    Only the loops over at most BASE blocks can give back, which recurses; the blocks themselves are possessive, which iterates.
    """
    if most < BASE:
        return rf"(?:{UNIT}){{0,{most}}}"
    size, block = BASE, rf"(?:{UNIT}){{{BASE}}}+"
    while size * BASE <= most:
        size, block = size * BASE, rf"(?:{block}){{{BASE}}}+"
    full, rest = divmod(most, size)
    if rest == size - 1:
        return rf"(?:{block}){{0,{full}}}{up_to(rest)}"
    return rf"(?:(?:{block}){{{full}}}+{up_to(rest)}|(?:{block}){{0,{full - 1}}}{up_to(size - 1)})"


def cut_alternatives(limit: int) -> str:
    """The next piece of at most ``limit`` words.

    The alternatives stand in the order of the strength of their boundary: the end of the text, of a paragraph (if that leaves no
    piece under half full), of a sentence, of a line, of a clause, of a word. Each takes as many words as it may.
    """
    most, half = limit - 1, limit // 2
    return "|".join(
        (
            rf"(?:{UNIT}){{1,{limit}}}+\z",
            rf"(?:{UNIT}){{{half}}}+{up_to(max(0, most - half))}{NON}{{1,4000}}+[ \t\r]*+\n[ \t\r]*+\n{BLANK}*+",
            rf"{up_to(most)}{NON}{{0,4000}}{SENTENCE_END}{BLANK}++",
            rf"{up_to(most)}{NON}{{1,4000}}+[ \t\r]*+\n{BLANK}*+",
            rf"{up_to(most)}{NON}{{0,4000}}[,;:]{BLANK}++",
            rf"(?:{UNIT}){{1,{limit}}}+",
        )
    )


def cut_pattern(limit: int, room: int) -> str:
    """The pieces of a text: the first of up to ``limit`` words, the others with ``room`` words less, for their overlap."""
    return rf"\A{BLANK}*+(?:{cut_alternatives(limit)})|{cut_alternatives(max(1, limit - room))}"


def word_count(column):
    """Non-empty pieces between blanks, tabs and line breaks, with words of over 4,000 characters as the units cut."""
    return F.regexp_count(column, F.lit(rf"{NON}{{1,4000}}+"))


def is_long(text, limit: int):
    """word_count(text) > limit, decided for nearly all texts by a count without patterns: there are no more units
    than words and 4,000 characters."""
    words = F.size(F.array_remove(F.split(F.translate(text, "\t\r\n", "   "), " ", -1), ""))
    return F.when(words + F.length(text) / 4000 <= limit, False).otherwise(word_count(text) > limit)


def sentences(text):
    """An array of ``u, ends, n``: a text cut behind each sentence end, what each part is, and its words. The parts in order are the text."""
    parts = F.regexp_extract_all(text, F.lit(rf"(?s).+?(?:{SENTENCE_END}{BLANK}++|\z)"), F.lit(0))
    return F.transform(parts, lambda u: F.struct(u.alias("u"), u.rlike(rf"{SENTENCE_END}{BLANK}++\z").alias("ends"), word_count(u).alias("n")))


def widest_two(parts, limit: int):
    """The words of the longest two neighbouring sentences of a text that an overlap has room for."""
    two = F.transform(parts, lambda p, i: F.when(p["ends"], p["n"] + F.coalesce(F.get(parts, i - 1)["n"], F.lit(0))).otherwise(0))
    return F.coalesce(F.array_max(F.filter(two, lambda n: n <= int(limit * ROOMS[-1]))), F.lit(0))


def _bodies(text, widest, limit: int):
    rooms = [max(1, int(limit * r)) for r in ROOMS]
    cut = lambda room: F.regexp_extract_all(text, F.lit(cut_pattern(limit, room)), F.lit(0))
    out = F.when(widest <= rooms[0], cut(rooms[0]))
    for room in rooms[1:-1]:
        out = out.when(widest <= room, cut(room))
    return out.otherwise(cut(rooms[-1]))


def _pieces(bodies, limit: int):
    """An array of ``overlap, body``: each body with the two sentences before its cut, and what stands between them and the cut."""

    def behind(body, i):
        # bodies are no shorter than a quarter of the limit, so four of them hold all that has room
        before = F.array_join(F.slice(bodies, F.greatest(i - 3, F.lit(1)), F.least(i, F.lit(4))), "")
        return F.struct(body.alias("body"), (F.lit(limit) - word_count(body)).alias("room"), F.when(i > 0, sentences(before)).alias("parts"))

    def choose(piece):
        parts = piece["parts"]
        count = F.size(parts)
        # where a sentence begins: behind one that ended, or the text's beginning
        full = F.filter(F.transform(parts, lambda p, i: F.when(p["ends"], i)), lambda i: i.isNotNull())

        def tail(back: int):
            at = F.get(full, F.greatest(F.size(full) - back, F.lit(0)))
            return F.when(F.size(full) > 0, F.slice(parts, at + 1, count - at))

        words = lambda xs: F.aggregate(xs, F.lit(0), lambda s, p: s + p["n"])
        text = lambda xs: F.array_join(F.transform(xs, lambda p: p["u"]), "")
        fits = lambda xs: F.coalesce(words(xs) <= piece["room"], F.lit(False))
        overlap = F.when(fits(tail(2)), text(tail(2))).when(fits(tail(1)), text(tail(1))).otherwise(F.lit(""))
        return F.struct(F.coalesce(overlap, F.lit("")).alias("overlap"), piece["body"].alias("body"))

    return F.transform(F.transform(bodies, behind), choose)


def split_oversized(rows: DataFrame, key: str = "id", text: str = "document", limit: int = 500) -> DataFrame:
    """``id, piece_no, pieces, words, overlap_words, text``: every distinct record in pieces of at most ``limit`` words.

    A record within the limit is one piece, as it is. Others are consumed by cut_pattern; each later piece opens with the two
    sentences before its cut, and with what stands between them and the cut. Room for the longest two of the text is kept
    in all pieces but the first, as long as that is no more than three quarters of the limit; where two do not fit there is one, or none. A
    text without sentences has no overlaps. Every piece is a stretch of its text, and the bodies in order, which are the pieces
    without their overlaps, are the text. Null keys and texts are left out; an empty text is one piece of 0 words.
    """
    named = rows.select(F.col(key).alias("id"), F.col(text).alias("text")).dropna()
    short = named.filter(~is_long(F.col("text"), limit)).distinct()
    whole = short.select("id", F.lit(0).alias("piece_no"), F.lit(1).alias("pieces"), word_count("text").alias("words"), F.lit(0).alias("overlap_words"), "text")
    return whole.unionByName(_cut(named.filter(is_long(F.col("text"), limit)).distinct(), limit))


def _cut(long: DataFrame, limit: int) -> DataFrame:
    widest = let(sentences(F.col("text")), lambda parts: widest_two(parts, limit))
    cut = long.withColumn("parts", let(let(widest, lambda w: _bodies(F.col("text"), w, limit)), lambda bodies: _pieces(bodies, limit)))
    each = cut.select("id", F.size("parts").alias("pieces"), F.posexplode_outer("parts").alias("piece_no", "p"))  # never empty; without outer a filter on it would be pushed down that cuts again
    joined = F.concat("p.overlap", "p.body")
    return each.select("id", "piece_no", "pieces", word_count(joined).alias("words"), word_count("p.overlap").alias("overlap_words"), joined.alias("text"))


def oversized_ids(rows: DataFrame, key: str = "id", text: str = "document", limit: int = 500) -> DataFrame:
    """``id`` of the records that split_oversized cuts and whose text has more than ``limit`` words."""
    named = rows.select(F.col(key).alias("id"), F.col(text).alias("text")).dropna()
    cut = _cut(named.filter(is_long(F.col("text"), limit)).distinct(), limit).filter("piece_no = 1")  # a filter on pieces would be pushed below the cutting, which it would repeat
    whole_words = F.size(F.array_remove(F.split(F.translate("text", "\t\r\n", "   "), " ", -1), "")) > limit  # word_count cuts words of over 4,000 characters
    return cut.select("id").join(named.filter(whole_words).select("id").distinct(), "id").distinct()
