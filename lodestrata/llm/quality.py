"""Problem 10: statistics of each text that tell prose from lists, tables and junk.

A text is cut into chunks, each chunk counted on its own, and the counts merged by an associative rule. What a cut
splits, a word, a line or a block of lines, stays open at the chunk's edges as state that the merge closes, so
the result does not depend on where the cuts fell.
"""

from __future__ import annotations

import json
import re
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk, chunks of a text that one task counts, and states merged at a time.
CHUNK, SPREAD, FAN_IN = 2048, 512, 128
# The commonest words of four languages.
COMMON = frozenset(
    "the of and is a not it that for in are with as see both does our have which to at by what would no same each but while on an or be "
    "this was were they we if when once has been from how one can after over near without "
    "der die das den dem des und ist nicht ein eine einer von mit auf zu im bei als auch es wie wird werden sich wenn weil obwohl um "
    "le la les et est pas un une du de que dans pour sur par avec se bien soit au aux ce qui ne plus comme pendant "
    "el los las y del en con por para al su aunque sea porque como lo durante entre".split()
)
MARKER = re.compile(r"\s*(?:https?://|[-*+•]\s|\[\d+\]|\d{1,3}[.)]\s|\(?[a-z0-9]{1,3}\)\s)")
EDGE = 64
#: Words a line, in mean, above which lines without sentences are no list.
LONG_LINE = 12
ENDED = re.compile(r"[.!?][\"')»\]]*$")
WORD_COUNTS = ("words", "letters", "digits", "symbols", "common", "alphabetic", "numeric", "word_chars")


def word_state(text: str) -> list:
    """Length, letters, digits, symbols of a piece of a word, and its text if short."""
    letters, digits = sum(map(str.isalpha, text)), sum(map(str.isdigit, text))
    return [len(text), letters, digits, len(text) - letters - digits, text if len(text) <= EDGE else None]


def join_words(a: list | None, b: list | None) -> list | None:
    if not a or not b:
        return a or b
    text = a[4] + b[4] if a[4] is not None and b[4] is not None and a[0] + b[0] <= EDGE else None
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3], text]


def count_word(state: list | None) -> list:
    """WORD_COUNTS of one whole word."""
    if not state or not state[0]:
        return [0] * 8
    length, letters, digits, symbols, text = state
    core = text.strip(".,;:!?()\"'«»¿¡").lower() if text else ""
    core = core.rpartition("'")[2] or core
    plain = letters >= 1 and digits == 0 and (letters >= 0.7 * length)
    return [1, letters, digits, symbols, int(core in COMMON and not (text and len(text) > 1 and text.isupper())), int(plain), int(digits > letters), length]


def add(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b)]


FIELD = 40
MASK = (1 << FIELD) - 1


class PackedCounts(dict):
    """By word its WORD_COUNTS as fields of one integer, so that the counts of many words are one sum."""

    def __missing__(self, word: str) -> int:
        packed = sum(n << FIELD * k for k, n in enumerate(count_word(word_state(word)))) if word else 0
        if len(self) < 300_000 and len(word) <= EDGE:
            self[word] = packed
        return packed


PACKED = PackedCounts()
BLANK = re.compile(r"[\t\r\f\v\u00a0]")


def words_of_line(text: str) -> list[str]:
    return (BLANK.sub(" ", text) if BLANK.search(text) else text).split(" ")


def count_words(words: list[str]) -> list:
    total = sum(map(PACKED.__getitem__, words))
    return [total >> FIELD * k & MASK for k in range(8)]


def line_state(text: str) -> dict:
    """A piece of a line: edges ``pre`` and ``post`` are words that may go on; ``mid`` is None while all is one word."""
    parts = words_of_line(text)
    state = {"chars": len(text), "marks": [text.count("|"), text.count("\t"), text.count(";"), text.count(",")], "head": text[:24], "tail": text.rstrip()[-4:] if text.strip() else "", "dots": text.count("."), "pre": word_state(parts[0]) if parts[0] else None, "mid": None, "post": None}
    if len(parts) > 1:
        state["mid"] = count_words(parts[1:-1])
        state["post"] = word_state(parts[-1]) if parts[-1] else None
    return state


def join_lines(a: dict, b: dict) -> dict:
    out = {k: a[k] + b[k] for k in ("chars", "dots")} | {"marks": add(a["marks"], b["marks"]), "head": (a["head"] + b["head"])[:24], "tail": (a["tail"] + b["tail"])[-4:] if b["tail"] else a["tail"]}
    if a["mid"] is None and b["mid"] is None:
        return out | {"pre": join_words(a["pre"], b["pre"]), "mid": None, "post": None}
    if a["mid"] is None:
        return out | {"pre": join_words(a["pre"], b["pre"]), "mid": b["mid"], "post": b["post"]}
    if b["mid"] is None:
        return out | {"pre": a["pre"], "mid": a["mid"], "post": join_words(a["post"], b["pre"])}
    return out | {"pre": a["pre"], "mid": add(add(a["mid"], count_word(join_words(a["post"], b["pre"]))), b["mid"]), "post": b["post"]}


#: Of whole lines: lines, blank, ending in punctuation, list items, table rows; then WORD_COUNTS, the longest line apart.
LINE_COUNTS = ("lines", "blank_lines", "punctuated", "items", "rows", *WORD_COUNTS)


def judge_line(words: list, chars: int, marks: list, dots: int, head: str, tail: str) -> tuple[list, list, bool]:
    """Counts of a whole line; its block state ``chars, words, common``; whether it stands alone rather than in a block."""
    n, pipes, tabs, semis, commas = words[0], *marks
    if not n:
        return [1, 1, 0, 0, 0, *words], [chars, 0, 0], False
    marker = MARKER.match(head)
    leader = dots >= 6 and dots > n  # of a table of contents
    listed = commas >= 3 and commas >= 0.2 * n and words[4] < 0.1 * n
    item = bool(marker) or leader or listed  # a bullet or number, the leader of a table of contents, or a line of names with commas
    own = count_word(word_state(marker.group().strip())) if marker else [0] * 8  # "(a)" is no article
    row = pipes >= 2 or tabs >= 1 or semis >= 2 or (words[6] > 0.5 * n and not leader)
    ended = not row and bool(ENDED.search(tail))
    alone = item or row or words[5] < 0.5 * n
    return [1, 0, int(ended), int(item), int(row), *words], [chars, n - own[0], words[4] - own[4]], alone


def close_line(line: dict) -> tuple[list, list, bool]:
    words = add(count_word(line["pre"]), count_word(line["post"]))
    return judge_line(add(words, line["mid"] or [0] * 8), line["chars"], line["marks"], line["dots"], line["head"], line["tail"])


def whole_line(text: str) -> tuple[list, list, bool]:
    """close_line of a line that is known whole."""
    marks = [text.count("|"), text.count("\t"), text.count(";"), text.count(",")]
    return judge_line(count_words(words_of_line(text)), len(text), marks, text.count("."), text[:24], text.rstrip()[-4:])


def language_chars(block: list) -> int:
    """The characters of a block of lines if it reads as sentences: enough of its words are such as hold a sentence together."""
    chars, words, common = block
    return chars if words >= 3 and common >= 0.12 * words else 0


EMPTY = [0, 0, 0]


def lines_state(lines: list[tuple[list, list, bool]]) -> dict:
    """Whole lines in order: counts, closed language characters, and the blocks still open at both ends."""
    out = {"counts": [0] * len(LINE_COUNTS), "language": 0, "lead": EMPTY, "trail": EMPTY, "broken": False}
    for counts, block, alone in lines:
        block = [block[0] + 1, *block[1:]]  # its line break
        out["counts"] = add(out["counts"], counts)
        if alone:
            out["language"] += language_chars(block)
            if out["broken"]:
                out["language"] += language_chars(out["trail"])
                out["trail"] = EMPTY
            out["broken"] = True
        elif out["broken"]:
            out["trail"] = add(out["trail"], block)
        else:
            out["lead"] = add(out["lead"], block)
    return out


def join_blocks(a: dict, b: dict) -> dict:
    out = {"counts": add(a["counts"], b["counts"]), "language": a["language"] + b["language"], "broken": a["broken"] or b["broken"]}
    if a["broken"] and b["broken"]:
        return out | {"language": out["language"] + language_chars(add(a["trail"], b["lead"])), "lead": a["lead"], "trail": b["trail"]}
    if a["broken"]:
        return out | {"lead": a["lead"], "trail": add(a["trail"], b["lead"])}
    return out | {"lead": add(a["lead"], b["lead"]), "trail": b["trail"]}


def chunk_state(text: str) -> dict:
    """What a chunk is: the line it ends and the line it begins (one if it has no break), and the whole lines between."""
    lines = text.split("\n")
    if len(lines) == 1:
        return {"first": line_state(text), "rest": None, "last": None}
    return {"first": line_state(lines[0]), "rest": lines_state(list(map(whole_line, lines[1:-1]))), "last": line_state(lines[-1])}


def join_chunks(a: dict, b: dict) -> dict:
    """The state of two chunks that follow each other. Associative, not commutative."""
    if a["rest"] is None and b["rest"] is None:
        return {"first": join_lines(a["first"], b["first"]), "rest": None, "last": None}
    if a["rest"] is None:
        return b | {"first": join_lines(a["first"], b["first"])}
    if b["rest"] is None:
        return a | {"last": join_lines(a["last"], b["first"])}
    seam = lines_state([close_line(join_lines(a["last"], b["first"]))])
    return {"first": a["first"], "rest": join_blocks(join_blocks(a["rest"], seam), b["rest"]), "last": b["last"]}


STATISTICS = (
    "n_chars bigint, n_words bigint, n_lines bigint, mean_word_length double, symbol_ratio double, digit_ratio double, punctuated_share double, "
    "common_share double, item_share double, row_share double, language_share double, kind string, mostly_language boolean"
)


def statistics(state: dict) -> list:
    """The values of STATISTICS. Ratios without anything to divide by are 0."""
    rest = lines_state([close_line(state["first"])])
    if state["rest"] is not None:
        rest = join_blocks(join_blocks(rest, state["rest"]), lines_state([close_line(state["last"])]))
    language = rest["language"] + language_chars(rest["lead"]) + language_chars(rest["trail"])
    c = dict(zip(LINE_COUNTS, rest["counts"]))
    chars = state["chars"]
    full = c["lines"] - c["blank_lines"]
    over = lambda x, y: x / y if y else 0.0
    share = min(1.0, over(language, chars + 1))  # each line counts its break, the last one's is not there
    rows, items = over(c["rows"], full), over(c["items"], full)
    kind = "prose" if share >= 0.5 or not full else "table" if rows >= 0.5 else "list" if items >= 0.5 else "junk" if over(c["alphabetic"], c["words"]) < 0.5 or over(c["common"], c["words"]) >= 0.01 or c["words"] > LONG_LINE * full else "list"
    return [chars, c["words"], c["lines"], over(c["word_chars"], c["words"]), over(c["symbols"], c["word_chars"]), over(c["digits"], c["word_chars"]), over(c["punctuated"], full), over(c["common"], c["words"]), items, rows, share, kind, not chars or share >= 0.5]


def join_all(states: list[dict]) -> dict:
    """The states of neighbouring chunks merged two by two, level by level."""
    while len(states) > 1:
        states = [join_chunks(*two) | {"chars": two[0]["chars"] + two[1]["chars"]} if len(two) == 2 else two[0] for two in (states[i : i + 2] for i in range(0, len(states), 2))]
    return states[0]


def counted(chunk: str) -> dict:
    return chunk_state(chunk) | {"chars": len(chunk)}


def text_state(text: str, chunk: int) -> dict:
    """The state of a text from those of its chunks."""
    return join_all([counted(text[i : i + chunk]) for i in range(0, len(text), chunk)] or [counted("")])


NAMES = [x.split()[0] for x in STATISTICS.split(", ")]


def _derived(keys: pd.Series, states) -> pd.DataFrame:
    return pd.concat([keys.rename("key").reset_index(drop=True), pd.DataFrame([statistics(x) for x in states], columns=NAMES)], axis=1)


def _within(batches, chunk: int):
    """Texts whose chunks stay in one task."""
    for batch in batches:
        yield _derived(batch["key"], (text_state(t, chunk) for t in batch["text"]))


def _leaves(batches, chunk: int):
    """The states of the parts of texts that are spread."""
    for batch in batches:
        yield batch[["key", "row", "no"]].assign(state=[json.dumps(text_state(t, chunk)) for t in batch["part"]])


def _branches(batches):
    """Up to FAN_IN neighbouring states merged into one."""
    for batch in batches:
        states = [json.dumps(join_all([json.loads(x["state"]) for x in parts])) if len(parts) > 1 else parts[0]["state"] for parts in batch["parts"]]
        yield batch[["key", "row", "no"]].assign(state=states)


def _derive(batches):
    for batch in batches:
        yield _derived(batch["key"], map(json.loads, batch["state"]))


def text_quality(rows: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, spread: int = SPREAD) -> DataFrame:
    """One row a record: the key and STATISTICS.

    Every text is cut into chunks of ``chunk`` characters that are counted on their own and merged in a tree. The chunks
    of a text of more than ``spread`` of them are spread over all executors, and the tree grows over them, FAN_IN states at a time; three levels are enough
    for the longest text that a row can hold. How a text is cut or spread changes no result. Null texts are left out; a key may be null or come again, each row
    counts for itself; an empty text has zeros, kind prose and counts as language, there being nothing else in it.
    """
    named = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
    kind = dict(rows.dtypes)[key]
    result, shape = f"key {kind}, {STATISTICS}", f"key {kind}, row bigint, no int, state string"
    part = chunk * spread
    one = named.filter(F.length("text") <= part).mapInPandas(partial(_within, chunk=chunk), result)
    cut = named.filter(F.length("text") > part).select("key", F.monotonically_increasing_id().alias("row"), F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{part}}}"), F.lit(0)).alias("cut"))
    parts = cut.select("key", "row", F.posexplode("cut").alias("no", "part"))
    states = parts.repartition(F.col("row"), F.col("no")).mapInPandas(partial(_leaves, chunk=chunk), shape)
    for _ in range(3):
        near = states.groupBy("key", "row", F.floor(F.col("no") / FAN_IN).cast("int").alias("no")).agg(F.sort_array(F.collect_list(F.struct("no", "state"))).alias("parts"))
        states = near.mapInPandas(_branches, shape)
    return one.union(states.mapInPandas(_derive, result)).withColumnRenamed("key", key)


def not_language(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The keys of texts less than half of whose characters belong to sentences."""
    return text_quality(rows, key, text).filter("not mostly_language").select(key).distinct()
