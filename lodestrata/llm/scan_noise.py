"""Problem 5: text of scanned pages repaired into continuous paragraphs.

Word counts and skip-gram vectors are learnt from the whole collection. A word is linked to the more frequent words that a plausible
confusion of glyphs makes it from; which of them is meant, and whether any, is decided where the word stands, by how much more frequent it is and how much
nearer its vector is to those of the words around. In each scanned document the furniture of the
pages is told from its text, words broken across lines are put together, misread words corrected, and the lines put together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.session import settle

# What scanning prints for what was there.
GLYPHS = [
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("@", "a"), ("5", "s"), ("9", "g"), ("8", "b"), ("6", "b"), ("3", "e"), ("2", "z"), ("4", "a"), ("7", "t"),
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("b", "h"), ("h", "b"), ("rn", "m"), ("m", "rn"), ("ri", "n"), ("n", "ri"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("u", "ii"), ("vv", "w"), ("w", "vv"), ("u", "ll"), ("ll", "u"), ("li", "h"), ("nn", "m"), ("in", "m"), ("i", "l"), ("l", "i"), ("v", "y"), ("y", "v"), ("n", "u"), ("u", "n"), ("q", "g"), ("o", "c"), ("c", "o"),
]
HARD = {"0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "!", "|", "@"}
# Words that hold a sentence together, of which a running title has none.
FUNCTION = frozenset("a an the of and is are was were it its that this these in on at by to for with as our we one each both if when since without near over under after before compared be not no which who what would has have had but or from while although because so than then there here does do".split())
JOINING = frozenset("and or to und oder bis et ou y o e nor".split())
TOKEN = re.compile(r"[@!|]?[^\W_]+(?:[@!|][^\W_]+)*")
NUMBER = re.compile(r"\s*(?:[-–—] ?\d{1,5} ?[-–—]|\[\d{1,5}\]|\d{1,5}|[ivxlc]{1,8}|[Pp]\S{2,4} \d{1,5}(?: [o0]f \d{1,5})?)\s*")
FORMULA = re.compile(r"\s*[(\[]\d{1,3}(?:\.\d{1,3})+[a-z]?[)\]]\s*")
HYPHENS = tuple("-¬­‐‑")
STOPS = tuple(".!?:;")
BROKEN = re.compile(r"[^\W\d_]([-¬­‐‑])\s*$")


def terminal(line: str) -> bool:
    """Whether a line ends in a stop, quotes and brackets behind it aside."""
    return not line[-1:].isalnum() and line.rstrip().rstrip("\"')]»")[-1:] in STOPS


def broken(line: str):
    """The match of a hyphen behind a letter at a line's end."""
    return BROKEN.search(line) if line.rstrip()[-1:] in HYPHENS else None


#: Characters that show nothing: joiners, and soft hyphens that are not where a line breaks.
UNSEEN = re.compile("[\u200b-\u200d\u2060\ufeff]|\u00ad(?![ \t]*(?:\n|$))")
DIGIT = re.compile(r"\d+")
NUMBER_BEFORE, NUMBER_BEHIND = re.compile(r"^(?:\d{1,5}|[ivxlc]{1,8})\s+(?=\S)"), re.compile(r"\s+(?:\d{1,5}|[ivxlc]{1,8})$")
PART_NUMBER = re.compile(r"^[^\W\d_]\S{2,8} \d{1,3}\.\s+(?=\S)")
NO_TITLE = re.compile(r"[.,;:?]|[-¬­‐]$")
LOWER, UPPER = (bytes(filter(test, range(128))) for test in (lambda c: chr(c).islower(), lambda c: chr(c).isupper()))
ITEM = re.compile(r"\s*(?:[•*+-]|\d{1,3}[.)])\s+\S")
UNHARD = str.maketrans("0158!|@", "olsbila")
BY_SIGN: dict[str, list[tuple[str, str]]] = {}
LETTERS: dict[str, list[str]] = {}
for _wrong, _right in GLYPHS:
    if _wrong in HARD:
        LETTERS.setdefault(_wrong, []).append(_right)
    else:
        BY_SIGN.setdefault(_wrong[0], []).append((_wrong, _right))
#: The vocabulary is that of the most frequent words, of at most so many in all: all words of a collection that has no more.
VOCABULARY = 500_000
#: Words of more characters are not counted.
LONGEST = 40
#: Bytes of text that are counted or subsampled at once.
PORTION = 1 << 24
VECTOR, WINDOW = 24, 3
#: Words of a part of the training; the vectors of the parts are averaged after their pass.
PART = 1_000_000
#: Words of a larger share than this are seen less often in training, by the root of how much larger, as skip-gram training has it. It lets the
#: windows reach the words that tell something; but no word is thinned below so many occurrences.
SUBSAMPLE, AT_LEAST = 2e-5, 200
#: Words to either side whose vectors make up the context of a word.
AROUND = 3
#: In even contexts the word meant must be ten times as frequent as the one read (one in log10); each unit of cosine by which its vector is nearer to
#: the context counts like this many powers of ten, up to one: from a hundredfold on frequency decides, below LINKED times nothing does.
TENFOLD, NEARER, LINKED = 1.0, 2.0, 3
NOISE = "furniture broken misread".split()


class Words:
    """The vocabulary: counts, the least count in it, unit vectors of its more frequent words, and the short lines that recur."""

    def __init__(self, counts: dict[str, int], least: int, index: dict[str, int], vectors: np.ndarray, lines: frozenset = frozenset()):
        self.counts, self.least, self.index, self.lines = counts, least, index, lines
        self.memory: dict[str, list[str]] = {}
        self.sound: set[str] = set()  # words known to be no misreadings
        # what all words have in common is taken off, and frequent words count less in a context (smooth inverse frequency)
        often = np.array([counts.get(w, 1) for w in index], float)
        share = often / max(1.0, often.sum())
        own = vectors - share @ vectors if len(index) else vectors
        self.vectors = (own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        self.weight = 1e-3 / (1e-3 + share)

    def seen(self, word: str) -> int:
        """How often a word occurs; of a word that is not in the vocabulary, how often it may at most."""
        return self.counts.get(word) or max(1, self.least - 1)

    def neighbours(self, word: str) -> list[str]:
        """LINKED times more frequent words from which one confusion makes this one, or up to three if all put digits or signs for letters."""
        known = self.memory.get(word)
        if known is not None:
            return known
        enough = LINKED * self.seen(word)
        found: list[str] = []
        hard = sum(map(HARD.__contains__, word))
        if not hard:
            for at, sign in enumerate(word):
                for wrong, right in BY_SIGN.get(sign, ()):
                    if word.startswith(wrong, at):
                        new = word[:at] + right + word[at + len(wrong) :]
                        if len(new) >= 4 and self.counts.get(new, 0) >= enough and new not in found:
                            found.append(new)
        elif hard <= 3:
            forms = [""]  # every digit and sign as each letter that it may be
            for sign in word:
                forms = [f + right for f in forms for right in (LETTERS.get(sign, ()) if sign in HARD else (sign,))]
            found = [f for f in dict.fromkeys(forms) if len(f) >= 3 and self.counts.get(f, 0) >= enough]
        if len(self.memory) < 200_000:
            self.memory[word] = found
        return found

    def suspect(self, word: str) -> bool:
        """Whether a word may be a misreading."""
        if len(word) > 2 and not word.isdigit() and any(map(str.isalpha, word)) and self.neighbours(word):
            return True
        if len(self.sound) < 200_000:
            self.sound.add(word)
        return False

    def nearness(self, word: str, context: np.ndarray) -> float:
        """The cosine of a word's vector and a context's; 0, which unrelated words have, if the word is too rare for a vector."""
        at = self.index.get(word)
        return 0.0 if at is None else float(self.vectors[at] @ context)

    def correct(self, word: str, context: list[str]) -> str | None:
        """The word that is meant if this one is a misreading: a noisy channel of frequency and nearness to the context.

        That a word fits its context better than the one meant counts as far as their vectors differ: a misreading that came often enough for a vector
        is used like the word it stands for."""
        found = self.neighbours(word)
        if not found:
            return None
        if len(found) == 1 and np.log10(self.counts[found[0]] / self.seen(word)) >= TENFOLD + 1:
            return found[0]  # as the context counts one power of ten at most
        near = [self.index[c] for c in context if c in self.index]
        around = self.weight[near] @ self.vectors[near] if near else np.zeros(self.vectors.shape[1])
        around = around / (np.linalg.norm(around) or 1.0)
        own, at = self.nearness(word, around), self.index.get(word)

        def score(c: str) -> float:
            nearer = self.nearness(c, around) - own
            if nearer < 0 and at is not None and c in self.index:
                nearer *= (1 - float(self.vectors[at] @ self.vectors[self.index[c]])) / 2
            return np.log10(self.counts[c] / self.seen(word)) + min(1.0, max(-1.0, NEARER * nearer))

        best = max(found, key=score)
        return best if score(best) >= TENFOLD - 1e-9 else None


def plain_line(line: str) -> str:
    """A line with all numbers alike, as it is compared between pages."""
    return DIGIT.sub("9", line.strip())


def _title(line: str) -> bool:
    text = line.strip()
    if text[:1].isdecimal() or text[:1] in "ivxlc":
        text = NUMBER_BEFORE.sub("", text)
    if text[-1:].isdecimal() or text[-1:] in "ivxlc":
        text = NUMBER_BEHIND.sub("", text)
    if "." in text:
        text = PART_NUMBER.sub("", text)
    if not text or len(text) > 80 or not (text[0].isupper() or text[0] in "0156") or NO_TITLE.search(text) or text.endswith("!"):
        return False
    words = text.split()
    if not 1 <= len(words) <= 8 or any(w.lower().translate(UNHARD) in FUNCTION for w in words):
        return False
    return True


def _numbered(line: str) -> bool:
    return bool(re.match(r"\s*(?:\d{1,5}|[ivxlc]{1,8})\s+\D", line) or re.search(r"\D\s(?:\d{1,5}|[ivxlc]{1,8})\s*$", line))


def _cases(line: str) -> tuple[int, int]:
    """How many letters are upper case, and lower case."""
    if line.isascii():
        signs = line.encode()
        return len(signs) - len(signs.translate(None, UPPER)), len(signs) - len(signs.translate(None, LOWER))
    return sum(map(str.isupper, line)), sum(map(str.islower, line))


def line_kinds(lines: list[str], known: frozenset = frozenset()) -> list[str] | None:
    """``blank, furniture, formula, heading, item`` or ``text`` for each line; None if the document is not scanned text."""
    width = sorted(len(x) for x in lines)[int(0.9 * (len(lines) - 1))]
    first = []
    for line in lines:
        if len(line) > 12 and (line[0].islower() or line[0].isalpha() and line[1].islower() and (", " in line or ". " in line[14:])):
            first.append("text")  # what the rules below come to for most lines
            continue
        upper, lower = _cases(line)
        capitals = upper > 0.8 * (upper + lower)
        kind = "blank" if not line.strip() else "formula" if FORMULA.fullmatch(line) else "number" if NUMBER.fullmatch(line) else "title" if _title(line) and (len(line.strip()) <= 0.97 * width or capitals or _numbered(line)) else "heading" if capitals and upper > 3 and not terminal(line) else "item" if ITEM.match(line) else "text"
        first.append(kind)
    text = [i for i, k in enumerate(first) if k in ("text", "item")]
    wraps = sum(1 for i, j in zip(text, text[1:]) if not terminal(lines[i]) and (lines[j][:1].islower() or broken(lines[i])))
    long = sorted(len(lines[i]) for i in text)
    if wraps < 2 or wraps < 0.25 * (len(text) - 1) or long[len(long) // 2] < 35:
        return None
    often = Counter(plain_line(x) for x, k in zip(lines, first) if k != "text" or len(x) <= 0.8 * width)

    def footer(i: int) -> bool:
        line = lines[i].strip()
        return first[i] == "text" and len(line) <= 0.75 * width and line[:1].isupper() and not terminal(line) and not broken(line) and len(line.split()) <= 7 and (plain_line(line) in known or often[plain_line(line)] > 1)

    apart = [k in ("number", "title") for k in first]
    for _ in range(2):
        for i in range(len(lines)):
            if not apart[i] and (i and apart[i - 1] or i + 1 < len(lines) and apart[i + 1]) and footer(i):
                apart[i] = True
    kinds = ["text" if k == "title" or k == "number" else k for k in first]
    i = 0
    while i < len(lines):
        if not apart[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(lines) and (apart[j + 1] or first[j + 1] == "blank" and j + 2 < len(lines) and apart[j + 2]):
            j += 1
        before = next((lines[k] for k in range(i - 1, -1, -1) if first[k] == "text"), "")
        after = next((lines[k] for k in range(j + 1, len(lines)) if first[k] == "text"), "")
        cuts = bool(before) and not terminal(before) or after[:1].islower()
        paged = any(first[k] == "number" or first[k] == "title" and _numbered(lines[k]) for k in range(i, j + 1))
        for k in range(i, j + 1):
            if first[k] != "blank":
                kinds[k] = "furniture" if paged or cuts or often[plain_line(lines[k])] > 1 else "heading"
        i = j + 1
    return kinds


def _cased(word: str, like: str) -> str:
    letters = [c for c in like if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return word.upper()
    return word[:1].upper() + word[1:] if letters and letters[0].isupper() and like[:1].isalpha() else word


#: Bytes of Latin-1 without what stands between tokens, and with the ends of lines.
IN_TOKEN = bytes(c if chr(c).isalnum() or chr(c) in "@!|" else 32 for c in range(256))
IN_LINE = bytes(c if chr(c) == "\n" else IN_TOKEN[c] for c in range(256))


def in_tokens(text: str, table: bytes) -> str | None:
    """The text with blanks for what stands between tokens, character for character; None if only the pattern can tell: letters or digits are of more
    than a byte, or the signs of a token stand beside such characters."""
    try:
        plain = text.encode("latin-1")
    except UnicodeEncodeError:
        if any(c in text for c in "@!|") or any(c > "\xff" and c.isalnum() for c in set(text)):
            return None
        plain = text.encode("latin-1", "replace")  # the question mark stands between tokens, too
    return plain.translate(table).decode("latin-1")


def line_tokens(text: str, lines: list[str]) -> Callable[[int], list[str]]:
    """What gives the tokens of a line, without the pattern if the line's letters and digits have one byte and it has no signs."""
    plain = in_tokens(text, IN_LINE)
    if plain is None:
        return lambda i: TOKEN.findall(lines[i])
    spaced = plain.split("\n")
    signs = any(c in plain for c in "@!|")
    return lambda i: TOKEN.findall(lines[i]) if signs and any(c in spaced[i] for c in "@!|") else spaced[i].split()


def analyse(text: str, words: Words) -> tuple[str, list[tuple[int, bool, bool, bool]]]:
    """The repaired text, and its lines with noise: number from 1, furniture, broken word, misread word."""
    seen = text if text.isascii() else UNSEEN.sub("", text)
    lines = seen.split("\n")
    kinds = line_kinds(lines, words.lines) if len(lines) >= 4 else None
    if kinds is None:
        return text, []
    noise = {i: [k == "furniture", False, False] for i, k in enumerate(kinds)}
    order = [i for i, k in enumerate(kinds) if k in ("text", "item", "heading", "formula")]
    running = [i for i in order if kinds[i] in ("text", "item")]
    tokens = line_tokens(seen, lines)
    found = {i: tokens(i) for i in order}
    joins: dict[int, str] = {}  # by line, what the sign at its end becomes
    whole: list[tuple[int, int, str]] = []  # first line, second line, a word broken across them
    joined: dict[int, set[int]] = {}  # by line, the tokens that are part of such a word
    for i, j in zip(running, running[1:]):
        sign = broken(lines[i])
        if not sign or not found[i]:
            continue
        if not found[j] or not lines[j].lstrip().startswith(found[j][0]):
            joins[i] = "keep"
            continue
        head, rest = found[i][-1], found[j][0]
        word, sure = (head + rest).lower(), sign[1] in "¬\u00ad"
        if rest.lower() in JOINING and not sure and word not in words.counts:
            joins[i] = "keep"
            continue
        noise[i][1] = True
        if sure or word in words.counts or words.neighbours(word) or not (head.lower() in words.counts and rest.lower() in words.counts):
            joins[i] = "join"
            whole.append((i, j, head + rest))
            joined.setdefault(i, set()).add(len(found[i]) - 1)
            joined.setdefault(j, set()).add(0)
        else:
            joins[i] = "hyphen"
    flat, base = [], {}
    suspects: list[tuple[int, int]] = []
    for i in order:
        base[i] = len(flat)
        low = list(map(str.lower, found[i]))
        flat += low
        if not words.sound.issuperset(low):
            suspects += [(i, k) for k, word in enumerate(low) if word not in words.sound and words.suspect(word) and k not in joined.get(i, ())]
    changes: dict[int, list[tuple[int, int, str]]] = {}

    def around(at: int, width: int = 1) -> list[str]:
        return flat[max(0, at - AROUND) : at] + flat[at + width : at + width + AROUND]

    for i, k in suspects:
        meant = words.correct(flat[base[i] + k], around(base[i] + k))
        if meant is not None:
            noise[i][2] = True
            span = [m.span() for m in TOKEN.finditer(lines[i])][k]
            changes.setdefault(i, []).append((*span, _cased(meant, found[i][k])))
    for i, j, token in whole:
        meant = words.correct(token.lower(), around(base[j] - 1, 2)) if any(map(str.isalpha, token)) else None
        if meant is None:
            continue
        size, word = len(found[i][-1]), token.lower()
        wrong = next((k for k, (a, b) in enumerate(zip(word, meant)) if a != b), min(len(word), len(meant)))
        noise[i if wrong < size else j][2] = True
        if wrong == size - 1 and not meant.endswith(word[size:]):
            noise[j][2] = True  # the glyphs confused stand on both sides of the break
        start = [m.span() for m in TOKEN.finditer(lines[i])][-1]
        changes.setdefault(i, []).append((*start, _cased(meant, token)))
        changes.setdefault(j, []).append((*TOKEN.search(lines[j]).span(), ""))
    listed = [(i + 1, *flags) for i, flags in sorted(noise.items()) if any(flags)]
    clean = list(lines)
    for i, spots in changes.items():
        for start, end, new in sorted(spots, reverse=True):
            clean[i] = clean[i][:start] + new + clean[i][end:]
    return reflow(clean, kinds, joins, [len(x) for x in lines]), listed


def _uncut(text: str, sign: str = "") -> str:
    """The text with another sign for a hyphen at its end."""
    return text[:-1] + sign if text[-1:] in HYPHENS else text


def reflow(lines: list[str], kinds: list[str], joins: dict[int, str], lengths: list[int]) -> str:
    """Paragraphs: text lines joined, furniture left out; headings, formula numbers and items stay apart."""
    texts = sorted(n for n, k in zip(lengths, kinds) if k == "text")
    width = texts[int(0.9 * (len(texts) - 1))] if texts else 0
    out: list[str] = []
    last = None
    for i, (line, kind) in enumerate(zip(lines, kinds)):
        if kind == "furniture":
            continue
        if kind == "blank":
            last = None
            continue
        line = line.strip()
        if kind in ("text", "item") and last is not None and kind != "item":
            how = joins.get(last)
            if how == "join":
                out[-1] = _uncut(out[-1]) + line
            elif how == "hyphen":
                out[-1] = _uncut(out[-1], "-") + line
            elif terminal(out[-1]) and lengths[last] < 0.8 * width:
                out.append(line)
            else:
                out[-1] += " " + line
        else:
            out.append(line)
        last = i if kind in ("text", "item") else None
    return "\n\n".join(out)


#: Of a line that may go on in the next: its start, or the end of the one before.
GOES_ON, BREAKS = re.compile(r"\n[^\W\d_A-Z]"), re.compile(r"[-¬­‐‑]\s*\n")
NINES = str.maketrans("012345678", "9" * 9)


def may_be_scanned(text):
    """False only for texts that line_kinds gives None for: no four lines, or no line that may go on in the next."""
    return (F.substring_index(text, "\n", 3) != text) & text.rlike(r"\n\p{Ll}|[-¬­‐‑]\s*\n")


LINE_JOIN = re.compile(r"[-¬­‐‑](?<=[^\W\d_][-¬­‐‑])[ \t]*\n[ \t]*(?=[^\W\d_])")


def spaced_words(text: str) -> tuple[str, bool]:
    """The tokens of a text in lower case between blanks, and whether these are single ones, of which each parts two tokens. Texts of one-byte letters
    without a pattern, as that is several times faster."""
    text = text.lower()
    if "\n" in text:
        text = LINE_JOIN.sub("", text)
    plain = in_tokens(text, IN_TOKEN)
    if plain is None:
        return " ".join(TOKEN.findall(text)), True
    if any(c in plain for c in "@!|"):
        return " ".join([w.strip("@!|") for w in plain.split()]), True
    return plain.strip(), False


def recurring_lines(text: str) -> list[str]:
    """The lines of a wrapped text as plain_line gives them, of 3 to 60 characters, if they are as short themselves or have a number."""
    if text.count("\n") < 3 or not (GOES_ON.search(text) or BREAKS.search(text)):
        return []
    if text.isascii():
        text = text.translate(NINES)
        while "99" in text:
            text = text.replace("99", "9")
    else:
        text = DIGIT.sub("9", text)
    return [x for y in text.split("\n") if (len(y) <= 60 or "9" in y) and 3 <= len(x := y.strip()) <= 60]


def _rows(kind: str, tokens: pa.Array, n: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.repeat(kind, len(tokens)), tokens.cast(pa.string()), n.cast(pa.int64())], ["kind", "token", "n"])


def portions(texts: pa.Array):
    """The texts in stretches of PORTION bytes, or one that is longer."""
    ends, start = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(ends, PORTION + (ends[start - 1] if start else 0), "right")))
        yield texts[start:end]
        start = end


def _count(batches):
    """By portion: the words of each text, their partial counts and those of the short lines of wrapped texts, and the number of all words. The words
    are split and counted in Arrow, where none becomes an object."""
    for portion in (p for batch in batches for p in portions(batch["text"])):
        texts, lines, kinds = ([], []), [], []
        for text in portion.to_pylist():
            spaced, single = spaced_words(text)
            texts[single].append(spaced)
            kinds.append(single)
            lines += recurring_lines(text)
        loose, single = (pa.array(x, pa.large_string()) for x in texts)
        split = [pc.ascii_split_whitespace(loose), pc.split_pattern(single, " ")]
        words = pa.concat_arrays([x.flatten() for x in split])
        contexts = pa.concat_arrays([pc.binary_join(split[0], pa.scalar(" ", pa.large_string())), single])
        yield _rows("context", contexts.take(pa.array(np.argsort(np.argsort(kinds, kind="stable")))), pa.repeat(0, len(contexts)))  # in their order
        yield _rows("running", pa.array([""]), pa.array([len(words)]))
        token, n = words.value_counts().flatten()
        counted = pa.array((0 < (size := pc.utf8_length(token).to_numpy())) & (size <= LONGEST))
        yield _rows("word", token.filter(counted), n.filter(counted))
        yield _rows("line", *pa.array(lines, pa.large_string()).value_counts().flatten())


def _subsampled(batches, keep: dict[str, float]):
    """The words of each text that the training is to see: those of ``keep`` by a chance drawn for their text and place, and all others."""
    shares = np.array([*keep.values(), 1.0])
    for texts in (p for batch in batches for p in portions(batch["token"])):
        lists = pc.split_pattern(texts, " ")
        words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy()
        at = pc.fill_null(pc.index_in(words, value_set=pa.array(list(keep), words.type)), len(keep)).to_numpy()
        kept = np.concatenate([np.random.default_rng(zlib.crc32(t.as_buffer())).random(n) for t, n in zip(texts, sizes.tolist())]) < shares[at]
        ends = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(sizes)])]
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(pa.array(kept)))], ["words"])


def least_count(counts: DataFrame, most: int | None = None) -> int:
    """The least count from which on there are at most ``most`` words. The counts come to the driver in steps of a hundredth (single ones up to
    128), so there are a few thousand whatever the collection."""
    most = VOCABULARY if most is None else most
    step = F.when(F.col("n") <= 128, F.col("n")).otherwise(128 + F.floor(F.log(F.col("n") / 128.0) / F.log1p(F.lit(0.01))))
    steps = counts.groupBy(step.alias("step")).agg(F.min("n").alias("low"), F.count(F.lit(1)).alias("words")).collect()
    least = words = 0
    for r in sorted(steps, key=lambda r: -r["low"]):
        words += r["words"]
        if words > most:
            return least or r["low"] + 1
        least = r["low"]
    return 1


def learn(named: DataFrame) -> Words:
    """Counts and skip-gram vectors of the words of all records, and the short lines that recur in the wrapped ones.

    What comes to the driver is bounded whatever the collection: VOCABULARY words, vectors for at most 100,000
    of them, and at most 100,000 lines.
    """
    from pyspark.ml.feature import Word2Vec

    read = settle(named.select("text").mapInArrow(_count, "kind string, token string, n bigint"))
    counts = settle(read.filter("kind != 'context'").groupBy("kind", "token").agg(F.sum("n").alias("n")))
    sums = {r["kind"]: r["n"] for r in counts.filter("kind != 'word'").groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    number, running = sums.get("line", 0), sums.get("running", 0)
    least, recurs = least_count(counts.filter("kind = 'word'")), max(5, int(np.ceil(number * 1e-5)))
    vocabulary = {r["token"]: r["n"] for r in counts.filter((F.col("kind") == "word") & (F.col("n") >= least)).toLocalIterator()}
    known = frozenset(r["token"] for r in counts.filter((F.col("kind") == "line") & (F.col("n") >= recurs)).toLocalIterator())
    index, vectors = {}, np.zeros((0, VECTOR), np.float32)
    context = read.filter("kind = 'context'").select("token")
    enough = max(5, int(np.ceil(running * 1e-5)))
    if running >= 1000:
        parts = max(1, -(-int(running) // PART))  # by the words, so that clusters of any size learn alike
        keep = {w: max(float(np.sqrt(SUBSAMPLE * running / n)), min(1.0, AT_LEAST / n)) for w, n in vocabulary.items() if n > SUBSAMPLE * running}
        # at most 1 / SUBSAMPLE words; settled, as the training reads it twice
        context = settle(context.mapInArrow(partial(_subsampled, keep=keep), "words array<string>"))
        model = Word2Vec(vectorSize=VECTOR, minCount=enough, numPartitions=parts, stepSize=0.05, maxIter=1, seed=42, windowSize=WINDOW, inputCol="words", outputCol="v").fit(context)
        found = [(r["word"], r["vector"].toArray()) for r in model.getVectors().toLocalIterator()]
        index = {w: i for i, (w, _) in enumerate(found)}
        vectors = np.array([v for _, v in found], np.float32)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Words(vocabulary, least, index, vectors, known)


def _analysed(named: DataFrame, words: Words) -> DataFrame:
    """``id, text, noise`` of records that may be scanned."""
    shared = named.sparkSession.sparkContext.broadcast(words)

    def work(batches):
        words = shared.value
        for batch in batches:
            done = [analyse(t, words) for t in batch["text"].to_pylist()]
            ends = pa.array(np.cumsum([0, *(len(lines) for _, lines in done)]), pa.int32())
            flat = pa.array([n[0] for _, lines in done for n in lines], pa.int64()), *(pa.array([n[k] for _, lines in done for n in lines], pa.bool_()) for k in range(1, 1 + len(NOISE)))
            noise = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, ["line_no", *NOISE]))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array([t for t, _ in done], batch["text"].type), noise], ["id", "text", "noise"])

    line = T.StructType([T.StructField("line_no", T.LongType()), *(T.StructField(n, T.BooleanType()) for n in NOISE)])
    return named.mapInArrow(work, T.StructType([T.StructField("id", named.schema["id"].dataType), T.StructField("text", T.StringType()), T.StructField("noise", T.ArrayType(line))]))


def repair(rows: DataFrame, key: str = "id", text: str = "document") -> DataFrame:
    """``id, text, noise``: every distinct record repaired; noise is an array of ``line_no, furniture, broken, misread``.

    A record that is no scanned text comes out as it is, with no noise. Null keys and texts are left out; an empty
    table gives no rows.
    """
    named = rows.select(F.col(key).alias("id"), F.col(text).alias("text")).dropna()
    done = _analysed(named.filter(may_be_scanned(F.col("text"))).distinct(), learn(named))
    rest = named.filter(~may_be_scanned(F.col("text"))).distinct().withColumn("noise", F.array().cast(done.schema["noise"].dataType))
    return done.unionByName(rest)


def noisy_lines(rows: DataFrame, key: str = "id", text: str = "document") -> DataFrame:
    """``id, line_no`` of the lines with furniture, a broken word or a misread word, as repair finds and mends them."""
    return repair(rows, key, text).select("id", F.explode("noise.line_no").alias("line_no")).distinct()
