"""Problem 4: text that prints alike brought to one form."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators.pairs import meetings, sharing
from lodestrata.session import settle

# Letters drawn exactly like a Latin one, by script.
TWINS = {
    "Cyrillic": dict(zip("АВЕІЈКМНОРСТУХҮаеіјорсухүӏ", "ABEIJKMHOPCTYXYaeijopcyxyl")),
    "Greek": dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧον", "ABEZHIKMNOPTYXov")),
    "Armenian": dict(zip("օսհոցզԼՕՏ", "ouhngqLOS")),
    "Cherokee": dict(zip("ᎠᎡᎢᎩᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏔᏕᏙᏚᏞᏟᏢᏦᏧᏴ", "DRTyAJEWMHYGhZbWSVSLCPKdB")),
    "Lisu": dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU")),
    "Coptic": dict(zip("ⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "HIKMNOPCTYXopc")),
}
# The same of letters that few languages use; a word is not respelt in a script for their sake.
RARE = {"Cyrillic": dict(zip("ЅԌԚԜѴѕһԁԛԝѵ", "SGQWVshdqwv")), "Greek": dict(zip("ϹͿϲϳ", "CJcj"))}
LATIN = dict(zip("ɡɑᴄᴏᴠᴡᴢꜱꞬ", "gacovwzsG"))
# Letters like a Latin one only inside a word of Latin letters.
NEARLY = dict(zip("αγικρσυωкпт", "ayikpouwknt"))
HYPHENS = dict.fromkeys("‐‑‒−˗﹣－⁃", "-")
# Unseen characters: joiners, marks of direction, variation selectors, fillers.
UNSEEN = regex.compile(r"[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff]")
BREAK_HYPHEN = regex.compile("­(?=[\r\n]|$)")
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: By script the Latin letters that its letters look like; every letter with its Latin twin; and back, by script.
LOOKS = {script: frozenset(table.values()) for script, table in TWINS.items()}
TO_LATIN = {own: latin for table in (*TWINS.values(), *RARE.values(), LATIN) for own, latin in table.items()}
FROM_LATIN = {script: {latin: own for own, latin in reversed((table | RARE.get(script, {})).items())} for script, table in TWINS.items()}
SCRIPTS = "Latin Cyrillic Greek Armenian Georgian Hebrew Arabic Syriac Devanagari Bengali Tamil Telugu Thai Lao Tibetan Khmer Ethiopic Cherokee Coptic Lisu Han Hiragana Katakana Hangul Bopomofo".split()
EXTENDED = {s: regex.compile(rf"\p{{scx={s}}}") for s in SCRIPTS}
#: Writing systems of several scripts, by script.
JOINT = {"Han": {"Japanese", "Korean", "Han with Bopomofo"}, "Hiragana": {"Japanese"}, "Katakana": {"Japanese"}, "Hangul": {"Korean"}, "Bopomofo": {"Han with Bopomofo"}}


@lru_cache(1 << 16)
def scripts_of(letter: str) -> frozenset:
    """The scripts that use a letter by its script extensions, and the writing systems that these belong to."""
    own = {s for s, p in EXTENDED.items() if p.match(letter)} or {"Other"}
    return frozenset(own.union(*(JOINT.get(s, ()) for s in own)))


@lru_cache(1 << 16)
def resolved(letter: str, rare: bool = False) -> frozenset:
    """The scripts in which a letter that looks like this one is at home. Letters that look alike have the same, whatever they are."""
    latin = TO_LATIN.get(letter, letter)
    if latin.isascii():
        return frozenset({"Latin"} | {s for s, looks in LOOKS.items() if latin in looks or rare and latin in RARE.get(s, {}).values()})
    return scripts_of(letter)


@lru_cache(1 << 16)
def plain_character(char: str) -> str:
    """A character without what makes it only another form: width, joining, font, kind of blank or hyphen."""
    if char in HYPHENS:
        return HYPHENS[char]
    if unicodedata.category(char) == "Zs":
        return " "
    kind, _, rest = unicodedata.decomposition(char).partition(" ")
    if kind in ("<wide>", "<narrow>", "<noBreak>", "<font>"):
        return "".join(plain_character(chr(int(x, 16))) for x in rest.split())
    if kind == "<compat>":
        parts = "".join(chr(int(x, 16)) for x in rest.split())
        if parts.isalpha() and (len(parts) > 1 or unicodedata.name(char, "").startswith(("ROMAN NUMERAL", "SMALL ROMAN NUMERAL"))):
            return parts
    return char


def letters_of(word: str) -> list[str]:
    return [c for c in word if unicodedata.category(c)[0] == "L"]


@lru_cache(1 << 16)
def choices(word: str) -> tuple[str, ...]:
    """The scripts that a word can be spelt in throughout, Latin first: the intersection of the resolved scripts of its letters.

    If it is empty, rare letters are let in, and then those that only look nearly Latin; still none, the word is of mixed scripts that are no look-alikes.
    """
    letters = letters_of(word)
    for rare in (False, True):
        shared = frozenset.intersection(*(resolved(c, rare) for c in letters)) if letters else frozenset()
        if shared:
            return tuple(sorted(shared, key=lambda s: (s != "Latin", s)))
    if all("Latin" in resolved(c) or c in NEARLY for c in letters) and any("Latin" in resolved(c) for c in letters):
        return ("Latin",)
    return ()


@lru_cache(1 << 16)
def spelt(word: str, script: str) -> tuple[str, str]:
    """A word in the letters of a script, and ``mixed``, ``whole`` or ``none``: whether it had letters of several scripts, all of another, or none to change."""
    if script == "Latin":
        out = "".join(TO_LATIN.get(c, NEARLY.get(c, c)) for c in word)
    elif script in FROM_LATIN:
        table = FROM_LATIN[script]
        out = "".join(c if script in scripts_of(c) or unicodedata.category(c)[0] != "L" else table.get(TO_LATIN.get(c, c), c) for c in word)
    else:
        out = word
    if out == word:
        return word, "none"
    return out, "whole" if not any(a == b for a, b in zip(word, out) if unicodedata.category(a)[0] == "L") and len({frozenset(scripts_of(c)) for c in letters_of(word)}) == 1 else "mixed"


def respelt(words: list[tuple[str, int]]) -> list[tuple[str, str]]:
    """``spelt`` of each word of a text; words come with the number of their line.

    A word that can be spelt in one script only is. One that could be in several goes with its line: to another script than Latin if the nearest words
    with one choice, before and behind it in the line, are of that script (one of them, if there is only one), else to Latin. All this depends on looks
    alone, so texts that look alike come out equal, and the short words of a sentence in Cyrillic stay with it.
    """
    given = [choices(w) for w, _ in words]
    foreign = any(len(c) == 1 and c[0] != "Latin" for c in given)
    around: list[list[str]] = [[] for _ in words]
    for order in ((range(len(words)), range(len(words) - 1, -1, -1)) if foreign else ()):
        last = None
        for i in order:
            if last is not None and last[1] != words[i][1]:
                last = None
            if last is not None and len(given[i]) > 1:
                around[i].append(last[0])
            if len(given[i]) == 1:
                last = (given[i][0], words[i][1])
    out = []
    for (word, _), scripts, near in zip(words, given, around):
        script = near[0] if near and len(set(near)) == 1 and near[0] in scripts else scripts[0] if scripts else None
        out.append((word, "none") if script is None else spelt(word, script))
    return out


@lru_cache(1 << 16)
def stays(char: str) -> bool:
    """Whether a character comes out as it is whatever stands around it: a plain composed Latin letter, or no letter at all."""
    if char.isascii():
        return True
    kind = unicodedata.category(char)
    if kind[0] == "M" or UNSEEN.match(char) or plain_character(char) != char or unicodedata.normalize("NFC", char) != char:
        return False
    return kind[0] != "L" or scripts_of(char) == {"Latin"} and char not in LATIN


def one_form(text: str) -> tuple[str, int, int, int]:
    """The form of a text, and how many characters were unseen, how many words were mixed and whole confusables."""
    if text.isascii() or all(map(stays, set(text))):
        return text, 0, 0, 0
    text = BREAK_HYPHEN.sub("-", text)
    seen = UNSEEN.sub("", text)
    plain = unicodedata.normalize("NFD", "".join(map(plain_character, seen)) if not seen.isascii() else seen)
    counts = {"mixed": 0, "whole": 0, "none": 0}

    found, line, at = [], 0, 0
    for match in WORD.finditer(plain):
        line += plain.count("\n", at, match.start())
        at = match.start()
        found.append((match.group(), line))
    replaced = iter(respelt(found))

    def replace(match) -> str:
        word, kind = next(replaced)
        counts[kind] += 1
        return word

    return unicodedata.normalize("NFC", WORD.sub(replace, plain)), len(text) - len(seen), counts["mixed"], counts["whole"]


def _forms(texts: pd.Series) -> pd.DataFrame:
    rows = [(None, 0, 0, 0) if t is None else one_form(t) for t in texts]
    return pd.DataFrame(rows, columns=["text", "unseen", "mixed", "whole"])


def _form_only(texts: pd.Series) -> pd.Series:
    return pd.Series([one_form(t)[0] for t in texts], dtype=object)


def with_form(rows: DataFrame, text: str = "document") -> DataFrame:
    """``rows`` with a struct ``form``: text, unseen, mixed, whole. A null text has a null form text."""
    shape = T.StructType([T.StructField("text", T.StringType()), *(T.StructField(n, T.IntegerType()) for n in ("unseen", "mixed", "whole"))])
    return rows.withColumn("form", F.pandas_udf(_forms, shape)(F.col(text)))


def normalized(rows: DataFrame, key: str = "id", text: str = "document") -> DataFrame:
    """``id, text, unseen, mixed, whole``: every distinct record with its text in one form.

    Widths, ligatures, fonts, blanks and hyphens of any sort, composition and unseen characters are settled, words in letters of
    several scripts respelt in one; accents, case, digits, symbols such as single Greek letters without a Latin twin, and line breaks stay. Null texts stay null.
    """
    return with_form(rows.select(F.col(key).alias("id"), F.col(text).alias("given")).distinct(), "given").select("id", "form.*")


def look_alike_ids(rows: DataFrame, key: str = "id", text: str = "document") -> DataFrame:
    """``id_a, id_b`` (id_a < id_b): keys of texts that have one form but are different strings."""
    named = rows.select(F.col(key).alias("id"), F.col(text).alias("given")).dropna()
    form = F.pandas_udf(_form_only, T.StringType())("given")
    formed = settle(named.select("id", F.xxhash64("given").alias("own"), F.unhex(F.sha2(form, 256)).alias("form")).distinct())
    kinds = formed.groupBy("form", "own").agg(F.count(F.lit(1)).alias("ids"))
    several = sharing(kinds, "form").select("form").distinct()
    # strings of one form meet in blocks, and then their ids: copies of one string meet no other copies of it
    strings = meetings(sharing(kinds.select("form", "own"), "form"), "form", "own").select("own_p", "own_q", "form")
    members = formed.join(several, "form", "left_semi")
    one, two = (members.select("form", F.col("own").alias(f"own_{s}"), F.col("id").alias(f"id_{s}")) for s in "pq")
    met = strings.join(one, ["form", "own_p"]).join(two, ["form", "own_q"]).filter("id_p != id_q")
    return met.select(F.least("id_p", "id_q").alias("id_a"), F.greatest("id_p", "id_q").alias("id_b")).distinct()


def look_alike_groups(rows: DataFrame, key: str = "id", text: str = "document") -> DataFrame:
    """``id, class, strings, members``: one row a key and form of its text: the least key with that form, the different strings that have it, and
    the keys. Null keys and texts are left out; an empty table gives no rows."""
    named = rows.select(F.col(key).alias("id"), F.col(text).alias("given")).dropna()
    form = F.pandas_udf(_form_only, T.StringType())("given")
    formed = settle(named.select("id", F.xxhash64("given").alias("own"), F.unhex(F.sha2(form, 256)).alias("form")).distinct())
    strings = formed.groupBy("form", "own").agg(F.min("id").alias("id")).groupBy("form").agg(F.count(F.lit(1)).alias("strings"), F.min("id").alias("class"))
    ids = formed.select("form", "id").distinct()
    members = ids.groupBy("form").agg(F.count(F.lit(1)).alias("members"))
    return ids.join(strings.join(members, "form"), "form").select("id", "class", "strings", "members")
