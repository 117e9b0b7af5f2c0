import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.llm import lookalike, markup, mix, pack, quality, scan_noise, split, tokens

SAME = [
    ("ｆｕｌｌ　ｗｉｄｔｈ", "full width"), ("ﬁne ﬂow", "fine flow"), ("e\u0301te\u0301", "été"), ("zero\u200bwidth\ufeff", "zerowidth"), ("a\u00a0b\u2009c", "a b c"), ("well‐posed", "well-posed"), ("co\u00adop", "coop"),
    ("ѕсоре", "scope"), ("mіxеd", "mixed"), ("Κelvin", "Kelvin"), ("ɡram", "gram"), ("end\u00ad\nnext", "end-\nnext"), ("Αpprοx", "Approx"), ("𝐛old", "bold"), ("Ａпрель", "Апрель"),
]


@pytest.mark.parametrize("one,two", SAME)
def test_same_look(one, two):
    assert lookalike.one_form(one)[0] == lookalike.one_form(two)[0]


@pytest.mark.parametrize("one,two", [("resume", "resumé"), ("Case", "case"), ("l1", "ll"), ("a b", "ab"), ("a\nb", "a b"), ("θ", "o"), ("x²", "x2"), ("привет", "npubet"), ("a  b", "a b"), ("a–b", "a-b")])
def test_other_look(one, two):
    assert lookalike.one_form(one)[0] != lookalike.one_form(two)[0]


GENUINE = [
    "Он сел в автобус и уехал, а вор остался у реки. Это хор.", "Сор и рос, ТОТ и ОСА: все в одном.", "Ο ήλιος και η θάλασσα είναι το τέλος.", "Հայերեն օսում հոց են սա։", "ѕвезда и месец", "日本語のテキストと한국어",
    "In English, the word Москва stands alone; a cat sees it.", "The α of a γ ray",
]


@pytest.mark.parametrize("text", GENUINE)
def test_genuine_words_stay(text):
    import unicodedata

    assert lookalike.one_form(text)[0] == unicodedata.normalize("NFC", text)


def test_spelling_follows_the_line():
    swap = str.maketrans("асорхеуТОА", "acopxeyTOA")  # Cyrillic to Latin of the same look
    text = "Он сел в автобус и уехал, а вор остался у реки. Это хор.\nТОТ сор рос"
    lines = text.split("\n")
    assert lookalike.one_form(text.translate(swap))[0] == lookalike.one_form(text)[0]
    assert lookalike.one_form("The ѕсоре of a сору in use")[0] == "The scope of a copy in use"
    assert lookalike.one_form(lines[1])[0] == lines[1].translate(swap)  # with no word around that has one choice, Latin
    assert lookalike.one_form("ᎪᏢᏢᏞᎬ ꓮꓑꓑꓡꓰ")[0] == "APPLE APPLE"


def test_scripts_of_letters():
    assert lookalike.choices("日本語の") and lookalike.choices("한국") and lookalike.scripts_of("ー") >= {"Hiragana", "Katakana", "Japanese"}
    assert lookalike.choices("сор")[0] == "Latin" and "Cyrillic" in lookalike.choices("сор") and lookalike.choices("вор") == ("Cyrillic",)
    assert all(len(latin) == 1 and latin.isascii() and latin.isalpha() for latin in lookalike.TO_LATIN.values())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_form_is_stable(text):
    once = lookalike.one_form(text)[0]
    assert lookalike.one_form(once)[0] == once


def test_look_alike_pairs(spark):
    rows = [("a", "a fine day", 1), ("b", "a ﬁne day", 1), ("b", "a ﬁne day", 1), ("c", "a fine day", 1), ("d", None, 1), (None, "a fine day", 1), ("e", "", 1), ("f", "A fine day", 1)]
    df = spark.createDataFrame(rows, "id string, document string, form int")
    assert sorted(map(tuple, lookalike.look_alike_ids(df).collect())) == [("a", "b"), ("b", "c")]
    groups = {r["id"]: tuple(r)[1:] for r in lookalike.look_alike_groups(df).collect()}
    assert groups == {"a": ("a", 2, 3), "b": ("a", 2, 3), "c": ("a", 2, 3), "e": ("e", 1, 1), "f": ("f", 1, 1)}
    assert lookalike.normalized(df).count() == 7 and lookalike.look_alike_ids(df.limit(0)).count() == 0


CLEAN = [
    ("no markup: a < b, Q&A, 5 * 3, x**2 + y**2, {a, b}, $5 to $7, [3], max_iter_count", None, ()),
    ("<p>One &amp; <b>two</b></p><ul><li>a<li>b</ul>", "One & two\n\n• a\n• b", ("html",)),
    ("<h1>Top</h1><p>x<!-- gone --><script>no()</script><span style='display: none'>hid</span>y", "Top\n\nxy", ("html",)),
    ("<table><tr><th>run<th>value<tr><td>1<td>22</table>", "run  value\n1    22", ("html",)),
    ("lone</div> tag and <br/>break", "lone tag and\nbreak", ("html",)),
    ("note<sup>&</sup>lt;sup>3</sup>.", "note.", ("html",)),
    ("# Head\n\nSome **bold**, `code` and [text](https://x.example/a).[^1]\n\n- one\n- two", "Head\n\nSome bold, code and text.\n\n• one\n• two", ("markdown",)),
    ("| a | bb |\n|---|---:|\n| ccc | d |", "a    bb\nccc  d", ("markdown",)),
    ("```\n10 LET A = 1 < 2\n```\n\ntext", "10 LET A = 1 < 2\n\ntext", ("markdown",)),
    ("== Part ==\nSome ''soft'' and '''hard''' [[page|words]].{{ref|x}}\n{| class=\"p\"\n|-\n| 1 || 2.5\n|-\n| 10 || 3\n|}", "Part\n\nSome soft and hard words.\n\n1   2.5\n10  3", ("wiki",)),
    ("\\section{Start}\nSee \\textbf{this}~\\cite{k1} and $a_1 = \\frac{b}{c}$.\n\\begin{itemize}\n\\item one\n\\end{itemize}", "Start\n\nSee this [k1] and $a_1 = \\frac{b}{c}$.\n\n• one", ("latex",)),
    ("\\begin{equation}\nx = y\n\\end{equation}", "$$x = y$$", ("latex",)),
    ("at \\(k = 1\\) now", "at $k = 1$ now", ("latex",)),
    ("- a\n  - b\n    - c\n- d", "• a\n  • b\n    • c\n• d", ("markdown",)),
    ("1. one\n   - sub\n2. two", "1. one\n  • sub\n2. two", ("markdown",)),
    ("The run ends. \n> It is a quote of a line.\n\nx", "The run ends.\n\nIt is a quote of a line.\n\nx", ("markdown",)),
    ("a < b and c\n> d in each run; x**2\n+ y**2, 5\n* 3 cells", None, ()),
    ("'''Bold''' text\n* one\n** two\n** three\n* four", "Bold text\n• one\n  • two\n  • three\n• four", ("wiki",)),
    ("[[page]] lists\n# first\n# second", "page lists\n1. first\n2. second", ("wiki",)),
    ("\\begin{tabular}{l|r}\n\\hline\nrun & value \\\\\n\\hline\n1 & 22 \\\\\n\\end{tabular}", "run  value\n1    22", ("latex",)),
    ("x " + "**" + "long " * 300 + "end** and *" + "it " * 300 + "is* y", "x " + "long " * 300 + "end and " + "it " * 300 + "is y", ("markdown",)),
    ("see \\footnote{" + "note " * 3000 + "so} there", "see " + "note " * 3000 + "so there", ("latex",)),
    ("$$" + "a + " * 4000 + "b$$", "$$" + "a + " * 4000 + "b$$", ("latex",)),
    ("• bullet\n- 104 -\n3 Heading\nkey: v | key: w", None, ()),
    ("", None, ()),
]


@pytest.mark.parametrize("given_text,wanted,kinds", CLEAN)
def test_markup(given_text, wanted, kinds):
    text, *counts = markup.render(given_text)
    assert text == (given_text if wanted is None else wanted)
    assert tuple(k for k, n in zip(markup.COLUMNS[1:5], counts) if n) == kinds


def test_outline_keeps_levels():
    assert markup.render("# Top\n\ntext\n\n### Deep *one*\n\n<h2>Two</h2>")[-1] == "1 Top\n3 Deep one\n2 Two\n"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/pbli&;*_`~#[](){}|=$\\'! \n-ab1", max_size=80))
def test_markup_never_fails(text):
    markup.render(text)


def test_markup_rows(spark):
    df = spark.createDataFrame([("a", "<b>x</b>", 1), ("a", "<b>x</b>", 1), ("n", None, 1), ("l", "plain " * 100_000, 1)], "id string, document string, text int")
    assert sorted(map(tuple, markup.markup_kinds(df).collect())) == [("a", "html")] and markup.clean_markup(df).count() == 3


def test_split_limits_overlaps_and_bodies(spark):
    rng = random.Random(4)
    prose = "\n\n".join(" ".join(f"{' '.join(f'w{rng.randrange(99)}' for _ in range(rng.randrange(3, 14)))}." for _ in range(20)) for _ in range(9))
    long_sentences = " ".join(" ".join(f"v{i}" for i in range(110)) + "." for _ in range(12))
    rows = [("p", prose), ("l", long_sentences), ("n", "word " * 1300), ("x", "y" * 9000), ("s", "short text."), ("e", ""), ("z", None), ("r", "\n".join("row one two" for _ in range(400)))]
    df = spark.createDataFrame(rows, "id string, document string")
    pieces = split.split_oversized(df, limit=500).collect()
    of = {}
    for r in sorted(pieces, key=lambda r: (r["id"], r["piece_no"])):
        of.setdefault(r["id"], []).append(r)
    assert all(r["words"] <= 500 for r in pieces) and set(of) == {"p", "l", "n", "x", "s", "e", "r"}
    assert [len(of[k]) for k in ("s", "e", "x")] == [1, 1, 1]
    for one, two in zip(of["p"], of["p"][1:]):
        last = one["text"].strip().replace("\n\n", " ").split(". ")[-2:]
        assert two["text"].replace("\n\n", " ").startswith(". ".join(last)) and two["overlap_words"] > 0
    assert all(r["overlap_words"] == 220 for r in of["l"][1:]) and len(of["l"]) > 2
    texts = dict(rows)
    for k, parts in of.items():
        assert parts[0]["words"] >= 440 or len(parts) == 1  # the first fills the limit
        assert all(r["text"] in texts[k] for r in parts)
        assert sum(r["words"] - r["overlap_words"] for r in parts if k != "x") == (len(texts[k].split()) if k != "x" else 0)
    assert all(r["overlap_words"] == 0 for k in "nr" for r in of[k])
    assert " ".join(r["text"] for r in of["n"]).split() == ("word " * 1300).split()
    assert {r["id"] for r in split.oversized_ids(df).collect()} == {"p", "l", "n", "r"}
    assert split.split_oversized(df.limit(0)).count() == 0


def test_split_with_large_limits(spark):
    rng = random.Random(9)
    text = " ".join(f"w{i}" + "." * (rng.random() < 0.05) for i in range(200_000))
    df = spark.createDataFrame([("a", text), ("b", "word " * 200_000)], "id string, document string")
    for limit in (2_000, 50_000):
        got = split.split_oversized(df, limit=limit).orderBy("id", "piece_no").collect()
        assert max(r["words"] for r in got) <= limit and min(r["words"] for r in got if r["piece_no"] == 0) > 0.98 * limit
        assert sum(r["words"] - r["overlap_words"] for r in got) == 400_000


def test_split_overlap_takes_in_what_has_no_stop(spark):
    text = "One two three. Four five six. Seven eight nine.\n\nA heading\n\n" + " ".join(f"x{i}" for i in range(40)) + "."
    got = split.split_oversized(spark.createDataFrame([("a", text)], "id string, document string"), limit=20).orderBy("piece_no").collect()
    assert got[0]["text"].endswith("A heading\n\n") and got[1]["text"].startswith("Four five six. Seven eight nine.\n\nA heading\n\nx0 x1")


@pytest.mark.parametrize("most", [0, 1, 31, 32, 33, 100, 1023, 1024, 1500])
def test_units_up_to(spark, most):
    df = spark.createDataFrame([("w " * (most + 5),), ("w " * (most // 2),)], "t string")
    got = [r[0] for r in df.select(F.length(F.regexp_extract("t", r"\A" + split.up_to(most), 0)) / 2).collect()]
    assert got == [most, most // 2]


PAGE = """The kernel of the operator is stiff and the boundary does not ch@nge
while the sensor limits it. Near the layered vortex the tempera-
- 12 -
Shallow cavity pressure
ture of the plume is smooth. We find that the quasi-
static channel follows the rnesh in both pre-
and post-processing of the kebaloru field.
(1.12)
STIFF COLUMN DENSITY OF RUN 7881
It follows that H2O reaches the mesh before the vortex has
settled. The lattice does not change."""


def vocabulary():
    from collections import Counter

    text = "the kernel operator boundary change sensor limits near layered vortex temperature plume smooth quasi static channel follows mesh pre post processing field lattice".split()
    return scan_noise.Words(Counter({w: 500 for w in text}), 1, {}, np.zeros((0, 8)))


def test_scan_lines():
    text, noise = scan_noise.analyse(PAGE, vocabulary())
    flags = {n[0]: n[1:] for n in noise}
    assert flags == {1: (False, False, True), 2: (False, True, False), 3: (True, False, False), 4: (True, False, False), 5: (False, True, False), 6: (False, False, True)}
    assert "the temperature of the plume is smooth" in text and "quasi-static channel follows the mesh in both pre- and post-processing" in text and "change while" in text
    assert "STIFF COLUMN DENSITY OF RUN 7881" in text.split("\n\n") and "- 12 -" not in text


def test_scan_ignores_unseen_characters():
    dirty = PAGE.replace("kernel", "ker\u200bnel").replace("lattice", "lat\u00adtice")
    assert scan_noise.analyse(dirty, vocabulary()) == scan_noise.analyse(PAGE, vocabulary())


def test_context_is_alike_at_every_size():
    vectors = np.array([[1.0, 0.0], [0.8, 0.6], [0.0, 1.0], [0.0, 1.0], [1.0, 0.0], [-1.0, -1.0]])  # that, tbat, around both words, cast, east
    index = {"that": 0, "tbat": 1, "near": 2, "cast": 3, "east": 4, "other": 5}
    for times in (1, 100):
        counts = {w: n * times for w, n in {"that": 9000, "tbat": 47, "near": 900, "cast": 60, "east": 900, "other": 9000}.items()}
        words = scan_noise.Words(counts, 1, index, vectors)
        assert words.correct("tbat", ["near"]) == "that"
        assert words.correct("cast", ["near"]) is None  # a word of its own
        assert words.correct("cast", ["that"]) == "east"
        assert scan_noise.Words(counts, 1, {}, np.zeros((0, 2))).correct("cast", ["near"]) == "east"  # frequency alone would err


def test_vocabulary_by_rank(spark):
    counts = spark.createDataFrame([("word", f"w{i}", n) for i, n in enumerate([1] * 50 + [2] * 20 + [500, 501, 9000])], "kind string, token string, n bigint")
    assert [scan_noise.least_count(counts, most) for most in (100, 73, 72, 23, 22, 3)] == [1, 1, 2, 2, 500, 500]
    assert scan_noise.least_count(counts.limit(0)) == 1


def topical(rng):
    """Texts of two topics; "cast" is a word in one of them, and a misreading of "east" in three lines of the other."""
    metal, wind = "furnace iron molten alloy mould steel foundry ladle".split(), "west north coast harbour sail storm breeze tide".split()
    docs = []
    for k in range(400):
        words = rng.choice(metal if k % 2 else wind, 64).tolist()
        for at in rng.choice(64, 6, replace=False):
            words[at] = ("cast" if rng.random() < 0.03 else "pour") if k % 2 else "east"
        docs.append(words)
    for k in (10, 20, 30):
        docs[k][docs[k].index("east")] = "cast"
    return ["\n".join(" ".join(d[i : i + 8]) for i in range(0, 64, 8)) for d in docs]


def test_vectors_decide_between_words(spark):
    """Ablation: learnt vectors keep a true word where frequency alone corrects it, and lose no misreading."""
    docs = topical(np.random.default_rng(3))
    named = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    words = scan_noise.learn(named)
    blind = scan_noise.Words(words.counts, words.least, {}, np.zeros((0, scan_noise.VECTOR)), words.lines)
    found = []
    for w in (words, blind):
        hits = [(k, n[0]) for k, d in enumerate(docs) for n in scan_noise.analyse(d, w)[1] if n[3]]
        found.append((len({k for k, _ in hits} & {10, 20, 30}), sum(k not in (10, 20, 30) for k, _ in hits)))
    (hit, wrong), (hit_blind, wrong_blind) = found
    assert hit_blind == 3 and wrong_blind > 10  # without vectors all of both kinds
    assert hit >= 2 and wrong < 0.3 * wrong_blind, found


def test_scan_of_repeated_corpus(spark):
    rng = np.random.default_rng(4)
    plain = "kernel operator boundary change sensor limits layered vortex temperature plume smooth static channel follows lattice density".split()
    docs = [" ".join(rng.choice(plain, 60)) for _ in range(40)]
    docs = [d.replace("kernel", "kcrnel", 1) if k == 7 else d.replace("smooth", "srnooth", 1) if k == 11 else d for k, d in enumerate(docs)]
    docs = ["\n".join(" ".join(d.split()[i : i + 8]) for i in range(0, 60, 8)) for d in docs]
    found = []
    for times in (1, 100):
        df = spark.createDataFrame([(f"{k} {n}", d) for k, d in enumerate(docs) for n in range(times)], "id string, document string")
        got = {(r["id"], r["line_no"]) for r in scan_noise.noisy_lines(df).collect()}
        found.append({(i.split()[0], n) for i, n in got})
        assert len(got) == times * len(found[-1])
    assert found[0] == found[1] and {i for i, _ in found[0]} == {"7", "11"}


SCANS = ["The ﬁrst – “quoted” li-\nne of\nth!s page, p. 1O\nand 12 more", "Иван съел яблоко @home !x\nи 7 слив", "a | b\nc | d!", "", " ", "é" * 41 + " été Été", "It's 1234 5\n12 of 345\n- 7 -\nof it"] * 3


def test_words_are_counted_in_portions(spark, monkeypatch):
    """Counts in Arrow are those of the words one by one, whatever the portions."""
    import pyarrow as pa

    found = []
    for portion in (1, 100, 1 << 24):
        monkeypatch.setattr(scan_noise, "PORTION", portion)
        sums: dict = {}
        for b in scan_noise._count([pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["text"]) for x in (SCANS[:5], [], SCANS[5:])]):
            for r in b.to_pylist():
                key = (r["kind"], r["token"])
                sums[key] = sums.get(key, 0) + (1 if r["kind"] == "context" else r["n"])
        order = [t for k, t in sums if k == "context"]
        assert [t.split(" ")[0] for t in order] == ["the", "иван", "a", "", "é" * 41, "it"]
        found.append(sums)
    assert found[0] == found[1] == found[2]
    got = found[0]
    assert got["word", "line"] == 3 and got["word", "été"] == 6 and got["word", "@home"] == got["word", "яблоко"] == got["word", "1o"] == 3 and got["word", "th!s"] == 3
    assert ("word", "") not in got and ("word", "é" * 41) not in got and got["line", "9 of 9"] == got["line", "- 9 -"] == 3
    assert got["context", "é" * 41 + " été été"] == 3 and got["running", ""] == sum(n * (t.count(" ") + 1) for (k, t), n in got.items() if k == "context")


def test_tokens_of_lines():
    for text in SCANS:
        lines = text.split("\n")
        tokens = scan_noise.line_tokens(text, lines)
        assert [tokens(i) for i in range(len(lines))] == [scan_noise.TOKEN.findall(x) for x in lines]


def test_training_sees_words_by_chance(monkeypatch):
    """By text and place, whatever the portions; the words one by one give the same and cost more."""
    import time
    import zlib
    from collections import Counter
    from itertools import compress, repeat

    import pyarrow as pa

    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["often", "some", "rare", "x" * 41], 400, p=[0.7, 0.2, 0.099, 0.001])) for _ in range(2000)]
    held = Counter(w for t in texts for w in t.split(" "))
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["token"])

    def seen():
        return [x for b in scan_noise._subsampled([batch], {"often": 0.1}) for x in b["words"].to_pylist()]

    whole = seen()
    got = Counter(w for t in whole for w in t)
    assert all(got[w] == held[w] for w in held if w != "often") and abs(got["often"] / held["often"] - 0.1) < 0.003

    def one_by_one():
        out = []
        for text in texts:
            words = text.split(" ")
            kept = np.fromiter(map({"often": 0.1}.get, words, repeat(1.0)), float, len(words))
            out.append(list(compress(words, (np.random.default_rng(zlib.crc32(text.encode())).random(len(words)) < kept).tolist())))
        return out

    assert whole == one_by_one()
    monkeypatch.setattr(scan_noise, "PORTION", 10_000)
    assert seen() == whole
    monkeypatch.undo()

    def cost(work):
        took = []
        for _ in range(5):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    assert cost(lambda: list(scan_noise._subsampled([batch], {"often": 0.1}))) < 0.8 * cost(one_by_one)


def test_context_is_learnt_from_all_texts(spark):
    rng = np.random.default_rng(6)
    plain = "kernel operator boundary change sensor limits layered vortex".split()
    rows = [(k, " ".join(rng.choice(plain, 60))) for k in range(40)]  # one line each, so none is wrapped
    words = scan_noise.learn(spark.createDataFrame(rows, "id int, text string"))
    assert set(words.index) == set(plain) and words.vectors.shape[1] >= 24 and scan_noise.WINDOW >= 3


def test_context_may_keep_a_word_with_a_digit():
    vectors = np.array([[1.0, 0.0], [0.0, 1.0], [0.0, 1.0], [-1.0, -1.0]])
    words = scan_noise.Words({"also": 9000, "als0": 400, "near": 900, "other": 9000}, 1, {"also": 0, "als0": 1, "near": 2, "other": 3}, vectors)
    assert words.correct("als0", ["near"]) is None and words.correct("als0", ["also"]) == "also"


def test_scan_leaves_other_text(spark):
    rows = [("a", PAGE, 1), ("a", PAGE, 1), ("b", "One paragraph only.", 1), ("c", "- x\n- y\n- z\n- w", 1), ("d", None, 1), ("e", "", 1), ("f", "a, b\n" * 5000, 1)]
    df = spark.createDataFrame(rows, "id string, document string, noise int")
    got = {r["id"]: r for r in scan_noise.repair(df).collect()}
    assert set(got) == set("abcef") and all(not got[k]["noise"] and got[k]["text"] == t for k, t, _ in rows if k in "bcef")
    assert {3, 4} <= {r["line_no"] for r in scan_noise.noisy_lines(df).collect()}
    assert scan_noise.repair(df.limit(0)).count() == 0


TEXT = st.text(alphabet=st.sampled_from("ab the.,;|\t\n-•1 [5] \u00e9the and of it is"), max_size=200)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 30))
def test_quality_does_not_depend_on_cuts(text, size):
    from functools import reduce

    whole = quality.chunk_state(text)
    parts = [quality.chunk_state(text[i : i + size]) for i in range(0, len(text), size)] or [quality.chunk_state("")]
    merged = reduce(quality.join_chunks, parts)
    assert quality.statistics(whole | {"chars": len(text)}) == quality.statistics(merged | {"chars": len(text)})


def test_quality_rows(spark):
    prose = "It follows that the kernel of the operator is stiff, and we find that the sensor limits it."
    rows = [(1, prose), (2, "1.5\t2.5\tx\n" * 30), (3, "- red kernel\n- blue vortex\n- green mesh"), (4, None), (5, ""), (6, prose.replace(",", "").replace(".", "")), (7, (prose + "\n") * 3000), (8, "qxv zrtk " * 50), (9, prose + "\n" + "3 | 4 | 5\n" * 40), (10, "(a) rotating column\n(a) thermal magnet\n" * 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in quality.text_quality(df).collect()}
    assert {k: r["mostly_language"] for k, r in got.items()} == {1: True, 2: False, 3: False, 5: True, 6: True, 7: True, 8: False, 9: False, 10: False}
    assert got[2]["kind"] == "table" and got[3]["kind"] == "list" and got[7]["n_lines"] == 3001 and got[1]["punctuated_share"] == 1
    for chunk, spread in ((500, 1000), (64, 1), (7, 300)):
        assert {r["doc_id"]: r for r in quality.text_quality(df, chunk=chunk, spread=spread).collect()} == got
    twice = df.filter("doc_id = 7").union(df.filter("doc_id = 7")).union(df.filter("doc_id = 1").selectExpr("cast(null as bigint)", "text"))
    assert quality.text_quality(twice, chunk=100, spread=2).count() == 3
    assert quality.text_quality(df.limit(0)).count() == 0
    assert sorted(r[0] for r in quality.not_language(df).collect()) == [2, 3, 8, 9, 10]


def test_token_blocks():
    text = "some words " * 30_000
    assert "".join(tokens.blocks(text)) == text and abs(tokens.count_tokens(text) - len(tokens.encoder(tokens.VOCABULARY).encode_ordinary(text))) < 20
    assert tokens.count_tokens("x" * 250_000) > 0


def test_fill_against_all_subsets():
    rng = random.Random(1)
    for _ in range(60):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}
        capacity = rng.randrange(10, 70)
        reach = {0}
        for s, n in counts.items():
            reach = {r + s * k for r in reach for k in range(n + 1) if r + s * k <= capacity}
        chosen = pack.fill(sorted(counts, reverse=True), counts, capacity)
        assert sum(s * k for s, k in chosen.items()) == max(reach) and all(k <= counts[s] for s, k in chosen.items())


def test_pack_places_everything_once(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("cat" for _ in range(rng.choice((1, 3, 7, 7, 7, 7, 20, 61, 130))))) for i in range(400)] + [(900, ""), (901, None), (3, "cat cat")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = spark.createDataFrame([("s", 16), ("t", 16), ("l", 50), ("none", None), ("zero", 0)], "pack_name string, capacity_tokens int")
    got = pack.pack(docs, sizes).toPandas()
    assert set(got["pack_name"]) == {"s", "t", "l"}
    for _, one in got.groupby("pack_name"):
        used = one[one["tokens"] > 0].sort_values(["container", "place"])
        assert (used.groupby("container")["tokens"].sum() <= used["capacity_tokens"].iloc[0]).all()
        assert (used["place"] == used.groupby("container")["tokens"].cumsum() - used["tokens"]).all()
        assert one["tokens"].sum() == sum(tokens.count_tokens(t) if t else 0 for _, t in rows) and set(one["doc_id"]) == {i for i, _ in rows}
        split_up = one.groupby(["doc_id"])["piece"].nunique()
        assert all(tokens.count_tokens(dict(rows)[i]) > one["capacity_tokens"].iloc[0] for i in split_up[split_up > 1].index)
    report = {r["pack_name"]: r for r in pack.filling(pack.pack(docs, sizes)).collect()}
    assert all(r["fill"] > 0.97 for r in report.values())
    assert pack.pack(docs.limit(0), sizes).count() == 0 and pack.pack(docs, sizes.limit(0)).count() == 0


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, "cat " * rng.randrange(1, 60), rng.choice(["Big ", "big", "big", "mid", "MID"])) for i in range(3000)] + [(9000 + i, "cat " * 50, "tiny") for i in range(4)] + [(1, None, "big"), (2, "", "mid"), (3, "cat", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("times", F.lit(9))
    goals = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 1), ("Tiny", 0.1, 10), ("gone", 0.1, 3), ("off", 0.0, 1)], "source string, target_share double, max_repeats int")
    chosen, report = mix.mix(docs, goals)
    shares = {r["source"]: r for r in report.collect()}
    assert abs(shares["big"]["share"] - 0.5 / 0.9) < 0.01 and abs(shares["tiny"]["share"] - 0.1 / 0.9) < 0.01 and shares["gone"]["tokens_used"] == 0
    for r in chosen.groupBy("source").agg(F.max("times").alias("t")).collect():
        assert r["t"] <= shares[r["source"]]["max_repeats"]
    assert chosen.groupBy("doc_id").count().filter("count > 1").count() == 0
    _, more = mix.mix(docs, goals, total=60_000.0)
    more = {r["source"]: r for r in more.collect()}
    assert more["tiny"]["exponent"] > 0 and all(r["tokens_used"] <= r["max_repeats"] * r["tokens_available"] for r in more.values())
    _, scarce = mix.mix(docs, goals, scarce=0.2)
    scarce = {r["source"]: r for r in scarce.collect()}
    assert scarce["tiny"]["exponent"] > 0.5 and scarce["tiny"]["tokens_used"] == 10 * scarce["tiny"]["tokens_available"] and scarce["tiny"]["tokens_unused"] == 0
    assert sum(r["tokens_used"] for r in scarce.values()) > 2 * sum(r["tokens_used"] for r in shares.values())
    assert abs(scarce["big"]["share"] / scarce["mid"]["share"] - 5 / 3) < 0.05
    blocks = mix.realise(*(lambda m: (m[0], m[1], mix.budgets(m[1], 5_000.0)[0]))(mix.wanted_sources(mix.sized(docs, "doc_id", "text", "source", tokens.VOCABULARY), goals)), block_tokens=8)
    assert abs(blocks.selectExpr("sum(tokens * times)").first()[0] - 5_000) < 200
    alone = {r["source"]: r for r in mix.temperature_mix(docs, goals).collect()}
    assert alone["big"]["tokens_used"] > 0 and alone["off"]["tokens_used"] == 0
    empty, zero = mix.mix(docs.limit(0), goals)
    assert empty.count() == 0 and all(r["share"] == 0 for r in zero.collect())


def test_budgets_respect_limits():
    rng = random.Random(8)
    for _ in range(300):
        sources = [mix.Source(str(i), rng.choice((0, rng.random())), rng.randrange(0, 6), rng.choice((0, rng.randrange(1, 10**6)))) for i in range(rng.randrange(1, 9))]
        held = sum(s.repeats * s.tokens for s in sources if s.target > 0)
        for total in (None, 0.0, 0.3 * held, 0.9 * held, 2.0 * held):
            wanted, exponent = mix.budgets(sources, total)
            assert all(-1e-6 <= w <= s.repeats * s.tokens * (1 + 1e-6) for w, s in zip(wanted, sources)) and exponent >= 0
            if total is not None:
                assert wanted.sum() == pytest.approx(min(total, held), rel=1e-3, abs=1e-6)


def test_exponents():
    shares = np.array([0.7, 0.2, 0.1])
    for wanted in (0.9, 1.0, 0.5):
        x = mix.exponent_for_entropy(shares, wanted)
        assert mix.entropy(mix.tempered(shares, x)) == pytest.approx(wanted, abs=1e-6)
    assert mix.exponent_for_entropy(shares, 5.0) == 0


@pytest.mark.parametrize("piece", ["<b>", "</p>", "<li>x", "<table><tr><td>", "\\textbf{a \\emph{b}} ", "\\frac{", "\\[", "$$", "`", "**a", "{{x", "[[a", "| a | b |\n|---|---|\n", "> q\n", "''", "&amp;", "<!-- ", "{{x}} {{y ", "\\(", "\\begin{equation}", "*a ", "_a ", "__a ", "[a](", "![", "\\x[", "- a\n  - b\n", "* a\n** b\n", "\\begin{tabular}{l} a & b ", "}}", "{{a|b={{c|"])
def test_markup_of_long_texts_ends(piece):
    import time

    began = time.time()
    markup.render(piece * 20_000)
    assert time.time() - began < 20
