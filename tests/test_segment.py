import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import structure as S
from lodestrata.functions import text as X
from lodestrata.operators import segment as K


def buffer_model(counts, limit, overlap=2):
    """The fold as it is told: a buffer of sentences that is emitted when full."""
    out, buffer = [], []
    for i, _ in enumerate(counts, 1):
        buffer.append(i)
        if sum(counts[k - 1] for k in buffer) >= limit:
            out.append((buffer[0], buffer[-1]))
            buffer = buffer[-overlap:] if len(buffer) > overlap else buffer[:]
    if buffer and (not out or out[-1] != (buffer[0], buffer[-1])):
        out.append((buffer[0], buffer[-1]))
    return out


def test_ranges_follow_the_buffer(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice((1, 3, 8, 20, 60)) for _ in range(rng.randrange(0, 25))]) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, c array<int>").select("i", "c", K.chunk_ranges(F.col("c"), 40, 2).alias("r"))
    for r in df.collect():
        assert [(x["first"], x["last"]) for x in r["r"]] == buffer_model(r["c"], 40)


HEADINGS = [
    ("# Title words", True), ("####### seven", False), ("# $$x$$", False), ("# 12", False), ("# Step 1:", False), ("## Results", True), ("1.3 Numerical methods", True), ("10 Results", False),
    ("1 Results", True), ("Theorem 2", True), ("Proof. Let it be so", True), ("References", True), ("**Abstract**", True), ("Appendix A", False), ("ALL CAPITALS HERE", True), ("ABC", False), ("a plain line", False),
    ("", False), ("10 PRINT X", False), ("Contents", True), ("A" * 60, False), ("A" * 59, True), ("1.1 Ab " + "x" * 80, False),
]


@pytest.mark.parametrize("line,wanted", HEADINGS)
def test_headings(column, line, wanted):
    assert column(S.is_heading, line) is wanted


@pytest.mark.parametrize("text,wanted", [("| a |\n| b |\nc", True), ("| a |", False), ("a\nb\n| c", False)])
def test_tables(column, text, wanted):
    assert column(S.table_dominated, text) is wanted


def test_noise(column):
    assert column(S.toc_dominated, "1. Intro part ..... 4\n2. Second part ..... 9\ntext") is True
    assert column(S.url_dominated, "https://a.example/x\nwww.b.example\ntext") is True
    assert column(S.prose_words, "some words here\n```\nnot these ones\n```\nbut these") == 5
    assert column(S.is_meaningful, "only four long words") is False
    assert column(S.is_meaningful, "five words with some math $$x$$ \\frac{a}{b}") is True
    assert column(S.is_meaningful, "word " * 25) is True and column(S.is_meaningful, "word " * 24) is False


def test_sections_and_boilerplate(spark):
    text = "intro line\n# One\nbody one\n## Empty\n## Two 103\nbody two\nReferences\nsomebody 1999"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, t string")
    got = [(r["section_no"], r["heading"], r["lines"]) for r in K.section_rows(df, "k", "t", True).orderBy("section_no").collect()]
    assert got == [(0, "", ["intro line"]), (1, "One", ["body one"]), (2, "Two 103", ["body two"]), (3, "References", ["somebody 1999"])]
    assert K.section_rows(df, "k", "t").count() == 3
    assert column_heading(spark, "Two 103") == "Two"


def column_heading(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(S.heading_name(F.col("t"))).first()[0]


def test_code_runs(spark):
    df = spark.createDataFrame([(["text", "10 PRINT A  ", "20 GOTO 10", "", "more"],)], "l array<string>")
    assert df.select(K.code_fenced(F.col("l"))).first()[0] == "text\n```\n10 PRINT A\n20 GOTO 10\n```\n\nmore"


def test_sentences(column):
    assert column(X.sentences, " One. Two!  Three? four ") == ["One.", "Two!", "Three?", "four"]
    assert column(X.sentences, "$$a. b$$ c. d") == ["$$a. b$$ c. d"]


def test_orphans(spark):
    df = spark.createDataFrame([(["One. Two.", "Therefore it holds.", "Plain start."],)], "c array<string>")
    assert df.select(K.join_orphans(F.col("c"))).first()[0] == ["One. Two. Therefore it holds.", "Plain start."]
    long = "x " * 599 + "end. Last."
    df = spark.createDataFrame([([long, "Hence so."],)], "c array<string>")
    assert df.select(K.join_orphans(F.col("c"))).first()[0][1] == "Last. Hence so."


def test_chunks_keep_every_sentence_and_have_no_shuffle(spark):
    text = "\n\n".join(" ".join(f"Sentence number {i} of paragraph {p} says something." for i in range(40)) for p in range(6))
    df = spark.createDataFrame([(1, text)], "k int, t string")
    chunks = K.smart_chunks(df, "k", "t")
    assert "Exchange" not in chunks._jdf.queryExecution().executedPlan().toString()
    whole = " ".join(r["body"] for r in chunks.collect())
    assert all(f"Sentence number {i} of paragraph {p} says" in whole for i in range(40) for p in range(6))
