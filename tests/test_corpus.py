import os
import time

from lodestrata.corpus import Corpus
from lodestrata.operators import graph as G
from lodestrata.sources.json_store import manifest_json, read_graph, read_manifest


def write(path, text, at):
    path.write_text(text)
    os.utime(path, (at, at))


def test_files_in_changed_and_checked(spark, tmp_path):
    docs, now = tmp_path / "docs", int(time.time()) - 1000
    docs.mkdir()
    body = "It was the laminar vortex and then the resonant cavity or the plastic magnet that counted in each of the runs made here. " * 3
    write(docs / "a.md", "# One\n" + body + "\n# Two\n" + body, now)
    write(docs / "b.txt", body + " A purple submarine sank.", now)
    corpus = Corpus(spark, str(tmp_path / "store"))
    assert corpus.ingest(str(docs)) == {"new": 2} and corpus.ingest(str(docs)) == {"skip": 2}
    assert corpus.table("chunks").count() == 3
    stats = corpus.stats()
    assert corpus.check(str(docs))[2] is True
    write(docs / "a.md", "# One\n" + body, now + 500)
    assert corpus.ingest(str(docs)) == {"changed": 1, "skip": 1}
    assert sorted(r["id"] for r in corpus.table("chunks").collect()) == ["a__ch0", "b__ch0"]
    assert corpus.stats()["nodes"] <= stats["nodes"]
    assert "purple" in corpus.search("purple submarine", 1)[0]
    assert "resonant cavity" in corpus.concept_map("laminar vortex") and corpus.expand("laminar vortex")
    (docs / "b.txt").unlink()
    _, orphans, ok = corpus.check(str(docs))
    assert [r["source"] for r in orphans.collect()] == ["b.txt"] and ok is False
    assert corpus.ingest(str(docs), "other") == {"new": 1}


def test_shrunken_and_shared_names(spark, tmp_path):
    docs, now = tmp_path / "docs", int(time.time()) - 1000
    (docs / "sub").mkdir(parents=True)
    body = "It was the laminar vortex and then the resonant cavity or the plastic magnet that counted in each of the runs made here. " * 3
    write(docs / "one.txt", body, now)
    write(docs / "two.txt", body + "Purple submarines sank.", now)
    write(docs / "sub" / "two.txt", body + "Green trains stopped.", now)
    corpus = Corpus(spark, str(tmp_path / "store"), parts=16)
    assert corpus.ingest(str(docs)) == {"new": 3}
    chunks = corpus.table("chunks")
    assert chunks.count() == 3 and chunks.select("id").distinct().count() == 2
    assert len(corpus.search("purple submarines", 2)) == 2 and len(corpus.search("green trains", 10)) == 3  # no more than there are, though ids are shared
    before = corpus.tables["chunks"].current()
    write(docs / "one.txt", "short", now + 500)
    assert corpus.ingest(str(docs)) == {"changed": 1, "skip": 2}
    assert {r["source"] for r in corpus.table("chunks").collect()} == {"two.txt", "sub/two.txt"} == {r["source"] for r in corpus.table("links").collect()}
    assert corpus.ingest(str(docs)) == {"skip": 3}
    after = corpus.tables["chunks"].current()
    assert sum(after[p] != n for p, n in before.items()) <= 1  # other parts stand as they were written
    weight = corpus.graph().filter("a = 'laminar vortex' and b = 'resonant cavity'").first()["weight"]
    assert weight == 2 and sorted(map(tuple, corpus.graph().collect())) == sorted(map(tuple, G.edges(corpus.table("links").selectExpr("entity", "concat(source, chunk) chunk")).collect()))
    assert corpus.vacuum() >= 1 and corpus.table("chunks").count() == 2


PDF = b"%PDF-1.4\n1 0 obj <</Type /Catalog>> 2 0 obj <</Type /Pages /Count 2>> <</Type /Page>> <</Type/Page>>\n<</Title (A \\(fine\\) Report) /Author <FEFF00C900760061> /CreationDate (D:20240305120000Z)>>"


def test_pdf_files(spark, tmp_path):
    from pyspark.sql import functions as F

    docs, now, calls = tmp_path / "docs", int(time.time()) - 1000, tmp_path / "calls"
    docs.mkdir()
    calls.mkdir()
    for name, content in (("report.pdf", PDF), ("locked.pdf", PDF + b" /Encrypt 5 0 R"), ("other.pdf", PDF.replace(b"Title", b"X"))):
        (docs / name).write_bytes(content)
        os.utime(docs / name, (now, now))
    (docs / "bad.txt").write_bytes(b"a\0b")
    words = "It was the laminar vortex and then the resonant cavity or the plastic magnet that counted in each of the runs made here. " * 3

    def extract(files):
        (calls / str(len(list(calls.iterdir())))).touch()
        text = F.when(~F.contains("source", F.lit("locked")), F.concat(F.regexp_replace("source", "other.pdf", "report"), F.lit("\n" + words)))
        return files.select("source", text.alias("text"))

    corpus = Corpus(spark, str(tmp_path / "store"), extract_pdf=extract)
    assert corpus.ingest(str(docs)) == {"new": 4, "failed": 2}
    states = {r["source"]: r["status"] for r in corpus.failures().collect()}
    assert "encrypted" in states["locked.pdf"] and "bad.txt" in states and states["other.pdf"].startswith("done: none of the words")
    row = corpus.table("chunks").filter("source = 'report.pdf'").first()
    assert (row["title"], row["author"], row["page_count"], row["creation_date"]) == ("A (fine) Report", "Éva", 2, "2024-03-05")
    assert corpus.table("chunks").filter("source = 'other.pdf'").first()["title"] == "other"
    report = {r["source"]: r["extracted"] for r in corpus.check(str(docs))[0].collect()}
    assert report["locked.pdf"] == "MISSING" and report["report.pdf"] == "EMPTY"  # by the size of the extracted text
    assert corpus.ingest(str(docs), "again") == {"new": 4, "failed": 2} and corpus.table("cache").count() == 2
    assert corpus.table("chunks").filter("source = 'report.pdf'").count() == 2
    assert Corpus(spark, str(tmp_path / "store")).ingest(str(docs), "third") == {"new": 4, "failed": 2}  # without an extractor, from the cache


def test_embedder_decides_the_search(spark, tmp_path):
    from pyspark.sql import functions as F

    from lodestrata.sources.providers import hashed_embedding

    texts = ["The sky is blue today.", "Bread is baked from flour.", "Cars need fuel to drive."]
    length = lambda text: F.array(F.length(text).cast("double"), F.lit(1.0))
    for embed, first in ((hashed_embedding(), "Bread is baked from flour."), (None, "Bread is baked from flour."), (length, texts[1])):
        corpus = Corpus(spark, str(tmp_path / f"store{first == texts[1]}{embed is None}{embed is length}"), embedder=embed)
        corpus.ingest_texts(texts, ["1", "2", "3"])
        assert corpus.search("baked bread from flour" if embed is not length else "x" * 26, 1) == [first]


def test_texts_search(spark, tmp_path):
    corpus = Corpus(spark, str(tmp_path / "store"))
    assert corpus.search("anything") == []
    texts = ["The sky is blue today.", "Bread is baked from flour.", "Cars need fuel to drive."]
    assert corpus.ingest_texts(texts, ["1", "2", "3"], collection="t") == 3
    assert corpus.ingest_texts(["The sky is grey."], ["1"], collection="t") == 1
    assert corpus.search("what is in the sky", 1, "t") == ["The sky is grey."]
    assert "flour" in corpus.search_graph("baked bread", 1, collection="t")[0]


def test_json_round_trips(spark):
    manifest = spark.createDataFrame([("a", 1.5), ("b", None)], "source string, mtime double")
    assert sorted(map(tuple, read_manifest(manifest_json(manifest)).collect()), key=str) == [("a", 1.5), ("b", None)]
    links = spark.createDataFrame([("x", "1"), ("y", "1")], "entity string, chunk string")
    nodes, edges = read_graph(G.node_link_json(links, G.edges(links)))
    assert sorted(map(tuple, nodes.collect())) == [("x", "1"), ("y", "1")] and [tuple(r) for r in edges.collect()] == [("x", "y", 1)]
