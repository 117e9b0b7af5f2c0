import pytest

from lodestrata.functions import metadata as M
from lodestrata.operators.ingest import ingest, pending
from lodestrata.sources.files import csv_prose, scan, sniff

CASES = [
    (b"%PDF-1.7", "pdf"), (b"ab\0cd", "unsupported"), (None, "unsupported"), (b"", "text"), (b"# Title\ntext", "markdown"), (b"x\n" * 39 + b"## T", "markdown"), (b"x\n" * 40 + b"## T", "text"),
    (b"a,b,c\n1,2,3\n4,5,6\n", "csv"), (b"a;b\n1;2\n3;4\n", "csv"), (b"a\tb\n1\t2\n", "csv"), (b"Just one line of prose", "text"), ("café ".encode() * 2000 + "é".encode()[:1], "text"),
]


@pytest.mark.parametrize("head,wanted", CASES)
def test_sniff(head, wanted):
    assert sniff(head) == wanted


def test_csv_prose():
    assert csv_prose("key,age,town\n1,31,Ulm\n2,40,Rome\n3,7,Bonn\n") == "key: 1 | age: 31 | town: Ulm\n\nkey: 2 | age: 40 | town: Rome\n\nkey: 3 | age: 7 | town: Bonn"
    assert csv_prose("1,2\n,\n3,\n4,5\n6,7\n") == "col0: 1 | col1: 2\n\ncol0: 3\n\ncol0: 4 | col1: 5\n\ncol0: 6 | col1: 7"
    assert csv_prose("only a line of prose") == "col0: only a line of prose"
    assert csv_prose("") == ""


def test_names(column):
    assert column(M.suffix, "a/b.c/D.PDF") == "pdf" and column(M.suffix, "a/none") == "" and column(M.stem, "a/b.tar.gz") == "b.tar"
    assert column(M.cache_key, "a/b/c.pdf") == "a__b__c.md"
    assert column(M.pdf_date, "D:20210304120000") == "2021-03-04" and column(M.pdf_date, "2021") == "" and column(M.pdf_date, None) == ""
    assert column(M.real_title, "Microsoft Word - x") == "" and column(M.real_title, "Documentation") == "Documentation" and column(M.real_title, None) == ""
    assert column(M.real_author, "abc") == "" and column(M.real_author, "N/A") == "" and column(M.real_author, "Ann Lee") == "Ann Lee"
    stem = "Physics_ a start -- A_B_ Cee -- House -- isbn13 9 -- abc -- Anna's Archive"
    assert column(lambda c: M.archive_names(c)[0], stem) == "Physics: a start" and column(lambda c: M.archive_names(c)[1], stem) == "A.B. Cee"
    assert column(lambda c: M.archive_names(c)[0], "plain") == ""


def test_files_to_chunks_and_again(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/a.md").write_text("# Head\n" + "Some words make a sentence here. " * 10)
    (tmp_path / "b.csv").write_text("name,what\n" + "\n".join(f"thing{i},value number {i} here" for i in range(20)))
    (tmp_path / "c.exe").write_text("no")
    files = scan(spark, str(tmp_path))
    assert sorted(r["source"] for r in files.select("source").collect()) == ["b.csv", "sub/a.md"]
    chunks = ingest(files).collect()
    assert {r["id"] for r in chunks} == {"a__ch0", "b__ch0"} and {r["doc_type"] for r in chunks} == {"markdown", "csv"}
    manifest = files.select("source", "mtime")
    assert pending(files, manifest).count() == 0 and pending(files, manifest.limit(0)).count() == 2


def test_stream_upserts(spark, tmp_path):
    from lodestrata.streaming.intake import read_chunks, upsert_stream

    schema = "collection_name string, id string, document string, ingested_at timestamp, mtime double"
    inbox, store, mark = (str(tmp_path / x) for x in ("in", "store", "mark"))
    for n, rows in enumerate([[("c", "a", "old"), ("c", "b", "b")], [("c", "a", "new")]]):
        df = spark.createDataFrame(rows, "collection_name string, id string, document string").selectExpr("*", f"timestamp'2024-01-0{n + 1}' ingested_at", f"{float(n)}D mtime")
        df.coalesce(1).write.parquet(f"{inbox}/{n}")
        upsert_stream(read_chunks(spark, inbox, schema), store, mark).awaitTermination()
    from lodestrata.streaming.intake import stored

    table = stored(spark, store, schema)
    assert {r["id"]: r["document"] for r in table.read().collect()} == {"a": "new", "b": "b"}
    touched = table.versions()
    assert set(touched) == {0, 1} and len(touched[1]) == 1  # the second batch left the other part alone
