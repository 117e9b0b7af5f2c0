import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import graph as G
from lodestrata.operators import search as V
from lodestrata.operators import store as R


def test_latest_is_idempotent_and_takes_ties(spark):
    rows = spark.createDataFrame([("c", "a", 1.0, "x"), ("c", "a", 2.0, "y"), ("c", "a", 2.0, "z"), ("c", "b", None, "n")], "c string, id string, m double, d string")
    once = R.latest(rows, ["c", "id"], ["m"])
    assert sorted((r["id"], r["d"]) for r in once.collect()) == [("a", "z"), ("b", "n")]
    assert R.upsert(once, rows, ["c", "id"], ["m"]).count() == 2
    assert R.latest(rows.limit(0), ["c", "id"], ["m"]).count() == 0


def test_replace_leaves_no_tail(spark):
    stored = spark.createDataFrame([("c", "f", "f__ch0"), ("c", "f", "f__ch1"), ("c", "g", "g__ch0")], "collection_name string, source string, id string")
    got = R.replace_sources(stored, stored.filter("id = 'f__ch0'"))
    assert sorted(r["id"] for r in got.collect()) == ["f__ch0", "g__ch0"]


def test_file_status(spark):
    files = spark.createDataFrame([("n", 1.0), ("c", 3.0), ("s", 2.0), ("o", 1.0), ("u", 1.0), ("c", 2.0)], "source string, mtime double")
    manifest = spark.createDataFrame([("c", 2.0), ("s", 2.0), ("o", 5.0), ("u", None), ("gone", 1.0)], "source string, mtime double")
    assert {r["source"]: r["status"] for r in R.file_status(files, manifest).collect()} == {"n": "new", "c": "changed", "s": "skip", "o": "skip", "u": "new"}


def test_completeness(spark):
    files = spark.createDataFrame([("a.pdf", "a.pdf", "PDF", 499), ("b.pdf", "b.pdf", "pdf", 5000), ("c.txt", "c.txt", "txt", 1), ("d.exe", "d.exe", "exe", 9), ("e.pdf", "e.pdf", "pdf", None)], "source string, filename string, suffix string, length bigint")
    chunks = spark.createDataFrame([("b.pdf",), ("b.pdf",), ("a.pdf",), ("lost.pdf",), (None,)], "source string")
    report = R.completeness(files, chunks, ("pdf", "txt"))
    got = {r["source"]: (r["extracted"], r["chunks"], r["issues"]) for r in report.collect()}
    assert got == {"a.pdf": ("EMPTY", 1, "extracted text is empty"), "b.pdf": ("4 KB", 2, "OK"), "c.txt": ("n/a", 0, "no chunks"), "e.pdf": ("MISSING", 0, "no extracted text, no chunks")}
    orphans = R.orphan_sources(files, chunks)
    assert sorted(r["source"] for r in orphans.collect()) == ["", "lost.pdf"]
    assert R.verdict(report, orphans).first()["ok"] is False
    assert R.verdict(report.limit(0), orphans.limit(0)).first()["ok"] is False


def graph_model(edges, asked, hops, top_n=10):
    around = {}
    for a, b, w in edges:
        around.setdefault(a, []).append((-w, b))
        around.setdefault(b, []).append((-w, a))
    around = {k: sorted(v) for k, v in around.items()}
    score = {}
    for q in set(asked):
        for w, n in around.get(q, [])[:top_n]:
            score[n] = score.get(n, 0) - w
            if hops >= 2:
                for w2, n2 in around[n][:3]:
                    score[n2] = score.get(n2, 0) - 0.5 * w2
    best = sorted((-s, n) for n, s in score.items() if n not in asked)
    return [(n, -s) for s, n in best[:top_n]]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hops", [1, 2])
def test_expansion_follows_the_walk(spark, seed, hops):
    rng = random.Random(seed)
    edges = [(f"n{a:02}", f"n{b:02}", rng.randrange(1, 6)) for a in range(25) for b in range(a + 1, 25) if rng.random() < 0.2]
    asked = ["n03", "n07", "nobody", "n03"]
    df = spark.createDataFrame(edges, "a string, b string, weight bigint")
    got = [(r["concept"], r["score"]) for r in G.expand(df, asked, hops).orderBy("rank").collect()]
    assert got == graph_model(edges, asked, hops)


def test_pairs_in_blocks_equal_all_pairs(spark):
    rng = random.Random(0)
    links = {(f"e{rng.randrange(30)}", f"c{rng.randrange(6)}") for _ in range(140)}
    df = spark.createDataFrame(sorted(links), "entity string, chunk string")
    want = {}
    for x, c in links:
        for y, d in links:
            if c == d and x < y:
                want[x, y] = want.get((x, y), 0) + 1
    for block in (2, 5, 256):
        assert {(r["a"], r["b"]): r["n"] for r in G.count_pairs(df, block=block).collect()} == want


def test_edges_do_not_grow_when_taken_in_again(spark):
    nodes = spark.createDataFrame([(" Alpha ", ["1", "2", None]), ("beta", ["1", "1"]), (None, ["1"]), ("beta", None)], "entity string, chunks array<string>")
    once = G.edges(G.node_links(nodes)).collect()
    assert once == G.edges(G.node_links(nodes.union(nodes))).collect() and once[0]["weight"] == 1


def test_concept_map_puts_asked_first(spark):
    df = spark.createDataFrame([("a", "b", 3), ("a", "c", 2), ("b", "c", 1)], "a string, b string, weight bigint")
    got = G.concept_map(df, ["a"]).orderBy("place", "rank").collect()
    assert [(r["concept"], r["neighbour"]) for r in got] == [("a", "b"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", "a"), ("c", "b")]


def test_batch_search_equals_single(spark):
    rng = random.Random(2)
    rows = [(i, [rng.random() for _ in range(4)]) for i in range(120)] + [(200, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    batch = V.nearest_to_each(df.repartition(5), df.filter("vec_id % 50 = 0"), 4, block=2)
    for q in (0, 50, 100):
        point = [float(x) for x in df.filter(f"vec_id = {q}").first()["embedding"]]
        assert [r["vec_id"] for r in V.nearest(df, point, 4).orderBy("rank").collect()] == [r["vec_id"] for r in batch.filter(f"query = {q}").orderBy("rank").collect()]
    assert V.nearest_to_each(df, df.limit(0)).count() == 0


def test_text_search(spark):
    df = spark.createDataFrame([("s", "The sky is blue and wide."), ("g", "Grass grows green."), ("n", None), ("e", "")], "id string, document string")
    assert V.search_text(df, "what colour is the sky", 1).first()["id"] == "s"
    assert [r["similarity"] for r in V.search_text(df, "", 5).collect()] == [0.0, 0.0, 0.0]
