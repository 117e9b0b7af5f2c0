"""A corpus on shared storage: what a user ingests into, searches and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import patterns as P
from lodestrata.functions.entities import entities
from lodestrata.functions.metadata import cache_key
from lodestrata.operators import graph as G
from lodestrata.operators import search as V
from lodestrata.operators import store as R
from lodestrata.operators.ingest import CACHE, chunks_of, pending, texts_of
from lodestrata.session import settle
from lodestrata.sources.files import scan
from lodestrata.sources.partitioned import PartitionedTable
from lodestrata.sources.providers import Embedder, EntityExtractor, Extractor

CHUNKS = (
    "collection_name string, id string, document string, source string, filename string, doc_type string, mtime double, title string, author string, "
    "page_count int, creation_date string, heading string, chunk_index int, ingested_at timestamp"
)
#: ``place`` is what a row is replaced by: its source, or for texts without one a bucket of ids.
PLACED = ("collection_name", "place")
SHAPES = {
    "chunks": f"{CHUNKS}, place string",
    "links": "collection_name string, place string, source string, entity string, chunk string",
    "edges": "collection_name string, place string, a string, b string, weight bigint",
    "manifest": "collection_name string, source string, mtime double, status string",
}
BUCKETS = 4096


def place() -> Column:
    return F.coalesce("source", F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("string")))


class Corpus:
    """Tables under ``root``: chunks, their entities, what each source adds to the entity graph, a manifest, and the text extracted from PDF files.

    All are kept in parts by source. Taking files in reads and writes only the parts they belong to; the graph's edges are summed from what the
    sources add, so no pair is counted again that did not change.
    """

    def __init__(self, spark: SparkSession, root: str, entity_extractor: EntityExtractor = entities, extract_pdf: Extractor | None = None, embedder: Embedder | None = None, parts: int = 64):
        self.spark, self.root, self.entities, self.extract_pdf, self.embedder = spark, root.rstrip("/"), entity_extractor, extract_pdf, embedder
        keys = {"manifest": ("collection_name", "source")}
        self.tables = {name: PartitionedTable(spark, f"{self.root}/{name}", shape, keys.get(name, PLACED), parts) for name, shape in SHAPES.items()}
        self.tables["cache"] = PartitionedTable(spark, f"{self.root}/cache", CACHE, ("source",), parts)

    def table(self, name: str) -> DataFrame:
        return self.tables[name].read()

    def _take_in(self, chunks: DataFrame, gone: DataFrame) -> None:
        """Chunks, their links and edges put in the place of those of the places ``gone``. Both are settled."""
        self.tables["chunks"].replace(chunks, gone, PLACED)
        found = chunks.select(*PLACED, "source", F.explode(self.entities(F.col("document"))).alias("entity"), F.col("id").alias("chunk"))
        links = settle(found.dropna(subset=["entity", "chunk"]).distinct())
        self.tables["links"].replace(links, gone, PLACED)
        record = F.struct(*PLACED, "chunk")
        self.tables["edges"].replace(G.edges_within(links.withColumn("record", record), F.col("record.collection_name"), F.col("record.place")), gone, PLACED)

    def ingest(self, folder: str, collection: str = "default") -> dict[str, int]:
        """New and changed files of a folder taken in; the number of files by status: new, changed, skip, and of the first two failed.

        A file that gives no chunk any more loses those it had. A file that fails is noted with the reason, keeps what it had, and is tried again the next
        time. The manifest comes last, so what a failed run did not finish is done again, which changes nothing.
        """
        files = scan(self.spark, folder)
        manifest = self.table("manifest").filter(F.col("collection_name") == collection)
        status = R.file_status(files, manifest.filter("status like 'done%'"))
        counts = {r["status"]: r["count"] for r in status.groupBy("status").count().collect()}
        if counts.get("new", 0) + counts.get("changed", 0):
            todo = pending(files, manifest.filter("status like 'done%'"))
            docs = settle(texts_of(todo, self.extract_pdf, self.table("cache")))
            fresh = docs.filter("raw is not null and not from_cache").select("source", cache_key(F.col("source")).alias("cache_key"), "mtime", F.col("raw").alias("text"))
            if fresh.limit(1).count():
                self.tables["cache"].replace(fresh, fresh.select("source"), ("source",))
            good = docs.filter("status like 'done%'")
            gone = settle(good.select(F.lit(collection).alias("collection_name"), F.col("source").alias("place")).distinct())
            self._take_in(settle(chunks_of(good, collection).withColumn("place", place())), gone)
            noted = docs.select(F.lit(collection).alias("collection_name"), "source", "mtime", "status")
            self.tables["manifest"].replace(noted, noted, ("collection_name", "source"))
            failed = docs.filter("status like 'failed%'").count()
            counts |= {"failed": failed} if failed else {}
        return counts

    def failures(self, collection: str = "default") -> DataFrame:
        """``source, status`` of the files that could not be taken in, or whose text does not seem to be theirs."""
        return self.table("manifest").filter((F.col("collection_name") == collection) & (F.col("status") != "done")).select("source", "status")

    def ingest_texts(self, documents: list[str], ids: list[str], metadatas: list[dict] | None = None, collection: str = "default") -> int:
        """Texts put in as they are, under the given ids; what had an id before is replaced."""
        names = [c.split() for c in CHUNKS.split(", ")]
        given = [{"collection_name": collection, "id": i, "document": d, **(m or {})} for i, d, m in zip(ids, documents, metadatas or [None] * len(ids))]
        rows = self.spark.createDataFrame([tuple(g.get(n) for n, _ in names) for g in given], CHUNKS).withColumn("ingested_at", F.current_timestamp()).withColumn("place", place())
        rows = settle(R.latest(rows, ["collection_name", "id"], ["ingested_at", "mtime"]))
        stale = self.table("chunks").select("collection_name", "id", "place").join(rows.select("collection_name", "id"), ["collection_name", "id"], "left_semi")
        gone = settle(stale.select(*PLACED).union(rows.select(*PLACED)).distinct())
        beside = self.tables["chunks"].read(self.tables["chunks"].touched(gone)).join(gone, list(PLACED), "left_semi").join(rows.select("collection_name", "id"), ["collection_name", "id"], "left_anti")
        self._take_in(settle(beside.select(*rows.columns).unionByName(rows)), gone)
        return len(given)

    def graph(self, collection: str | None = None) -> DataFrame:
        edges = self.table("edges")
        edges = edges if collection is None else edges.filter(F.col("collection_name") == collection)
        return edges.groupBy("a", "b").agg(F.sum("weight").alias("weight"))

    def query_entities(self, query: str) -> list[str]:
        return self.spark.createDataFrame([(query,)], "q string").select(self.entities(F.col("q"))).first()[0] or []

    def search(self, query: str, n: int = 5, collection: str = "default") -> list[str]:
        """The n documents most like the query, by the embedder if there is one."""
        chunks = self.table("chunks").filter(F.col("collection_name") == collection)
        return [r["document"] for r in V.best_texts(chunks, query, n, embed=self.embedder).orderBy("rank").collect()]

    def expand(self, query: str, hops: int = 2, top_n: int = 10) -> list[str]:
        asked = self.query_entities(query)
        return [r["concept"] for r in G.expand(self.graph(), asked, hops, top_n).orderBy("rank").collect()] if asked else []

    def search_graph(self, query: str, n: int = 5, hops: int = 2, collection: str = "default") -> list[str]:
        return self.search(" ".join([query, *self.expand(query, hops)]), n, collection)

    def concept_map(self, query: str, hops: int = 2) -> dict[str, list[str]]:
        asked = self.query_entities(query)
        out: dict[str, list[str]] = {}
        for r in G.concept_map(self.graph(), asked, hops).orderBy("place", "rank").collect() if asked else []:
            out.setdefault(r["concept"], []).append(r["neighbour"])
        return out

    def stats(self) -> dict[str, int]:
        return G.stats(self.table("links").select("entity", "chunk"), self.graph()).first().asDict()

    def check(self, folder: str) -> tuple[DataFrame, DataFrame, bool]:
        """The report on a folder's files, the sources without a file, and whether all is well. Of a PDF the size of its extracted text counts."""
        files = scan(self.spark, folder).select("source", "filename", "suffix", "mtime", "length")
        texts = self.table("cache").groupBy("source").agg(F.max(F.octet_length("text")).alias("extracted"))
        sized = files.join(texts, "source", "left").withColumn("length", F.when(F.col("suffix") == "pdf", F.col("extracted")).otherwise(F.col("length"))).drop("extracted")
        report = R.completeness(sized, self.table("chunks"), P.SUFFIXES)
        orphans = R.orphan_sources(files, self.table("chunks").filter("source is not null"))
        return report, orphans, bool(R.verdict(report, orphans).first()["ok"])

    def vacuum(self) -> int:
        """Removes what later versions of the tables have replaced."""
        return sum(t.vacuum() for t in self.tables.values())
