"""Every operator as a query over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.functions import clean as C
from lodestrata.functions import metadata as M
from lodestrata.functions import patterns as P
from lodestrata.functions import structure as S
from lodestrata.functions import text as X
from lodestrata.functions.entities import entities
from lodestrata.operators import graph as G
from lodestrata.operators import search as V
from lodestrata.operators import segment as K
from lodestrata.operators import store as R
from lodestrata.session import table
from lodestrata.sources import files as I
from lodestrata.sources.json_store import manifest_json, read_manifest

QUERY = "thermal relaxation of the laminar vortex in the resonant cavity"
ASKED = ["time step", "error bound", "boundary condition", "plastic magnet"]
ID = "id"


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select(ID, "document").distinct()


def _cleaned(step):
    return lambda spark, folder: docs(spark, folder).select(ID, step(F.col("document")).alias("text"))


def _flag(test):
    return lambda spark, folder: docs(spark, folder).select(ID, test(F.col("document")).alias("flag"))


def _lines(spark, folder):
    return docs(spark, folder).select(ID, F.posexplode(X.lines(F.col("document"))).alias("pos", "line"))


def q_scan_suffix(spark, folder):
    files = table(spark, folder, "raw_files").select("source").distinct()
    return files.filter(M.is_supported(F.col("source"))).select("source", M.filename(F.col("source")).alias("filename"), M.suffix(F.col("source")).alias("suffix"))


def q_sniff_text(spark, folder):
    return docs(spark, folder).select(ID, I.format_of(F.encode("document", "UTF-8")).alias("format"))


def q_csv_serialize(spark, folder):
    customer = table(spark, folder, "customer")
    return customer.select("c_custkey", I.row_prose(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).alias("text"))


def q_csv_text(spark, folder):
    rows = table(spark, folder, "nation").select(F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey").alias("line"), "n_regionkey")
    files = rows.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("content"))  # five lines a region
    return files.select("n_regionkey", I.csv_text(F.concat(F.lit("key,name,region\n"), "content")).alias("text"))


def q_cache_key(spark, folder):
    return table(spark, folder, "raw_files").select("source").distinct().select("source", M.cache_key(F.col("source")).alias("cache_key"))


def q_cache_hit(spark, folder):
    return R.cache_status(table(spark, folder, "raw_files"), table(spark, folder, "manifest").filter("mtime is not null"))


def q_cache_misaligned(spark, folder):
    rows = table(spark, folder, "chunks").select(ID, "source", "document").distinct()
    head = F.array_join(F.slice(X.lines(F.col("document")), 1, 200), "\n")
    return rows.select(ID, "source", R.misaligned(M.stem(F.col("source")), head).alias("flag"))


def q_upsert_latest(spark, folder):
    rows = table(spark, folder, "chunks").select("collection_name", ID, "document", "source", "mtime", "ingested_at")
    return R.latest(rows, ["collection_name", ID], ["ingested_at", "mtime"])


def _changed(spark, folder):
    return R.file_status(table(spark, folder, "raw_files"), table(spark, folder, "manifest")).filter("status = 'changed'").select("source", F.col("mtime").alias("new"))


def q_replace_sources(spark, folder):
    rows = table(spark, folder, "chunks").select("collection_name", ID, "source", "chunk_index", "mtime").distinct()
    again = rows.join(_changed(spark, folder), "source").select("collection_name", ID, "source", "chunk_index", F.col("new").alias("mtime")).distinct()
    return R.replace_sources(rows, again)


def q_reingest_shrunk(spark, folder):
    """All changed files are taken in again, and only the PDF files among them still give chunks."""
    rows = table(spark, folder, "chunks").select("collection_name", ID, "source").distinct()
    again = rows.join(_changed(spark, folder).select("source"), "source", "left_semi").select(*rows.columns)
    return R.replace_sources(rows, again.filter(M.suffix(F.col("source")) == "pdf"), taken=again)


def q_ingest_texts(spark, folder):
    stored = table(spark, folder, "chunks").select("collection_name", ID, "document").distinct()
    texts = table(spark, folder, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias(ID), F.col("text").alias("document"))
    return R.ingest_texts(stored, texts).select("collection_name", ID, "document")


def q_manifest_diff(spark, folder):
    return R.file_status(table(spark, folder, "raw_files"), table(spark, folder, "manifest"))


def q_ingest_counters(spark, folder):
    return q_manifest_diff(spark, folder).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def q_manifest_roundtrip(spark, folder):
    return read_manifest(manifest_json(R.next_manifest(table(spark, folder, "raw_files"), table(spark, folder, "manifest"))))


def q_boilerplate(spark, folder):
    headings = table(spark, folder, "chunks").select(F.coalesce("heading", F.lit("")).alias("heading")).distinct()
    return headings.select("heading", S.is_boilerplate(F.col("heading")).alias("flag"))


def q_heading_lines(spark, folder):
    return _lines(spark, folder).filter(S.is_heading(F.col("line"))).select(ID, "pos", "line", S.heading_text(F.col("line")).alias("heading"))


def q_prose_words(spark, folder):
    return docs(spark, folder).select(ID, S.prose_words(F.col("document")).alias("n"))


def q_placeholder_meta(spark, folder):
    rows = table(spark, folder, "chunks").select("title", "author").distinct()
    return rows.select("title", "author", M.real_title(F.col("title")).alias("real_title"), M.real_author(F.col("author")).alias("real_author"))


def q_entities(spark, folder):
    return docs(spark, folder).select(ID, F.posexplode(entities(F.col("document"))).alias("place", "entity"))


def q_file_metadata(spark, folder):
    files = table(spark, folder, "raw_files").groupBy("source").agg(F.max("mtime").alias("mtime"))
    path = F.col("source")
    return files.select("source", M.filename(path).alias("filename"), M.stem(path).alias("stem"), M.suffix(path).alias("suffix"), "mtime", M.stem(path).alias("title"), F.lit("").alias("author"), F.lit(0).alias("page_count"), F.lit("").alias("creation_date"))


def q_title_fallback(spark, folder):
    rows = table(spark, folder, "chunks").select("source", "title", "author").distinct()
    stem = M.stem(F.col("source"))
    return rows.select("source", "title", "author", M.document_title(F.col("title"), stem).alias("shown_title"), M.document_author(F.col("author"), stem).alias("shown_author"))


def q_pdf_date(spark, folder):
    dates = table(spark, folder, "chunks").select("creation_date").distinct()
    raw = F.concat(F.lit("D:"), F.replace("creation_date", F.lit("-"), F.lit("")), F.lit("120000Z"))
    return dates.select("creation_date", M.pdf_date(raw).alias("date"))


def q_filename_parse(spark, folder):
    rows = table(spark, folder, "chunks").select("title", "author", "source").distinct()
    stem = F.concat_ws(" -- ", F.replace(F.coalesce("title", F.lit("Notes_ draft")), F.lit(": "), F.lit("_ ")), F.lit("A_B_ Writer"), F.lit("Press"), F.lit(P.ARCHIVE_TAG))
    title, author = M.archive_names(stem)
    return rows.select("source", "title", stem.alias("stem"), title.alias("parsed_title"), author.alias("parsed_author"))


def q_chunk_ids(spark, folder):
    return K.numbered_chunks(K.smart_chunks(docs(spark, folder), ID, "document").withColumnRenamed(ID, "doc"), "doc", F.col("doc")).select("doc", "chunk_index", ID)


def q_lines(spark, folder):
    return docs(spark, folder).select(ID, F.size(X.lines(F.col("document"))).alias("n"), F.array_join(X.lines(F.col("document")), "\n").alias("text"))


def _section_rows(spark, folder, keep=True):
    return K.section_rows(docs(spark, folder), ID, "document", keep)


def q_sections(spark, folder):
    return _section_rows(spark, folder).select(ID, "section_no", "heading", F.size("lines").alias("n"), F.array_join("lines", "\n").alias("text"))


def q_sections_kept(spark, folder):
    return _section_rows(spark, folder, False).select(ID, "section_no", "heading")


def q_heading_norm(spark, folder):
    return _section_rows(spark, folder).select("heading", S.heading_name(F.col("heading")).alias("name")).distinct()


def q_code_runs(spark, folder):
    return _section_rows(spark, folder).select(ID, "section_no", K.code_fenced(F.col("lines")).alias("text"))


def q_paragraphs(spark, folder):
    return _section_rows(spark, folder).select(ID, "section_no", F.posexplode(X.paragraphs(K.code_fenced(F.col("lines")))).alias("place", "paragraph"))


def _sentences(spark, folder):
    flat = F.flatten(F.transform(X.paragraphs(K.code_fenced(F.col("lines"))), X.sentences))
    return _section_rows(spark, folder).select(ID, "section_no", flat.alias("s"))


def q_sentences(spark, folder):
    return _sentences(spark, folder).select(ID, "section_no", F.posexplode("s").alias("place", "sentence"))


def q_chunk_fold(spark, folder):
    ranges = K.chunk_ranges(F.transform("s", X.word_count), 60, 2)
    return _sentences(spark, folder).select(ID, "section_no", F.posexplode(ranges).alias("chunk_no", "r")).select(ID, "section_no", "chunk_no", "r.first", "r.last")


def q_orphan_merge(spark, folder):
    chunks = K.section_chunks(F.col("lines"), 60, 2)
    return _section_rows(spark, folder).select(ID, "section_no", F.posexplode(chunks).alias("chunk_no", "chunk"))


def q_smart_chunk(spark, folder):
    return K.smart_chunks(docs(spark, folder), ID, "document")


def q_orphans_made(spark, folder):
    """q_orphan_merge over texts in which sentences refer to what came before, as few of the collection do."""
    made = docs(spark, folder).select(ID, F.replace("document", F.lit(". The "), F.lit(". Therefore, the ")).alias("document"))
    chunks = K.section_chunks(F.col("lines"), 60, 2)
    return K.section_rows(made, ID, "document", True).select(ID, "section_no", F.posexplode(chunks).alias("chunk_no", "chunk"))


def q_noise_made(spark, folder):
    """The noise filter over tables of contents and lists of links made from the file names, as the collection has none."""
    files = table(spark, folder, "raw_files").select("source", F.max(F.col("length") % 4).over(Window.partitionBy("source")).cast("int").alias("kind")).distinct()
    name = F.substring("source", 1, 40)
    entry, link = F.concat(F.lit("1.2 "), name, F.lit(" ....... 17\n")), F.concat(F.lit("https://example.org/"), F.replace("source", F.lit(" "), F.lit("_")), F.lit("\n"))
    many = F.coalesce("kind", F.lit(0))
    text = F.concat(F.repeat(entry, many), F.repeat(link, 3 - many), F.lit("One line of text.\n"))
    made = files.select("source", text.alias("text"))
    return made.select("source", S.toc_dominated(F.col("text")).alias("toc"), S.url_dominated(F.col("text")).alias("urls"), S.is_meaningful(F.col("text")).alias("keep"))


def q_chunks_per_doc(spark, folder):
    return q_smart_chunk(spark, folder).groupBy(ID).agg(F.count(F.lit(1)).alias("chunks"))


def q_line_freq(spark, folder):
    lines = _lines(spark, folder).select(ID, X.strip(F.col("line")).alias("line")).filter(C.header_candidate(F.col("line")))
    return lines.groupBy(ID, "line").agg(F.count(F.lit(1)).alias("n"))


def q_chunks_per_source(spark, folder):
    return R.chunks_per_source(table(spark, folder, "chunks"))


def _report(spark, folder):
    return R.completeness(table(spark, folder, "raw_files"), table(spark, folder, "chunks"), P.SUFFIXES)


def q_completeness(spark, folder):
    return _report(spark, folder)


def q_completeness_totals(spark, folder):
    return _report(spark, folder).agg(F.count(F.lit(1)).alias("files"), F.sum("chunks").alias("chunks"), F.count_if(F.col("issues") != "OK").alias("with_issues"))


def q_orphan_sources(spark, folder):
    return R.orphan_sources(table(spark, folder, "raw_files"), table(spark, folder, "chunks"))


def q_check_verdict(spark, folder):
    return R.verdict(_report(spark, folder), q_orphan_sources(spark, folder))


def _links(spark, folder):
    return G.node_links(table(spark, folder, "nodes"))


def q_graph_nodes(spark, folder):
    return _links(spark, folder)


def q_graph_edges(spark, folder):
    return G.edges(_links(spark, folder))


def q_graph_update(spark, folder):
    return G.add_edges(table(spark, folder, "edges"))


def q_graph_stats(spark, folder):
    return G.stats(_links(spark, folder), q_graph_update(spark, folder))


def q_graph_topk(spark, folder):
    return G.heaviest(G.adjacency(q_graph_update(spark, folder)), 3)


def q_graph_expand(spark, folder):
    return G.expand(q_graph_update(spark, folder), ASKED)


def q_graph_expand_1hop(spark, folder):
    return G.expand(q_graph_update(spark, folder), ASKED, hops=1)


def q_concept_map(spark, folder):
    return G.concept_map(q_graph_update(spark, folder), ASKED)


def q_graph_json(spark, folder):
    return G.node_link_json(_links(spark, folder), q_graph_update(spark, folder))


def q_graph_from_text(spark, folder):
    return G.text_links(docs(spark, folder), entities(F.col("document"))).groupBy("entity").agg(F.count(F.lit(1)).alias("chunks"))


def _point(spark, folder):
    return [float(x) for x in table(spark, folder, "embeddings").filter("vec_id = 0").first()["embedding"]]


def q_vector_topk(spark, folder):
    return V.nearest(table(spark, folder, "embeddings"), _point(spark, folder)).withColumn("distance", F.round("distance", 6))


def q_vector_topk_label(spark, folder):
    return V.nearest(table(spark, folder, "embeddings"), _point(spark, folder), 10, where=F.col("label") % 2 == 1).withColumn("distance", F.round("distance", 6))


def q_vector_knn_batch(spark, folder):
    rows = table(spark, folder, "embeddings")
    return V.nearest_to_each(rows, rows.filter("vec_id % 100 = 0"), 5).withColumn("distance", F.round("distance", 6))


def q_search_text(spark, folder):
    return V.search_text(table(spark, folder, "chunks"), QUERY, 10)


def q_search_graph(spark, folder):
    return V.search_graph(table(spark, folder, "chunks"), q_graph_update(spark, folder), QUERY, ASKED, 10)


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("q_")} | {
    "q_clean_span": _cleaned(C.span_tags),
    "q_clean_double_sup": _cleaned(C.double_footnotes),
    "q_clean_residual": _cleaned(C.left_footnotes),
    "q_clean_math": _cleaned(C.math_scripts),
    "q_clean_footnote": _cleaned(C.footnotes),
    "q_clean_image": _cleaned(C.page_images),
    "q_clean_ocr": _cleaned(C.recognition_artefacts),
    "q_clean_page": _cleaned(C.page_artefacts),
    "q_clean_all": _cleaned(C.clean),
    "q_table_dominated": _flag(S.table_dominated),
    "q_toc_dominated": _flag(S.toc_dominated),
    "q_url_dominated": _flag(S.url_dominated),
    "q_meaningful": _flag(S.is_meaningful),
}
