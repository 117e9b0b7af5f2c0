"""From files to chunks: the pipeline that the parts make up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import metadata as M
from lodestrata.functions.clean import clean
from lodestrata.functions.text import lines
from lodestrata.operators.segment import numbered_chunks, smart_chunks
from lodestrata.operators.store import cache_status, file_status, misaligned
from lodestrata.sources.files import csv_text, decode, format_of
from lodestrata.sources.pdf import described
from lodestrata.sources.providers import Extractor

#: Lines at the head of an extracted text in which the words of its file's name are looked for.
HEAD_LINES = 200
ENCRYPTED = "failed: the PDF is encrypted or protected by a password; decrypt it and take it in again"
NO_TEXT = "failed: no text could be extracted"
NO_EXTRACTOR = "failed: a PDF needs an extractor"
UNSUPPORTED = "failed: neither text nor PDF"
MISALIGNED = "done: none of the words of the file's name stand at the head of its text"
CACHE = "source string, cache_key string, mtime double, text string"


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """The files that are new or changed."""
    return files.join(file_status(files, manifest).filter("status != 'skip'").select("source"), "source", "left_semi")


def extracted(pdf: DataFrame, extract_pdf: Extractor | None, cache: DataFrame | None = None) -> DataFrame:
    """``source, text, from_cache``: the raw text of PDF files, from the cache if it is no older than the file, else by the extractor.

    Files that have neither have null text.
    """
    blank = pdf.select("source", F.lit(None).cast("string").alias("text"), F.lit(False).alias("from_cache"))
    if cache is None:
        return blank if extract_pdf is None else extract_pdf(pdf).select("source", "text", F.lit(False).alias("from_cache"))
    kept = cache.filter("text is not null")
    hits = cache_status(pdf, kept).filter("status = 'hit'").select("source")
    old = kept.join(hits, "source", "left_semi").select("source", "text", F.lit(True).alias("from_cache"))
    new = pdf.join(hits, "source", "left_anti")
    made = new.select("source", F.lit(None).cast("string").alias("text"), F.lit(False).alias("from_cache")) if extract_pdf is None else extract_pdf(new).select("source", "text", F.lit(False).alias("from_cache"))
    return old.unionByName(made)


def texts_of(files: DataFrame, extract_pdf: Extractor | None = None, cache: DataFrame | None = None) -> DataFrame:
    """``source, filename, mtime, doc_type, raw, text, title, author, page_count, creation_date, from_cache, status``: one row a file.

    The format is that of the content. A PDF's raw text comes from the cache or the extractor and is cleaned; what it says of itself goes along. A file that gives no text
    has the reason as its status and stops no other.
    """
    typed = files.withColumn("doc_type", format_of(F.col("content")))
    text = F.when(F.col("doc_type") == "csv", csv_text(decode(F.col("content")))).when(F.col("doc_type") != "unsupported", decode(F.col("content")))
    status = F.when(F.col("doc_type") == "unsupported", UNSUPPORTED).otherwise("done")
    plain = typed.filter("doc_type != 'pdf'").select(
        "source", "filename", "mtime", "doc_type", F.lit(None).cast("string").alias("raw"), text.alias("text"), F.lit("").alias("title"), F.lit("").alias("author"), F.lit(0).alias("page_count"),
        F.lit("").alias("creation_date"), F.lit(False).alias("from_cache"), status.alias("status"),
    )
    pdf = typed.filter("doc_type = 'pdf'")
    told = pdf.select("source", "filename", "mtime", "doc_type", described(F.col("content")).alias("told"))
    raw = extracted(pdf, extract_pdf, cache)
    head = F.array_join(F.slice(lines(F.col("text")), 1, HEAD_LINES), "\n")
    missing = F.when(F.col("told.encrypted"), ENCRYPTED).otherwise(NO_EXTRACTOR if extract_pdf is None else NO_TEXT)
    state = F.when(F.col("text").isNull(), missing).when(misaligned(M.stem(F.col("source")), head), MISALIGNED).otherwise("done")
    of_pdf = told.join(raw, "source", "left").select(
        "source", "filename", "mtime", "doc_type", F.col("text").alias("raw"), clean(F.col("text")).alias("text"), F.col("told.title").alias("title"), F.col("told.author").alias("author"),
        F.col("told.page_count").alias("page_count"), M.pdf_date(F.col("told.creation_date")).alias("creation_date"), F.coalesce("from_cache", F.lit(False)).alias("from_cache"), state.alias("status"),
    )
    return plain.unionByName(of_pdf)


def chunks_of(docs: DataFrame, collection: str = "default") -> DataFrame:
    """Chunks with ids and metadata from the rows of texts_of, ready for the store.

    An id is the file's stem and the chunk's number; files of one stem in several folders share ids and are told apart by their source.
    """
    stem = M.stem(F.col("source"))
    chunks = numbered_chunks(smart_chunks(docs, "source", "text"), "source", stem)
    named = chunks.join(docs.select("source", "filename", "mtime", "doc_type", "title", "author", "page_count", "creation_date"), "source")
    return named.select(
        F.lit(collection).alias("collection_name"), "id", F.col("body").alias("document"), "source", "filename", "doc_type", "mtime", M.document_title(F.col("title"), stem).alias("title"),
        M.document_author(F.col("author"), stem).alias("author"), "page_count", "creation_date", "heading", "chunk_index", F.current_timestamp().alias("ingested_at"),
    )


def ingest(files: DataFrame, collection: str = "default", extract_pdf: Extractor | None = None) -> DataFrame:
    """Chunks of the given files."""
    return chunks_of(texts_of(files, extract_pdf), collection)
