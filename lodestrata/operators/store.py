"""The chunk store: keyed upsert, replacement by source, manifest, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.text import strip

MIN_EXTRACTED = 500


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, nulls first; of rows equal in it the one greatest in the other columns.

    A maximum of structs, so it is combined before the shuffle and no key, however often sent, is sorted.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"row.`{c}`").alias(c) for c in rows.columns])


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stored and incoming rows, the last of each key."""
    return latest(stored.unionByName(incoming, allowMissingColumns=True), keys, order)


def replace_sources(stored: DataFrame, incoming: DataFrame, keys: tuple[str, ...] = ("collection_name", "source"), taken: DataFrame | None = None) -> DataFrame:
    """Stored rows of sources that do not come in again, and all incoming ones: a file that shrank leaves no old tail.

    ``taken`` are the keys of all that was taken in, of which some may have given no rows; without it they are those of the incoming rows."""
    gone = (incoming if taken is None else taken).select(*keys).distinct()
    return stored.join(gone, list(keys), "left_anti").unionByName(incoming)


def ingest_texts(stored: DataFrame, texts: DataFrame, collection: str = "default") -> DataFrame:
    """Given ``id, document`` (and any metadata) put into a collection as they are; the last of an id stays."""
    named = texts.withColumn("collection_name", F.lit(collection))
    return replace_sources(stored, named, ("collection_name", "id"))


def file_status(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``source, mtime, status``: new, changed or skip for each file, by the manifest's time.

    A file listed more than once counts with its latest time; an entry without a time counts as none; a file without a time is changed if the manifest knows
    it.
    """
    now = files.groupBy("source").agg(F.max("mtime").alias("mtime"))
    then = manifest.filter("mtime is not null").groupBy("source").agg(F.max("mtime").alias("stored"))
    status = F.when(F.col("stored").isNull(), "new").when(F.col("stored") >= F.col("mtime"), "skip").otherwise("changed")
    return now.join(then, "source", "left").select("source", "mtime", status.alias("status"))


def next_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``source, mtime`` after the files have been taken in; entries of files that are gone stay."""
    both = manifest.select("source", "mtime").unionByName(files.select("source", "mtime"))
    return both.groupBy("source").agg(F.max("mtime").alias("mtime"))


def cache_status(files: DataFrame, cache: DataFrame) -> DataFrame:
    """``source, status``: hit if the cached text is at least as new as its file, stale or missing otherwise."""
    now = files.groupBy("source").agg(F.max("mtime").alias("mtime"))
    kept = cache.groupBy("source").agg(F.max("mtime").alias("cached"))
    status = F.when(F.col("cached").isNull(), "missing").when(F.col("cached") >= F.col("mtime"), "hit").otherwise("stale")
    return now.join(kept, "source", "left").select("source", status.alias("status"))


def stem_words(stem: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(stem), F.lit("[a-z]{4,}"), F.lit(0)))


def misaligned(stem: Column, head: Column) -> Column:
    """Whether a text's first lines have none of the words of its file's name; false for a name without words."""
    words = stem_words(stem)
    return (F.size(words) > 0) & ~F.exists(words, lambda w: F.contains(F.lower(head), w))


def chunks_per_source(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("chunks"))


def short_name(name: Column, width: int = 52) -> Column:
    return F.when(F.length(name) > width, F.concat(F.substring(name, 1, width - 1), F.lit("…"))).otherwise(name)


def completeness(files: DataFrame, chunks: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """``source, name, extracted, chunks, issues``: one row a file of a supported suffix.

    extracted is n/a but for PDF: MISSING without a size, EMPTY under 500 bytes, else the kilobytes. issues is OK or what is wrong.
    """
    kind = F.lower(strip(F.col("suffix")))
    once = files.filter(kind.isin(*suffixes)).groupBy("source").agg(F.max("filename").alias("filename"), F.max(kind).alias("suffix"), F.max("length").alias("length"))
    joined = once.join(chunks_per_source(chunks), "source", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))
    size = F.col("length")
    text = F.when(F.col("suffix") != "pdf", "n/a").when(size.isNull(), "MISSING").when(size < MIN_EXTRACTED, "EMPTY").otherwise(F.concat(F.floor(size / 1024).cast("string"), F.lit(" KB")))
    issues = F.array_compact(F.array(F.when(text == "MISSING", "no extracted text"), F.when(text == "EMPTY", "extracted text is empty"), F.when(F.col("chunks") == 0, "no chunks")))
    return joined.select("source", short_name(F.col("filename")).alias("name"), text.alias("extracted"), "chunks", F.when(F.size(issues) == 0, "OK").otherwise(F.array_join(issues, ", ")).alias("issues"))


def orphan_sources(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """``source, chunks`` of the sources that have chunks but no file."""
    return chunks_per_source(chunks).join(files.select("source").distinct(), "source", "left_anti")


def verdict(report: DataFrame, orphans: DataFrame) -> DataFrame:
    """``files, complete, orphans, ok``: one row; ok if there are files, all complete, and no orphans."""
    done = report.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("issues") == "OK").alias("complete"))
    return done.withColumn("orphans", orphans.agg(F.count(F.lit(1))).scalar()).withColumn("ok", F.expr("files > 0 and files = complete and orphans = 0"))
