"""Provenance of files: names, titles, authors, dates, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions import patterns as P
from lodestrata.functions.text import strip


def filename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """The lower-case suffix without its dot, empty if there is none."""
    return F.lower(F.regexp_extract(filename(path), r"^.+\.([^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(filename(path), r"^(.+)\.[^.]*$", "$1")


def is_supported(path: Column) -> Column:
    return suffix(path).isin(*P.SUFFIXES)


def cache_key(path: Column) -> Column:
    """The flat name under which a file's extracted text is kept."""
    return F.regexp_replace(F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(".md")), r"[/\\]", "__")


def pdf_date(raw: Column) -> Column:
    """``D:YYYYMMDD...`` as ``YYYY-MM-DD``, anything else empty; days are not checked against the calendar."""
    parts = [F.regexp_extract(raw, P.PDF_DATE, i) for i in (1, 2, 3)]
    return F.when(raw.rlike(P.PDF_DATE), F.concat_ws("-", *parts)).otherwise("")


def real_title(raw: Column) -> Column:
    text = strip(F.coalesce(raw, F.lit("")))
    return F.when(text.rlike(P.PLACEHOLDER_TITLE), "").otherwise(text)


def real_author(raw: Column) -> Column:
    text = strip(F.coalesce(raw, F.lit("")))
    return F.when(text.rlike(P.PLACEHOLDER_AUTHOR), "").otherwise(text)


def archive_names(file_stem: Column) -> tuple[Column, Column]:
    """Title and author of a stem ``title -- author -- ... -- tag``, both empty if it is none."""

    def plain(part: int) -> Column:
        found = F.regexp_extract(strip(file_stem), P.ARCHIVE_STEM, part)
        return strip(F.regexp_replace(F.regexp_replace(found, r"\b([A-Z])_([A-Z])_(?!\w)", "$1.$2."), rf"_(?={P.SPACE})", ":"))

    return plain(1), plain(2)


def first_of(*choices: Column) -> Column:
    """The first that is not empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices], F.lit(""))


def document_title(raw: Column, file_stem: Column) -> Column:
    return first_of(real_title(raw), archive_names(file_stem)[0], file_stem)


def document_author(raw: Column, file_stem: Column) -> Column:
    return first_of(real_author(raw), archive_names(file_stem)[1])


def chunk_id(file_stem: Column, number: Column) -> Column:
    return F.concat(file_stem, F.lit("__ch"), number.cast("string"))
