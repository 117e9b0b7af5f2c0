"""Files as tables: scanning, format by content, CSV as prose."""

from __future__ import annotations

import csv
import io
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions import metadata as M

HEAD_BYTES, HEAD_CHARACTERS = 8192, 4096
DELIMITERS = ",;\t|"


def scan(spark: SparkSession, root: str) -> DataFrame:
    """``source, filename, suffix, mtime, length, content`` of the supported files under ``root``; content is read only if selected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.regexp_replace("path", "^file:/*", "/")
    inside = F.regexp_replace(path, "^" + re.escape(root.rstrip("/")) + "/", "")
    rows = files.select(inside.alias("source"), M.filename(path).alias("filename"), M.suffix(path).alias("suffix"), F.unix_micros("modificationTime").alias("micros"), "length", "content")
    return rows.withColumn("mtime", F.col("micros") / 1e6).drop("micros").filter(M.is_supported(F.col("source")))


def dialect_of(sample: str):
    """The CSV dialect a sample seems to have, or None."""
    try:
        return csv.Sniffer().sniff(sample, delimiters=DELIMITERS)
    except csv.Error:
        return None


def sniff(head: bytes | None) -> str:
    """pdf, unsupported, text, markdown or csv by the first bytes of a file. No bytes at all are text, null is unsupported."""
    if head is None:
        return "unsupported"
    head = bytes(head[:HEAD_BYTES])
    if head.startswith(b"%PDF"):
        return "pdf"
    if b"\0" in head:
        return "unsupported"
    try:
        text = head.decode("utf-8")
    except UnicodeDecodeError:
        text = head.decode("latin-1")
    full = [x for x in text.splitlines() if x.strip()]
    if any(re.match(r"#{1,6}\s+\S", x) for x in full[:40]):
        return "markdown"
    dialect = dialect_of(text[:HEAD_CHARACTERS]) if full else None
    if dialect is not None:
        try:
            widths = [len(r) for r in csv.reader(io.StringIO("\n".join(full[:20])), dialect) if r][:10]
        except csv.Error:
            widths = []
        if widths and widths[0] > 1 and max(widths) - min(widths) <= 1:
            return "csv"
    return "text"


def format_of(content: Column) -> Column:
    """A file's format by its content. Only its head goes to Python."""
    return F.pandas_udf(lambda heads: pd.Series([sniff(h) for h in heads]), T.StringType())(F.substring(content, 1, HEAD_BYTES))


def decode(content: Column) -> Column:
    """Bytes as text, bad ones as the replacement character; within the JVM."""
    return F.make_valid_utf8(content.cast("string"))


def csv_prose(text: str) -> str:
    """Each row as ``header: value | ...``, rows apart by a blank line; without a header the columns are col0, col1, ..."""
    sample = text[:HEAD_CHARACTERS]
    dialect, header = dialect_of(sample), False
    if dialect is not None:
        try:
            header = csv.Sniffer().has_header(sample)
        except csv.Error:
            dialect = None
    rows = list(csv.reader(io.StringIO(text, newline=""), dialect or csv.excel))
    if not rows:
        return ""
    names = rows[0] if header else [f"col{i}" for i in range(len(rows[0]))]
    out = [" | ".join(f"{n}: {v}" for n, v in zip(names, r) if v.strip()) for r in rows[header:]]
    return "\n\n".join(x for x in out if x)


def csv_text(text: Column) -> Column:
    return F.pandas_udf(lambda xs: pd.Series([None if x is None else csv_prose(x) for x in xs]), T.StringType())(text)


def row_prose(columns: list[str]) -> Column:
    """A table row as prose, blank values left out; within the JVM."""
    parts = [F.when(F.trim(F.col(c).cast("string")) != "", F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns]
    return F.concat_ws(" | ", *parts)
