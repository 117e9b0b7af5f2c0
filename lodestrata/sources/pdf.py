"""What a PDF file says of itself, read from its bytes."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SHAPE = "title string, author string, creation_date string, page_count int, encrypted boolean"
PAGE = re.compile(rb"/Type\s*/Page(?![A-Za-z])")
COUNT = re.compile(rb"/Count\s+(\d+)")
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b"", b"\n": b""}


def _string(content: bytes, name: bytes) -> str:
    """The text of a string entry, written in parentheses or in hexadecimal digits; empty if there is none."""
    if found := re.search(rb"/" + name + rb"\s*\(((?:[^()\\]|\\.|\([^()]*\))*)\)", content, re.S):
        raw = re.sub(rb"\\(\d{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else ESCAPES.get(m[1], m[1]), found[1], flags=re.S)
    elif found := re.search(rb"/" + name + rb"\s*<([0-9A-Fa-f\s]*)>", content):
        digits = re.sub(rb"\s", b"", found[1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        return ""
    return raw[2:].decode("utf-16-be", "replace") if raw.startswith(b"\xfe\xff") else raw.decode("latin-1")


def describe(content: bytes) -> tuple[str, str, str, int, bool]:
    """The values of SHAPE; of a file whose objects are compressed or encrypted, what stands outside of them."""
    pages = len(PAGE.findall(content)) or max((int(n) for n in COUNT.findall(content)), default=0)
    return _string(content, b"Title").strip(), _string(content, b"Author").strip(), _string(content, b"CreationDate"), pages, b"/Encrypt" in content


def described(content: Column) -> Column:
    def read(files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([("", "", "", 0, False) if f is None else describe(bytes(f)) for f in files], columns=[c.split()[0] for c in SHAPE.split(", ")])

    return F.pandas_udf(read, SHAPE)(content)
