"""What needs a model stands behind these protocols, with a deterministic default that needs none."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.entities import entities


class Extractor(Protocol):
    """Text of files: adds ``text`` to ``source, content``."""

    def __call__(self, files: DataFrame) -> DataFrame: ...


class EntityExtractor(Protocol):
    """An array of lower-case entities of a text, in order, each once."""

    def __call__(self, text: Column) -> Column: ...


class Embedder(Protocol):
    """A vector for a text."""

    def __call__(self, text: Column) -> Column: ...


def extracted_table(extracted: DataFrame) -> Extractor:
    """PDF text from a table ``source, text`` made elsewhere; files not in it have null text."""
    return lambda files: files.join(extracted.select("source", "text"), "source", "left")


rule_entities: EntityExtractor = entities


def hashed_embedding(dimensions: int = 256) -> Embedder:
    """Unit vectors of hashed word counts."""
    from lodestrata.functions.text import let
    from lodestrata.operators.search import word_bucket

    def embed(text: Column) -> Column:
        words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))

        def unit(buckets: Column) -> Column:
            counts = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda d: F.size(F.filter(buckets, lambda b: b == d)).cast("double"))
            return let(counts, lambda c: let(F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)), lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(0.0))))

        return let(F.transform(words, lambda w: word_bucket(w, dimensions)), unit)

    return embed
