"""The manifest and the graph as JSON, for exchange with other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest_json(manifest: DataFrame) -> DataFrame:
    """``line``: one JSON object ``{source: mtime}`` a source; lines stay apart, as one object of all sources would be one task's."""
    return manifest.filter("source is not null").select(F.to_json(F.create_map("source", "mtime")).alias("line"))


def read_manifest(lines: DataFrame) -> DataFrame:
    """``source, mtime`` from JSON objects of any number of sources each."""
    return lines.select(F.explode(F.from_json("line", "map<string,double>")).alias("source", "mtime"))


def read_graph(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links ``entity, chunk`` and edges ``a, b, weight`` from the lines of node_link_json."""
    parsed = lines.select(F.from_json("line", "kind string, id string, chunk string, source string, target string, weight bigint").alias("x")).select("x.*")
    return parsed.filter("kind = 'node'").select(F.col("id").alias("entity"), "chunk"), parsed.filter("kind = 'edge'").select(F.col("source").alias("a"), F.col("target").alias("b"), "weight")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")
