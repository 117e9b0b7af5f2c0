"""The entity graph: nodes, weighted edges, expansion, concept maps. Ties fall to the lesser name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.text import strip
from lodestrata.operators.pairs import meetings, sharing

BLOCK = 256


def entity_name(c: Column) -> Column:
    return F.lower(strip(c))


def node_links(nodes: DataFrame, entity: str = "entity", chunks: str = "chunks") -> DataFrame:
    """Distinct ``entity, chunk``: the graph's nodes with their chunks, one row each, so no node is one unbounded row."""
    pairs = nodes.select(entity_name(F.col(entity)).alias("entity"), F.explode(F.array_distinct(F.col(chunks))).alias("chunk"))
    return pairs.dropna().distinct()


def text_links(chunks: DataFrame, entities: Column, key: str = "id") -> DataFrame:
    """Distinct ``entity, chunk`` from an array column of each chunk's entities."""
    return chunks.select(F.explode(entities).alias("entity"), F.col(key).alias("chunk")).dropna().distinct()


def count_pairs(links: DataFrame, item: str = "entity", record: str = "chunk", block: int = BLOCK) -> DataFrame:
    """``a, b, n`` with a < b: in how many records both items are.

    A record of more than ``block`` items is cut into blocks that meet two by two, each under a key of its own: no
    task gets more than the pairs of two blocks of one record at a time.
    """
    links = links.select(F.col(item).alias("item"), F.col(record).alias("record"))
    met = meetings(sharing(links, "record"), "record", "item", block)
    return met.groupBy(F.least("item_p", "item_q").alias("a"), F.greatest("item_p", "item_q").alias("b")).agg(F.count(F.lit(1)).alias("n"))


def edges(links: DataFrame) -> DataFrame:
    """``a, b, weight``: the chunks two entities share. Computed from the links, so ingesting a file again changes nothing."""
    return count_pairs(links).withColumnRenamed("n", "weight")


def edges_within(links: DataFrame, *groups: Column) -> DataFrame:
    """The group columns and ``a, b, weight``: edges by what each group of records adds, from ``entity, record``. A record is in one group."""
    met = meetings(sharing(links.select("record", "entity"), "record"), "record", "entity", BLOCK)
    return met.groupBy(*groups, F.least("entity_p", "entity_q").alias("a"), F.greatest("entity_p", "entity_q").alias("b")).agg(F.count(F.lit(1)).alias("weight"))


def add_edges(*parts: DataFrame) -> DataFrame:
    """Edge tables summed, each pair in one order; loops and rows with nulls are left out."""
    out = None
    for part in parts:
        x, y = entity_name(F.col("a")), entity_name(F.col("b"))
        plain = part.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.col("weight").cast("bigint").alias("weight")).dropna().filter("a != b")
        out = plain if out is None else out.unionByName(plain)
    return out.groupBy("a", "b").agg(F.sum("weight").alias("weight"))


def adjacency(graph: DataFrame) -> DataFrame:
    """``node, neighbour, weight``: each edge seen from both ends."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("neighbour")), F.struct(F.col("b").alias("node"), F.col("a").alias("neighbour"))))
    return graph.select(ends.alias("e"), "weight").select("e.node", "e.neighbour", "weight")


def heaviest(neighbours: DataFrame, k: int) -> DataFrame:
    """Each node's k heaviest neighbours with their ``rank`` from 1; groups are limited before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("weight"), F.asc("neighbour")))
    return neighbours.withColumn("rank", rank).filter(F.col("rank") <= k)


def _start(graph: DataFrame, query: list[str]) -> DataFrame:
    rows = [(name, i) for i, name in enumerate(dict.fromkeys(query))]
    return F.broadcast(graph.sparkSession.createDataFrame(rows, "node string, place int"))


def expand(graph: DataFrame, query: list[str], hops: int = 2, top_n: int = 10) -> DataFrame:
    """``concept, score, rank``: the ``top_n`` concepts that the neighbourhood of the query's entities speaks for.

    Each of an entity's ``top_n`` heaviest neighbours counts its weight; with two hops or more, each of that neighbour's three
    heaviest counts half of its own, once for each path. The query's entities are walked through but never
    come out. Only edges at the query's entities and their neighbours are ranked.
    """
    around = adjacency(graph)
    asked = _start(graph, query)
    first = heaviest(around.join(asked.select("node"), "node"), top_n).select("node", "neighbour", F.col("weight").cast("double").alias("score"))
    found = first.select(F.col("neighbour").alias("concept"), "score")
    if hops >= 2:
        via = first.select(F.col("neighbour").alias("node"), F.col("node").alias("from"))  # at most top_n rows for each entity asked
        near = around.join(F.broadcast(via.select("node").distinct()), "node")
        second = heaviest(near, 3).select("node", F.col("neighbour").alias("concept"), (F.col("weight") * 0.5).alias("score"))
        found = found.unionByName(second.join(via, "node").select("concept", "score"))
    total = found.groupBy("concept").agg(F.sum("score").alias("score"))
    kept = total.join(asked.select(F.col("node").alias("concept")), "concept", "left_anti")
    best = kept.orderBy(F.desc("score"), F.asc("concept")).limit(top_n)  # top_n rows, so the window below is small
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), F.asc("concept"))))


def concept_map(graph: DataFrame, query: list[str], hops: int = 2) -> DataFrame:
    """``concept, place, neighbour, rank``: the query's entities with eight neighbours each, then, with two hops or more, the first three
    neighbours of each with five. An entity of the query keeps its eight; places follow first appearance."""
    around = adjacency(graph)
    asked = _start(graph, query)
    first = heaviest(around.join(asked, "node"), 8)
    keys = first.select(F.col("node").alias("concept"), F.struct((F.col("place") * 10).alias("p")).alias("order"), F.lit(8).alias("width")).distinct()
    if hops >= 2:
        inner = first.filter("rank <= 3").select(F.col("neighbour").alias("concept"), F.struct((F.col("place") * 10 + F.col("rank")).alias("p")).alias("order"), F.lit(5).alias("width"))
        keys = keys.unionByName(inner)
    keys = keys.groupBy("concept").agg(F.min("order.p").alias("p"), F.max("width").alias("width"))
    keys = keys.withColumn("place", F.row_number().over(Window.orderBy("p", "concept")))  # at most four rows for each entity asked
    near = heaviest(around.join(F.broadcast(keys.select(F.col("concept").alias("node"))), "node"), 8)
    return near.join(F.broadcast(keys.withColumnRenamed("concept", "node")), "node").filter("rank <= width").select(F.col("node").alias("concept"), "place", "neighbour", "rank")


def stats(links: DataFrame, graph: DataFrame) -> DataFrame:
    """``nodes, edges``: one row."""
    return links.agg(F.count_distinct("entity").alias("nodes")).withColumn("edges", graph.agg(F.count(F.lit(1))).scalar())


def node_link_json(links: DataFrame, graph: DataFrame) -> DataFrame:
    """``line``: the graph as JSON lines, a node with one of its chunks or an edge each."""
    nodes = links.select(F.to_json(F.struct(F.lit("node").alias("kind"), F.col("entity").alias("id"), "chunk")).alias("line"))
    return nodes.union(graph.select(F.to_json(F.struct(F.lit("edge").alias("kind"), F.col("a").alias("source"), F.col("b").alias("target"), "weight")).alias("line")))
