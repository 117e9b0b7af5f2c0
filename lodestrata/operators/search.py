"""Exact nearest-neighbour search over vectors, and search over texts with a lexical embedding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.text import let
from lodestrata.operators import graph as G

DIMENSIONS = 256
#: Of the queries that go to the executors at a time, and of the distances that a task holds.
BLOCK_BYTES = 64 << 20


def squared_distance(vector: Column, query: list[float]) -> Column:
    point = F.array(*[F.lit(float(x)) for x in query])
    return F.aggregate(F.zip_with(vector, point, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, query: list[float], k: int = 5, key: str = "vec_id", vector: str = "embedding", where: Column | None = None) -> DataFrame:
    """``rank, <key>, distance`` of the k rows nearest in squared distance, ties by key; rows without vector never match."""
    rows = vectors.filter(F.col(vector).isNotNull() & (F.size(vector) == len(query)))
    rows = rows if where is None else rows.filter(where)
    best = rows.select(key, squared_distance(F.col(vector), query).alias("distance")).orderBy("distance", key).limit(k)
    return best.select(F.row_number().over(Window.orderBy("distance", key)).alias("rank"), key, "distance")  # k rows


def _nearest_in(batches, names: np.ndarray, points: np.ndarray, k: int):
    """The k rows of a task nearest to each point.

    One matrix product finds the rows that can be among the k nearest, with a margin for its rounding; only those are measured by their differences,
    which decides. So the result is that of measuring all.
    """
    squares = (points**2).sum(axis=1)
    at, far, who = np.zeros(0, np.int64), np.zeros(0), None
    for batch in batches:
        if not len(batch):
            continue
        them, keys = np.array(batch["v"].tolist(), float), batch["key"].to_numpy()
        norms, step = (them**2).sum(axis=1), max(1, BLOCK_BYTES // (8 * len(keys)))
        for i in range(0, len(names), step):
            total = squares[i : i + step, None] + norms[None, :]
            rough = total - 2 * points[i : i + step] @ them.T
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k] if len(keys) > k else np.inf
            row, column = np.nonzero(rough <= limit + 1e-12 * points.shape[1] * total)
            at = np.concatenate([at, row + i])
            far = np.concatenate([far, ((points[row + i] - them[column]) ** 2).sum(axis=1)])
            who = keys[column] if who is None else np.concatenate([who, keys[column]])
        order = np.lexsort((who, far, at))
        first = np.searchsorted(at[order], at[order], "left")
        order = order[np.arange(len(order)) - first < k]
        at, far, who = at[order], far[order], who[order]
    if len(at):
        yield pd.DataFrame({"query": names[at], "key": who, "distance": far})


def nearest_to_each(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", block: int | None = None) -> DataFrame:
    """``query, rank, <key>, distance``: the k nearest of all rows for every query, itself included, ties by key.

    The queries go out in blocks of BLOCK_BYTES; within a task a block meets each batch of rows, and only its k best leave the
    task. Rows without vector, or of another length than the queries', are left out.
    """
    spark = vectors.sparkSession
    asked = queries.select(F.col(key).alias("key"), F.col(vector).alias("v")).dropna()
    total, width = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v")).dropna().filter(F.size("v") == width)
    asked = asked.filter(F.size("v") == width)
    number = max(1, -(-total // (block or max(1, BLOCK_BYTES // (8 * max(1, width))))))
    kind = dict(rows.dtypes)["key"]
    found = None
    for b in range(number):
        part = asked if number == 1 else asked.filter(F.pmod(F.xxhash64("key"), F.lit(number)) == b)
        local = part.toPandas()
        if not len(local):
            continue
        shared = spark.sparkContext.broadcast((local["key"].to_numpy(), np.array(local["v"].tolist(), float)))

        def work(batches, shared=shared):
            return _nearest_in(batches, *shared.value, k)

        one = rows.mapInPandas(work, f"query {kind}, key {kind}, distance double")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return rows.select(F.col("key").alias("query"), F.lit(1).alias("rank"), F.col("key").alias(key), F.lit(0.0).alias("distance")).limit(0)
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "key"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "rank", F.col("key").alias(key), "distance")


def word_bucket(word: Column, dimensions: int = DIMENSIONS) -> Column:
    return F.conv(F.substring(F.md5(word), 1, 6), 16, 10).cast("int") % dimensions


def query_words(text: str) -> list[str]:
    import re

    return re.findall(r"[a-z0-9]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


def _bucket(word: str, dimensions: int) -> int:
    import hashlib

    return int(hashlib.md5(word.encode()).hexdigest()[:6], 16) % dimensions


def lexical_similarity(text: Column, query: str, dimensions: int = DIMENSIONS) -> Column:
    """The cosine between hashed word counts of a text and of the query, within the row; 0 if either has no words."""
    counts: dict[int, int] = {}
    for word in query_words(query):
        counts[_bucket(word, dimensions)] = counts.get(_bucket(word, dimensions), 0) + 1
    norm = float(np.sqrt(sum(n * n for n in counts.values())))
    if not norm:
        return F.lit(0.0)
    words = F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("[a-z0-9]+"), F.lit(0))
    ordered = F.sort_array(F.transform(words, lambda w: word_bucket(w, dimensions)))
    weights = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    state = F.struct(F.lit(-1).alias("last"), F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("squares"), F.lit(0).cast("bigint").alias("dot"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x == s["last"], s["run"] + 1).otherwise(F.lit(1).cast("bigint"))
        return F.struct(x.alias("last"), run.alias("run"), (s["squares"] + 2 * run - 1).alias("squares"), (s["dot"] + F.coalesce(F.try_element_at(weights, x), F.lit(0))).cast("bigint").alias("dot"))

    return F.aggregate(ordered, state, step, lambda s: F.when(s["squares"] > 0, s["dot"] / (F.sqrt(s["squares"].cast("double")) * norm)).otherwise(0.0))


def similarity_to(text: Column, query: str, embed=None, spark=None) -> Column:
    """The likeness of a text to the query: lexical, or the cosine of their embeddings; 0 if either has none."""
    if embed is None:
        return lexical_similarity(text, query)
    asked = spark.createDataFrame([(query,)], "q string").select(embed(F.col("q"))).first()[0] or []
    point = F.array(*[F.lit(float(x)) for x in asked])
    norm = float(np.sqrt(sum(float(x) ** 2 for x in asked)))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return let(embed(text), lambda v: F.coalesce(dot(v, point) / F.nullif(F.sqrt(dot(v, v)) * norm, F.lit(0.0)), F.lit(0.0))) if norm else F.lit(0.0)


def search_text(chunks: DataFrame, query: str, k: int = 5, key: str = "id", text: str = "document", embed=None) -> DataFrame:
    """``rank, <key>, similarity``: the k texts most like the query; rows of one key count once, null texts never match."""
    rows = chunks.select(key, F.col(text).alias("text")).dropna().distinct()
    scored = rows.select(key, F.round(similarity_to(F.col("text"), query, embed, chunks.sparkSession), 9).alias("similarity"))
    best = scored.orderBy(F.desc("similarity"), key).limit(k)
    return best.select(F.row_number().over(Window.orderBy(F.desc("similarity"), key)).alias("rank"), key, "similarity")  # k rows


def best_texts(chunks: DataFrame, query: str, k: int = 5, embed=None) -> DataFrame:
    """``rank, id, source, similarity, document`` of the k chunks most like the query; chunks of one id in two sources are two."""
    rows = chunks.select("id", "source", "document").dropna(subset=["id", "document"])
    order = [F.desc("similarity"), F.asc("id"), F.asc("source"), F.asc("document")]
    scored = rows.withColumn("similarity", F.round(similarity_to(F.col("document"), query, embed, chunks.sparkSession), 9))
    best = scored.distinct().orderBy(*order).limit(k)
    return best.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "id", "source", "similarity", "document")  # k rows


def expanded_query(graph: DataFrame, query: str, entities: list[str], hops: int = 2, top_n: int = 10) -> str:
    """The query followed by the concepts its entities lead to; at most ``top_n`` names come to the driver."""
    more = [r["concept"] for r in G.expand(graph, entities, hops, top_n).orderBy("rank").collect()]
    return " ".join([query, *more])


def search_graph(chunks: DataFrame, graph: DataFrame, query: str, entities: list[str], k: int = 5, hops: int = 2, key: str = "id", text: str = "document") -> DataFrame:
    return search_text(chunks, expanded_query(graph, query, entities, hops), k, key, text)
