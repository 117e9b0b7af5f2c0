"""Rows that share a key met two by two, however many share it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024


def sharing(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` of keys that occur more than once, with the number of rows of the key as ``n``: one shuffle by key, in which the lone rows end."""
    return rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(key))).filter("n > 1")


def meetings(rows: DataFrame, key: str, member: str, block: int = BLOCK) -> DataFrame:
    """Each two rows of a key once, its other columns with ``_p`` and ``_q``, the lesser ``member`` of rows in one block first.

    ``rows`` come with ``n`` as from ``sharing``; members of a key are distinct. A key of more than ``block`` rows is cut into blocks that meet
    two by two, each under a key of its own: no task gets more than the pairs of two blocks of one key at a time.
    """
    carried = [c for c in rows.columns if c not in (key, "n")]
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    placed = rows.withColumn("blocks_", blocks).withColumn("own_", F.pmod(F.xxhash64(member), F.col("blocks_")).cast("int"))
    spread = placed.select(key, *carried, "own_", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)).alias("other_"))
    spread = spread.select(key, *carried, "own_", F.least("own_", "other_").alias("i_"), F.greatest("own_", "other_").alias("j_"))
    one, two = (spread.filter(F.col("own_") == F.col(end)).select(key, "i_", "j_", *(F.col(c).alias(f"{c}_{side}") for c in carried)) for end, side in (("i_", "p"), ("j_", "q")))
    met = one.join(two, [key, "i_", "j_"]).filter((F.col("i_") < F.col("j_")) | (F.col(f"{member}_p") < F.col(f"{member}_q")))
    return met.drop("i_", "j_")
