"""Problem 1: how often every term occurs, in how many records, and which terms are too rare or too common."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def normal_term(column):
    """Lower case without outer white space: the form in which terms are compared."""
    return F.lower(F.regexp_replace(column, r"^[ \t\r\n\u000B\f]+|[ \t\r\n\u000B\f]+$", ""))


def term_frequencies(
    rows: DataFrame, term: str = "entity", records: str = "chunks", rare_below: int = 3, common_above: float = 0.1, salts: int | None = None
) -> DataFrame:
    """One row a term: ``term, occurrences, records, total_records, is_rare, is_common``.

    Last-seen counters: the tokens are hash-partitioned by term, ordered by record, and read once; a term needs only
    its counts and the record it was last seen in, never a set of records. A term's records are spread over ``salts``
    partitions (as many as a shuffle has) by the record's hash, so a term with a third of all rows is no single task; a record lies in one
    salt only, which makes the counts of the salts add up. Repeated ids of one list are counted before the shuffle.

    Null terms are no terms; null ids are no records, nor are they occurrences; a term with only null or empty lists
    has 0 of both and is rare. Rows sent again add occurrences, not records. An empty table gives no rows.
    """
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) if salts is None else salts
    lists = rows.select(normal_term(F.col(term)).alias("term"), F.filter(F.col(records), lambda x: x.isNotNull()).alias("ids"))
    tokens = lists.select("term", F.size("ids").alias("n"), F.posexplode_outer(F.array_distinct("ids")).alias("pos", "record"))
    tokens = tokens.select("term", "record", F.when(F.col("pos") == 0, F.col("n")).otherwise(0).cast("bigint").alias("n"))
    named = tokens.filter(F.col("term").isNotNull()).withColumn("salt", F.pmod(F.xxhash64("record"), F.lit(salts)))
    seen = F.lag("record").over(Window.partitionBy("term", "salt").orderBy("record"))
    counted = (
        named.select("term", "n", (F.col("record").isNotNull() & ~F.col("record").eqNullSafe(seen)).alias("new"))
        .groupBy("term")
        .agg(F.sum("n").alias("occurrences"), F.count_if("new").alias("records"))
    )
    total = tokens.select("record").groupBy("record").agg(F.lit(1)).agg(F.count("record").alias("total_records"))
    return counted.withColumn("total_records", total.scalar()).select(
        "term", "occurrences", "records", "total_records",
        (F.col("records") < rare_below).alias("is_rare"),
        (F.col("records") > F.col("total_records") * common_above).alias("is_common"),
    )


def marked_terms(frequencies: DataFrame) -> DataFrame:
    """``entity, mark``: one row for each mark a term has."""
    marks = F.array_compact(F.array(F.when(F.col("is_rare"), F.lit("rare")), F.when(F.col("is_common"), F.lit("common"))))
    return frequencies.select(F.col("term").alias("entity"), F.explode(marks).alias("mark"))
