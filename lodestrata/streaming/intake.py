"""The store kept up to date from a stream of chunk rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators.store import latest
from lodestrata.session import settle
from lodestrata.sources.partitioned import PartitionedTable


def read_chunks(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Chunk rows from Parquet files as they arrive in ``folder``."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def stored(spark: SparkSession, store: str, shape: str, keys: tuple[str, ...] = ("collection_name", "id"), parts: int = 64) -> PartitionedTable:
    """The table that upsert_stream keeps; ``read`` gives its rows."""
    return PartitionedTable(spark, store, shape, keys, parts)


def upsert_stream(rows: DataFrame, store: str, checkpoint: str, keys: tuple[str, ...] = ("collection_name", "id"), order: tuple[str, ...] = ("ingested_at", "mtime"), parts: int = 64):
    """Starts a query that merges each batch into the table under ``store``.

    Of the table only the parts are read and written that the batch has keys of. A batch is the version of its number; one that runs again after a
    failure finds its version finished and leaves it, or writes it anew, so nothing is lost or counted twice.
    """
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def merge(batch: DataFrame, number: int) -> None:
        table = stored(batch.sparkSession, store, shape, keys, parts)
        if number in table.versions():
            return
        batch = settle(batch)
        touched = table.touched(batch)
        table.write(latest(table.read(touched).unionByName(batch), list(keys), list(order)), touched, number)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(rows: DataFrame, width: str = "1 hour", late: str = "1 day", at: str = "ingested_at") -> DataFrame:
    """Chunks for each window of arrival and document type; rows later than ``late`` are left out of finished windows."""
    return rows.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), "doc_type").agg(F.count(F.lit(1)).alias("chunks")).select(F.col("w.start").alias("start"), "doc_type", "chunks")
