"""A table on shared storage of which a write touches only the parts that it changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class PartitionedTable:
    """Rows under ``path`` in ``parts`` parts by the hash of ``keys``.

    A write makes a version: a folder ``v=N`` with the new contents of the parts that it touches, and at last a file that names them. Only
    then it counts, so a reader or a job that comes after a failure sees what was there before; versions without the file are written over. A part's
    rows are those of the last version that touched it. ``vacuum`` removes what is out of date.
    """

    def __init__(self, spark: SparkSession, path: str, shape: str, keys: tuple[str, ...], parts: int = 64):
        self.spark, self.path, self.shape, self.keys = spark, path.rstrip("/"), shape, keys
        self.columns = [c.split()[0] for c in shape.split(", ")]
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._at = lambda name="": hadoop.Path(f"{self.path}/{name}" if name else self.path)
        self._system = self._at().getFileSystem(spark._jsc.hadoopConfiguration())
        self.parts = int(self._noted("_parts") or parts)  # the first write settles how many there are

    def _noted(self, name: str) -> str:
        if not self._system.exists(self._at(name)):
            return ""
        stream = self._system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _note(self, name: str, text: str) -> None:
        stream = self._system.create(self._at(name), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def versions(self) -> dict[int, set[int]]:
        """The parts that each finished version touched."""
        if not self._system.exists(self._at()):
            return {}
        names = [s.getPath().getName() for s in self._system.listStatus(self._at())]
        noted = {int(n[2:]): self._noted(f"{n}/_touched") for n in names if n.startswith("v=") and self._system.exists(self._at(f"{n}/_touched"))}
        return {n: {int(p) for p in text.split()} for n, text in noted.items()}

    def current(self) -> dict[int, int]:
        """The version that holds each part."""
        return {part: n for n, touched in sorted(self.versions().items()) for part in touched}

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts that rows with the keys belong to: at most ``parts`` numbers."""
        return sorted(r[0] for r in rows.select(self.part().alias("part")).distinct().collect())

    def read(self, parts: list[int] | None = None) -> DataFrame:
        holds = [f"{self.path}/v={n}/part={part}" for part, n in self.current().items() if parts is None or part in parts]
        found = [p for p in holds if self._system.exists(self._at(p[len(self.path) + 1 :]))]  # a part that was emptied has no folder
        if not found:
            return self.spark.createDataFrame([], self.shape)
        return self.spark.read.schema(self.shape).option("basePath", self.path).parquet(*found).select(*self.columns)

    def write(self, rows: DataFrame, touched: list[int], number: int | None = None) -> int:
        """Makes ``rows`` all that the touched parts hold; rows of other parts must not be among them."""
        number = max(self.versions(), default=-1) + 1 if number is None else number
        placed = rows.select(*self.columns).withColumn("part", self.part())
        placed.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/v={number}")
        if not self._system.exists(self._at("_parts")):
            self._note("_parts", str(self.parts))
        self._note(f"v={number}/_touched", " ".join(map(str, touched)))
        return number

    def replace(self, rows: DataFrame, gone: DataFrame, on: tuple[str, ...]) -> None:
        """Takes out the rows with the keys ``on`` of ``gone`` and puts in ``rows``. ``on`` contains what the parts are made by, so only their parts are touched."""
        touched = sorted({*self.touched(gone), *self.touched(rows)})
        kept = self.read(touched).join(gone.select(*on).distinct(), list(on), "left_anti")
        self.write(kept.select(*self.columns).unionByName(rows.select(*self.columns)), touched)

    def vacuum(self) -> int:
        """Removes the folders of parts that a later version holds, and versions that no part is held by any more; the number removed."""
        current, removed = self.current(), 0
        for n, touched in self.versions().items():
            for part in touched:
                if current[part] != n and self._system.delete(self._at(f"v={n}/part={part}"), True):
                    removed += 1
            if not any(v == n for v in current.values()):
                self._system.delete(self._at(f"v={n}"), True)
        return removed
