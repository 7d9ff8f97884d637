"""Append-only tables whose rows lie in hash buckets of one column, batch by batch.

A join or aggregate on that column reads the stored rows bucket by bucket and never
shuffles them: only the other side is brought into the same buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.session import hadoop_fs


class Buckets:
    """schema, with `by` the bucketed column, under `path`; one sub-folder per batch.

    The number of buckets is kept in the folder: a table opened again has the number
    it was made with, whatever `buckets` says then.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, by: str, buckets: int = 32, compression: str = "zstd"):
        self.spark, self.path, self.schema, self.by = spark, path.rstrip("/"), schema, by
        self.buckets = self._kept(buckets)
        self.name = "tidemark_" + hashlib.md5(self.path.encode()).hexdigest()
        self.columns = StructType.fromDDL(schema).names
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}, batch INT) USING parquet OPTIONS (compression '{compression}') PARTITIONED BY (batch)"
            f" CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'"
        )

    def _kept(self, buckets: int) -> int:
        fs, at = hadoop_fs(self.spark, self.path)
        if fs.exists(at):
            for s in fs.listStatus(at):
                if s.getPath().getName().startswith("buckets-"):
                    return int(s.getPath().getName().removeprefix("buckets-"))
        _, marker = hadoop_fs(self.spark, f"{self.path}/buckets-{buckets}")
        fs.create(marker, False).close()
        return buckets

    def put(self, rows: DataFrame, batch: int, placed: bool = False) -> None:
        """Replaces the batch's rows. placed: rows come from tables with the same buckets, so each task holds one bucket already."""
        self.remove(batch)
        rows = rows.select(*self.columns)
        rows = rows if placed else rows.repartition(self.buckets, self.by)
        rows.withColumn("batch", F.lit(batch)).write.insertInto(self.name)

    def remove(self, batch: int) -> None:
        fs, at = hadoop_fs(self.spark, f"{self.path}/rows/batch={batch}")
        fs.delete(at, True)
        self.spark.catalog.refreshTable(self.name)

    def rows(self, batches: list[int]) -> DataFrame:
        return self.spark.table(self.name).where(F.col("batch").isin(batches) if batches else F.lit(False)).select(*self.columns)

    def drop(self) -> None:
        """Removes the table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        fs, at = hadoop_fs(self.spark, self.path)
        fs.delete(at, True)


class Markers:
    """Which batches of a folder count: one empty file each, made once all their tables are written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> list[int]:
        """Committed batches; of those up to the last compaction only the compacted one."""
        fs, at = hadoop_fs(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        of = lambda kind: [int(n.removeprefix(kind)) for n in names if n.startswith(kind)]
        base = max(of("compacted-"), default=0)
        return sorted({b for b in of("committed-") if b > base} | ({base} if base else set()))

    def commit(self, batch: int, kind: str = "committed") -> None:
        fs, at = hadoop_fs(self.spark, f"{self.path}/{kind}-{batch}")
        fs.create(at, False).close()
