"""What ``foreachBatch`` functions carry from one micro-batch to the next.

A stream's checkpoint gives its query an id; a new checkpoint gives a new one. Tables and
changelogs are kept per query id, so starting anew never mixes with what an older run left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_QUERY_ID = "sql.streaming.queryId"


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query whose batch this is; ``batch`` outside of a stream."""
    return spark.sparkContext.getLocalProperty(_QUERY_ID) or "batch"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    folder, system = _hadoop(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def remove(spark: SparkSession, path: str) -> None:
    folder, system = _hadoop(spark, path)
    system.delete(folder, True)


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


class Carried:
    """A table that batches add to. Batch b reads the newest copy from before b, so a repeated
    batch starts from what it started from before; a batch that adds nothing writes nothing."""

    def __init__(self, path: str, schema: StructType):
        self.path = path
        self.schema = schema

    def fold(
        self, update: DataFrame, batch_id: int, merge: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """Merge ``update`` into the table; the table after this batch."""
        spark = update.sparkSession
        before = self._before(spark, batch_id)
        rows = update.select(*self.schema.names)
        if before:
            rows = self._read(spark, before[-1]).unionByName(rows)
        copy = f"{batch_id:019d}"
        merged = merge(rows).select(*self.schema.names)
        merged.write.mode("overwrite").parquet(f"{self._folder(spark)}/{copy}")
        for old in before[:-1]:
            remove(spark, f"{self._folder(spark)}/{old}")
        return self._read(spark, copy)

    def current(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The table that batch ``batch_id`` starts from."""
        before = self._before(spark, batch_id)
        if not before:
            return spark.createDataFrame([], self.schema)
        return self._read(spark, before[-1])

    def _folder(self, spark: SparkSession) -> str:
        return f"{self.path}/{query_id(spark)}"

    def _before(self, spark: SparkSession, batch_id: int) -> list[str]:
        names = folder_names(spark, self._folder(spark))
        return [n for n in names if n.isdigit() and int(n) < batch_id]

    def _read(self, spark: SparkSession, copy: str) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self._folder(spark)}/{copy}")
