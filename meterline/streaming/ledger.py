"""A keyed table that micro-batches add to, without writing all of it each time.

A batch writes its own rows as a delta, dealt by the key's hash into buckets, and writes one
bucket's table anew from what that bucket has; the bucket is another one each batch. So a batch
costs its own rows and one bucket, however large the table is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.streaming.carried import folder_names, query_id, remove

BATCH = "_batch"
_BUCKET = "bucket"
Merge = Callable[[DataFrame], DataFrame]


def newest(key: str) -> Merge:
    """One row per key: that of the latest batch."""

    def merge(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*rows.columns), BATCH)
        return rows.groupBy(key).agg(last.alias("last")).select("last.*")

    return merge


class Ledger:
    """Rows of ``schema`` by ``key``, kept below ``path`` per query id.

    ``merge`` says which rows still count; it sees them with their ``_batch``. A repeated batch
    reads what it read the first time and overwrites what it wrote.
    """

    def __init__(
        self, path: str, schema: StructType, key: str, merge: Merge | None = None, buckets: int = 16
    ):
        self.path = path
        self.stored = StructType(list(schema.fields)).add(BATCH, "long")
        self.key = key
        self.merge = merge or newest(key)
        self.buckets = buckets

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The table that batch ``batch_id`` starts from."""
        return self.merge(self._read(spark, self._paths(spark, batch_id, range(self.buckets))))

    def add(self, rows: DataFrame, batch_id: int, merge: Merge | None = None) -> None:
        """Add a batch's rows and write one bucket anew, merged by ``merge`` if given."""
        spark = rows.sparkSession
        folder = self._folder(spark)
        own = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        names = [n for n in self.stored.names if n != BATCH]
        kept = rows.select(*names, F.lit(batch_id).cast("long").alias(BATCH), own.alias(_BUCKET))
        # One file per bucket, but for a bucket too large for a task, which is split.
        dealt = kept.hint("rebalance", _BUCKET)
        dealt.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{folder}/delta/{_name(batch_id)}")
        bucket = batch_id % self.buckets
        paths = self._paths(spark, batch_id, [bucket], own=True)
        if paths:
            table = (merge or self.merge)(self._read(spark, paths)).select(*self.stored.names)
            base = f"{folder}/base/{bucket:05d}"
            table.write.mode("overwrite").parquet(f"{base}/{_name(batch_id)}")
            self._forget(spark, folder, batch_id)

    def _paths(self, spark: SparkSession, batch_id: int, buckets, own: bool = False) -> list[str]:
        """The newest table of each bucket from before a batch, and the deltas since; the batch's
        ``own`` too if asked for."""
        folder = self._folder(spark)
        deltas = {
            d: set(folder_names(spark, f"{folder}/delta/{d}"))
            for d in folder_names(spark, f"{folder}/delta")
            if d < _name(batch_id + own)
        }
        found = []
        for bucket in buckets:
            base = self._bases(spark, folder, bucket, batch_id)
            found += [f"{folder}/base/{bucket:05d}/{b}" for b in base[-1:]]
            found += [
                f"{folder}/delta/{d}/{_BUCKET}={bucket}"
                for d, names in deltas.items()
                if f"{_BUCKET}={bucket}" in names and (not base or d > base[-1])
            ]
        return found

    def _bases(self, spark: SparkSession, folder: str, bucket: int, batch_id: int) -> list[str]:
        names = folder_names(spark, f"{folder}/base/{bucket:05d}")
        return [n for n in names if n < _name(batch_id)]

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], self.stored)
        return spark.read.schema(self.stored).parquet(*paths)

    def _forget(self, spark: SparkSession, folder: str, batch_id: int) -> None:
        """Remove what neither this batch, if it is repeated, nor a later one reads."""
        needed = []
        for bucket in range(self.buckets):
            bases = self._bases(spark, folder, bucket, batch_id)
            for old in bases[:-1]:
                remove(spark, f"{folder}/base/{bucket:05d}/{old}")
            needed += bases[-1:]
        if len(needed) == self.buckets:
            for d in folder_names(spark, f"{folder}/delta"):
                if d <= min(needed):
                    remove(spark, f"{folder}/delta/{d}")

    def _folder(self, spark: SparkSession) -> str:
        return f"{self.path}/{query_id(spark)}"


def _name(batch_id: int) -> str:
    return f"{batch_id:019d}"
