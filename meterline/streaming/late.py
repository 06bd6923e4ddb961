"""Routing late rows of a stream to a side output.

Spark drops late rows before user code sees them, so the router reads a stream without a
watermark and keeps its own: for batch b it is the highest event time of earlier batches minus
the delay. That one value is stored per batch in the shared folder before the batch ends, so a
repeated batch is split as before. Two slots suffice: batch b reads slot b % 2 and only ever
writes the other one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.durations import interval
from meterline.functions.scalars import processing_time
from meterline.operators.late import LATE, ON_TIME
from meterline.streaming.sinks import BatchWriter, batch_counts, total_counts


class LateRouter:
    """A ``foreachBatch`` function that writes on-time and late rows to different sinks.

    Rows get ``watermark``, ``proc_time`` and ``status``.
    """

    def __init__(
        self,
        control: str,
        on_time: BatchWriter,
        late: BatchWriter,
        delay: str = "5 seconds",
        event_time: str = "event_time",
        generator: Column | None = None,
    ):
        """``generator`` (G3) is an aggregate over a batch that gives the watermark it leads to,
        such as that of marker rows only; the watermark never moves back."""
        self.control = control
        self.on_time = on_time
        self.late = late
        self.delay = delay
        self.event_time = event_time
        self.generator = generator

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        watermark = self._watermark(spark, batch_id)
        batch.persist()
        try:
            observed = self.observe(batch, watermark)
            self.on_time(observed.where(F.col("status") == ON_TIME), batch_id)
            self.late(observed.where(F.col("status") == LATE), batch_id)
            reached = self.generator
            if reached is None:
                reached = F.max(self.event_time) - interval(self.delay)
            seen = batch.agg(reached.alias("reached")).select(
                F.lit(batch_id + 1).alias("batch_id"),
                F.greatest(F.lit(watermark).cast("long"), F.unix_micros("reached")).alias(
                    "watermark_us"
                ),
            )
            seen.coalesce(1).write.mode("overwrite").parquet(self._slot(batch_id + 1))
        finally:
            batch.unpersist()

    def observe(self, batch: DataFrame, watermark: int | None) -> DataFrame:
        """The rows with the watermark they met (given in microseconds) and their status."""
        limit = F.timestamp_micros(F.lit(watermark).cast("long"))
        late = F.col(self.event_time) < limit
        return batch.select(
            "*",
            limit.alias("watermark"),
            processing_time().alias("proc_time"),
            F.when(late, LATE).otherwise(ON_TIME).alias("status"),
        )

    def _slot(self, batch_id: int) -> str:
        return f"{self.control}/slot={batch_id % 2}"

    def _watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        stored = spark.read.schema("batch_id INT, watermark_us BIGINT").parquet(
            self._slot(batch_id)
        )
        row = stored.where(F.col("batch_id") == batch_id).first()
        if row is None:
            raise RuntimeError(f"no watermark stored for batch {batch_id}")
        return row["watermark_us"]


def late_counts(path: str) -> BatchWriter:
    """A side output that keeps only how many rows came late."""
    return batch_counts(path, ["status"])


def total_late(spark: SparkSession, path: str) -> DataFrame:
    totals = total_counts(spark, path, "status STRING")
    return totals.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("stat_value")).select(
        F.lit("late_events").alias("stat_name"), "stat_value"
    )
