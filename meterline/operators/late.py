"""Late rows on a table that records arrival order.

Before each row the watermark is the highest event time that arrived earlier, minus a delay; the
first row has none. That running maximum goes over the whole table in arrival order, so it is
formed in time cells (see ``plans.ordered``), never in one task. The stream form, where the watermark
moves between micro-batches, is ``meterline.streaming.late``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.durations import interval
from meterline.plans.ordered import CELL, Running, running

ON_TIME, LATE = "on-time", "LATE"  # fixed values


def with_watermark(
    rides: DataFrame,
    order: list[str],
    delay: str = "5 seconds",
    cell: str = CELL,
    generator: Column | None = None,
) -> DataFrame:
    """Add the ``watermark`` each row meets on arrival.

    ``generator`` (G3) replaces the event time as what moves the watermark, for instance by the
    time of marker rows and NULL on others. ``order`` starts with the time of arrival.
    """
    moves = F.col("event_time") if generator is None else generator
    seen = running(rides, [], order, [Running("_max", "max", moves, before=True)], cell)
    return seen.withColumn("watermark", F.col("_max") - interval(delay)).drop("_max")


def late_observer(watermarked: DataFrame, arrival: str = "arrival_time") -> DataFrame:
    """Each row's time, the watermark it met, when it was processed, and its status."""
    status = F.when(F.col("event_time") < F.col("watermark"), LATE).otherwise(ON_TIME)
    return watermarked.select(
        "event_id",
        F.col("PULocationID").alias("zone_id"),
        F.col("total_amount").alias("fare"),
        "event_time",
        "watermark",
        F.col(arrival).alias("proc_time"),
        status.alias("status"),
    )


def late_rows(observed: DataFrame) -> DataFrame:
    """The dead-letter side."""
    return observed.where(F.col("status") == LATE)


def on_time_rows(observed: DataFrame) -> DataFrame:
    """The main side."""
    return observed.where(F.col("status") == ON_TIME)


def late_count(observed: DataFrame) -> DataFrame:
    """The number of late events, as a statistics row."""
    return observed.agg(F.count_if(F.col("status") == LATE).alias("stat_value")).select(
        F.lit("late_events").alias("stat_name"), "stat_value"
    )


def windows_with_lateness(
    observed: DataFrame, size: str = "5 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    """Window totals where late rows still count until window end plus ``lateness``.

    ``late_updates`` is how many rows came after their window had closed and changed its result.
    With no lateness they are dropped, the default behaviour.
    """
    placed = observed.select(
        "zone_id", "fare", "watermark", F.window("event_time", size).alias("w")
    )
    # A row that meets no watermark is first of all, and never late.
    closed = F.coalesce(F.col("w.end") <= F.col("watermark"), F.lit(False))
    expired = F.coalesce(F.col("w.end") + interval(lateness) <= F.col("watermark"), F.lit(False))
    return (
        placed.where(~expired)
        .groupBy("zone_id", "w")
        .agg(
            F.count("*").alias("trip_count"),
            F.sum("fare").alias("total_revenue"),
            F.count_if(closed).alias("late_updates"),
        )
        .select(
            "zone_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "trip_count",
            "total_revenue",
            "late_updates",
        )
    )
