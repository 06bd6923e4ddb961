"""Aggregates and per-key patterns that never reset.

The aggregates run on tables and, in update mode, on streams. The per-row patterns here are the
table form; their stream form is in ``meterline.streaming.keyed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators.windows import ZONE
from meterline.plans.ordered import CELL, Running, running


def _zone() -> Column:
    return F.col(ZONE["zone_id"]).alias("zone_id")


def cumulative_counter(rides: DataFrame) -> DataFrame:
    """Totals per zone and when they last changed."""
    return rides.groupBy(_zone()).agg(
        F.count("*").alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.max("event_time").alias("last_updated"),
    )


def zone_cumulative(rides: DataFrame) -> DataFrame:
    """F1 reduced to the count."""
    return rides.groupBy(_zone()).agg(F.count("*").alias("total_trips"))


def max_fare_tracker(rides: DataFrame) -> DataFrame:
    """Highest fare and longest trip ever seen per zone."""
    return rides.groupBy(_zone()).agg(
        F.max("total_amount").alias("max_fare"), F.max("trip_distance").alias("max_distance")
    )


def min_fare_tracker(rides: DataFrame) -> DataFrame:
    """Lowest fare ever seen per zone."""
    return rides.groupBy(_zone()).agg(F.min("total_amount").alias("min_fare"))


def avg_stats(rides: DataFrame) -> DataFrame:
    """L3, D3: averages per zone."""
    return rides.groupBy(_zone()).agg(
        F.avg("total_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.count("*").alias("trip_count"),
    )


def processing_stats(rides: DataFrame) -> DataFrame:
    """One row about the whole input."""
    return rides.agg(
        F.count("*").alias("stat_value"), F.max("event_time").alias("last_updated")
    ).select(F.lit("total_events").alias("stat_name"), "stat_value", "last_updated")


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row table."""
    return df.agg(F.count("*").alias("row_count"))


def entries_and_exits(zone_events: DataFrame) -> DataFrame:
    """Events per zone and kind."""
    return zone_events.groupBy("zone_id", "event_type").agg(F.count("*").alias("event_count"))


def dedup(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    within: str | None = None,
) -> DataFrame:
    """the first row per key.

    On a table the first row by ``order`` is kept by an aggregate, so copies of a hot key are
    reduced before the shuffle. On a stream (with a watermark) the first to arrive is kept, and
    a key is forgotten once the watermark passes it.
    """
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(keys)
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("first")).select("first.*")


def last_n(
    df: DataFrame, keys: list[str], order: list[str], n: int = 5, rank: str = "recency"
) -> DataFrame:
    """the latest n rows per key, most recent first.

    Spark applies the rank limit before the shuffle too, so a key sends at most n rows per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn(rank, F.row_number().over(newest)).where(F.col(rank) <= n)


def running_average(rides: DataFrame, cell: str = CELL) -> DataFrame:
    """each ride with its zone's average fare so far."""
    fares = rides.select("event_id", _zone(), "event_time", F.col("total_amount").alias("fare"))
    seen = running(
        fares,
        ["zone_id"],
        ["event_time", "event_id"],
        [
            Running("total", "sum", F.col("fare")),
            Running("fares", "sum", F.col("fare").isNotNull().cast("long")),
        ],
        cell,
    )
    return seen.select(
        "event_id",
        "zone_id",
        "event_time",
        "fare",
        F.try_divide(F.col("total"), F.col("fares")).alias("running_avg"),
    )


def first_seen(rides: DataFrame, key: str = "driver_id") -> DataFrame:
    """when each key first appeared."""
    return rides.groupBy(key).agg(F.min("event_time").alias("first_seen"))


def change_detection(
    df: DataFrame,
    keys: list[str],
    value: str,
    order: list[str],
    cell: str = CELL,
) -> DataFrame:
    """F8: rows whose value differs from the key's previous one; a first row is no change."""
    # A struct is never NULL, so a previous value of NULL is still the previous value.
    previous = Running("_previous", "last", F.struct(F.col(value).alias("v")), before=True)
    seen = running(df.select(*keys, *order, value), keys, order, [previous], cell)
    return (
        seen.where(
            F.col("_previous").isNotNull() & ~F.col(value).eqNullSafe(F.col("_previous.v"))
        )
        .select(
            *keys,
            *order,
            F.col("_previous.v").alias("previous_value"),
            F.col(value).alias("current_value"),
        )
    )


def rate_verdicts(
    rides: DataFrame, size: str = "1 minute", limit: int = 20, cell: str = CELL
) -> DataFrame:
    """each ride, in order, allowed or throttled by its zone's count in the window so far."""
    placed = rides.select(
        "event_id",
        _zone(),
        "event_time",
        F.window("event_time", size)["start"].alias("window_start"),
    )
    counted = running(
        placed,
        ["zone_id", "window_start"],
        ["event_time", "event_id"],
        [Running("nth_in_window", "count")],
        cell,
    )
    verdict = F.when(F.col("nth_in_window") <= limit, "allow").otherwise("throttle")
    return counted.withColumn("verdict", verdict)


def top_k(df: DataFrame, by: str, tie: list[str], k: int = 5) -> DataFrame:
    """H1, H2: the k rows highest in ``by``; ``tie`` makes the choice unique.

    Each task keeps its best k, so nothing is sorted as a whole. On a stream call it inside
    ``foreachBatch``.
    """
    return df.orderBy(F.col(by).desc(), *tie).limit(k)


def slice_of(
    df: DataFrame, key: str, value: object, order: list[str], n: int = 5
) -> DataFrame:
    """H3: the first n rows of one key."""
    return df.where(F.col(key) == value).orderBy(*order).limit(n)


def first_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """H4: any n rows."""
    return df.limit(n)
