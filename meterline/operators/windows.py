"""Event-time windows.

Fixed windows are aligned to the epoch and contain their start but not their end. Aggregates are
formed before the shuffle, so a busy zone costs one partial row per task and window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.durations import bucket_start, interval, to_micros

ZONE = {"zone_id": "PULocationID"}


def tumbling(
    df: DataFrame,
    size: str,
    keys: dict[str, str],
    aggregates: list[Column],
    time_col: str = "event_time",
) -> DataFrame:
    """One row per key and window. ``keys`` maps output names to input columns.

    ``time_col`` chooses event time or processing time (G9).
    """
    window = F.window(time_col, size).alias("w")
    grouped = df.groupBy(*_renamed(keys), window).agg(*aggregates)
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    rest = [c for c in grouped.columns if c not in keys and c != "w"]
    return grouped.select(*keys, *bounds, *rest)


def tumbling_revenue(rides: DataFrame, size: str = "1 minute") -> DataFrame:
    """Rides and revenue per zone and window."""
    return tumbling(rides, size, ZONE, _count_and_sum())


def hourly_revenue(rides: DataFrame, size: str = "1 hour") -> DataFrame:
    """As E1, identified by the window's end."""
    aggregates = [F.count("*").alias("trip_count"), F.sum("total_amount").alias("revenue")]
    return tumbling(rides, size, ZONE, aggregates).drop("window_start")


def windowed_revenue(rides: DataFrame, size: str = "1 minute") -> DataFrame:
    """Revenue only, for a keyed sink."""
    return tumbling(rides, size, ZONE, [F.sum("total_amount").alias("revenue")]).drop(
        "window_start"
    )


def hourly_counts(rides: DataFrame, size: str = "1 hour") -> DataFrame:
    """Rides per zone and window, to set against the count that never resets."""
    return tumbling(rides, size, ZONE, [F.count("*").alias("trip_count")])


def rate_alerts(rides: DataFrame, size: str = "1 minute", more_than: int = 20) -> DataFrame:
    """Windows with more rides than allowed."""
    counted = tumbling(rides, size, ZONE, [F.count("*").alias("ride_count")])
    return counted.where(F.col("ride_count") > more_than)


def sliding_average(
    rides: DataFrame, size: str = "5 minutes", slide: str = "10 seconds", panes: bool | None = None
) -> DataFrame:
    """Overlapping windows, a new one every ``slide``.

    A row lies in size/slide windows. With ``panes`` rows are first reduced to one partial sum
    per slide, and only those partials are copied to the windows; it needs the slide to divide
    the size. On a stream this chains two windowed aggregates, which append mode allows and
    update mode does not, so there it is off unless asked for.
    """
    divides = to_micros(size) % to_micros(slide) == 0
    if panes is None:
        panes = divides and not rides.isStreaming
    if panes and not divides:
        raise ValueError(f"slide {slide!r} does not divide size {size!r}")
    fare = F.col("total_amount")
    if panes:
        pane = F.window("event_time", slide).alias("pane")
        source = rides.groupBy(*_renamed(ZONE), pane).agg(
            F.count("*").alias("n"), F.count(fare).alias("fares"), F.sum(fare).alias("total")
        )
        window = F.window("pane", size, slide).alias("w")
        count, average = F.sum("n"), F.sum("total") / F.sum("fares")
    else:
        source = rides.withColumnsRenamed({v: k for k, v in ZONE.items()})
        window = F.window("event_time", size, slide).alias("w")
        count, average = F.count("*"), F.avg(fare)
    return (
        source.groupBy("zone_id", window)
        .agg(count.alias("trip_count"), average.alias("avg_fare"))
        .select(
            "zone_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "trip_count",
            "avg_fare",
        )
    )


def session_driver(rides: DataFrame, gap: str = "10 seconds") -> DataFrame:
    """E5: bursts of one driver's rides, closed after ``gap`` without one.

    Rides exactly one gap apart belong together; a session ends one gap after its last ride.
    Streams use the built-in session window (append mode). On a table, rides are first reduced
    to cells one gap long: rides in a cell are less than a gap apart, so a cell never straddles
    sessions, and a driver has at most span/gap cells however many rides there are.
    """
    if rides.isStreaming:
        session = F.session_window("event_time", gap).alias("s")
        return (
            rides.groupBy("driver_id", session)
            .agg(*_count_and_sum())
            .select(
                "driver_id",
                F.col("s.start").alias("session_start"),
                F.col("s.end").alias("session_end"),
                "trip_count",
                "total_revenue",
            )
        )
    width = to_micros(gap)
    cell = bucket_start("event_time", gap).alias("cell")
    cells = (
        rides.where(F.col("event_time").isNotNull())
        .groupBy("driver_id", cell)
        .agg(
            F.min("event_time").alias("first"),
            F.max("event_time").alias("last"),
            F.count("*").alias("n"),
            F.sum("total_amount").alias("total"),
        )
    )
    by_driver = Window.partitionBy("driver_id").orderBy("cell")
    idle = F.unix_micros("first") - F.unix_micros(F.lag("last").over(by_driver))
    numbered = cells.withColumn("opens", F.coalesce((idle > width).cast("long"), F.lit(1))).select(
        "*", F.sum("opens").over(by_driver).alias("nth")
    )
    return (
        numbered.groupBy("driver_id", "nth")
        .agg(
            F.min("first").alias("session_start"),
            (F.max("last") + interval(gap)).alias("session_end"),
            F.sum("n").alias("trip_count"),
            F.sum("total").alias("total_revenue"),
        )
        .drop("nth")
    )


def window_kind_counts(
    rides: DataFrame,
    tumble: str = "1 minute",
    size: str = "5 minutes",
    slide: str = "10 seconds",
    gap: str = "10 seconds",
) -> DataFrame:
    """How many result rows each kind of window makes of the same rides."""
    kinds = {
        "tumbling": tumbling_revenue(rides, tumble),
        "sliding": sliding_average(rides, size, slide),
        "session": session_driver(rides, gap),
    }
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(kind).alias("type"), "rows")
        for kind, df in kinds.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _count_and_sum() -> list[Column]:
    return [F.count("*").alias("trip_count"), F.sum("total_amount").alias("total_revenue")]


def _renamed(keys: dict[str, str]) -> list[Column]:
    return [F.col(source).alias(name) for name, source in keys.items()]
