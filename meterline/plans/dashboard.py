"""The dashboard: several results of one ride source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators import joins, state, windows


BY_ZONE = ("dashboard_hourly_revenue", "dashboard_top_zones", "dashboard_avg_stats")


def from_rides(rides: DataFrame) -> dict[str, DataFrame]:
    """L1-L4 by result table."""
    totals = state.cumulative_counter(rides).select("zone_id", "total_trips", "total_revenue")
    return {
        "dashboard_hourly_revenue": windows.hourly_revenue(rides),
        "dashboard_top_zones": totals,
        "dashboard_avg_stats": state.avg_stats(rides),
        "dashboard_processing_stats": state.processing_stats(rides),
    }


def top_zones(rides: DataFrame, k: int = 5) -> DataFrame:
    """L2 as promised: the k busiest zones."""
    totals = from_rides(rides)["dashboard_top_zones"]
    return state.top_k(totals, "total_trips", ["zone_id"], k)


def ranked(top: DataFrame, by: str = "total_trips", tie: str = "zone_id") -> DataFrame:
    """The few rows of a top-k with their ``rank``, which keys the table that holds them."""
    order = Window.orderBy(F.col(by).desc(), tie)
    return top.select(F.row_number().over(order).alias("rank"), "*")


def from_trips(pickups: DataFrame, dropoffs: DataFrame) -> dict[str, DataFrame]:
    """L5, L7, L8. Trips over two hours need a bound wider than the 30-minute default."""
    all_trips = joins.trip_join(pickups, dropoffs, within="1 day")
    return {
        "dashboard_avg_duration": joins.avg_trip_duration(all_trips),
        "fraud_flags": joins.fraud_flags(all_trips),
        "long_trips": joins.long_trips(all_trips),
    }


def named(rides: DataFrame, zones: DataFrame, result: str) -> DataFrame:
    """One of L1-L3 with zone names; the dimension's size is checked once."""
    return joins.with_zone_names(from_rides(rides)[result], zones)
