"""Declared tables: a schema over a topic or path (A12), and the entity schemas.

A table's name and the topic it reads need not agree. ``key`` marks a keyed (upsert) table;
``event_time`` and ``delay`` describe its event-time attribute.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from meterline.functions.scalars import event_time as from_epoch_ms


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: str
    topic: str | None = None
    key: tuple[str, ...] = ()
    epoch_ms: str | None = None
    event_time: str | None = None
    delay: str = "5 seconds"

    @property
    def schema(self) -> StructType:
        """The declared columns; a running session is needed to read the declaration."""
        return StructType.fromDDL(self.columns)

    def with_event_time(self, df: DataFrame, watermark: bool = True) -> DataFrame:
        """Add the event-time attribute, and on a stream its watermark.

        Watermarks need an instant, so zone-less timestamps are cast; the session zone is UTC.
        """
        if self.event_time is None:
            return df
        if self.epoch_ms is not None:
            df = df.withColumn(self.event_time, from_epoch_ms(self.epoch_ms))
        else:
            df = df.withColumn(self.event_time, df[self.event_time].cast("timestamp"))
        if watermark and df.isStreaming:
            df = df.withWatermark(self.event_time, self.delay)
        return df


# Column names and types of the entities and of the result tables.
RIDES = TableSpec(
    "rides",
    "driver_id INT, PULocationID INT, DOLocationID INT, trip_distance DOUBLE, "
    "total_amount DOUBLE, tpep_pickup_datetime BIGINT",
    topic="rides",
    epoch_ms="tpep_pickup_datetime",
    event_time="event_time",
)
DRIVERS = TableSpec(
    "drivers", "driver_id INT, name STRING, rating DOUBLE", topic="drivers", key=("driver_id",)
)
ZONES = TableSpec("zones", "zone_id INT, zone_name STRING", topic="zones", key=("zone_id",))
TAXI_ZONES = TableSpec(
    "taxi_zones", "zone_id INT, borough STRING, zone_name STRING", key=("zone_id",)
)
PICKUPS = TableSpec(
    "pickups",
    "trip_id STRING, pickup_zone INT, pickup_time TIMESTAMP_NTZ",
    topic="pickups",
    event_time="pickup_time",
)
DROPOFFS = TableSpec(
    "dropoffs",
    "trip_id STRING, dropoff_zone INT, dropoff_time TIMESTAMP_NTZ, fare DOUBLE",
    topic="dropoffs",
    event_time="dropoff_time",
)

RESULTS = {
    spec.name: spec
    for spec in (
        TableSpec(
            "high_fare_rides",
            "PULocationID INT, DOLocationID INT, trip_distance DOUBLE, total_amount DOUBLE",
            topic="high-fare-rides",
        ),
        TableSpec(
            "rides_eur",
            "pickup_zone INT, dropoff_zone INT, distance_miles DOUBLE, fare_eur DOUBLE",
            topic="rides-eur",
        ),
        TableSpec(
            "zone_events",
            "event_type STRING, zone_id INT, event_timestamp BIGINT",
            topic="zone-events",
        ),
        TableSpec(
            "minute_revenue",
            "zone_id INT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, "
            "trip_count BIGINT, total_revenue DOUBLE",
            key=("zone_id", "window_start"),
        ),
        TableSpec(
            "rolling_avg_fare",
            "zone_id INT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, "
            "trip_count BIGINT, avg_fare DOUBLE",
            key=("zone_id", "window_start"),
        ),
        TableSpec(
            "driver_sessions",
            "driver_id INT, session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ, "
            "trip_count BIGINT, total_revenue DOUBLE",
            key=("driver_id", "session_start"),
        ),
        TableSpec(
            "zone_trip_totals",
            "zone_id INT, total_trips BIGINT, total_revenue DOUBLE, last_updated TIMESTAMP_NTZ",
            key=("zone_id",),
        ),
        TableSpec(
            "zone_max_fare",
            "zone_id INT, max_fare DOUBLE, max_distance DOUBLE",
            key=("zone_id",),
        ),
        TableSpec("zone_cumulative", "zone_id INT, total_trips BIGINT", key=("zone_id",)),
        TableSpec(
            "zone_rate_alerts",
            "zone_id INT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, "
            "ride_count BIGINT",
            key=("zone_id", "window_start"),
        ),
        TableSpec(
            "windowed_revenue",
            "zone_id INT, window_end TIMESTAMP_NTZ, revenue DOUBLE",
            topic="windowed-revenue",
            key=("zone_id", "window_end"),
        ),
        TableSpec(
            "enriched_rides",
            "pickup_zone_id INT, pickup_zone_name STRING, dropoff_zone_id INT, "
            "dropoff_zone_name STRING, fare DOUBLE, event_time TIMESTAMP_NTZ",
            topic="enriched-rides",
        ),
        TableSpec(
            "completed_trips",
            "trip_id STRING, pickup_zone INT, dropoff_zone INT, pickup_time TIMESTAMP_NTZ, "
            "dropoff_time TIMESTAMP_NTZ, duration_minutes BIGINT, fare DOUBLE",
            topic="completed-trips",
            key=("trip_id",),
        ),
        TableSpec(
            "nearby_rides",
            "zone_id INT, ride1_time TIMESTAMP_NTZ, ride1_fare DOUBLE, "
            "ride2_time TIMESTAMP_NTZ, ride2_fare DOUBLE, time_diff_seconds BIGINT",
            key=("zone_id", "ride1_time", "ride2_time"),
        ),
        TableSpec(
            "dashboard_hourly_revenue",
            "zone_id INT, window_end TIMESTAMP_NTZ, trip_count BIGINT, revenue DOUBLE",
            key=("zone_id", "window_end"),
        ),
        TableSpec(
            "dashboard_top_zones",
            "zone_id INT, total_trips BIGINT, total_revenue DOUBLE",
            key=("zone_id",),
        ),
        TableSpec(
            "dashboard_top_five",
            "rank INT, zone_id INT, total_trips BIGINT, total_revenue DOUBLE",
            key=("rank",),
        ),
        TableSpec(
            "named_dashboard_hourly_revenue",
            "zone_id INT, window_end TIMESTAMP_NTZ, trip_count BIGINT, revenue DOUBLE, "
            "zone_name STRING",
            key=("zone_id", "window_end"),
        ),
        TableSpec(
            "named_dashboard_top_zones",
            "zone_id INT, total_trips BIGINT, total_revenue DOUBLE, zone_name STRING",
            key=("zone_id",),
        ),
        TableSpec(
            "named_dashboard_avg_stats",
            "zone_id INT, avg_fare DOUBLE, avg_distance DOUBLE, trip_count BIGINT, "
            "zone_name STRING",
            key=("zone_id",),
        ),
        TableSpec(
            "last_rides",
            "PULocationID INT, recency INT, event_time TIMESTAMP_NTZ, total_amount DOUBLE",
            key=("PULocationID", "recency"),
        ),
        TableSpec(
            "first_seen", "driver_id INT, first_seen TIMESTAMP_NTZ", key=("driver_id",)
        ),
        TableSpec(
            "expiring_counts", "PULocationID INT, total_trips BIGINT", key=("PULocationID",)
        ),
        TableSpec(
            "late_events",
            "driver_id INT, PULocationID INT, DOLocationID INT, trip_distance DOUBLE, "
            "total_amount DOUBLE, tpep_pickup_datetime BIGINT, event_time TIMESTAMP_NTZ, "
            "watermark TIMESTAMP_NTZ, proc_time TIMESTAMP_NTZ, status STRING",
            topic="late-events",
        ),
        TableSpec(
            "dashboard_avg_stats",
            "zone_id INT, avg_fare DOUBLE, avg_distance DOUBLE, trip_count BIGINT",
            key=("zone_id",),
        ),
        TableSpec(
            "dashboard_processing_stats",
            "stat_name STRING, stat_value BIGINT, last_updated TIMESTAMP_NTZ",
            key=("stat_name",),
        ),
        TableSpec(
            "dashboard_avg_duration",
            "pickup_zone INT, trip_count BIGINT, avg_duration_minutes DOUBLE",
            key=("pickup_zone",),
        ),
        TableSpec(
            "dashboard_late_events",
            "stat_name STRING, stat_value BIGINT",
            key=("stat_name",),
        ),
    )
}


def to_sink_types(df: DataFrame) -> DataFrame:
    """Instants become zone-less timestamps, the type every result table declares."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )
