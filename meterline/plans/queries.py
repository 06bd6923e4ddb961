"""The registered queries: every operator over the ride views of the given tables.

The tables hold about one ride per four minutes at the smallest useful scale, so windows are an
hour or a day and sessions six hours here; the operators' defaults are the short ones.
Sums are rounded to cents and averages to six digits, since neither engine fixes the order in
which doubles are added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import joins, late, state, stateless, windows
from meterline.plans import dashboard
from meterline.session import configure
from meterline.sources import views
from meterline.sources.specs import RIDES, to_sink_types

Query = Callable[[SparkSession, str], DataFrame]

_SUMS = {"total_revenue", "revenue"}
_AVERAGES = {"avg_fare", "avg_distance", "avg_duration_minutes", "running_avg"}


def _presented(df: DataFrame) -> DataFrame:
    """Rounded measures and the result tables' timestamp type."""
    for name in _SUMS & set(df.columns):
        df = df.withColumn(name, F.round(name, 2))
    for name in _AVERAGES & set(df.columns):
        # Decimals round ties alike in both engines; doubles do not.
        exact = F.col(name).cast("decimal(38,10)").cast("decimal(28,6)")
        df = df.withColumn(name, exact.cast("double"))
    return to_sink_types(df)


def _of_rides(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(views.rides(spark, sf))


def _trips(spark: SparkSession, sf: str, within: str = "30 minutes", how: str = "inner"):
    return joins.trip_join(views.pickups(spark, sf), views.dropoffs(spark, sf), within, how)


def _bursts(rides: DataFrame) -> DataFrame:
    """The same rides, a day of them squeezed into a minute, so that a minute holds many."""
    squeezed = F.unix_micros("event_time") / 1440
    return rides.withColumn("event_time", F.timestamp_micros(F.floor(squeezed)))


def _alerts(rides: DataFrame) -> DataFrame:
    return windows.rate_alerts(rides, "1 day", 20)


def _pass_through_json(rides: DataFrame) -> DataFrame:
    ride = rides.select("event_id", *RIDES.schema.names)
    schema = ride.schema
    decoded = stateless.decode_json(stateless.encode_json(ride), schema)
    return stateless.pass_through(
        decoded.drop(stateless.CORRUPT),
        source=F.lit("rides"),
        total_amount=F.col("total_amount") * 2,
    )


def _change_detection(rides: DataFrame) -> DataFrame:
    return state.change_detection(
        rides, ["driver_id"], "PULocationID", ["event_time", "event_id"]
    )


def _last_n(rides: DataFrame) -> DataFrame:
    recent = state.last_n(rides, ["PULocationID"], ["event_time", "event_id"], 5)
    return recent.select(
        F.col("PULocationID").alias("zone_id"),
        F.col("recency").cast("long").alias("recency"),
        "event_id",
        "event_time",
        F.col("total_amount").alias("fare"),
    )


def _dedup(rides: DataFrame) -> DataFrame:
    keys = ["driver_id", "PULocationID", "DOLocationID"]
    return state.dedup(
        rides.select(*keys, "event_time", "event_id", "total_amount"),
        keys,
        ["event_time", "event_id"],
    )


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    arrived = late.with_watermark(views.late_rides(spark, sf), ["arrival_time", "event_id"])
    return late.late_observer(arrived)


def _zone_asof(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.asof_join(
        views.rides(spark, sf).withColumnRenamed("PULocationID", "zone_id"),
        views.zone_versions(spark, sf),
        key="zone_id",
        time="event_time",
        valid_from="valid_from",
        sequence="version",
        columns=["zone_name"],
        row_id="event_id",
    )
    name = F.coalesce("zone_name", F.lit("Unknown")).alias("zone_name")
    return joined.select("event_id", "zone_id", "event_time", name)


def _driver_join(policy: str, max_wait: str = "1 hour") -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return joins.driver_join(
            views.rides(spark, sf), views.driver_updates(spark, sf), policy, max_wait
        ).select("event_id", "driver_id", "event_time", "total_amount", "driver_name",
                 "driver_rating")

    return query


def _trip_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return joins.trip_outcomes(views.pickups(spark, sf), views.dropoffs(spark, sf))


def _from_trips(name: str) -> Query:
    return lambda spark, sf: dashboard.from_trips(
        views.pickups(spark, sf), views.dropoffs(spark, sf)
    )[name]


def _seed_load(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a seed row; those who are drivers already keep their row."""
    target = views.drivers(spark, sf)
    seeds = views.driver_columns(views.table(spark, sf, "customer")).withColumn(
        "name", F.concat(F.lit("seed "), "name")
    )
    return target.unionByName(joins.absent_rows(seeds, target, ["driver_id"]))


def _upsert(spark: SparkSession, sf: str) -> DataFrame:
    updates = views.driver_updates(spark, sf)
    return joins.latest_per_key(updates, ["driver_id"], ["updated_at", "update_id"])


def _queries() -> dict[str, Query]:
    return {
        # Stateless (B, I)
        "filter_high_fare": _of_rides(stateless.filter_high_fare),
        "filter_premium": _of_rides(stateless.filter_premium),
        "map_to_eur": _of_rides(stateless.map_to_eur),
        "price_per_mile": _of_rides(stateless.price_per_mile),
        "flatmap_zone_events": _of_rides(stateless.zone_events),
        "flatmap_ride_complete": _of_rides(stateless.zone_events_with_completion),
        "pass_through_json": _of_rides(_pass_through_json),
        "constant_column": _of_rides(
            lambda rides: stateless.with_constant(
                rides.select("event_id", "total_amount"), "currency", "USD"
            )
        ),
        "default_driver_key": _of_rides(
            lambda rides: stateless.default_key(
                rides.select("event_id", F.nullif("driver_id", F.lit(7)).alias("driver_id"))
            )
        ),
        "union_all_zones": _of_rides(
            lambda rides: stateless.union_all(
                rides.select(F.col("PULocationID").alias("zone_id"), "event_id"),
                rides.select(F.col("DOLocationID").alias("zone_id"), "event_id"),
            )
        ),
        "union_distinct_zones": _of_rides(
            lambda rides: stateless.union_distinct(
                rides.select(F.col("PULocationID").alias("zone_id"), "driver_id"),
                rides.select(F.col("DOLocationID").alias("zone_id"), "driver_id"),
            )
        ),
        # Windows (E, F3)
        "tumbling_revenue": _of_rides(lambda r: windows.tumbling_revenue(r, "1 hour")),
        "tumbling_minute_revenue": _of_rides(windows.tumbling_revenue),
        "hourly_revenue": _of_rides(windows.hourly_revenue),
        "windowed_revenue": _of_rides(lambda r: windows.windowed_revenue(r, "1 hour")),
        "hourly_counts": _of_rides(windows.hourly_counts),
        "sliding_average": _of_rides(
            lambda r: windows.sliding_average(r, "1 hour", "10 minutes")
        ),
        "session_driver": _of_rides(lambda r: windows.session_driver(r, "6 hours")),
        "sliding_average_default": _of_rides(windows.sliding_average),
        "session_driver_default": _of_rides(windows.session_driver),
        "rate_alerts_default": _of_rides(lambda r: windows.rate_alerts(_bursts(r))),
        "window_kind_counts": _of_rides(
            lambda r: windows.window_kind_counts(r, "1 hour", "1 hour", "10 minutes", "6 hours")
        ),
        "rate_alerts": _of_rides(_alerts),
        # Aggregates, per-key state, top-k (D, F, H, L2-L4, L10)
        "cumulative_counter": _of_rides(state.cumulative_counter),
        "zone_cumulative": _of_rides(state.zone_cumulative),
        "max_fare_tracker": _of_rides(state.max_fare_tracker),
        "min_fare_tracker": _of_rides(state.min_fare_tracker),
        "avg_stats": _of_rides(state.avg_stats),
        "processing_stats": _of_rides(state.processing_stats),
        "row_count": _of_rides(state.row_count),
        "zone_entries_exits": _of_rides(
            lambda r: state.entries_and_exits(stateless.zone_events(r))
        ),
        "dedup": _of_rides(_dedup),
        "last_n": _of_rides(_last_n),
        "running_avg": _of_rides(state.running_average),
        "first_seen": _of_rides(state.first_seen),
        "change_detection": _of_rides(_change_detection),
        "rate_verdict_per_event": _of_rides(lambda r: state.rate_verdicts(r, "1 day", 15)),
        "top_zones": _of_rides(dashboard.top_zones),
        "top_fares": _of_rides(
            lambda r: state.top_k(state.max_fare_tracker(r), "max_fare", ["zone_id"])
        ),
        "latest_alerts": _of_rides(
            lambda r: state.top_k(_alerts(r), "window_end", ["zone_id"], 10)
        ),
        "zone_slice": _of_rides(
            lambda r: state.slice_of(
                windows.tumbling_revenue(r, "1 hour"), "zone_id", 16, ["window_start"]
            )
        ),
        # Joins (C, L5, L7-L9)
        "zone_lookup": lambda s, sf: joins.zone_lookup(views.rides(s, sf), views.taxi_zones(s, sf)),
        "zone_asof": _zone_asof,
        "trip_join": _trips,
        "trip_outer": lambda s, sf: _trips(s, sf, how="left_outer"),
        "trip_outcomes": _trip_outcomes,
        "nearby_rides": _of_rides(joins.nearby_rides),
        "driver_buffer_join": _driver_join("buffer"),
        "driver_drop_if_old": _driver_join("drop_if_old"),
        "driver_emit_partial": _driver_join("emit_partial"),
        "broadcast_enrich": lambda s, sf: joins.broadcast_enrich(
            views.rides(s, sf), _blank_some(views.taxi_zones(s, sf))
        ),
        "chained_enrich": lambda s, sf: joins.chained_enrich(
            views.rides(s, sf), views.taxi_zones(s, sf), views.drivers(s, sf)
        ),
        "seed_load": _seed_load,
        "upsert_latest": _upsert,
        "avg_trip_duration": _from_trips("dashboard_avg_duration"),
        "fraud_flags": _from_trips("fraud_flags"),
        "long_trips": _from_trips("long_trips"),
        "dashboard_named": lambda s, sf: dashboard.named(
            views.rides(s, sf), views.taxi_zones(s, sf), "dashboard_hourly_revenue"
        ),
        "dashboard_named_totals": lambda s, sf: dashboard.named(
            views.rides(s, sf), views.taxi_zones(s, sf), "dashboard_top_zones"
        ),
        "dashboard_named_stats": lambda s, sf: dashboard.named(
            views.rides(s, sf), views.taxi_zones(s, sf), "dashboard_avg_stats"
        ),
        # Late data (G, L6)
        "late_observer": _observed,
        "late_side_output": lambda s, sf: late.late_rows(_observed(s, sf)),
        "on_time_output": lambda s, sf: late.on_time_rows(_observed(s, sf)),
        "late_count": lambda s, sf: late.late_count(_observed(s, sf)),
        "allowed_lateness": lambda s, sf: late.windows_with_lateness(_observed(s, sf)),
        "late_dropped": lambda s, sf: late.windows_with_lateness(
            _observed(s, sf), lateness="0 seconds"
        ),
    }


def _blank_some(zones: DataFrame) -> DataFrame:
    """Zones of one borough with an empty name, which counts as unknown."""
    return zones.withColumn(
        "zone_name", F.when(F.col("borough") == "ASIA", "").otherwise(F.col("zone_name"))
    )


def registered() -> dict[str, Query]:
    def ready(query: Query) -> Query:
        return lambda spark, sf_dir: _presented(query(configure(spark), sf_dir))

    return {name: ready(query) for name, query in _queries().items()}
