"""Joins: lookup, as-of, interval, buffered and broadcast enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.durations import bucket_start, interval, to_micros
from meterline.functions.scalars import (
    UNKNOWN,
    minutes_between,
    or_default,
    or_unknown,
    seconds_between,
)
from meterline.plans.ordered import CELL, Running, running
from meterline.plans.sizing import broadcast_when_small

_BEGINNING = "0001-01-01 00:00:00"
_END = "9999-12-31 00:00:00"


# --- lookups ---------------------------------------------------------------------------------


def lookup(
    df: DataFrame, dimension: DataFrame, on: dict[str, str], columns: dict[str, str]
) -> DataFrame:
    """Left join to the current rows of a static dimension that is unique on its key.

    ``on`` maps a column of ``df`` to the dimension's key, ``columns`` a dimension column to its
    output name. Several lookups of one dimension should share one ``broadcast_when_small``.
    """
    keys = {key: f"_lookup_{key}" for key in on.values()}
    side = dimension.select(
        *(F.col(key).alias(name) for key, name in keys.items()),
        *(F.col(source).alias(name) for source, name in columns.items()),
    )
    match = [F.col(left) == F.col(keys[key]) for left, key in on.items()]
    return df.join(side, match, "left").drop(*keys.values())


def zone_lookup(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Names of the pickup and the dropoff zone; a missing zone is ``Unknown``."""
    names = broadcast_when_small(zones.select("zone_id", "zone_name"))
    joined = lookup(rides, names, {"PULocationID": "zone_id"}, {"zone_name": "_pickup_name"})
    joined = lookup(joined, names, {"DOLocationID": "zone_id"}, {"zone_name": "_dropoff_name"})
    return joined.select(
        F.col("PULocationID").alias("pickup_zone_id"),
        or_default("_pickup_name", UNKNOWN).alias("pickup_zone_name"),
        F.col("DOLocationID").alias("dropoff_zone_id"),
        or_default("_dropoff_name", UNKNOWN).alias("dropoff_zone_name"),
        F.col("total_amount").alias("fare"),
        "event_time",
    )


def broadcast_enrich(rides: DataFrame, latest_zones: DataFrame) -> DataFrame:
    """The whole ride plus zone names; a missing, NULL or empty name is ``Unknown``."""
    names = broadcast_when_small(latest_zones.select("zone_id", "zone_name"))
    joined = lookup(rides, names, {"PULocationID": "zone_id"}, {"zone_name": "pickup_zone"})
    joined = lookup(joined, names, {"DOLocationID": "zone_id"}, {"zone_name": "dropoff_zone"})
    return joined.withColumns(
        {"pickup_zone": or_unknown("pickup_zone"), "dropoff_zone": or_unknown("dropoff_zone")}
    )


def latest_per_key(updates: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """The last update of each key; combined before the shuffle."""
    last = F.max_by(F.struct(*updates.columns), F.struct(*sequence))
    return updates.groupBy(*keys).agg(last.alias("last")).select("last.*")


def with_zone_names(by_zone: DataFrame, zones: DataFrame) -> DataFrame:
    """A per-zone result with the zone's name."""
    names = broadcast_when_small(zones.select("zone_id", "zone_name"))
    joined = lookup(by_zone, names, {"zone_id": "zone_id"}, {"zone_name": "zone_name"})
    return joined.withColumn("zone_name", or_default("zone_name", UNKNOWN))


def absent_rows(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key the target lacks."""
    return rows.join(target.select(*keys), keys, "left_anti")


# --- as-of -----------------------------------------------------------------------------------


def asof_join(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    valid_from: str,
    sequence: str,
    columns: list[str],
    row_id: str,
    backfill: bool = False,
    cell: str = CELL,
) -> DataFrame:
    """Each row with the version of its key in force at its time, or NULLs.

    A version holds from ``valid_from`` until the key's next one; of two from the same instant
    the higher ``sequence`` counts. ``backfill`` lets a key's first version hold from the
    beginning, so that rows older than it get it too.

    Tables of any size are merged with the versions in time order, and the last version is
    carried forward from one time cell to the next: safe for a hot key and for many versions (see
    ``plans.ordered``). A stream is joined to validity intervals by key, whatever the number of
    versions; Spark picks the join by their size in every micro-batch. Inside ``foreachBatch``
    rows are a table, and get the first form.
    """
    used = versions.select(key, valid_from, sequence, *columns).where(
        F.col(key).isNotNull() & F.col(valid_from).isNotNull()
    )
    if df.isStreaming:
        return _asof_by_interval(df, used, key, time, valid_from, sequence, columns, backfill)
    if backfill:
        used = _first_from_beginning(used, key, valid_from, sequence)
    return _asof_by_merge(df, used, key, time, valid_from, sequence, columns, row_id, cell)


def _asof_by_interval(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    valid_from: str,
    sequence: str,
    columns: list[str],
    backfill: bool,
) -> DataFrame:
    in_order = Window.partitionBy(key).orderBy(valid_from, sequence)
    start = F.col(valid_from)
    if backfill:
        first = F.row_number().over(in_order) == 1
        start = F.when(first, F.lit(_BEGINNING).cast("timestamp")).otherwise(start)
    intervals = versions.select(
        F.col(key).alias("_v_key"),
        start.alias("_v_from"),
        F.lead(valid_from, 1).over(in_order).alias("_v_next"),
        *(F.col(c).alias(f"_v_{c}") for c in columns),
    ).withColumn("_v_to", or_default("_v_next", F.lit(_END).cast("timestamp")))
    match = (
        (F.col(key) == F.col("_v_key"))
        & (F.col(time) >= F.col("_v_from"))
        & (F.col(time) < F.col("_v_to"))
    )
    return df.join(intervals, match, "left").select(
        *df.columns, *(F.col(f"_v_{c}").alias(c) for c in columns)
    )


def _first_from_beginning(
    versions: DataFrame, key: str, valid_from: str, sequence: str
) -> DataFrame:
    """Each key's first version once more, as if it had held since the beginning."""
    first = F.min_by(F.struct(*versions.columns), F.struct(valid_from, sequence))
    opening = versions.groupBy(key).agg(first.alias("first")).select("first.*")
    return versions.unionByName(
        opening.withColumn(valid_from, F.lit(_BEGINNING).cast("timestamp"))
    )


def _asof_by_merge(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    valid_from: str,
    sequence: str,
    columns: list[str],
    row_id: str,
    cell: str,
) -> DataFrame:
    version = F.struct(*columns).alias("_version")
    kind = versions.select(version).schema["_version"].dataType
    merged = df.select(
        F.col(key).alias("_key"),
        F.col(time).alias("_time"),
        F.lit(1).alias("_side"),
        F.col(row_id).cast("long").alias("_seq"),
        F.lit(None).cast(kind).alias("_version"),
        F.struct(*df.columns).alias("_row"),
    ).unionByName(
        versions.select(
            F.col(key).alias("_key"),
            F.col(valid_from).alias("_time"),
            F.lit(0).alias("_side"),
            F.col(sequence).cast("long").alias("_seq"),
            version,
        ),
        allowMissingColumns=True,
    )
    filled = running(
        merged,
        ["_key"],
        ["_time", "_side", "_seq"],
        [Running("_current", "last", F.col("_version"))],
        cell,
    )
    return filled.where(F.col("_side") == 1).select(
        "_row.*", *(F.col(f"_current.{c}").alias(c) for c in columns)
    )


# --- interval joins --------------------------------------------------------------------------


def trip_join(
    pickups: DataFrame, dropoffs: DataFrame, within: str = "30 minutes", how: str = "inner"
) -> DataFrame:
    """A trip's pickup and dropoff, the latter at most ``within`` later (inclusive).

    On streams both sides need a watermark: the time bound then also bounds the state, and
    ``how="left_outer"`` emits an unmatched pickup once the watermark has passed its bound.
    """
    p = pickups.select("trip_id", "pickup_zone", "pickup_time")
    d = dropoffs.select(
        F.col("trip_id").alias("_d_trip"), "dropoff_zone", "dropoff_time", "fare"
    )
    match = (
        (F.col("trip_id") == F.col("_d_trip"))
        & (F.col("dropoff_time") >= F.col("pickup_time"))
        & (F.col("dropoff_time") <= F.col("pickup_time") + interval(within))
    )
    return p.join(d, match, how).select(
        "trip_id",
        "pickup_zone",
        "dropoff_zone",
        "pickup_time",
        "dropoff_time",
        minutes_between("pickup_time", "dropoff_time").alias("duration_minutes"),
        "fare",
    )


def trip_outcomes(pickups: DataFrame, dropoffs: DataFrame, within: str = "30 minutes") -> DataFrame:
    """Pickups that were matched, expired (dropoff out of bounds) or never dropped off.

    The per-trip step keeps the partitioning of the join, so only the three counts are shuffled
    again.
    """
    d = dropoffs.select(F.col("trip_id").alias("_d_trip"), "dropoff_time")
    in_time = (F.col("dropoff_time") >= F.col("pickup_time")) & (
        F.col("dropoff_time") <= F.col("pickup_time") + interval(within)
    )
    per_trip = (
        pickups.join(d, F.col("trip_id") == F.col("_d_trip"), "left")
        .groupBy("trip_id", "pickup_time")
        .agg(F.max(in_time).alias("in_time"))
    )
    outcome = (
        F.when(F.col("in_time"), "matched")
        .when(F.col("in_time").isNull(), "unmatched")
        .otherwise("expired")
    )
    return per_trip.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("trips"))


def trip_ends(pickups: DataFrame, dropoffs: DataFrame, wide: str = "1 day") -> DataFrame:
    """C8 on a stream: each pickup with its dropoff at most ``wide`` away, before or after it.

    Wider than a trip may last, so that a dropoff that comes too late is seen too; a pickup without
    one is emitted once the watermark has passed its bound. A trip has one dropoff.
    """
    d = dropoffs.select(F.col("trip_id").alias("_d_trip"), "dropoff_time")
    match = (
        (F.col("trip_id") == F.col("_d_trip"))
        & (F.col("dropoff_time") >= F.col("pickup_time") - interval(wide))
        & (F.col("dropoff_time") <= F.col("pickup_time") + interval(wide))
    )
    return pickups.join(d, match, "left_outer").select("trip_id", "pickup_time", "dropoff_time")


def with_outcome(ends: DataFrame, within: str = "30 minutes") -> DataFrame:
    """C8 on a stream: rows of ``trip_ends`` told apart, for ``batch_counts``."""
    in_time = (F.col("dropoff_time") >= F.col("pickup_time")) & (
        F.col("dropoff_time") <= F.col("pickup_time") + interval(within)
    )
    outcome = (
        F.when(F.col("dropoff_time").isNull(), "unmatched")
        .when(in_time, "matched")
        .otherwise("expired")
    )
    return ends.withColumn("outcome", outcome)


def nearby_rides(
    rides: DataFrame, others: DataFrame | None = None, within: str = "5 minutes"
) -> DataFrame:
    """C4: pairs of rides in one zone, the second later by at most ``within``.

    Time is cut into buckets ``within`` long; the second ride can only lie in the first one's
    bucket or the next. Joining on (zone, bucket) keeps a task to the rides of a short time
    instead of a zone's whole history, for tables and for streaming state alike. Streams must be
    read twice: pass the second reader as ``others``.
    """

    def side(df: DataFrame, n: int) -> DataFrame:
        return df.select(
            F.col("PULocationID").alias(f"_zone{n}"),
            F.col("event_time").alias(f"ride{n}_time"),
            F.col("total_amount").alias(f"ride{n}_fare"),
            bucket_start("event_time", within).alias(f"_bucket{n}"),
        )

    reachable = F.array(F.col("_bucket1"), F.col("_bucket1") + to_micros(within))
    first = side(rides, 1).select("*", F.explode(reachable).alias("_bucket"))
    second = side(others if others is not None else rides, 2)
    match = (
        (F.col("_zone1") == F.col("_zone2"))
        & (F.col("_bucket") == F.col("_bucket2"))
        & (F.col("ride2_time") > F.col("ride1_time"))
        & (F.col("ride2_time") <= F.col("ride1_time") + interval(within))
    )
    return first.join(second, match).select(
        F.col("_zone1").alias("zone_id"),
        "ride1_time",
        "ride1_fare",
        "ride2_time",
        "ride2_fare",
        seconds_between("ride1_time", "ride2_time").alias("time_diff_seconds"),
    )


def avg_trip_duration(trips: DataFrame) -> DataFrame:
    """Average duration per pickup zone."""
    return trips.groupBy("pickup_zone").agg(
        F.count("*").alias("trip_count"),
        F.avg("duration_minutes").alias("avg_duration_minutes"),
    )


def trip_duration_parts(trips: DataFrame) -> DataFrame:
    """L5 on a stream: what a batch of trips adds to the average."""
    return trips.groupBy("pickup_zone").agg(
        F.count("*").alias("trips"), F.sum("duration_minutes").alias("minutes")
    )


def avg_from_duration_parts(parts: DataFrame) -> DataFrame:
    """L5 from the parts of all batches."""
    return parts.groupBy("pickup_zone").agg(
        F.sum("trips").alias("trip_count"),
        (F.sum("minutes") / F.sum("trips")).alias("avg_duration_minutes"),
    )


def long_trips(trips: DataFrame, minutes: int = 120) -> DataFrame:
    """Trips longer than ``minutes``. ``trips`` must be joined over a wider bound."""
    return trips.where(_longer_than(minutes))


def fraud_flags(trips: DataFrame, minutes: int = 120, fare: float = 50.0) -> DataFrame:
    """Suspicious trips, with what makes each suspicious."""
    circular = (F.col("pickup_zone") == F.col("dropoff_zone")) & (F.col("fare") > fare)
    return trips.select(
        "*",
        or_default(_longer_than(minutes), False).cast("int").alias("too_long"),
        or_default(circular, False).cast("int").alias("circular"),
    ).where((F.col("too_long") == 1) | (F.col("circular") == 1))


def _longer_than(minutes: int) -> Column:
    """By exact time, so that two hours and a second is longer than two hours."""
    return F.col("dropoff_time") > F.col("pickup_time") + interval(f"{minutes} minutes")


# --- buffered driver join (table form) -------------------------------------------------------


def driver_join(
    rides: DataFrame,
    updates: DataFrame,
    policy: str = "buffer",
    max_wait: str = "1 hour",
    cell: str = CELL,
) -> DataFrame:
    """Rides with their driver, as if both had arrived in event-time order.

    A ride takes the driver's latest update at its time. If there is none yet, ``buffer`` waits
    for the first one, ``drop_if_old`` does so for at most ``max_wait``, and ``emit_partial``
    emits the ride at once without driver fields. Rides never answered are not emitted, except
    by ``emit_partial``. ``updates`` has driver_id, name, rating, updated_at and update_id.
    """
    if policy not in ("buffer", "drop_if_old", "emit_partial"):
        raise ValueError(f"unknown policy: {policy!r}")
    known = updates.withColumnsRenamed({"name": "driver_name", "rating": "driver_rating"})
    joined = asof_join(
        rides,
        known.withColumn("_since", F.col("updated_at")),
        key="driver_id",
        time="event_time",
        valid_from="updated_at",
        sequence="update_id",
        columns=["driver_name", "driver_rating", "_since"],
        row_id="event_id",
        backfill=policy != "emit_partial",
        cell=cell,
    )
    if policy == "buffer":
        joined = joined.where(F.col("_since").isNotNull())
    elif policy == "drop_if_old":
        joined = joined.where(F.col("_since") <= F.col("event_time") + interval(max_wait))
    return joined.drop("_since")


def chained_enrich(rides: DataFrame, zones: DataFrame, drivers: DataFrame) -> DataFrame:
    """Zone names, then the driver's current name and rating."""
    known = broadcast_when_small(drivers.select("driver_id", "name", "rating"))
    return lookup(
        broadcast_enrich(rides, zones),
        known,
        {"driver_id": "driver_id"},
        {"name": "driver_name", "rating": "driver_rating"},
    )
