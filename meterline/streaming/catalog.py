"""The streaming jobs by the table they feed, each a list of outputs to start.

A job asks its context for sources, dimensions and sinks, so the same job runs on topics or on
files, into topics, changelogs or a database.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.operators import joins, state, stateless, windows
from meterline.plans import dashboard
from meterline.sources import jdbc, topics
from meterline.sources.specs import DRIVERS, DROPOFFS, PICKUPS, RESULTS, RIDES, ZONES, TableSpec
from meterline.streaming import jobs, keyed, sinks
from meterline.streaming.carried import Carried
from meterline.streaming.enrich import BroadcastEnricher, tagged
from meterline.streaming.jobs import Output
from meterline.streaming.late import LateRouter
from meterline.streaming.sinks import BatchWriter


@dataclass(frozen=True)
class Places:
    """Where a deployment reads and writes.

    ``servers`` names a broker; without one ``folder`` holds a sub-folder of files per table.
    Results go to ``database`` if given, else to the broker if the result has a topic, else to
    changelogs under ``out``, where ``files_per_batch`` limits the files of keyed results.
    ``state`` is a shared folder for what jobs carry along.
    """

    spark: SparkSession
    out: str
    state: str
    servers: str | None = None
    folder: str | None = None
    fmt: str = "json"
    database: str | None = None
    zones: DataFrame | None = None  # instead of the database's table
    max_per_trigger: int | None = None
    files_per_batch: int | None = None
    database_options: dict[str, str] = field(default_factory=dict)  # user, password, driver
    opened: dict[str, TableSpec] = field(default_factory=dict, compare=False)

    def open(
        self, spec: TableSpec, starting: str, position: bool = False, watermark: bool = True
    ) -> DataFrame:
        """The well-formed records of a source; ``rejected`` has the others."""
        self.opened[spec.name] = spec
        return topics.well_formed(self._read(spec, starting, position, watermark))

    def _read(
        self, spec: TableSpec, starting: str, position: bool = False, watermark: bool = True
    ) -> DataFrame:
        if self.servers:
            kept = ("timestamp", "offset") if position else ()
            return topics.read_topic(
                self.spark, spec, self.servers, starting, self.max_per_trigger,
                position=kept, watermark=watermark,
            )
        path = f"{self.folder}/{spec.topic or spec.name}"
        files = self.max_per_trigger or 1
        return topics.read_files(self.spark, spec, path, self.fmt, files, position, watermark)

    def rejected(self, starting: str = topics.EARLIEST) -> list[Output]:
        """An output per source opened so far: its malformed records, as a changelog."""
        if not self.servers and self.fmt != "json":
            return []
        outputs = []
        for spec in self.opened.values():
            name = f"{spec.name}_rejected"
            rows = topics.malformed(self._read(spec, starting, watermark=False))
            rows = rows.select(F.col(stateless.CORRUPT).alias("record"))
            outputs.append(Output(name, rows, sinks.changelog(f"{self.out}/{name}")))
        return outputs

    def order(self) -> list[str]:
        return ["timestamp", "offset"] if self.servers else ["timestamp"]

    def dimension(self, name: str) -> Callable[[], DataFrame]:
        """A dimension that is current each time it is asked for."""
        if self.zones is not None:
            return lambda: self.zones
        return jdbc.JdbcDimension(
            self.spark, TableSpec(name, ""), {"url": self.database} | self.database_options
        ).current

    def sink(self, name: str) -> BatchWriter:
        spec = RESULTS.get(name, TableSpec(name, ""))
        if self.servers and spec.topic:
            return sinks.topic_writer(spec, self.servers)
        if self.database and spec.key:
            return sinks.jdbc_upsert(spec, self.database, **self.database_options)
        files = self.files_per_batch if spec.key else None
        return sinks.changelog(f"{self.out}/{name}", files=files)


Job = Callable[[Places], list[Output]]


def _of_rides(
    name: str, operator: Callable[[DataFrame], DataFrame], starting: str, mode: str = "append"
) -> Job:
    def job(places: Places) -> list[Output]:
        rows = operator(places.open(RIDES, starting))
        return [Output(name, rows, places.sink(name), mode)]

    return job


def _event_log(places: Places) -> list[Output]:
    rides = places.open(RIDES, topics.LATEST, watermark=False)
    router = LateRouter(
        f"{places.state}/event_log", places.sink("event_log"), places.sink("late_events")
    )
    return [Output("event_log", rides, router)]


def _with_lateness(places: Places) -> list[Output]:
    """Ten minutes of lateness on top of the five seconds of disorder."""
    patient = replace(RIDES, delay="605 seconds")
    rows = windows.tumbling_revenue(places.open(patient, topics.LATEST), "5 minutes")
    return [Output("revenue_with_lateness", rows, places.sink("revenue_with_lateness"), "update")]


def _enriched_rides(places: Places) -> list[Output]:
    rides = places.open(RIDES, topics.LATEST)
    sink = places.sink("enriched_rides")

    zones = places.dimension("taxi_zones")

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(joins.zone_lookup(batch, zones()), batch_id)

    return [Output("enriched_rides", rides, write)]


def _completed_trips(places: Places) -> list[Output]:
    rows = joins.trip_join(
        places.open(PICKUPS, topics.LATEST), places.open(DROPOFFS, topics.LATEST)
    )
    return [Output("completed_trips", rows, places.sink("completed_trips"))]


def _nearby_rides(places: Places) -> list[Output]:
    first, second = (places.open(RIDES, topics.LATEST) for _ in range(2))
    return [Output("nearby_rides", joins.nearby_rides(first, second), places.sink("nearby_rides"))]


def _drivers_by(name: str, policy: str) -> Job:
    def job(places: Places) -> list[Output]:
        rides = places.open(RIDES, topics.EARLIEST, watermark=False)
        drivers = places.open(DRIVERS, topics.EARLIEST, position=True)
        join = keyed.DriverJoin(f"{places.state}/{name}", places.sink(name), policy)
        return [Output(name, keyed.with_drivers(rides, drivers, "timestamp"), join)]

    return job


def _keyed(name: str, pattern: Callable[..., BatchWriter], *args) -> Job:
    """A per-key pattern over the rides; its table lies in the state folder."""

    def job(places: Places) -> list[Output]:
        rides = places.open(RIDES, topics.EARLIEST, watermark=False)
        write = pattern(f"{places.state}/{name}", places.sink(name), *args)
        return [Output(name, rides, write)]

    return job


def _zone_rides(places: Places) -> list[Output]:
    rides = places.open(RIDES, topics.EARLIEST, watermark=False)
    zones = places.open(ZONES, topics.EARLIEST, position=True)
    enricher = BroadcastEnricher(f"{places.state}/zones", places.sink("zone_rides"))
    return [Output("zone_rides", tagged(rides, zones, places.order()), enricher)]


def _dashboard(places: Places) -> list[Output]:
    rides = lambda: places.open(RIDES, topics.EARLIEST)
    totals = dashboard.from_rides(rides())["dashboard_top_zones"]
    best = places.sink("dashboard_top_five")

    def top_five(batch: DataFrame, batch_id: int) -> None:
        best(dashboard.ranked(state.top_k(batch, "total_trips", ["zone_id"])), batch_id)

    outputs = jobs.dashboard_outputs(rides, places.sink)
    return [*outputs, Output("dashboard_top_five", totals, top_five, "complete")]


def _dashboard_named(places: Places) -> list[Output]:
    """L1-L3 with the zones' current names."""
    zones = places.dimension("taxi_zones")

    def output(name: str) -> Output:
        sink = places.sink(f"named_{name}")

        def write(batch: DataFrame, batch_id: int) -> None:
            sink(joins.with_zone_names(batch, zones()), batch_id)

        rows = dashboard.from_rides(places.open(RIDES, topics.EARLIEST))[name]
        return Output(f"named_{name}", rows, write, "update")

    return [output(name) for name in dashboard.BY_ZONE]


def _dashboard_trips(places: Places) -> list[Output]:
    """L5, L7, L8 from one join. Its bound is a day: two-hour trips exceed the usual one."""
    trips = joins.trip_join(
        places.open(PICKUPS, topics.EARLIEST), places.open(DROPOFFS, topics.EARLIEST), "1 day"
    )
    schema = StructType.fromDDL("pickup_zone INT, trips BIGINT, minutes BIGINT")
    so_far = Carried(f"{places.state}/trip_duration", schema)
    sink = places.sink("dashboard_avg_duration")

    def average(parts: DataFrame, batch_id: int) -> None:
        total = so_far.fold(parts, batch_id, _summed("pickup_zone", "trips", "minutes"))
        sink(joins.avg_from_duration_parts(total), batch_id)

    write = sinks.fan_out(
        (joins.trip_duration_parts, average),
        (joins.long_trips, places.sink("long_trips")),
        (joins.fraud_flags, places.sink("fraud_flags")),
    )
    return [Output("dashboard_trips", trips, write)]


def _dashboard_late_events(places: Places) -> list[Output]:
    """The number of late rides so far."""
    rides = places.open(RIDES, topics.EARLIEST, watermark=False)
    schema = StructType.fromDDL("stat_name STRING, stat_value BIGINT")
    so_far = Carried(f"{places.state}/late_total", schema)
    sink = places.sink("dashboard_late_events")

    def count(late: DataFrame, batch_id: int) -> None:
        n = late.agg(F.count("*").alias("stat_value"))
        n = n.select(F.lit("late_events").alias("stat_name"), "stat_value")
        sink(so_far.fold(n, batch_id, _summed("stat_name", "stat_value")), batch_id)

    router = LateRouter(f"{places.state}/dashboard_late_events", sinks.ignore, count)
    return [Output("dashboard_late_events", rides, router)]


def _summed(key: str, *values: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(key).agg(*(F.sum(v).alias(v) for v in values))


def _trip_outcomes(places: Places) -> list[Output]:
    """Trips by outcome, counted per batch. A trip is waited for as long as a day."""
    joined = joins.trip_ends(
        places.open(PICKUPS, topics.EARLIEST), places.open(DROPOFFS, topics.EARLIEST), "1 day"
    )
    counts = sinks.batch_counts(f"{places.out}/trip_outcomes", ["outcome"])
    return [Output("trip_outcomes", joins.with_outcome(joined), counts)]


JOBS: dict[str, Job] = {
    "high_fare_rides": _of_rides("high_fare_rides", stateless.filter_high_fare, topics.LATEST),
    "rides_eur": _of_rides("rides_eur", stateless.map_to_eur, topics.LATEST),
    "zone_events": _of_rides("zone_events", stateless.zone_events, topics.LATEST),
    "minute_revenue": _of_rides("minute_revenue", windows.tumbling_revenue, topics.EARLIEST),
    "rolling_avg_fare": _of_rides(
        "rolling_avg_fare", lambda r: windows.sliding_average(r, panes=True), topics.EARLIEST
    ),
    "driver_sessions": _of_rides("driver_sessions", windows.session_driver, topics.LATEST),
    "zone_trip_totals": _of_rides(
        "zone_trip_totals", state.cumulative_counter, topics.EARLIEST, "update"
    ),
    "zone_max_fare": _of_rides(
        "zone_max_fare", state.max_fare_tracker, topics.EARLIEST, "update"
    ),
    "zone_cumulative": _of_rides(
        "zone_cumulative", state.zone_cumulative, topics.EARLIEST, "update"
    ),
    "zone_rate_alerts": _of_rides("zone_rate_alerts", windows.rate_alerts, topics.EARLIEST),
    "event_log": _event_log,
    "windowed_revenue": _of_rides("windowed_revenue", windows.windowed_revenue, topics.LATEST),
    "revenue_with_lateness": _with_lateness,
    "enriched_rides": _enriched_rides,
    "completed_trips": _completed_trips,
    "nearby_rides": _nearby_rides,
    "driver_rides": _drivers_by("driver_rides", keyed.BUFFER),
    "zone_rides": _zone_rides,
    "dashboard": _dashboard,
    "dashboard_named": _dashboard_named,
    "dashboard_trips": _dashboard_trips,
    "dashboard_late_events": _dashboard_late_events,
    "driver_rides_emit_partial": _drivers_by("driver_rides_emit_partial", keyed.EMIT_PARTIAL),
    "driver_rides_drop_if_old": _drivers_by("driver_rides_drop_if_old", keyed.DROP_IF_OLD),
    "trip_outcomes": _trip_outcomes,
    "unique_rides": _of_rides(
        "unique_rides",
        lambda r: state.dedup(r, ["driver_id", "tpep_pickup_datetime"], ["event_time"]),
        topics.EARLIEST,
    ),
    "last_rides": _keyed(
        "last_rides", keyed.LastN, "PULocationID", ["event_time", "total_amount"]
    ),
    "first_seen": _of_rides("first_seen", state.first_seen, topics.EARLIEST, "update"),
    "fare_changes": _keyed("fare_changes", keyed.Changes, "PULocationID", "total_amount"),
    "ride_verdicts": _keyed("ride_verdicts", keyed.Verdicts),
    "expiring_counts": _keyed("expiring_counts", keyed.ExpiringCount),
}
