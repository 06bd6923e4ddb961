"""The same operator on a stream, file by file, and on the whole table."""

import pytest

from meterline.operators import joins, state, stateless, windows
from meterline.plans import dashboard
from meterline.sources.specs import DROPOFFS, PICKUPS, RIDES, to_sink_types
from meterline.sources.topics import read_files, well_formed
from meterline.streaming import jobs, keyed
from meterline.streaming.sinks import changelog, current_rows, read_changelog, to_memory
from tests.streams import at, ride, rows_of, run, write_batches

BATCHES = [
    [ride(0, 1, 21.0, 1), ride(5, 1, 20.0, 2), ride(15, 2, 30.5, 1, to=1)],
    [ride(25, 1, 8.0, 1), ride(59, 3, 60.0, 3, distance=7.0), ride(60, 1, 9.5, 2)],
    [ride(61, 2, 11.0, 1), ride(130, 2, 12.0, 1), ride(300, 1, 7.0, 2)],
]
# A far later row moves the watermark past every window; it is in both inputs.
FLUSH = [[ride(100_000, 9)], [ride(100_001, 9)]]


def stream(spark, tmp_path, batches, spec=RIDES, name="in"):
    return well_formed(read_files(spark, spec, write_batches(tmp_path / name, *batches)))


def table(spark, tmp_path, spec=RIDES, name="in"):
    return spec.with_event_time(spark.read.schema(spec.schema).json(str(tmp_path / name)))


def streamed(spark, tmp_path, df, mode, keys=()):
    path = str(tmp_path / "out")
    run(df.writeStream.outputMode(mode).foreachBatch(changelog(path)), tmp_path / "cp")
    schema = to_sink_types(df).schema
    if keys:
        return current_rows(spark, path, schema, keys)
    return read_changelog(spark, path, schema).drop("run", "batch_id")


@pytest.mark.parametrize(
    "operator",
    [
        stateless.filter_high_fare,
        stateless.filter_premium,
        stateless.map_to_eur,
        stateless.price_per_mile,
        stateless.zone_events,
        stateless.zone_events_with_completion,
    ],
    ids=lambda f: f.__name__,
)
def test_stateless(spark, tmp_path, operator):
    df = operator(stream(spark, tmp_path, BATCHES))
    expected = operator(table(spark, tmp_path))
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, streamed(spark, tmp_path, df, "append").collect()), key=key) == sorted(
        map(tuple, expected.collect()), key=key
    )


@pytest.mark.parametrize(
    "operator",
    [
        windows.tumbling_revenue,
        windows.rate_alerts,
        windows.session_driver,
        lambda r: windows.sliding_average(r, "60 seconds", "20 seconds"),
        lambda r: windows.sliding_average(r, "60 seconds", "20 seconds", panes=True),
    ],
    ids=["tumbling", "alerts", "session", "sliding", "sliding_panes"],
)
def test_windows_in_append_mode(spark, tmp_path, operator):
    batches = [*BATCHES, [ride(200 + n / 10, 4) for n in range(21)], *FLUSH]
    df = operator(stream(spark, tmp_path, batches))
    got = rows_of(streamed(spark, tmp_path, df, "append"))
    # The stream holds back windows that the watermark has not passed: those of the last rows.
    done = to_sink_types(operator(table(spark, tmp_path)))
    end = next(c for c in done.columns if c.endswith("_end"))
    expected = rows_of(done.where(done[end] < at(99_000)))
    assert got == expected and got


@pytest.mark.parametrize(
    "operator, keys",
    [
        (state.cumulative_counter, ["zone_id"]),
        (state.max_fare_tracker, ["zone_id"]),
        (state.min_fare_tracker, ["zone_id"]),
        (state.zone_cumulative, ["zone_id"]),
        (state.first_seen, ["driver_id"]),
        (state.avg_stats, ["zone_id"]),
        (state.processing_stats, ["stat_name"]),
        (windows.windowed_revenue, ["zone_id", "window_end"]),
    ],
    ids=lambda v: getattr(v, "__name__", ""),
)
def test_aggregates_in_update_mode(spark, tmp_path, operator, keys):
    df = operator(stream(spark, tmp_path, BATCHES))
    got = rows_of(streamed(spark, tmp_path, df, "update", keys))
    assert got == rows_of(to_sink_types(operator(table(spark, tmp_path))))


def test_dedup_within_watermark(spark, tmp_path):
    twice = [BATCHES[0], BATCHES[0] + BATCHES[1]]
    keys = ["driver_id", "tpep_pickup_datetime"]
    df = state.dedup(stream(spark, tmp_path, twice), keys, ["event_time"])
    got = streamed(spark, tmp_path, df, "append")
    assert rows_of(got, *keys) == rows_of(table(spark, tmp_path).select(keys).distinct())


def test_zone_lookup(spark, tmp_path):
    zones = spark.createDataFrame([(1, "A"), (2, "")], "zone_id INT, zone_name STRING")
    df = joins.zone_lookup(stream(spark, tmp_path, BATCHES), zones)
    got = rows_of(streamed(spark, tmp_path, df, "append"))
    assert got == rows_of(to_sink_types(joins.zone_lookup(table(spark, tmp_path), zones)))


def test_asof_with_static_versions(spark, tmp_path):
    versions = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2024-01-01 12:00:00', 0, 'a'), "
        "(1, timestamp'2024-01-01 12:00:20', 1, 'b') AS v(zone_id, since, seq, name)"
    )

    def operator(rides):
        named = rides.withColumnRenamed("PULocationID", "zone_id")
        args = ("zone_id", "event_time", "since", "seq", ["name"], "tpep_pickup_datetime")
        return joins.asof_join(named, versions, *args)

    df = operator(stream(spark, tmp_path, BATCHES))
    got = streamed(spark, tmp_path, df, "append").where("zone_id = 1")
    assert rows_of(got, "event_time", "name") == [
        (at(0), "a"), (at(5), "a"), (at(25), "b"), (at(60), "b"), (at(300), "b"),
    ]


def test_asof_with_many_versions_per_key(spark, tmp_path):
    versions = spark.range(100).selectExpr(
        "1 AS driver_id", "id AS seq", "id AS v",
        "timestamp_seconds(1704110400 + id * 3) AS since")
    operator = lambda rides: joins.asof_join(
        rides, versions, "driver_id", "event_time", "since", "seq", ["v"], "tpep_pickup_datetime")
    got = rows_of(streamed(spark, tmp_path, operator(stream(spark, tmp_path, BATCHES)), "append"))
    assert got == rows_of(to_sink_types(operator(table(spark, tmp_path))))
    assert len({r[-1] for r in got}) > 2


def trips(spark, tmp_path, how):
    def text(seconds):
        return at(seconds).isoformat()

    def pickup(trip, seconds):
        return {"trip_id": trip, "pickup_zone": 1, "pickup_time": text(seconds)}

    def dropoff(trip, seconds):
        return {"trip_id": trip, "dropoff_zone": 2, "dropoff_time": text(seconds), "fare": 5.0}

    pickups = [[pickup("at once", 0), pickup("edge", 1)], [pickup("over", 2), pickup("none", 3)],
               [pickup("flush", 90_000)], [pickup("flush", 90_001)]]
    dropoffs = [[dropoff("at once", 0)], [dropoff("edge", 1801), dropoff("over", 1802.001)],
                [dropoff("flush", 100_000)], [dropoff("flush", 100_001)]]
    both = []
    for spec, name, batches in ((PICKUPS, "p", pickups), (DROPOFFS, "d", dropoffs)):
        raw = spark.readStream.schema(spec.schema).option("maxFilesPerTrigger", 1).json(
            write_batches(tmp_path / name, *batches)
        )
        both.append(spec.with_event_time(raw))
    df = joins.trip_join(*both, how=how)
    got = rows_of(streamed(spark, tmp_path, df, "append"), "trip_id", "duration_minutes")
    static = joins.trip_join(
        table(spark, tmp_path, PICKUPS, "p"), table(spark, tmp_path, DROPOFFS, "d"), how=how
    )
    return got, rows_of(static.where("trip_id <> 'flush'"), "trip_id", "duration_minutes")


def test_trip_join(spark, tmp_path):
    got, static = trips(spark, tmp_path, "inner")
    assert got == static == [("at once", 0), ("edge", 30)]


def test_unmatched_pickups_surface(spark, tmp_path):
    got, static = trips(spark, tmp_path, "left_outer")
    assert got == static == [("at once", 0), ("edge", 30), ("none", None), ("over", None)]


def test_nearby_rides(spark, tmp_path):
    batches = [
        [ride(0, 1, 1.0), ride(0, 1, 2.0), ride(10, 2, 3.0)],
        [ride(299, 1, 4.0), ride(300, 1, 5.0)],
        [ride(300.001, 1, 6.0)],
    ]
    first = stream(spark, tmp_path, batches)
    second = read_files(spark, RIDES, str(tmp_path / "in"))
    got = rows_of(
        streamed(spark, tmp_path, joins.nearby_rides(first, second), "append"),
        "ride1_fare", "ride2_fare", "time_diff_seconds",
    )
    assert got == [
        (1.0, 4.0, 299), (1.0, 5.0, 300), (2.0, 4.0, 299), (2.0, 5.0, 300),
        (4.0, 5.0, 1), (4.0, 6.0, 1), (5.0, 6.0, 0),
    ]
    static = joins.nearby_rides(table(spark, tmp_path))
    assert rows_of(static, "ride1_fare", "ride2_fare", "time_diff_seconds") == got


def test_top_zones_of_a_stream(spark, tmp_path):
    df = dashboard.top_zones(stream(spark, tmp_path, BATCHES), 2)
    run(to_memory(df, "busiest", "complete"), tmp_path / "cp")
    assert [tuple(r) for r in spark.table("busiest").collect()] == [
        tuple(r) for r in dashboard.top_zones(table(spark, tmp_path), 2).collect()
    ]


def test_chained_enrichment(spark, tmp_path):
    """A join with what earlier batches left, then two lookups, in one query."""
    rides = stream(spark, tmp_path, BATCHES)
    updates = spark.readStream.schema("driver_id INT, name STRING, rating DOUBLE, t TIMESTAMP")
    drivers = updates.json(write_batches(tmp_path / "drivers", [
        {"driver_id": 1, "name": "Ann", "rating": 4.9, "t": at(10).isoformat()}]))
    zones = spark.createDataFrame([(1, "A")], "zone_id INT, zone_name STRING")
    sink = changelog(str(tmp_path / "out"))
    write = keyed.DriverJoin(
        str(tmp_path / "state"), lambda rows, n: sink(joins.broadcast_enrich(rows, zones), n))
    both = keyed.with_drivers(rides, drivers, "t")
    run(both.writeStream.foreachBatch(write), tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(got, "total_amount", "pickup_zone", "dropoff_zone", "driver_name") == [
        (8.0, "A", "Unknown", "Ann"), (11.0, "Unknown", "Unknown", "Ann"),
        (12.0, "Unknown", "Unknown", "Ann"), (21.0, "A", "Unknown", "Ann"),
        (30.5, "Unknown", "A", "Ann"),
    ]


def test_totals_survive_a_restart(spark, tmp_path):
    source = lambda: read_files(spark, RIDES, str(tmp_path / "in"))
    out = str(tmp_path / "out")

    def go():
        output = jobs.Output(
            "totals", state.cumulative_counter(source()), changelog(out), "update"
        )
        jobs.await_all([jobs.start(output, str(tmp_path / "cp"), once=True)], 120)

    write_batches(tmp_path / "in", *BATCHES[:2])
    go()
    write_batches(tmp_path / "in", BATCHES[2], first=2)
    go()
    expected = to_sink_types(state.cumulative_counter(table(spark, tmp_path)))
    assert rows_of(current_rows(spark, out, expected.schema, ["zone_id"])) == rows_of(expected)


def test_dashboard_is_one_job_with_many_outputs(spark, tmp_path):
    write_batches(tmp_path / "in", *BATCHES)
    outputs = jobs.dashboard_outputs(
        lambda: read_files(spark, RIDES, str(tmp_path / "in")),
        lambda name: changelog(str(tmp_path / name)),
    )
    jobs.await_all(jobs.start_all(outputs, str(tmp_path / "cp"), once=True), 240)
    keys = {"dashboard_hourly_revenue": ["zone_id", "window_end"],
            "dashboard_processing_stats": ["stat_name"]}
    for name, expected in dashboard.from_rides(table(spark, tmp_path)).items():
        expected = to_sink_types(expected)
        got = current_rows(
            spark, str(tmp_path / name), expected.schema, keys.get(name, ["zone_id"])
        )
        assert rows_of(got) == rows_of(expected), name
