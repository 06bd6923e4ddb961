"""Every job, from files to changelogs, as a user would submit it."""

import pytest
from pyspark.sql import functions as F

from meterline import submit
from meterline.operators import joins, late, state, windows
from meterline.plans import dashboard
from meterline.sources import topics
from meterline.sources.specs import DROPOFFS, PICKUPS, RESULTS, RIDES, to_sink_types
from meterline.streaming import jobs
from meterline.streaming.catalog import JOBS, Places
from meterline.streaming.late import LateRouter
from meterline.streaming.sinks import changelog, current_rows
from tests.streams import at, ms, ride, rows_of, write_batches


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("topics")
    write_batches(
        root / "rides",
        [ride(n, fare=30.0, to=1) for n in range(25)],
        [ride(70, zone=2), ride(400)],
        [ride(10), ride(5000)],
        [ride(20_000)],
        [ride(20_001)],
    )
    pickup, dropoff = at(0).isoformat(), (at(600).isoformat(), at(9600).isoformat())
    write_batches(root / "pickups", [
        {"trip_id": "t", "pickup_zone": 1, "pickup_time": pickup},
        {"trip_id": "slow", "pickup_zone": 1, "pickup_time": pickup}])
    write_batches(root / "dropoffs", [
        {"trip_id": "t", "dropoff_zone": 2, "dropoff_time": dropoff[0], "fare": 9.0},
        {"trip_id": "slow", "dropoff_zone": 2, "dropoff_time": dropoff[1], "fare": 9.0}])
    write_batches(root / "drivers", [{"driver_id": 1, "name": "Ann", "rating": 4.9}])
    write_batches(root / "zones", [{"zone_id": 1, "zone_name": "A"}])
    return str(root)


# Job, result, rows, and a fact about them.
EXPECTED = {
    "high_fare_rides": ("high_fare_rides", 25, "total_amount = 30"),
    "rides_eur": ("rides_eur", 31, "fare_eur > 9"),
    "zone_events": ("zone_events", 62, "event_type IN ('pickup', 'dropoff')"),
    "minute_revenue": ("minute_revenue", 4, "window_end > window_start"),
    "driver_sessions": ("driver_sessions", 4, "trip_count >= 1"),
    "zone_rate_alerts": ("zone_rate_alerts", 1, "ride_count >= 25"),
    "event_log": ("event_log", 30, "status = 'on-time'"),
    "enriched_rides": ("enriched_rides", 31, "dropoff_zone_name IN ('A', 'Unknown')"),
    "completed_trips": ("completed_trips", 1, "duration_minutes = 10"),
    "nearby_rides": ("nearby_rides", 300, "time_diff_seconds BETWEEN 1 AND 300"),
    "driver_rides": ("driver_rides", 31, "driver_name = 'Ann'"),
    "zone_rides": ("zone_rides", 31, "pickup_zone IN ('A', 'Unknown')"),
    "driver_rides_drop_if_old": ("driver_rides_drop_if_old", 31, "driver_name = 'Ann'"),
    "ride_verdicts": ("ride_verdicts", 30, "verdict = IF(nth_in_window > 20, 'throttle', 'allow')"),
    "unique_rides": ("unique_rides", 30, "total_amount > 0"),
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_job(spark, tmp_path, folder, job):
    zones = spark.createDataFrame([(1, "A")], "zone_id INT, zone_name STRING")
    places = Places(
        spark, out=str(tmp_path / "out"), state=str(tmp_path / "state"), folder=folder, zones=zones
    )
    outputs = JOBS[job](places)
    jobs.await_all(jobs.start_all(outputs, str(tmp_path / "cp"), once=True), 240)
    results = [output.name for output in outputs]
    if job == "dashboard_trips":
        results = ["dashboard_avg_duration", "long_trips", "fraud_flags"]
        assert table_of(spark, tmp_path, "dashboard_avg_duration") == [(1, 2, 85.0)]
    if job == "dashboard_late_events":
        assert table_of(spark, tmp_path, "dashboard_late_events") == [("late_events", 1)]
    if job == "trip_outcomes":
        counts = spark.read.parquet(f"{tmp_path}/out/trip_outcomes").groupBy("outcome")
        trips = [spark.read.schema(t.schema).json(f"{folder}/{t.name}") for t in (PICKUPS, DROPOFFS)]
        assert rows_of(counts.agg(F.sum("rows"))) == rows_of(joins.trip_outcomes(*trips))
    for name in results:
        assert spark.read.parquet(f"{tmp_path}/out/{name}").count() > 0
    if job in EXPECTED:
        name, rows, fact = EXPECTED[job]
        result = spark.read.parquet(f"{tmp_path}/out/{name}")
        if job not in ("minute_revenue", "driver_sessions", "nearby_rides"):
            assert result.count() == rows
        assert result.where(f"NOT ({fact})").count() == 0
    if job == "event_log":
        assert rows_of(spark.read.parquet(f"{tmp_path}/out/late_events"), "event_time") == [(at(10),)]
    if job in TABLE_FORM:
        rides = RIDES.with_event_time(spark.read.schema(RIDES.schema).json(f"{folder}/rides"))
        for name, operator in TABLE_FORM[job].items():
            expected = to_sink_types(operator(rides))
            got = table_of(spark, tmp_path, name)
            if job in UNTIL_WATERMARK:
                # Windows that the watermark has not passed are still open.
                end = next(c for c in expected.columns if c.endswith("_end"))
                expected = expected.where(F.col(end) < at(19_000))
            columns = RESULTS[name].schema.names
            assert got == rows_of(expected, *columns) and got


def table_of(spark, tmp_path, name):
    """A result as its declared table."""
    spec = RESULTS[name]
    path = f"{tmp_path}/out/{name}"
    return rows_of(current_rows(spark, path, spec.schema, spec.key), *spec.schema.names)


# Results that must equal the table form row by row.
TABLE_FORM = {
    "rolling_avg_fare": {"rolling_avg_fare": windows.sliding_average},
    "minute_revenue": {"minute_revenue": windows.tumbling_revenue},
    "zone_trip_totals": {"zone_trip_totals": state.cumulative_counter},
    "zone_max_fare": {"zone_max_fare": state.max_fare_tracker},
    "zone_cumulative": {"zone_cumulative": state.zone_cumulative},
    "first_seen": {"first_seen": state.first_seen},
    "dashboard": {
        name: (lambda r, n=name: dashboard.from_rides(r)[n])
        for name in ("dashboard_top_zones", "dashboard_avg_stats", "dashboard_processing_stats")
    } | {"dashboard_top_five": lambda r: dashboard.ranked(dashboard.top_zones(r))},
}
UNTIL_WATERMARK = {"rolling_avg_fare", "minute_revenue"}


def test_named_dashboard(spark, tmp_path, folder):
    zones = spark.createDataFrame([(1, "A")], "zone_id INT, zone_name STRING")
    places = Places(spark, out=str(tmp_path / "out"), state=str(tmp_path / "s"), folder=folder,
                    zones=zones)
    jobs.await_all(jobs.start_all(JOBS["dashboard_named"](places), str(tmp_path / "cp"), True), 240)
    found = {r[0]: r[-1] for r in table_of(spark, tmp_path, "named_dashboard_top_zones")}
    assert found == {1: "A", 2: "Unknown"}


def test_malformed_lines_go_to_their_own_table(spark, tmp_path):
    folder = write_batches(tmp_path / "in" / "rides", [ride(0), ride(5)], [ride(9)])
    with open(f"{folder}/00001.json", "a") as out:
        out.write('\n{"PULocationID": "no number"}\nnot json at all\n')
    places = Places(spark, out=str(tmp_path / "out"), state=str(tmp_path / "s"),
                    folder=str(tmp_path / "in"))
    outputs = JOBS["zone_trip_totals"](places) + places.rejected()
    jobs.await_all(jobs.start_all(outputs, str(tmp_path / "cp"), once=True), 240)
    assert [r[:2] for r in table_of(spark, tmp_path, "zone_trip_totals")] == [(1, 3)]
    bad = spark.read.parquet(f"{tmp_path}/out/rides_rejected")
    assert {r["record"] for r in bad.collect()} == {'{"PULocationID": "no number"}', "not json at all"}


def test_malformed_records_of_a_topic(spark):
    records = spark.createDataFrame([('{"PULocationID": 3}',), ("{broken",)], "value STRING")
    rows = topics.decode(RIDES, records, watermark=False)
    assert [r["PULocationID"] for r in topics.well_formed(rows).collect()] == [3]
    assert topics.malformed(rows).count() == 1


def test_a_fresh_checkpoint_counts_as_later(spark, tmp_path):
    """Totals after a reset replace those before it, whatever the batch numbers."""
    folder = write_batches(tmp_path / "in" / "rides", [ride(0)], [ride(1)], [ride(2)])

    def run(checkpoint):
        places = Places(spark, out=str(tmp_path / "out"), state=str(tmp_path / checkpoint),
                        folder=str(tmp_path / "in"))
        outputs = JOBS["zone_trip_totals"](places)
        jobs.await_all(jobs.start_all(outputs, str(tmp_path / checkpoint), once=True), 240)
        return table_of(spark, tmp_path, "zone_trip_totals")[0][:2]

    assert run("a") == (1, 3)
    import os

    os.rename(f"{folder}/00001.json", f"{tmp_path}/gone1.json")
    os.rename(f"{folder}/00002.json", f"{tmp_path}/gone2.json")
    assert run("b") == (1, 1)
    assert len([x for x in os.listdir(f"{tmp_path}/out/zone_trip_totals") if "run=" in x]) == 2


def test_submit(spark, tmp_path, folder):
    zones = str(tmp_path / "zones")
    spark.createDataFrame([(1, "A")], "zone_id INT, zone_name STRING").write.parquet(zones)
    out = str(tmp_path / "out")
    submit.main(["enriched_rides", "--folder", folder, "--out", out, "--zones", zones,
                 "--checkpoints", str(tmp_path / "cp"), "--max-per-trigger", "5", "--once"])
    assert spark.read.parquet(f"{out}/enriched_rides").count() == 31


def test_arguments():
    args = submit.parse(["minute_revenue", "--servers", "b:9092", "--out", "/o"])
    assert (args.job, args.servers, args.once) == ("minute_revenue", "b:9092", False)
    with pytest.raises(SystemExit):
        submit.parse(["minute_revenue", "--out", "/o"])
    with pytest.raises(SystemExit):
        submit.parse(["unheard_of", "--folder", "/f", "--out", "/o"])


def test_custom_watermark_generator(spark, tmp_path):
    """Only rides with a NULL fare move the watermark."""
    rows = spark.createDataFrame(
        [(0, 100, 1.0), (1, 50, 1.0), (2, 90, None), (3, 60, 1.0), (4, 89, 1.0)],
        "event_id LONG, s LONG, total_amount DOUBLE",
    ).selectExpr("*", f"timestamp_millis({ms(0)} + s * 1000) AS event_time")
    marker = F.when(F.col("total_amount").isNull(), F.col("event_time"))
    met = late.with_watermark(rows, ["event_id"], "1 second", generator=marker)
    is_late = F.coalesce(F.col("event_time") < F.col("watermark"), F.lit(False))
    assert rows_of(met.where(is_late), "event_id") == [(3,)]

    kept, dropped = changelog(str(tmp_path / "kept")), changelog(str(tmp_path / "late"))
    router = LateRouter(str(tmp_path / "control"), kept, dropped, generator=F.max(marker))
    router(rows.where("event_id <= 2"), 0)
    router(rows.where("event_id > 2"), 1)
    assert rows_of(spark.read.parquet(str(tmp_path / "late")), "event_id") == [(3,), (4,)]


def test_windows_by_processing_time(spark, tmp_path):
    """The same window over the wall clock."""
    from meterline.functions.scalars import processing_time
    from meterline.operators.windows import ZONE, tumbling
    from meterline.sources.specs import RIDES
    from meterline.sources.topics import read_files
    from meterline.streaming.sinks import to_memory
    from tests.streams import run

    rides = read_files(
        spark, RIDES, write_batches(tmp_path / "in", [ride(0), ride(9000)]), watermark=False
    ).withColumn("seen_at", processing_time())
    counts = tumbling(rides, "1 day", ZONE, [F.count("*").alias("n")], time_col="seen_at")
    run(to_memory(counts, "by_clock", "complete"), tmp_path / "cp")
    assert rows_of(spark.table("by_clock"), "zone_id", "n") == [(1, 2)]
