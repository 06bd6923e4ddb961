"""Edge cases of the table forms, on literal rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterline.functions import scalars
from meterline.functions.durations import bucket_start, to_micros
from meterline.operators import joins, state, stateless, windows
from meterline.plans import dashboard
from meterline.sources.specs import RESULTS, RIDES, to_sink_types
from tests.streams import at, ms, ride, rows_of


def rides(spark, *rows):
    data = [tuple(r.get(c) for c in RIDES.schema.names) for r in rows]
    return RIDES.with_event_time(spark.createDataFrame(data, RIDES.schema))


def test_filter_is_strict_and_drops_null(spark):
    df = rides(spark, ride(0, fare=20.0), ride(0, fare=20.01), ride(0, fare=None))
    assert rows_of(stateless.filter_high_fare(df), "total_amount") == [(20.01,)]


def test_premium_needs_both(spark):
    df = rides(spark, ride(0, fare=51.0, distance=5.0), ride(0, fare=50.0, distance=6.0),
               ride(0, fare=50.5, distance=5.5))
    assert rows_of(stateless.filter_premium(df), "total_amount") == [(50.5,)]


def test_zero_distance_has_no_price_per_mile(spark):
    df = rides(spark, ride(0, fare=10.0, distance=0.0), ride(0, fare=10.0, distance=2.0))
    assert rows_of(stateless.price_per_mile(df).na.fill(-1.0), "price_per_mile") == [(-1.0,), (10.0 * 0.92 / 2.0,)]


def test_flat_map(spark):
    events = stateless.zone_events_with_completion(rides(spark, ride(0, zone=1, to=2, fare=9.0)))
    got = [tuple(r) for r in events.collect()]
    assert got == [
        ("pickup", 1, ms(0), None), ("dropoff", 2, ms(0), None), ("ride_complete", 2, ms(0), 9.0),
    ]
    assert stateless.zone_events(rides(spark, ride(0), ride(1))).count() == 4


def test_malformed_json_is_kept(spark):
    text = spark.createDataFrame(
        [('{"driver_id": 7, "extra": 1}',), ("not json",)], "value STRING"
    )
    got = stateless.decode_json(text, RIDES.schema).select("driver_id", stateless.CORRUPT)
    assert {tuple(r) for r in got.collect()} == {(7, None), (None, "not json")}


def test_new_field_wins(spark):
    df = stateless.pass_through(rides(spark, ride(0, fare=1.0)), total_amount=F.lit(2.0), x=F.lit(3))
    assert rows_of(df, "total_amount", "x") == [(2.0, 3)]


def test_union_kinds(spark):
    a, b = spark.range(3), spark.range(1, 4)
    assert stateless.union_all(a, b).count() == 6
    assert rows_of(stateless.union_distinct(a, b)) == [(0,), (1,), (2,), (3,)]


def test_scalars(spark):
    one = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:30' AS a, timestamp'2024-01-01 00:01:29' AS b, '' AS e"
    )
    row = one.select(
        scalars.minutes_between("a", "b").alias("m"),
        scalars.minutes_between("b", "a").alias("back"),
        scalars.seconds_between("a", "b").alias("s"),
        scalars.or_unknown("e").alias("u"),
        scalars.or_default("e", "x").alias("d"),
        scalars.ratio(F.lit(1.0), F.lit(0.0)).alias("r"),
        bucket_start("a", "1 minute").alias("bucket"),
        scalars.processing_time().alias("now"),
    ).first()
    assert (row.m, row.back, row.s, row.u, row.d, row.r) == (0, 0, 59, "Unknown", "", None)
    assert row.bucket == 1704067200 * 1_000_000
    assert isinstance(row.now, datetime)


def test_durations():
    assert to_micros("10 seconds") == 10_000_000
    assert to_micros("1 day") == 86_400_000_000
    for bad in ("1 month", "soon", "x minutes"):
        with pytest.raises(ValueError):
            to_micros(bad)


def test_window_edges(spark):
    df = rides(spark, ride(59.999), ride(60), ride(119.999))
    got = rows_of(to_sink_types(windows.tumbling_revenue(df)), "window_start", "trip_count")
    assert got == [(at(0), 1), (at(60), 2)]


def test_row_lies_in_size_over_slide_windows(spark):
    got = windows.sliding_average(rides(spark, ride(7)))
    assert got.count() == 30
    first = to_sink_types(got).agg(F.min("window_start"), F.max("window_end")).first()
    assert tuple(first) == (at(-290), at(300))


def test_sliding_average_ignores_null_fares(spark):
    df = rides(spark, ride(0, fare=None), ride(1, fare=4.0))
    rows = windows.sliding_average(df, "10 seconds", "10 seconds").collect()
    assert [(r.trip_count, r.avg_fare) for r in rows] == [(2, 4.0)]


@pytest.mark.parametrize("second, sessions", [(9.999, 1), (10, 1), (10.001, 2)])
def test_session_gap(spark, second, sessions):
    df = rides(spark, ride(0), ride(second))
    got = to_sink_types(windows.session_driver(df))
    assert got.count() == sessions
    assert got.agg(F.max("session_end")).first()[0] == at(second) + timedelta(seconds=10)


def test_sessions_are_per_driver(spark):
    df = rides(spark, ride(0, driver=1, fare=1.0), ride(5, driver=2, fare=2.0),
               ride(8, driver=1, fare=4.0), ride(19, driver=1, fare=8.0))
    got = rows_of(windows.session_driver(df), "driver_id", "trip_count", "total_revenue")
    assert got == [(1, 1, 8.0), (1, 2, 5.0), (2, 1, 2.0)]


@pytest.mark.parametrize("count, alerts", [(20, 0), (21, 1)])
def test_alert_threshold(spark, count, alerts):
    df = rides(spark, *(ride(n) for n in range(count)))
    assert windows.rate_alerts(df).count() == alerts


def test_window_kind_counts(spark):
    df = rides(spark, ride(0), ride(5), ride(30))
    got = dict(rows_of(windows.window_kind_counts(df)))
    # Slides start at -290 s .. 0 s and, for the last ride, up to 30 s.
    assert got == {"tumbling": 1, "session": 2, "sliding": 33}


def test_cumulative_and_extremes(spark):
    df = rides(spark, ride(0, fare=3.0, distance=9.0), ride(5, fare=7.0, distance=2.0))
    assert rows_of(to_sink_types(state.cumulative_counter(df))) == [(1, 2, 10.0, at(5))]
    assert rows_of(state.max_fare_tracker(df)) == [(1, 7.0, 9.0)]
    assert rows_of(state.min_fare_tracker(df)) == [(1, 3.0)]
    assert rows_of(state.avg_stats(df)) == [(1, 5.0, 5.5, 2)]
    assert rows_of(to_sink_types(state.processing_stats(df))) == [("total_events", 2, at(5))]


def test_dedup_keeps_the_first(spark):
    df = rides(spark, ride(5, fare=2.0), ride(0, fare=1.0), ride(9, driver=2, fare=3.0))
    got = state.dedup(df, ["driver_id"], ["event_time"])
    assert got.columns == df.columns
    assert rows_of(got, "driver_id", "total_amount") == [(1, 1.0), (2, 3.0)]


def test_change_detection(spark):
    df = rides(spark, ride(0, zone=1), ride(1, zone=1), ride(2, zone=None), ride(3, zone=None),
               ride(4, zone=1), ride(0, driver=2, zone=5))
    got = state.change_detection(df, ["driver_id"], "PULocationID", ["event_time"])
    shown = [tuple(r) for r in got.orderBy("event_time")
             .select("driver_id", "previous_value", "current_value").collect()]
    assert shown == [(1, 1, None), (1, None, 1)]


def test_top_and_slices(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, 1)], "zone INT, n INT")
    assert [tuple(r) for r in state.top_k(df, "n", ["zone"], 3).collect()] == [(2, 9), (3, 9), (1, 5)]
    assert [tuple(r) for r in state.slice_of(df, "n", 9, ["zone"], 1).collect()] == [(2, 9)]
    assert state.first_rows(df, 2).count() == 2


def trips(spark, *rows):
    pickups = spark.createDataFrame(
        [(t, 1, at(p)) for t, p, *_ in rows], "trip_id STRING, pickup_zone INT, pickup_time TIMESTAMP")
    dropoffs = spark.createDataFrame(
        [(t, zone, at(d), fare) for t, _, d, zone, fare in rows if d is not None],
        "trip_id STRING, dropoff_zone INT, dropoff_time TIMESTAMP, fare DOUBLE")
    return pickups, dropoffs


EDGES = [
    ("at once", 0, 0, 2, 1.0),
    ("edge", 0, 1800, 2, 1.0),
    ("over", 0, 1800.001, 2, 1.0),
    ("backwards", 0, -1, 2, 1.0),
    ("none", 0, None, 2, 1.0),
]


def test_trip_join_edges(spark):
    both = trips(spark, *EDGES)
    got = joins.trip_join(*both)
    assert rows_of(got, "trip_id", "duration_minutes") == [("at once", 0), ("edge", 30)]
    assert joins.trip_join(*both, how="left_outer").count() == 5
    assert rows_of(joins.trip_outcomes(*both)) == [("expired", 2), ("matched", 2), ("unmatched", 1)]
    ends = joins.with_outcome(joins.trip_ends(*both))
    assert rows_of(ends.groupBy("outcome").count()) == rows_of(joins.trip_outcomes(*both))


def test_fraud_flags(spark):
    results = dashboard.from_trips(*trips(
        spark,
        ("two hours", 0, 7200, 2, 1.0), ("longer", 0, 7200.001, 2, 1.0),
        ("circle", 0, 60, 1, 50.01), ("cheap circle", 0, 60, 1, 50.0),
        ("both", 0, 9000, 1, 99.0),
    ))
    assert rows_of(results["fraud_flags"], "trip_id", "too_long", "circular") == [
        ("both", 1, 1), ("circle", 0, 1), ("longer", 1, 0),
    ]
    assert rows_of(results["long_trips"], "trip_id") == [("both",), ("longer",)]
    durations = rows_of(results["dashboard_avg_duration"], "pickup_zone", "trip_count")
    assert durations == [(1, 5)]


def test_nearby_edges(spark):
    df = rides(spark, ride(0, fare=1.0), ride(0, fare=2.0), ride(300, fare=3.0),
               ride(300.001, fare=4.0), ride(10, zone=2, fare=5.0))
    got = rows_of(joins.nearby_rides(df), "ride1_fare", "ride2_fare", "time_diff_seconds")
    assert got == [(1.0, 3.0, 300), (2.0, 3.0, 300), (3.0, 4.0, 0)]


def test_nearby_equals_brute_force(spark):
    df = rides(spark, *(ride(n * 37 % 2003, zone=n % 3, fare=float(n)) for n in range(150)))
    a, b = df.alias("a"), df.alias("b")
    brute = a.join(b, F.expr(
        "a.PULocationID = b.PULocationID AND b.event_time > a.event_time "
        "AND b.event_time <= a.event_time + INTERVAL 5 MINUTES"
    )).select("a.total_amount", F.col("b.total_amount").alias("other"))
    got = rows_of(joins.nearby_rides(df), "ride1_fare", "ride2_fare")
    assert got == rows_of(brute) and got


def driver_rows(spark):
    left = rides(spark, ride(0, fare=1.0), ride(3600, fare=2.0), ride(9000, fare=3.0),
                 ride(0, driver=2, fare=4.0)).withColumn("event_id", F.col("total_amount"))
    updates = spark.createDataFrame(
        [(1, "late", 4.0, at(7200), 2), (1, "first", 4.5, at(7200), 1), (1, "next", 5.0, at(8000), 3)],
        "driver_id INT, name STRING, rating DOUBLE, updated_at TIMESTAMP, update_id LONG")
    return left, updates


@pytest.mark.parametrize("cell", ["1 second", "1 minute", "365 days"])
def test_driver_policies(spark, cell):
    def names(policy):
        got = joins.driver_join(*driver_rows(spark), policy, "1 hour", cell)
        return {r.total_amount: r.driver_name for r in got.collect()}

    # Of two updates from one instant a waiting ride is flushed by the first.
    assert names("buffer") == {1.0: "first", 2.0: "first", 3.0: "next"}
    assert names("drop_if_old") == {2.0: "first", 3.0: "next"}
    assert names("emit_partial") == {1.0: None, 2.0: None, 3.0: "next", 4.0: None}


def test_seed_rows_do_not_replace(spark):
    target = spark.createDataFrame([(1, "kept")], "k INT, v STRING")
    seeds = spark.createDataFrame([(1, "seed"), (2, "seed")], "k INT, v STRING")
    assert rows_of(joins.absent_rows(seeds, target, ["k"])) == [(2, "seed")]


def test_declared_result_columns(spark):
    df = rides(spark, ride(0), ride(5))
    zones = spark.createDataFrame([(1, "A")], "zone_id INT, zone_name STRING")
    made = {
        "high_fare_rides": stateless.filter_high_fare(df),
        "rides_eur": stateless.map_to_eur(df),
        "zone_events": stateless.zone_events(df),
        "minute_revenue": windows.tumbling_revenue(df),
        "rolling_avg_fare": windows.sliding_average(df),
        "driver_sessions": windows.session_driver(df),
        "zone_trip_totals": state.cumulative_counter(df),
        "zone_max_fare": state.max_fare_tracker(df),
        "zone_cumulative": state.zone_cumulative(df),
        "zone_rate_alerts": windows.rate_alerts(df),
        "windowed_revenue": windows.windowed_revenue(df),
        "enriched_rides": joins.zone_lookup(df, zones),
        "nearby_rides": joins.nearby_rides(df),
        "completed_trips": joins.trip_join(*trips(spark, ("t", 0, 1, 2, 3.0))),
        **dashboard.from_rides(df),
    }
    for name, result in made.items():
        declared = [(f.name, f.dataType) for f in RESULTS[name].schema.fields]
        assert [(f.name, f.dataType) for f in to_sink_types(result).schema.fields] == declared, name
