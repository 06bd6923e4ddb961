"""Per-key patterns on streams, on literal fixtures, and the ledgers they keep."""

import os

import pytest
from pyspark.sql import functions as F

from meterline.operators import joins, state
from meterline.sources.specs import RIDES, TableSpec
from meterline.sources.topics import read_files
from meterline.streaming import keyed
from meterline.streaming.ledger import Ledger
from meterline.streaming.sinks import changelog
from tests.streams import ms, ride, rows_of, run, write_batches

DRIVERS = TableSpec(
    "drivers",
    "driver_id INT, name STRING, rating DOUBLE, at_ms BIGINT",
    epoch_ms="at_ms",
    event_time="event_time",
)


def driver(seconds, key=1, name="Ann", rating=4.9):
    return {"driver_id": key, "name": name, "rating": rating, "at_ms": ms(seconds)}


def join(spark, tmp_path, rides, drivers, policy, max_wait="1 hour"):
    def source(spec, name, batches):
        path = write_batches(tmp_path / name, *batches)
        raw = spark.readStream.schema(spec.schema).option("maxFilesPerTrigger", 1).json(path)
        return spec.with_event_time(raw, False)

    left = source(RIDES, "rides", rides)
    right = source(DRIVERS, "drivers", drivers)
    path = str(tmp_path / "out")
    writer = keyed.DriverJoin(str(tmp_path / "state"), changelog(path), policy, max_wait)
    both = keyed.with_drivers(left, right)
    run(both.writeStream.foreachBatch(writer), tmp_path / "cp")
    return rows_of(
        spark.read.option("mergeSchema", "true").parquet(path),
        "driver_id", "total_amount", "driver_name", "driver_rating",
    )


def test_ride_waits_for_its_driver(spark, tmp_path):
    rides = [[ride(0, fare=1.0)], [ride(30, fare=2.0), ride(31, fare=9.0, driver=2)],
             [ride(60, fare=3.0)]]
    drivers = [[driver(-5, key=3)], [driver(20)], [driver(50, name="Ann B")]]
    assert join(spark, tmp_path, rides, drivers, "buffer") == [
        (1, 1.0, "Ann", 4.9),  # waited
        (1, 2.0, "Ann", 4.9),  # known at once
        (1, 3.0, "Ann B", 4.9),  # after an update; the ride of driver 2 waits for ever
    ]


def test_order_within_a_batch_is_event_time(spark, tmp_path):
    rides = [[ride(0, fare=1.0), ride(10, fare=2.0), ride(20, fare=3.0)]]
    drivers = [[driver(15, name="new"), driver(10, name="old")]]
    assert join(spark, tmp_path, rides, drivers, "buffer") == [
        (1, 1.0, "old", 4.9),
        (1, 2.0, "old", 4.9),  # at one instant the driver comes first
        (1, 3.0, "new", 4.9),
    ]


def test_emit_partial_does_not_wait(spark, tmp_path):
    rides = [[ride(0, fare=1.0)], [ride(30, fare=2.0)]]
    drivers = [[driver(-5, key=3)], [driver(20)]]
    assert join(spark, tmp_path, rides, drivers, "emit_partial") == [
        (1, 1.0, None, None),
        (1, 2.0, "Ann", 4.9),
    ]


def test_ride_without_driver_has_key_zero(spark, tmp_path):
    nobody = {k: v for k, v in ride(0, fare=5.0).items() if k != "driver_id"}
    got = join(spark, tmp_path, [[nobody]], [[driver(0, key=0, name="pool")]], "buffer")
    assert got == [(0, 5.0, "pool", 4.9)]


def test_ride_without_a_time_is_kept(spark, tmp_path):
    timeless = ride(0, fare=5.0) | {"tpep_pickup_datetime": None}
    got = join(spark, tmp_path, [[timeless]], [[driver(0)]], "buffer")
    assert got == [(1, 5.0, "Ann", 4.9)]


def test_drop_if_old(spark, tmp_path):
    rides = [[ride(0, fare=1.0), ride(3000, fare=2.0)], [ride(3000, fare=7.0, driver=5)]]
    drivers = [[driver(0, key=9)], [driver(3660)]]
    got = join(spark, tmp_path, rides, drivers, "drop_if_old", "1 hour")
    assert got == [(1, 2.0, "Ann", 4.9)]  # the first ride is 61 minutes old


def test_expired_rides_leave_the_state(spark, tmp_path):
    # Far later rides move the watermark past both waiting rides' time.
    far = [[ride(20_000, driver=8)], [ride(20_001, driver=8)], [ride(20_002, driver=8)]]
    rides = [[ride(0, fare=1.0)], *far]
    drivers = [[driver(0, key=9)], [driver(20_000, key=9)], [driver(20_001, key=9)],
               [driver(20_002, key=1)]]
    got = join(spark, tmp_path, rides, drivers, "drop_if_old", "1 minute")
    assert got == []


def stream(spark, tmp_path, *batches):
    return read_files(spark, RIDES, write_batches(tmp_path / "in", *batches))


def collect(spark, tmp_path, rides, writer, *columns):
    """What a writer, given where to keep its table and where to write, makes of a stream."""
    path = str(tmp_path / "out")
    write = writer(str(tmp_path / "state"), changelog(path))
    run(rides.writeStream.foreachBatch(write), tmp_path / "cp")
    return rows_of(spark.read.parquet(path), "batch_id", *columns)


def test_last_n(spark, tmp_path):
    rides = stream(
        spark, tmp_path, [ride(1, fare=1.0), ride(3, fare=3.0)], [ride(2, fare=2.0), ride(9, zone=4)]
    )
    writer = lambda p, w: keyed.LastN(p, w, "PULocationID", ["event_time", "total_amount"], 2)
    got = collect(spark, tmp_path, rides, writer, "PULocationID", "recency", "total_amount")
    assert got == [
        (0, 1, 1, 3.0), (0, 1, 2, 1.0),
        (1, 1, 1, 3.0), (1, 1, 2, 2.0), (1, 4, 1, 10.0),
    ]


def test_change_detection(spark, tmp_path):
    rides = stream(
        spark, tmp_path, [ride(1, zone=5), ride(2, zone=5)], [ride(4, zone=6), ride(3, zone=5)]
    )
    writer = lambda p, w: keyed.Changes(p, w, "driver_id", "PULocationID")
    got = collect(spark, tmp_path, rides, writer, "driver_id", "previous_value", "current_value")
    assert got == [(1, 1, 5, 6)]


def test_rate_verdicts(spark, tmp_path):
    rides = stream(spark, tmp_path, [ride(1), ride(2)], [ride(3), ride(61)], [ride(62)])
    writer = lambda p, w: keyed.Verdicts(p, w, limit=2)
    got = collect(spark, tmp_path, rides, writer, "PULocationID", "nth_in_window", "verdict")
    assert got == [
        (0, 1, 1, "allow"), (0, 1, 2, "allow"),
        (1, 1, 1, "allow"), (1, 1, 3, "throttle"),
        (2, 1, 2, "allow"),
    ]


def test_count_starts_over_after_ttl(spark, tmp_path):
    rides = stream(spark, tmp_path, [ride(1), ride(2), ride(3, zone=2)], [ride(4)], [ride(5)], [ride(6)])
    times = iter([100.0, 102.0, 104.5, 108.0])
    writer = lambda p, w: keyed.ExpiringCount(p, w, ttl="3 seconds", clock=lambda: next(times))
    got = collect(spark, tmp_path, rides, writer, "PULocationID", "total_trips")
    assert got == [(0, 1, 2), (0, 2, 1), (1, 1, 3), (2, 1, 4), (3, 1, 1)]


BATCHES = [
    [ride(i * 7 % 300, fare=float(i % 4), driver=1 if i % 3 else i % 11, zone=i % 5) for i in range(60)],
    [ride(300 + i, fare=float(i % 2), driver=1, zone=3) for i in range(120)],
    [ride(430 + i * 3, fare=1.0, driver=i % 11, zone=i % 6) for i in range(40)],
]


def replayed(spark, tmp_path, batches, writer):
    """Rows after each batch has been run, and run again."""
    path = str(tmp_path / "out")
    write = writer(str(tmp_path / "state"), changelog(path))
    for n, rows in enumerate(batches):
        write(rows, n)
        write(rows, n)
    return spark.read.parquet(path)


def tables(spark):
    schema = RIDES.schema
    return [RIDES.with_event_time(spark.createDataFrame(
        [[r.get(f) for f in schema.names] for r in rows], schema), False) for rows in BATCHES]


def whole(spark, rides):
    from functools import reduce

    return _with_ids(reduce(lambda a, b: a.unionByName(b), rides))


def _with_ids(df):
    return df.withColumn("event_id", F.xxhash64(*df.columns))


def test_last_n_equals_the_table_form(spark, tmp_path):
    rides = tables(spark)
    got = replayed(spark, tmp_path, rides, lambda p, w: keyed.LastN(
        p, w, "PULocationID", ["event_time", "total_amount"], 4))
    last = got.groupBy("PULocationID").agg(F.max("batch_id").alias("batch_id"))
    got = got.join(last, ["PULocationID", "batch_id"])
    want = state.last_n(whole(spark, rides), ["PULocationID"], ["event_time", "event_id"], 4)
    columns = ["PULocationID", "recency", "event_time", "total_amount"]
    assert rows_of(got, *columns) == rows_of(want, *columns)


def test_changes_equal_the_table_form(spark, tmp_path):
    rides = tables(spark)
    got = replayed(spark, tmp_path, rides, lambda p, w: keyed.Changes(
        p, w, "PULocationID", "total_amount"))
    want = state.change_detection(
        whole(spark, rides), ["PULocationID"], "total_amount", ["event_time", "event_id"])
    columns = ["PULocationID", "event_time", "previous_value", "current_value"]
    assert rows_of(got, *columns) == rows_of(want, *columns) and want.count() > 50


def test_verdicts_equal_the_table_form(spark, tmp_path):
    rides = tables(spark)
    got = replayed(spark, tmp_path, rides, lambda p, w: keyed.Verdicts(p, w, limit=9))
    want = state.rate_verdicts(whole(spark, rides), limit=9)
    want = want.withColumnRenamed("zone_id", "PULocationID")
    columns = ["PULocationID", "event_time", "nth_in_window", "verdict"]
    assert rows_of(got, *columns) == rows_of(want, *columns)
    assert {r["verdict"] for r in got.collect()} == {"allow", "throttle"}


@pytest.mark.parametrize("policy", ["buffer", "drop_if_old", "emit_partial"])
def test_driver_join_equals_the_table_form(spark, tmp_path, policy):
    """Both in the order of their times, as the table form takes them to have arrived."""
    rides = tables(spark)
    updates = [[driver(-5, key=3), driver(100), driver(100, name="Ann B"), driver(250, key=5)],
               [driver(310, name="Ann C"), driver(400, name="Ann D", rating=1.0)],
               [driver(440, key=k, name=f"d{k}") for k in range(6, 10)]]
    frames = [DRIVERS.with_event_time(spark.createDataFrame(
        [[u[f] for f in DRIVERS.schema.names] for u in some], DRIVERS.schema), False)
        for some in updates]
    batches = [keyed.with_drivers(r, u) for r, u in zip(rides, frames, strict=True)]
    got = replayed(spark, tmp_path, batches, lambda p, w: keyed.DriverJoin(p, w, policy, "2 minutes"))
    known = frames[0].unionByName(frames[1]).unionByName(frames[2])
    known = known.withColumnRenamed("event_time", "t").withColumn(
        "update_id", F.xxhash64("driver_id", "name", "rating", F.col("t")))
    want = joins.driver_join(whole(spark, rides), known.withColumnRenamed("t", "updated_at"), policy,
                             "2 minutes")
    columns = ["driver_id", "event_time", "total_amount", "driver_name", "driver_rating"]
    key = lambda rows: sorted(map(str, rows))
    assert key(map(tuple, got.select(*columns).collect())) == key(
        map(tuple, want.select(*columns).collect()))
    assert got.count() > 100


def test_no_python_sees_a_row(spark, tmp_path):
    plans = []

    def write(rows, batch_id):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        rows.write.format("noop").mode("overwrite").save()

    rides = tables(spark)[0]
    updates = DRIVERS.with_event_time(spark.createDataFrame([], DRIVERS.schema), False)
    keyed.DriverJoin(str(tmp_path / "a"), write)(keyed.with_drivers(rides, updates), 0)
    keyed.LastN(str(tmp_path / "b"), write, "PULocationID", ["total_amount"])(rides, 0)
    keyed.Changes(str(tmp_path / "c"), write, "PULocationID", "total_amount")(rides, 0)
    keyed.Verdicts(str(tmp_path / "d"), write)(rides, 0)
    keyed.ExpiringCount(str(tmp_path / "e"), write)(rides, 0)
    assert len(plans) == 5
    assert not [p for p in plans if "Python" in p or "Arrow" in p or "TransformWithState" in p]


def test_ledger_forgets_what_no_batch_reads(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([(k, 0) for k in range(9)], "k INT, v INT")
    ledger = Ledger(path, rows.schema, "k", buckets=3)
    for batch in range(12):
        changed = rows.where(F.col("k") % 4 == batch % 4).select("k", F.lit(batch).alias("v"))
        ledger.add(changed, batch)
        ledger.add(changed, batch)
        # What batch sees is what those before it left, however often it runs.
        want = sorted((k, max(b for b in range(12) if b < batch and b % 4 == k % 4))
                      for k in range(9) if any(b < batch and b % 4 == k % 4 for b in range(12)))
        assert rows_of(ledger.before(spark, batch), "k", "v") == want
    assert len(os.listdir(f"{path}/batch/delta")) <= 7
    assert max(len(os.listdir(f"{path}/batch/base/{b:05d}")) for b in range(3)) <= 2


@pytest.mark.parametrize("policy", ["unheard of"])
def test_unknown_policy(spark, policy):
    from meterline.operators.joins import driver_join

    with pytest.raises(ValueError):
        driver_join(None, None, policy)
    with pytest.raises(ValueError):
        keyed.DriverJoin("path", None, policy)
