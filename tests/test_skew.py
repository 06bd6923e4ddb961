"""The plans for large or hot inputs give what the plans for small ones give."""

import os
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterline.operators import joins, late, state, windows
from meterline.plans import sizing
from meterline.plans.ordered import Running, running
from meterline.plans.shared import drop_materialized, materialize, shared_dir
from tests.streams import rows_of

ONE_CELL, MANY_CELLS = "36500 days", "7 seconds"


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rides; zone 1 holds two thirds of them, some zones and fares are NULL."""
    return spark.range(0, 3000, 1, 8).selectExpr(
        "id AS event_id",
        "cast(if(id % 3 < 2, 1, if(id % 50 = 2, NULL, id % 7)) as int) AS PULocationID",
        "cast(id % 5 as int) AS driver_id",
        "if(id % 11 = 0, NULL, cast(id % 97 as double)) AS total_amount",
        "timestamp_millis(1704110400000 + (id * 7919 % 3001) * 1000) AS event_time",
    ).cache()


def both(make):
    small, split = make(ONE_CELL), make(MANY_CELLS)
    assert split.columns == small.columns
    as_set = lambda df: sorted(map(str, df.collect()))
    assert as_set(split) == as_set(small)
    return split


def test_running_average(spark, hot):
    both(
        lambda n: state.running_average(hot, n).withColumn("running_avg", F.round("running_avg", 9))
    )


def test_change_detection(spark, hot):
    both(lambda n: state.change_detection(hot, ["PULocationID"], "total_amount",
                                          ["event_time", "event_id"], n))


def test_rate_verdicts(spark, hot):
    both(lambda n: state.rate_verdicts(hot, "10 minutes", 5, n))


def test_watermark_over_the_whole_table(spark, hot):
    arrived = hot.withColumn("arrival_time", F.col("event_id"))
    both(lambda n: late.with_watermark(arrived, ["arrival_time"], cell=n))


def test_running_kinds(spark, hot):
    value = F.col("total_amount")
    columns = [
        Running("n", "count"), Running("n_before", "count", before=True),
        Running("s", "sum", value), Running("s_before", "sum", value, before=True),
        Running("m", "max", value), Running("l", "last", value),
        Running("l_before", "last", value, before=True),
    ]
    split = both(
        lambda n: running(hot, ["PULocationID"], ["event_time", "event_id"], columns, n)
    )
    rows = Window.partitionBy("PULocationID").orderBy("event_time", "event_id")
    until, before = (rows.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    plain = hot.select(
        "*",
        F.count("*").over(until).alias("n"), F.count("*").over(before).alias("n_before"),
        F.sum(value).over(until).alias("s"), F.sum(value).over(before).alias("s_before"),
        F.max(value).over(until).alias("m"),
        F.last(value, ignorenulls=True).over(until).alias("l"),
        F.last(value, ignorenulls=True).over(before).alias("l_before"),
    )
    assert rows_of(split) == rows_of(plain)


def test_rows_without_a_time_come_first(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL, 5), (2, timestamp'2024-01-01', 7), "
                   "(3, timestamp'1969-12-31', 1) AS t(id, at, v)")
    found = running(df, [], ["at", "id"], [Running("s", "sum", F.col("v"))], "1 second")
    assert {r["id"]: r["s"] for r in found.collect()} == {1: 5, 3: 6, 2: 13}


def test_unknown_kind():
    with pytest.raises(ValueError):
        Running("x", "median")


def test_hot_key_is_spread_over_tasks(spark, hot):
    before = {k: spark.conf.get(k, None) for k in
              ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        made = state.running_average(hot).withColumn("_task", F.spark_partition_id())
        sizes = Counter(r["_task"] for r in made.collect()).values()
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting) if setting else spark.conf.unset(name)
    # Zone 1 has two thirds of the rows; no task has a third.
    assert max(sizes) < 1000 and len(sizes) > 12


def test_building_starts_no_job_and_writes_nothing(spark, hot):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "", False)
    arrived = hot.withColumn("arrival_time", F.col("event_id"))
    try:
        state.running_average(hot)
        state.rate_verdicts(hot)
        state.change_detection(hot, ["PULocationID"], "total_amount", ["event_time", "event_id"])
        late.with_watermark(arrived, ["arrival_time"])
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("backfill", [False, True])
def test_asof_plans_agree(spark, hot, backfill):
    versions = spark.range(40).selectExpr(
        "cast(id % 6 as int) AS PULocationID",
        "timestamp_millis(1704110400000 + (id * 577 % 2500) * 1000) AS since",
        "id AS seq", "concat('v', id) AS name", "if(id % 4 = 0, NULL, id) AS extra",
    ).unionByName(spark.sql(
        # Two versions from one instant: the later sequence counts.
        "SELECT 1 AS PULocationID, timestamp'2024-01-01 12:20:00' AS since, s AS seq, "
        "concat('tie', s) AS name, s AS extra FROM VALUES (100L), (101L) AS t(s)"))

    def make(limit):
        joined = joins.asof_join(
            hot, versions, "PULocationID", "event_time", "since", "seq", ["name", "extra"],
            "event_id", backfill, cell=limit,
        )
        return joined.select("event_id", "PULocationID", "name", "extra")

    split = both(make)
    assert split.where("name = 'tie101'").count() > 0
    assert split.where("name = 'tie100'").count() == 0
    assert split.count() == 3000
    unanswered = split.where("PULocationID = 1 AND name IS NULL").count()
    assert (unanswered == 0) == backfill


def test_lookup_without_broadcast(spark, hot, monkeypatch):
    rides = hot.withColumn("DOLocationID", F.col("driver_id"))
    zones = spark.range(4).selectExpr("cast(id as int) AS zone_id", "concat('z', id) AS zone_name")
    small = joins.zone_lookup(rides, zones)
    monkeypatch.setattr(joins, "broadcast_when_small", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.zone_lookup(rides, zones)
        assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_check_refuses_a_large_side(spark):
    side = spark.range(100).selectExpr("id", "repeat('x', 100) AS text")
    hinted = sizing.broadcast_when_small(side, limit=100 * 200)
    plain = sizing.broadcast_when_small(side, limit=100 * 100)
    joined = lambda df: df.join(spark.range(5).toDF("k"), F.col("id") == F.col("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda df: joined(df)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(hinted)
        assert "BroadcastHashJoin" not in plan(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sessions_equal_built_in(spark, hot):
    gap = "3 seconds"
    session = F.session_window("event_time", gap).alias("s")
    built_in = hot.groupBy("driver_id", session).agg(
        F.count("*").alias("trip_count"), F.sum("total_amount").alias("total_revenue")
    ).select("driver_id", "s.start", "s.end", "trip_count", "total_revenue")
    assert rows_of(windows.session_driver(hot, gap)) == rows_of(built_in)


@pytest.mark.parametrize("size, slide", [("60 seconds", "20 seconds"), ("5 minutes", "10 seconds")])
def test_panes_equal_direct_windows(spark, hot, size, slide):
    direct = windows.sliding_average(hot, size, slide, panes=False)
    panes = windows.sliding_average(hot, size, slide, panes=True)
    exact = lambda df: rows_of(df.withColumn("avg_fare", F.round("avg_fare", 9)).fillna(-1.0))
    assert exact(panes) == exact(direct)


def test_panes_need_a_dividing_slide(spark, hot):
    assert windows.sliding_average(hot, "50 seconds", "20 seconds").count() > 0
    with pytest.raises(ValueError):
        windows.sliding_average(hot, "50 seconds", "20 seconds", panes=True)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffled_joins(spark, monkeypatch):
    """Joins at a scale where nothing is broadcast, with thresholds for small data."""
    monkeypatch.setattr(joins, "broadcast_when_small", lambda df: df)
    before = {name: spark.conf.get(name, None) for name in SKEW}
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_hot_zone_is_split_in_a_shuffled_lookup(spark, hot, shuffled_joins):
    rides = hot.withColumn("DOLocationID", F.col("driver_id"))
    zones = spark.range(40).selectExpr("cast(id as int) AS zone_id", "concat('z', id) AS zone_name")
    joined = joins.broadcast_enrich(rides, zones)
    assert len(joined.collect()) == 3000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_bucket_is_split_in_nearby_rides(spark, hot, shuffled_joins):
    burst = hot.withColumn("event_time", F.expr(
        "if(event_id % 3 < 2, timestamp_millis(1704110400000 + event_id * 20), event_time)"))
    joined = joins.nearby_rides(burst)
    rows = joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    # Zone 1 has 2000 rides within a minute, all of them pairs of each other.
    assert sum(r.zone_id == 1 and r.ride2_fare is not None for r in rows) > 1_000_000


def test_intermediate_tables_can_be_dropped(spark, hot):
    assert materialize(hot, "rides").count() == 3000
    drop_materialized(spark)
    folder = f"{shared_dir(spark)}/meterline/{spark.sparkContext.applicationId}"
    assert not os.path.exists(folder)


def test_shared_folder_is_the_cluster_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
