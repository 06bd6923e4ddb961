"""The ride entities as views over the given parquet tables.

Every view covers its whole base table. Rides come from ``events``, zones from ``nation`` and
``region``, drivers from ``customer``, driver updates from ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# The columns of the given tables. Declaring them saves the job that would read
# file footers to find them out.
COLUMNS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_MINUTES = "make_dt_interval(0, 0, cast({} as int), 0)"


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones 25-28 have no row in ``taxi_zones``."""
    return ride_columns(table(spark, sf_dir, "events"))


def ride_columns(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "cast(user_id as int) AS driver_id",
        "cast((event_id * 7 + user_id) % 29 as int) AS PULocationID",
        "cast((event_id * 11 + user_id * 3) % 29 as int) AS DOLocationID",
        "round(0.5D + (event_id % 245) / 10D, 2) AS trip_distance",
        "value AS total_amount",
        "unix_millis(cast(ts as timestamp)) AS tpep_pickup_datetime",
        "timestamp_millis(unix_millis(cast(ts as timestamp))) AS event_time",
        "event_type",
    )


def taxi_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS zone_id", "r_name AS borough", "n_name AS zone_name"
    )


def zone_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of each zone, two weeks apart, the first from 2 January on."""
    return (
        taxi_zones(spark, sf_dir)
        .selectExpr("zone_id", "zone_name", "explode(sequence(0, 2)) AS version")
        .selectExpr(
            "zone_id",
            "concat(zone_name, ' v', version) AS zone_name",
            "version",
            "timestamp'2024-01-02 00:00:00' "
            "+ make_dt_interval(version * 14, zone_id, 0, 0) AS valid_from",
        )
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers. Those of one market segment have ids that no ride names, so the rides of
    these customers have an unknown driver."""
    unknown = "if(c_mktsegment = 'MACHINERY', -c_custkey, c_custkey)"
    return driver_columns(table(spark, sf_dir, "customer"), unknown)


def driver_columns(customer: DataFrame, key: str = "c_custkey") -> DataFrame:
    return customer.selectExpr(
        f"cast({key} as int) AS driver_id",
        "c_name AS name",
        "round(4.5D + (c_custkey % 50) / 100D, 2) AS rating",
    )


def driver_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per order, spread over the 30 days the rides cover."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey as int) AS driver_id",
        "concat('Driver ', o_custkey, ' ', o_orderstatus) AS name",
        "round(4.5D + (o_orderkey % 50) / 100D, 2) AS rating",
        "timestamp'2024-01-01 00:00:00' + "
        + _MINUTES.format("o_orderkey * 37 % 43200")
        + " AS updated_at",
        "o_orderkey AS update_id",
    )


def pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides(spark, sf_dir).selectExpr(
        "cast(event_id as string) AS trip_id",
        "PULocationID AS pickup_zone",
        "event_time AS pickup_time",
    )


def dropoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0-149 minutes after the pickup. Those of rides that ended in an error name another trip,
    which no pickup has."""
    return rides(spark, sf_dir).selectExpr(
        "concat(if(event_type = 'error', 'lost ', ''), event_id) AS trip_id",
        "DOLocationID AS dropoff_zone",
        "event_time + " + _MINUTES.format("event_id % 150") + " AS dropoff_time",
        "total_amount AS fare",
    )


def late_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides with an arrival time: three in ten arrive 5-30 minutes after they happened."""
    late_by = "CASE WHEN event_id % 10 < 3 THEN 5 + event_id % 26 ELSE 0 END"
    return rides(spark, sf_dir).selectExpr(
        "*", "event_time + " + _MINUTES.format(late_by) + " AS arrival_time"
    )
