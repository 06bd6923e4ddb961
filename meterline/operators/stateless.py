"""Filters, maps and flat-maps: one record at a time, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.functions.scalars import ratio

USD_TO_EUR = 0.92  # fixed value
CORRUPT = "_corrupt_record"


def filter_high_fare(rides: DataFrame, above: float = 20.0) -> DataFrame:
    """B1: strictly above the fare; a NULL fare is dropped."""
    return rides.where(F.col("total_amount") > above).select(
        "PULocationID", "DOLocationID", "trip_distance", "total_amount"
    )


def filter_premium(rides: DataFrame, above: float = 50.0, farther: float = 5.0) -> DataFrame:
    """B2: expensive and long."""
    return rides.where(
        (F.col("total_amount") > above) & (F.col("trip_distance") > farther)
    ).select("PULocationID", "DOLocationID", "trip_distance", "total_amount")


def map_to_eur(rides: DataFrame, rate: float = USD_TO_EUR) -> DataFrame:
    """Clean names and the fare in another currency."""
    return rides.select(
        F.col("PULocationID").alias("pickup_zone"),
        F.col("DOLocationID").alias("dropoff_zone"),
        F.col("trip_distance").alias("distance_miles"),
        (F.col("total_amount") * rate).alias("fare_eur"),
    )


def price_per_mile(rides: DataFrame, rate: float = USD_TO_EUR) -> DataFrame:
    """B3 plus the fare per mile, NULL for a distance of zero."""
    return map_to_eur(rides, rate).withColumn(
        "price_per_mile", ratio("fare_eur", "distance_miles")
    )


def zone_events(rides: DataFrame) -> DataFrame:
    """A pickup and a dropoff event per ride, in one scan."""
    return _exploded(rides, [("pickup", "PULocationID"), ("dropoff", "DOLocationID")])


def zone_events_with_completion(rides: DataFrame) -> DataFrame:
    """B5 plus a ``ride_complete`` event at the dropoff zone, the only one with an amount."""
    return _exploded(
        rides,
        [("pickup", "PULocationID"), ("dropoff", "DOLocationID")],
        [("ride_complete", "DOLocationID", F.col("total_amount"))],
    )


def _exploded(
    rides: DataFrame,
    plain: list[tuple[str, str]],
    with_amount: list[tuple[str, str, Column]] | None = None,
) -> DataFrame:
    def event(kind: str, zone: str, *amount: Column) -> Column:
        fields = [
            F.lit(kind).alias("event_type"),
            F.col(zone).alias("zone_id"),
            F.col("tpep_pickup_datetime").alias("event_timestamp"),
        ]
        return F.struct(*fields, *(a.cast("double").alias("total_amount") for a in amount))

    no_amount = [F.lit(None)] if with_amount else []
    events = [event(kind, zone, *no_amount) for kind, zone in plain]
    events += [event(*spec) for spec in with_amount or []]
    return rides.select(F.inline(F.array(*events)))


def with_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    """A constant column."""
    return df.withColumn(name, F.lit(value))


def pass_through(df: DataFrame, **fields: Column) -> DataFrame:
    """The whole row plus new fields; a new field wins over an old one of its name."""
    return df.withColumns(fields)


def encode_json(df: DataFrame, name: str = "value") -> DataFrame:
    """The row as one JSON string."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def decode_json(
    df: DataFrame, schema: StructType, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows from JSON strings, next to the columns to ``keep``.

    A malformed record yields NULLs and is kept in CORRUPT.
    """
    full = StructType(list(schema.fields)).add(CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json(F.col(value).cast("string"), full, options).alias("record")
    return df.select(*keep, record).select("record.*", *keep)


def default_key(df: DataFrame, column: str = "driver_id", default: int = 0) -> DataFrame:
    """Rows without the key share a default one."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, matched by column name."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def union_distinct(*parts: DataFrame) -> DataFrame:
    """The distinct rows of all parts. Duplicates are dropped before and after the shuffle."""
    return union_all(*parts).distinct()
