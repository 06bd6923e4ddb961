"""Tables over topics (A1-A3, A14) and over folders of files that stand in for topics.

JSON is the wire format. Decoding is a column expression, so only the fields a query uses are
parsed, and no record passes through Python.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.stateless import CORRUPT, decode_json
from meterline.sources.specs import TableSpec

EARLIEST, LATEST = "earliest", "latest"


def kafka_options(
    spec: TableSpec,
    servers: str,
    starting: str = EARLIEST,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``min_partitions`` splits busy topic partitions over more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": spec.topic or spec.name,
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def decode(
    spec: TableSpec, records: DataFrame, position: tuple[str, ...] = (), watermark: bool = True
) -> DataFrame:
    """Typed rows with their event time, from records with a JSON ``value``.

    ``position`` keeps columns such as ``timestamp`` and ``offset``, which order the updates of
    a table that has no time of its own.
    """
    return spec.with_event_time(decode_json(records, spec.schema, keep=position), watermark)


def read_topic(
    spark: SparkSession,
    spec: TableSpec,
    servers: str,
    starting: str = EARLIEST,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    position: tuple[str, ...] = (),
    watermark: bool = True,
) -> DataFrame:
    """A1-A3: an endless table over a topic."""
    options = kafka_options(spec, servers, starting, max_per_trigger, min_partitions)
    records = spark.readStream.format("kafka").options(**options).load()
    return decode(spec, records, position, watermark)


def peek_topic(spark: SparkSession, spec: TableSpec, servers: str, n: int = 10) -> DataFrame:
    """N records of a topic, as a table that ends where the topic ends now."""
    options = kafka_options(spec, servers) | {"endingOffsets": LATEST}
    records = spark.read.format("kafka").options(**options).load().limit(n)
    return decode(spec, records)


def well_formed(rows: DataFrame) -> DataFrame:
    """The rows whose record was a valid one of the declared schema."""
    if CORRUPT not in rows.columns:
        return rows
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(rows: DataFrame) -> DataFrame:
    """The other records, for a dead-letter sink."""
    return rows.where(F.col(CORRUPT).isNotNull())


def offsets(topic: str, by_partition: dict[int, int]) -> str:
    """An explicit position in a topic, for ``starting``."""
    return json.dumps({topic: {str(p): o for p, o in sorted(by_partition.items())}})


def read_files(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    fmt: str = "json",
    files_per_trigger: int = 1,
    position: bool = False,
    watermark: bool = True,
) -> DataFrame:
    """An endless table over a folder of JSON or parquet files of the declared schema.

    A malformed JSON line yields NULLs and is kept in CORRUPT, as records of topics are.
    ``position`` adds the time each row's file was written, as ``timestamp``.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "json":
        rows = reader.format("text").load(path).where(F.trim("value") != "")
    else:
        rows = reader.schema(spec.schema).format(fmt).load(path)
    if position:
        rows = rows.select("*", F.col("_metadata.file_modification_time").alias("timestamp"))
    if fmt == "json":
        # Lines are decoded whole, as records of topics are, so that a bad field is always seen.
        return decode(spec, rows, ("timestamp",) if position else (), watermark)
    return spec.with_event_time(rows, watermark)
