"""Where streams end: topics, keyed tables, the console.

``foreachBatch`` may run a batch again after a failure. Keyed writers and changelogs then give
the same result; a topic without a key gets the batch's records again, as topics do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from meterline.sources import jdbc
from meterline.sources.specs import TableSpec, to_sink_types
from meterline.streaming.carried import folder_names, query_id

BatchWriter = Callable[[DataFrame, int], None]


# --- topics ----------------------------------------------------------------------------------


def append_records(df: DataFrame) -> DataFrame:
    """A5: one JSON value per row."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def upsert_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JSON key and value. On a compacted topic the last value per key remains."""
    return df.select(
        F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def to_topic(df: DataFrame, spec: TableSpec, servers: str, checkpoint: str) -> DataStreamWriter:
    """Append, or with a key declared, upsert."""
    rows = to_sink_types(df)
    records = upsert_records(rows, spec.key) if spec.key else append_records(rows)
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", spec.topic or spec.name)
        .option("checkpointLocation", checkpoint)
        .outputMode("update" if spec.key else "append")
    )


def topic_writer(spec: TableSpec, servers: str) -> BatchWriter:
    """A5, A6 from ``foreachBatch``, for jobs that write to several places.

    Without a key a repeated batch appends its records once more: readers must bear repeats.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = to_sink_types(batch)
        records = upsert_records(rows, spec.key) if spec.key else append_records(rows)
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
            "topic", spec.topic or spec.name
        ).save()

    return write


# --- keyed tables on files -------------------------------------------------------------------


def changelog(
    path: str,
    keys: Sequence[str] = (),
    sequence: Sequence[str] = (),
    files: int | None = None,
) -> BatchWriter:
    """Keep each batch as one partition of a changelog, below its run.

    A repeated batch overwrites its own partition. A stream started anew, on a fresh checkpoint,
    opens a new run, whose rows count as later than those of all runs before. Writing costs the batch only, however large
    the table is; ``current_rows`` gives the table itself. With ``sequence`` a batch is first
    reduced to the last row per key. ``files`` suits aggregates, whose few rows would else be
    spread over as many files as there are state partitions.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = to_sink_types(batch)
        if keys and sequence:
            rows = _last_per_key(rows, keys, sequence)
        if files:
            rows = rows.repartition(files)
        rows.write.mode("overwrite").parquet(_partition(batch, path, batch_id))

    return write


def _partition(batch: DataFrame, path: str, batch_id: int) -> str:
    """A batch's folder. Runs are numbered in the order in which their queries first wrote."""
    spark = batch.sparkSession
    own = query_id(spark)
    runs = [n for n in folder_names(spark, path) if n.startswith("run=")]
    run = next((n for n in runs if n.endswith(f"-{own}")), None)
    if run is None:
        last = int(runs[-1].removeprefix("run=").split("-")[0]) if runs else -1
        run = f"run={last + 1:06d}-{own}"
    return f"{path}/{run}/batch_id={batch_id}"


def read_changelog(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows written, with their ``run`` and ``batch_id``."""
    full = StructType(list(schema.fields)).add("run", "string").add("batch_id", "long")
    return spark.read.schema(full).parquet(path)


def current_rows(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]
) -> DataFrame:
    """The keyed table a changelog amounts to, one row per key."""
    return _last_row(read_changelog(spark, path, schema), schema, keys)


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    through: int,
    into: str,
) -> None:
    """Start a new changelog from the table as of batch ``through`` of the latest run.

    The old one is only read. Restart the stream on the new path, where it opens a later run.
    """
    latest = folder_names(spark, path)[-1].removeprefix("run=")
    until = (F.col("run") < latest) | (F.col("batch_id") <= through)
    log = read_changelog(spark, path, schema).where(until)
    _last_row(log, schema, keys).write.mode("overwrite").parquet(
        f"{into}/run=000000-compacted/batch_id={through}"
    )


def batch_counts(path: str, by: Sequence[str]) -> BatchWriter:
    """Keep only how many rows each batch had per value of ``by``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*by).agg(F.count("*").alias("rows"))
        counts.write.mode("overwrite").parquet(_partition(batch, path, batch_id))

    return write


def total_counts(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The sums over all batches; ``by`` declares the counted columns."""
    schema = StructType.fromDDL(by)
    log = spark.read.schema(StructType(schema.fields).add("rows", "long")).parquet(path)
    return log.groupBy(*schema.names).agg(F.sum("rows").alias("rows"))


def _last_row(log: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    # Should one batch hold a key twice, the choice between the two is at least a fixed one.
    rest = [name for name in schema.names if name not in keys]
    return _last_per_key(log, keys, ["run", "batch_id", *rest]).select(*schema.names)


def _last_per_key(rows: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    last = F.max_by(F.struct(*rows.columns), F.struct(*sequence))
    return rows.groupBy(*keys).agg(last.alias("last")).select("last.*")


def create_if_missing(spark: SparkSession, spec: TableSpec, path: str) -> None:
    """A10: an empty changelog, so that the table can be read before its first batch."""
    empty = spark.createDataFrame([], spec.schema)
    try:
        spark.read.schema(spec.schema).parquet(path).schema
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        empty.write.mode("ignore").parquet(f"{path}/run=000000-created/batch_id=-1")


# --- several results of one stream -----------------------------------------------------------


def fan_out(*branches: tuple[Callable[[DataFrame], DataFrame], BatchWriter]) -> BatchWriter:
    """A11 for branches without state of their own: one scan, one state, several results.

    The batch is held while it is written, for each write would else compute it again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for operator, sink in branches:
                sink(operator(batch), batch_id)
        finally:
            batch.unpersist()

    return write


def ignore(batch: DataFrame, batch_id: int) -> None:
    """A branch nobody asked for."""


# --- keyed tables in a database --------------------------------------------------------------


def jdbc_upsert(
    spec: TableSpec,
    url: str,
    connections: int = 16,
    sequence: Sequence[str] = (),
    **properties: str,
) -> BatchWriter:
    """Stage the batch from the executors, then move it over in one statement.

    The table is created before the first batch if it is missing. The statement is keyed, so a
    repeated batch changes nothing; it may not touch a row twice, so the stage holds one row per
    key: the last by ``sequence``, columns of the batch, which values that may fall again need.
    Each query has a stage of its own. ``connections`` limits how many executors write at once.
    """
    rest = [name for name in spec.schema.names if name not in spec.key]
    ready: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ready:
            jdbc.execute(batch.sparkSession, url, jdbc.create_table(spec), **properties)
            ready.append(spec.name)
        stage = stage_name(spec, batch.sparkSession)
        rows = _last_per_key(to_sink_types(batch), spec.key, sequence or rest or spec.key)
        rows = rows.select(*spec.schema.names)
        options = {"truncate": "true", "numPartitions": str(connections)}
        rows.write.options(**options).jdbc(url, stage, "overwrite", properties)
        jdbc.execute(batch.sparkSession, url, jdbc.upsert_from(spec, stage), **properties)

    return write


def stage_name(spec: TableSpec, spark: SparkSession) -> str:
    return f"{spec.name}_stage_{query_id(spark).replace('-', '')[:12]}"


# --- looking at results ----------------------------------------------------------------------


def to_console(df: DataFrame, mode: str = "append") -> DataStreamWriter:
    """Print rows."""
    return df.writeStream.format("console").option("truncate", False).outputMode(mode)


def to_memory(df: DataFrame, name: str, mode: str = "append") -> DataStreamWriter:
    """A8 for tests: rows of a small stream as a temporary table."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode)


def list_tables(spark: SparkSession) -> list[str]:
    """Names of the tables and views in the session's catalog."""
    return sorted(table.name for table in spark.catalog.listTables())
