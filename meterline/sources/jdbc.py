"""A dimension table in a database (A4), and the statements its sinks need."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from meterline.sources.specs import TableSpec

# Database type names.
_TYPES: dict[type[DataType], str] = {
    IntegerType: "INTEGER",
    LongType: "BIGINT",
    DoubleType: "DOUBLE PRECISION",
    StringType: "TEXT",
    TimestampType: "TIMESTAMP(3)",
    TimestampNTZType: "TIMESTAMP(3)",
}


@dataclass
class JdbcDimension:
    """A dimension read again once it is older than ``ttl_seconds``.

    Use ``current()`` inside ``foreachBatch``. Each refresh is a new scan; rows are not held on
    the driver, and whether the table is broadcast is decided by its measured size.
    """

    spark: SparkSession
    spec: TableSpec
    options: dict[str, str]
    ttl_seconds: float = 3600.0
    clock: Callable[[], float] = time.monotonic
    load: Callable[[], DataFrame] | None = None
    _read_at: float | None = field(default=None, init=False)
    _table: DataFrame | None = field(default=None, init=False)

    def current(self) -> DataFrame:
        now = self.clock()
        if self._read_at is None or now - self._read_at >= self.ttl_seconds:
            if self._table is not None:
                self._table.unpersist()
            self._table = (self.load or self._scan)().persist()
            self._read_at = now
        return self._table

    def _scan(self) -> DataFrame:
        options = {"dbtable": self.spec.name} | self.options
        return self.spark.read.format("jdbc").options(**options).load()


def create_table(spec: TableSpec, if_missing: bool = True) -> str:
    """A10: the table's definition, its key included."""
    columns = [f'"{f.name}" {_TYPES[type(f.dataType)]}' for f in spec.schema.fields]
    if spec.key:
        columns.append(f"PRIMARY KEY ({_quoted(spec.key)})")
    guard = "IF NOT EXISTS " if if_missing else ""
    return f'CREATE TABLE {guard}"{spec.name}" ({", ".join(columns)})'


def upsert_from(spec: TableSpec, stage: str) -> str:
    """One statement that moves staged rows into the keyed table."""
    names = spec.schema.names
    rest = [n for n in names if n not in spec.key]
    changes = ", ".join(f'"{n}" = EXCLUDED."{n}"' for n in rest)
    action = f"DO UPDATE SET {changes}" if rest else "DO NOTHING"
    return (
        f'INSERT INTO "{spec.name}" ({_quoted(names)}) SELECT {_quoted(names)} FROM "{stage}" '
        f"ON CONFLICT ({_quoted(spec.key)}) {action}"
    )


def insert_absent_from(spec: TableSpec, stage: str) -> str:
    """One statement that adds the staged rows whose key is new."""
    names = _quoted(spec.schema.names)
    return (
        f'INSERT INTO "{spec.name}" ({names}) SELECT {names} FROM "{stage}" '
        f"ON CONFLICT ({_quoted(spec.key)}) DO NOTHING"
    )


def execute(spark: SparkSession, url: str, statement: str, **properties: str) -> None:
    """Run one statement from the driver; rows stay between the executors and the database."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        command = connection.createStatement()
        command.execute(statement)
        command.close()
    finally:
        connection.close()


def _quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)
