"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.plans.shared import shared_dir

# A word is a run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder, which survives lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder, as a URI, where driver and executors can all read and write."""
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def give_back() -> None:
    """Return what Arrow keeps for later, at a task's end: a worker that idles needs none."""
    pa.default_memory_pool().release_unused()


def slices(column: pa.Array, chars: int = 1_000_000) -> Iterator[tuple[int, list]]:
    """Cut a column of texts into runs of about ``chars`` bytes: (first row, values)."""
    start, size = 0, 0
    values: list = []
    for i, scalar in enumerate(column):
        value = scalar.as_py()
        values.append(value)
        size += len(value) if value else 1
        if size >= chars:
            yield start, values
            start, size, values = i + 1, 0, []
    if values:
        yield start, values
