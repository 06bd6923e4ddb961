"""Helpers that feed a stream from one JSON file per micro-batch."""

import json
import os
from contextlib import contextmanager
from datetime import datetime, timezone

BASE = datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


def ms(seconds):
    """Epoch milliseconds at ``seconds`` after noon."""
    return int(BASE.timestamp() * 1000 + round(seconds * 1000))


def at(seconds):
    """The same instant as result tables show it."""
    return datetime.fromtimestamp(ms(seconds) / 1000, timezone.utc).replace(tzinfo=None)


def ride(seconds, zone=1, fare=10.0, driver=1, to=2, distance=1.0):
    return {
        "driver_id": driver,
        "PULocationID": zone,
        "DOLocationID": to,
        "trip_distance": distance,
        "total_amount": fare,
        "tpep_pickup_datetime": ms(seconds),
    }


def write_batches(folder, *batches, first=0):
    """One file per batch, with modification times in order so that batches keep theirs."""
    os.makedirs(folder, exist_ok=True)
    for n, rows in enumerate(batches, start=first):
        path = os.path.join(folder, f"{n:05d}.json")
        with open(path, "w") as out:
            out.write("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def run(writer, checkpoint, timeout=120):
    """Run a stream over all files present, one per micro-batch, to its end."""
    query = (
        writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    )
    try:
        assert query.awaitTermination(timeout), "stream did not end"
    finally:
        query.stop()
    return query


@contextmanager
def as_query(spark, query):
    """Calls inside look like batches of this query, as when it repeats one after a failure."""
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", str(query.id))
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
