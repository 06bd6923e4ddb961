"""Time the streaming forms over the rides of $BENCH_SF_DIR; print one JSON line.

The rides are first written as $BENCH_FILES files in event-time order, then each stream reads one
file per micro-batch until none is left.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import joins, state, stateless, windows
from meterline.session import get_session
from meterline.sources import views
from meterline.streaming import keyed


def split_by_time(df: DataFrame, time_col: str, path: str, files: int) -> None:
    ordered = df.repartitionByRange(files, time_col).sortWithinPartitions(time_col)
    ordered.write.parquet(path)


def open_stream(spark: SparkSession, df: DataFrame, path: str, time_col: str) -> DataFrame:
    reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path).withWatermark(time_col, "5 seconds")


def to_noop(rows: DataFrame, batch_id: int) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    files = int(os.environ.get("BENCH_FILES", "10"))
    spark = get_session(
        "meterline-bench-streams",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = tempfile.mkdtemp(prefix="meterline-streams-")
    sources = {
        "rides": (views.rides(spark, sf_dir), "event_time"),
        "pickups": (views.pickups(spark, sf_dir), "pickup_time"),
        "dropoffs": (views.dropoffs(spark, sf_dir), "dropoff_time"),
        "drivers": (
            views.drivers(spark, sf_dir).withColumn(
                "event_time", F.lit("2024-01-10").cast("timestamp")
            ),
            "event_time",
        ),
    }
    for name, (df, time_col) in sources.items():
        split_by_time(df, time_col, f"{base}/{name}", files)

    def source(name: str) -> DataFrame:
        df, time_col = sources[name]
        return open_stream(spark, df, f"{base}/{name}", time_col)

    zones = views.taxi_zones(spark, sf_dir)
    streams = {
        "filter_high_fare": ("append", lambda: stateless.filter_high_fare(source("rides"))),
        "zone_lookup": ("append", lambda: joins.zone_lookup(source("rides"), zones)),
        "tumbling_revenue": ("update", lambda: windows.tumbling_revenue(source("rides"))),
        "sliding_average": ("append", lambda: windows.sliding_average(
            source("rides"), "1 hour", "10 minutes", panes=True)),
        "session_driver": ("append", lambda: windows.session_driver(source("rides"), "6 hours")),
        "cumulative_counter": ("update", lambda: state.cumulative_counter(source("rides"))),
        "trip_join": ("append", lambda: joins.trip_join(source("pickups"), source("dropoffs"))),
        "nearby_rides": ("append", lambda: joins.nearby_rides(source("rides"), source("rides"))),
        "driver_join": (
            "append",
            lambda: keyed.with_drivers(source("rides"), source("drivers")),
            keyed.DriverJoin(f"{base}/state/driver_join", to_noop, cell="1 hour"),
        ),
        "change_detection": (
            "append",
            lambda: source("rides"),
            keyed.Changes(f"{base}/state/changes", to_noop, "driver_id", "PULocationID", "1 hour"),
        ),
    }
    results = {}
    for name, (mode, make, *batch_writer) in streams.items():
        start = time.perf_counter()
        writer = make().writeStream.outputMode(mode)
        writer = writer.foreachBatch(batch_writer[0]) if batch_writer else writer.format("noop")
        query = (
            writer
            .option("checkpointLocation", f"{base}/checkpoints/{name}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination(600)
        seconds = time.perf_counter() - start
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        query.stop()
        durations = sorted(p["durationMs"]["triggerExecution"] for p in progress)
        rows = sum(p["numInputRows"] for p in progress)
        results[name] = {
            "seconds": round(seconds, 2),
            "rows_per_second": round(rows / seconds),
            "p95_batch_ms": durations[int(0.95 * (len(durations) - 1))],
            "state_rows": sum(s["numRowsTotal"] for s in progress[-1]["stateOperators"]),
        }
    spark.stop()
    print(json.dumps({"metric": "streams", "streams": results, "files": files}))


if __name__ == "__main__":
    main()
