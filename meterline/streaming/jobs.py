"""Several outputs started and awaited as one job (A11), each with its own checkpoint."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from meterline.plans import dashboard
from meterline.streaming.sinks import BatchWriter

INTERVAL = "10 seconds"  # fixed value


@dataclass(frozen=True)
class Output:
    name: str
    rows: DataFrame
    write: BatchWriter
    mode: str = "append"


def start(output: Output, checkpoints: str, once: bool = False) -> StreamingQuery:
    """Start one output. Starting it again on the same checkpoint continues it.

    ``once`` processes what is there, file by file, and stops.
    """
    trigger = {"availableNow": True} if once else {"processingTime": INTERVAL}
    return (
        output.rows.writeStream.queryName(output.name)
        .outputMode(output.mode)
        .option("checkpointLocation", f"{checkpoints}/{output.name}")
        .trigger(**trigger)
        .foreachBatch(output.write)
        .start()
    )


def start_all(
    outputs: list[Output], checkpoints: str, once: bool = False
) -> list[StreamingQuery]:
    return [start(output, checkpoints, once) for output in outputs]


def await_all(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until all have ended; stop them all if one fails or time (in seconds) runs out."""
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        for query in queries:
            if deadline is None:
                query.awaitTermination()
            elif not query.awaitTermination(max(deadline - time.monotonic(), 0.001)):
                raise TimeoutError(f"{query.name} still running after {timeout} s")
    finally:
        for query in queries:
            query.stop()


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows a query's stateful steps have dropped for being late.

    Spark counts them after partial aggregation, so this may be less than the events dropped.
    """
    return sum(
        step["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for step in progress["stateOperators"]
    )


def dashboard_outputs(
    rides: Callable[[], DataFrame], writer: Callable[[str], BatchWriter]
) -> list[Output]:
    """L1-L4 as one job. ``rides`` opens the source, once per output; ``writer`` gives a sink.

    A streaming aggregate keeps its state with its own query, so the outputs share no scan.
    """
    names = list(dashboard.from_rides(rides()))
    return [
        Output(name, dashboard.from_rides(rides())[name], writer(name), "update")
        for name in names
    ]
