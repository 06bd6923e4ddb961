"""Per-key patterns on streams (C5, C6, F5, F8, F9, F10), as ``foreachBatch`` functions.

Each joins a micro-batch with what earlier batches left for its keys, by the plans of the table
forms: no Python sees a row, no task holds all rows of a key, and adaptive execution splits what a
busy key makes large. Inside a batch rows count in event-time order, those without a time first,
and at one instant by a hash of all their values, so that a repeated batch gives what it gave.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.functions.durations import interval, to_micros
from meterline.operators import joins, state
from meterline.plans.ordered import Running, running
from meterline.plans.sizing import broadcast_when_small
from meterline.streaming.carried import Carried
from meterline.streaming.ledger import Ledger
from meterline.streaming.sinks import BatchWriter

EMIT_PARTIAL, BUFFER, DROP_IF_OLD = "emit_partial", "buffer", "drop_if_old"
# A batch's rows of one key in one of these share a task.
CELL = "1 minute"
_BEGINNING, _TIMELESS = "0001-01-01 00:00:00", "0001-01-01 12:00:00"


def _instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _placed(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """``df`` with ``_at``, its time, and ``_id``, which tells rows of one instant apart."""
    at = F.coalesce(F.col(time_col).cast("timestamp"), _instant(_TIMELESS))
    return df.withColumns({"_at": at, "_id": F.xxhash64(*df.columns)})


def _of_keys(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """What ``table`` has of the keys of ``rows``; a NULL key is a key."""
    keys = broadcast_when_small(rows.select(F.col(key).alias("_wanted")).distinct())
    return table.join(keys, F.col(key).eqNullSafe(F.col("_wanted")), "left_semi")


# --- rides and drivers -----------------------------------------------------------------------


def with_drivers(rides: DataFrame, drivers: DataFrame, driver_time: str = "event_time") -> DataFrame:
    """Rides and driver updates as one stream, for ``DriverJoin``.

    A ride without driver_id has key 0.
    """
    keyed = rides.withColumn("driver_id", F.coalesce("driver_id", F.lit(0)))
    ride = keyed.select(F.struct(*keyed.columns).alias("ride"))
    update = drivers.select(
        F.struct("driver_id", "name", "rating", F.col(driver_time).alias("time")).alias("update")
    )
    return ride.unionByName(update, allowMissingColumns=True)


class DriverJoin:
    """C5, C6 over ``with_drivers``: rides with ``driver_name`` and ``driver_rating``.

    A ride gets its driver's latest update at its time; one that is known when the ride arrives
    counts as older than any ride. While there is none, ``buffer`` lets the ride wait for the first
    one, ``drop_if_old`` for at most ``max_wait`` of event time, and ``emit_partial`` passes it on
    without driver fields. Drivers and waiting rides are kept in ledgers; a ride waits no longer
    than its driver is unknown, so what has been answered is left out when a bucket is rewritten.
    """

    def __init__(
        self,
        path: str,
        write: BatchWriter,
        policy: str = BUFFER,
        max_wait: str = "1 hour",
        cell: str = CELL,
    ):
        if policy not in (BUFFER, DROP_IF_OLD, EMIT_PARTIAL):
            raise ValueError(f"unknown policy: {policy!r}")
        self.path = path
        self.write = write
        self.policy = policy
        self.max_wait = max_wait
        self.cell = cell

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            rides = batch.where("ride IS NOT NULL").select("ride.*")
            updates = _placed(batch.where("update IS NOT NULL").select("update.*"), "time")
            drivers = Ledger(f"{self.path}/drivers", _fields(updates, "driver_id", "name", "rating"),
                             "driver_id")
            waiting = Ledger(f"{self.path}/waiting", rides.schema, "driver_id", lambda rows: rows)
            known = drivers.before(spark, batch_id)
            asking = rides.withColumn("_new", F.lit(True))
            if self.policy != EMIT_PARTIAL:
                woken = _of_keys(waiting.before(spark, batch_id), updates, "driver_id")
                woken = self._unanswered(woken, known).select(*rides.columns)
                asking = asking.unionByName(woken.withColumn("_new", F.lit(False)))
            joined = self._joined(asking, known, updates).persist()
            try:
                found = joined.where(self._answered())
                self.write(found.select(*rides.columns, "driver_name", "driver_rating"), batch_id)
                if self.policy != EMIT_PARTIAL:
                    left = joined.where("_new AND _found IS NULL").select(*rides.columns)
                    waiting.add(left, batch_id, lambda rows: self._still_waiting(rows, known))
            finally:
                joined.unpersist()
            last = F.max_by(F.struct("name", "rating"), F.struct("_at", "_id")).alias("last")
            drivers.add(
                updates.groupBy("driver_id").agg(last).select("driver_id", "last.*"), batch_id
            )
        finally:
            batch.unpersist()

    def _joined(self, asking: DataFrame, known: DataFrame, updates: DataFrame) -> DataFrame:
        """Each ride with the version in force, whether there is one, and since when."""
        before = _of_keys(known, asking, "driver_id").select(
            "driver_id", "name", "rating", _instant(_BEGINNING).alias("_at"),
            F.lit(0).cast("long").alias("_id"), F.lit(None).cast("timestamp").alias("_since"),
        )
        versions = before.unionByName(
            updates.withColumn("_since", F.col("_at")).select(*before.columns)
        )
        versions = versions.withColumnsRenamed({"name": "driver_name", "rating": "driver_rating"})
        return joins.asof_join(
            _placed(asking),
            versions.withColumnsRenamed({"_at": "_from", "_id": "_seq"}).withColumn(
                "_found", F.lit(True)
            ),
            key="driver_id",
            time="_at",
            valid_from="_from",
            sequence="_seq",
            columns=["driver_name", "driver_rating", "_since", "_found"],
            row_id="_id",
            backfill=self.policy != EMIT_PARTIAL,
            cell=self.cell,
        )

    def _answered(self) -> Column:
        if self.policy == EMIT_PARTIAL:
            return F.lit(True)
        in_time = F.lit(True)
        if self.policy == DROP_IF_OLD:
            limit = F.coalesce("event_time", _instant(_BEGINNING)) + interval(self.max_wait)
            in_time = F.col("_since").isNull() | (F.col("_since") <= limit)
        return F.col("_found").isNotNull() & in_time

    @staticmethod
    def _unanswered(waiting: DataFrame, known: DataFrame) -> DataFrame:
        return waiting.join(known.select("driver_id"), "driver_id", "left_anti")

    def _still_waiting(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """A bucket's rides that may yet get a driver."""
        left = self._unanswered(rows, known)
        if self.policy == DROP_IF_OLD:
            # Updates come in the order of their times, give or take a wait.
            latest = left.agg(F.max("event_time")).first()[0]
            if latest is not None:
                old = F.col("event_time") + interval(self.max_wait) + interval(self.max_wait)
                left = left.where(~F.coalesce(old < F.lit(latest), F.lit(False)))
        return left


def _fields(df: DataFrame, *names: str) -> StructType:
    return StructType([df.schema[n] for n in names])


# --- patterns over one stream ----------------------------------------------------------------


class LastN:
    """the latest n items of each key of a batch, most recent first, for an upsert sink.

    A batch sends n rows per key and task at most, and keeps n per key.
    """

    def __init__(self, path: str, write: BatchWriter, key: str, columns: list[str], n: int = 5):
        self.path, self.write, self.key, self.columns, self.n = path, write, key, columns, n

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = _placed(batch).select(self.key, *self.columns, "_at", "_id")
        order = ["_at", "_id"]
        newest = state.last_n(rows, [self.key], order, self.n).persist()
        try:
            item = F.struct(*(c for c in newest.columns if c not in (self.key, "recency")))
            lists = newest.groupBy(self.key).agg(F.collect_list(item).alias("items"))
            ledger = Ledger(self.path, lists.schema, self.key)
            held = _of_keys(ledger.before(batch.sparkSession, batch_id), newest, self.key)
            held = held.select(self.key, F.explode("items").alias("item")).select(self.key, "item.*")
            both = held.unionByName(newest.drop("recency"))
            found = state.last_n(both, [self.key], order, self.n).persist()
            try:
                self.write(found.select(self.key, "recency", *self.columns), batch_id)
                lists = found.groupBy(self.key).agg(F.collect_list(item).alias("items"))
                ledger.add(lists, batch_id)
            finally:
                found.unpersist()
        finally:
            newest.unpersist()


class Changes:
    """F8: the rows of a batch whose value differs from their key's previous one."""

    def __init__(self, path: str, write: BatchWriter, key: str, value: str, cell: str = CELL):
        self.path, self.write, self.key, self.value, self.cell = path, write, key, value, cell

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = _placed(batch).select(self.key, F.col(self.value).alias("value"), "_at", "_id")
        rows.persist()
        try:
            ledger = Ledger(self.path, _fields(rows, self.key, "value"), self.key)
            before = _of_keys(ledger.before(batch.sparkSession, batch_id), rows, self.key).select(
                self.key, "value", _instant(_BEGINNING).alias("_at"),
                F.lit(0).cast("long").alias("_id"),
            )
            found = state.change_detection(
                before.unionByName(rows), [self.key], "value", ["_at", "_id"], self.cell
            )
            timed = F.when(F.col("_at") != _instant(_TIMELESS), F.col("_at")).alias("event_time")
            self.write(
                found.select(self.key, timed, "previous_value", "current_value"), batch_id
            )
            # A struct is never NULL, so a last value of NULL is one too.
            last = F.max_by(F.struct("value"), F.struct("_at", "_id"))["value"].alias("value")
            ledger.add(rows.groupBy(self.key).agg(last), batch_id)
        finally:
            rows.unpersist()


class Verdicts:
    """allow or throttle each ride by the count of its key and window so far.

    Rides without a time have no window. Counts are carried until the latest ride seen has passed
    the window's end by ``delay``; rides of such a window are too late for a verdict.
    """

    def __init__(
        self,
        path: str,
        write: BatchWriter,
        key: str = "PULocationID",
        size: str = "1 minute",
        limit: int = 20,
        delay: str = "5 seconds",
        cell: str = CELL,
    ):
        self.path, self.write, self.key, self.limit, self.cell = path, write, key, limit, cell
        self.size, self.keep = size, to_micros(size) + to_micros(delay)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = F.window("event_time", self.size)["start"].alias("window_start")
        rows = _placed(batch).select(self.key, "event_time", "_id", start)
        schema = _fields(rows, self.key, "window_start").add("n", "long").add("seen", "timestamp")
        carried = Carried(self.path, schema)
        before = carried.current(spark, batch_id)
        rows = rows.where(self._open(before.agg(F.max("seen")).first()[0]))
        counted = running(
            rows,
            [self.key, "window_start"],
            ["event_time", "_id"],
            [Running("nth", "count")],
            self.cell,
        )
        held = broadcast_when_small(
            before.select(F.col(self.key).alias("_key"), F.col("window_start").alias("_start"), "n")
        )
        same = F.col(self.key).eqNullSafe(F.col("_key")) & (F.col("window_start") == F.col("_start"))
        nth = F.col("nth") + F.coalesce("n", F.lit(0))
        verdict = F.when(F.col("nth_in_window") <= self.limit, "allow").otherwise("throttle")
        found = counted.join(held, same, "left").select(
            self.key, "event_time", nth.cast("long").alias("nth_in_window")
        )
        self.write(found.withColumn("verdict", verdict), batch_id)
        new = rows.groupBy(self.key, "window_start").agg(
            F.count("*").alias("n"), F.max("event_time").alias("seen")
        )
        latest = new.agg(F.max("seen")).first()[0]
        if latest is not None:
            carried.fold(new, batch_id, lambda both: self._summed(both).where(self._open(latest)))

    def _open(self, latest) -> Column:
        """Windows that a ride at ``latest`` leaves open."""
        if latest is None:
            return F.lit(True)
        passed = F.unix_micros(F.lit(latest).cast("timestamp")) - F.lit(self.keep)
        return F.unix_micros("window_start") >= passed

    def _summed(self, both: DataFrame) -> DataFrame:
        return both.groupBy(self.key, "window_start").agg(
            F.sum("n").alias("n"), F.max("seen").alias("seen")
        )


class ExpiringCount:
    """a count per key that starts over after ``ttl`` of the clock without a ride.

    A batch's rides are counted per key before they are shuffled.
    """

    def __init__(
        self,
        path: str,
        write: BatchWriter,
        key: str = "PULocationID",
        ttl: str = "1 hour",
        clock: Callable[[], float] = time.time,
    ):
        self.path, self.write, self.key, self.clock = path, write, key, clock
        self.ttl = to_micros(ttl) / 1e6

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        now = self.clock()
        counts = batch.groupBy(self.key).agg(F.count("*").alias("n"))
        schema = counts.schema.add("updated", "double")
        ledger = Ledger(self.path, schema, self.key)
        live = ledger.before(batch.sparkSession, batch_id).where(F.col("updated") > now - self.ttl)
        held = live.select(F.col(self.key).alias("_key"), F.col("n").alias("_before"))
        total = F.col("n") + F.coalesce("_before", F.lit(0))
        found = counts.join(held, F.col(self.key).eqNullSafe(F.col("_key")), "left").select(
            self.key, total.cast("long").alias("total_trips")
        )
        found.persist()
        try:
            self.write(found, batch_id)
            kept = found.select(
                self.key, F.col("total_trips").alias("n"), F.lit(now).alias("updated")
            )
            # What has run out goes when its bucket is rewritten.
            alive = F.col("updated") > now - self.ttl
            ledger.add(kept, batch_id, lambda rows: ledger.merge(rows).where(alive))
        finally:
            found.unpersist()
