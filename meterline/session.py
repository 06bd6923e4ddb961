"""Session settings every job here relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that may be changed on a running session. Partition counts and memory are left to
# the cluster: they depend on its size, and a streaming checkpoint freezes the former anyway.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # A busy driver's rows collapse to sessions before the shuffle instead of after it.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Settings that are fixed once a session exists.
STATIC_SETTINGS = {
    # Recording the Python call site of every expression makes building a plan several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def get_session(app: str = "meterline", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session. ``master`` is for local runs; a cluster supplies its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**STATIC_SETTINGS, **SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())
