"""Enrichment by a dimension that is itself a stream of updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators.joins import broadcast_enrich, latest_per_key
from meterline.streaming.carried import Carried
from meterline.streaming.sinks import BatchWriter

_ROWS = "_side"


def tagged(rides: DataFrame, zones: DataFrame, sequence: list[str]) -> DataFrame:
    """Both streams as one, so that one query reads both and replays them together.

    ``sequence`` are the columns of ``zones`` that order its updates, such as the offset.
    """
    ride = rides.select(F.lit("ride").alias(_ROWS), F.struct(*rides.columns).alias("ride"))
    zone = zones.select(
        F.lit("zone").alias(_ROWS),
        F.struct("zone_id", "zone_name", F.struct(*sequence).alias("seq")).alias("zone"),
    )
    return ride.unionByName(zone, allowMissingColumns=True)


class BroadcastEnricher:
    """A ``foreachBatch`` function over ``tagged`` rows.

    Each batch's zone updates are folded into the latest row per zone, then its rides are
    enriched. The dimension is carried in the shared folder and written only by batches that
    update it. The batch is held while it is read for both.
    """

    def __init__(self, dimension: str, write: BatchWriter):
        self.dimension = dimension
        self.write = write

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            updates = batch.where(F.col(_ROWS) == "zone").select("zone.*")
            schema = updates.schema.add("_age", "long")
            known = Carried(self.dimension, schema)
            if updates.isEmpty():
                zones = known.current(batch.sparkSession, batch_id)
            else:
                newer = updates.withColumn("_age", F.lit(batch_id).cast("long"))
                zones = known.fold(newer, batch_id, _latest)
            rides = batch.where(F.col(_ROWS) == "ride").select("ride.*")
            self.write(broadcast_enrich(rides, zones), batch_id)
        finally:
            batch.unpersist()


def _latest(zones: DataFrame) -> DataFrame:
    return latest_per_key(zones, ["zone_id"], ["_age", "seq"])
