"""Sharding by the minimax contiguous partition of ordered atomic groups.

Equal texts form a group, groups lie in the order of their hash, and neighbouring groups are
gathered into a fixed number of cells, which are what is cut between. The smallest capacity with
which a greedy pass needs no more than the given shards is found by binary search over the cells'
sizes: one row, of bounded length. The same expressions run at any size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 16
SALTS = 64

# Cells above the mean of what is left get a shard of their own, largest first: they set the
# capacity whatever the rest does, and would leave it spread over too few shards.
_PLAN = """
WITH c AS (SELECT array_sort(collect_list(struct(cell, bytes))) AS cells FROM {cells}),
g AS (
  SELECT cells, slice(sort_array(transform(cells, x -> struct(x.bytes, -x.cell AS back)), false),
                      1, {n}) AS top FROM c),
h AS (
  SELECT cells, top, aggregate(
    top,
    named_struct('rest', aggregate(cells, 0L, (a, x) -> a + x.bytes), 'own', 0, 'open', true),
    (a, x) -> IF(a.open AND a.own < {n} - 1 AND x.bytes * ({n} - a.own) > a.rest,
                 named_struct('rest', a.rest - x.bytes, 'own', a.own + 1, 'open', true),
                 named_struct('rest', a.rest, 'own', a.own, 'open', false))) AS s FROM g),
i AS (
  SELECT transform(slice(top, 1, s.own), x -> -x.back) AS giants, {n} - s.own AS left, s.rest,
         cells FROM h),
j AS (
  SELECT giants, left, rest, filter(cells, x -> NOT array_contains(giants, x.cell)) AS cells
  FROM i),
k AS (
  SELECT *, greatest(CAST(ceil(rest / left) AS BIGINT),
                     coalesce(array_max(transform(cells, x -> x.bytes)), 0L)) AS low,
         CAST(ceil(rest / left) AS BIGINT)
           + coalesce(array_max(transform(cells, x -> x.bytes)), 0L) AS high FROM j),
m AS (
  SELECT *, aggregate(
    sequence(1, 63), named_struct('low', low, 'high', high),
    (a, step) -> IF(a.low >= a.high, a,
      IF(aggregate(cells, named_struct('n', 1, 'fill', 0L),
           (b, x) -> IF(b.fill + x.bytes <= (a.low + a.high) DIV 2,
                        named_struct('n', b.n, 'fill', b.fill + x.bytes),
                        named_struct('n', b.n + 1, 'fill', x.bytes))).n <= left,
         named_struct('low', a.low, 'high', (a.low + a.high) DIV 2),
         named_struct('low', (a.low + a.high) DIV 2 + 1, 'high', a.high)))).low AS capacity
  FROM k)
SELECT giants, capacity, aggregate(
    cells, named_struct('fill', capacity + 1, 'starts', CAST(array() AS ARRAY<BIGINT>)),
    (a, x) -> IF(a.fill + x.bytes <= capacity,
                 named_struct('fill', a.fill + x.bytes, 'starts', a.starts),
                 named_struct('fill', x.bytes, 'starts', concat(a.starts, array(x.cell)))))
  .starts AS starts
FROM m
"""


def shard_by_bytes(
    docs: DataFrame,
    shards: int,
    *,
    overhead: int = 8,
    instead_of_text: dict[str, Column] | None = None,
) -> DataFrame:
    """Put documents into ``shards`` shards of nearly equal bytes; equal texts stay together.

    Input: ``doc_id``, ``text`` and any other columns. Adds (replacing columns of these names)
    ``size`` (UTF-8 bytes plus ``overhead``), ``shard`` and ``slot`` (gapless from 0 in a shard).
    With ``instead_of_text`` these columns are formed where the text is read and the text itself
    is left out, so that no shuffle carries it.

    A null text counts as an empty one. Repeated rows get slots of their own. Null ``doc_id``
    values come first in their cell. An empty table gives an empty one. A group above the mean
    fills a shard by itself, as groups are not cut; a table with fewer groups than shards leaves
    shards empty. ``slot`` is counted in (cell, salt) groups whose totals are summed beforehand,
    so a hot text is dealt over ``SALTS`` tasks.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    formed = instead_of_text or {}
    put = docs.drop("size", "shard", "slot").withColumns(
        {
            "size": (F.octet_length(text) + overhead).cast("long"),
            "__cell": F.shiftrightunsigned(F.xxhash64(text), 64 - CELL_BITS),
            "__salt": F.pmod(F.xxhash64("doc_id", *_others(docs)), F.lit(SALTS)),
        }
        | formed
    )
    if formed:
        put = put.drop("text")
    counted = put.groupBy("__cell", "__salt").agg(
        F.count("*").alias("__n"), F.sum("size").alias("__bytes")
    )
    cells = counted.groupBy(F.col("__cell").alias("cell")).agg(F.sum("__bytes").alias("bytes"))
    plan = spark.sql(_PLAN.format(cells="{cells}", n=shards), cells=cells).first()
    starts, giants = list(plan["starts"] or []), list(plan["giants"] or [])
    cell = F.col("__cell")
    after = F.size(F.filter(_longs(starts), lambda s: s <= cell)) - 1
    own = F.array_position(_longs(giants), cell)
    shard = F.when(own > 0, F.lit(shards) - own).otherwise(after).cast("int")
    lay = Window.partitionBy("shard").orderBy("__cell", "__salt")
    base = F.sum("__n").over(lay.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counted.withColumn("shard", shard).select(
        "__cell", "__salt", "shard", F.coalesce(base, F.lit(0)).alias("__base")
    )
    here = Window.partitionBy("__cell", "__salt").orderBy("doc_id", "size")
    return (
        put.withColumn("__place", F.row_number().over(here))
        .join(offsets, ["__cell", "__salt"])
        .withColumn("slot", (F.col("__base") + F.col("__place") - 1).cast("long"))
        .drop("__cell", "__salt", "__place", "__base")
    )


def _others(docs: DataFrame) -> list[str]:
    """Further small columns that tell apart rows of one ``doc_id``."""
    return [c for c in ("lang", "source", "n_chars") if c in docs.columns]


def _longs(values: list[int]):
    return F.array(*[F.lit(v).cast("long") for v in values]).cast("array<bigint>")
