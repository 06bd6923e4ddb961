"""Connected components of a link table, by alternating stars.

Every round joins each node to the smallest node it can see. Only nodes that occur in a link take
part; no group of links is gathered in one place, and each round's links are checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import settle

# Links a task takes at least, if that leaves a task per core: rounds on few links would else
# write a file for every pair of partitions, again and again.
TASK_LINKS = 50_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (its first two columns, one orderable type).

    The root is the smallest node that can be reached. Links that are null on a side, join a node
    to itself or are repeated change nothing; without links the result is empty.
    """
    a, b = links.columns[:2]
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = settle(_down(pairs))
    state = _state(edges)
    while state[0]:
        tasks = max(links.sparkSession.sparkContext.defaultParallelism, state[0] // TASK_LINKS)
        edges = _large_star(edges.coalesce(tasks), tasks)
        edges = settle(_small_star(edges, tasks))
        last, state = state, _state(edges)
        if state == last:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _down(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least, "u").where("v > u").coalesce(tasks)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    edges = edges.where("u <> v").distinct().coalesce(tasks)
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).coalesce(tasks).where("u <> v").distinct().coalesce(tasks)
