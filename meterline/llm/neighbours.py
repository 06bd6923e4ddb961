"""Nearest neighbours by cross-polytope hashing with multiprobe and exact reranking.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) sends a unit vector
to some direction; its hash is the signed axis nearest to it. Vectors are filed under one bucket
per table, queries look into several buckets per table, nearest axes first. All candidates of a
bucket are compared exactly, and the best are ranked by the inner product in double precision.
Vectors of unequal length get one more coordinate that makes them unit vectors in the same order.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import settle

TABLES = 16
PROBES = 8
# At any size: with these tables and probes, two hashes find little more than half.
HASHES = 1
BUCKET = 4096
SPARE = 4
_WIDE = 1 << 40


class Hasher:
    """Bucket numbers of vectors for all tables; the same for the same parameters anywhere."""

    def __init__(self, dims: int, top: float | None, tables: int, hashes: int, seed: int):
        self.top, self.tables, self.hashes = top, tables, hashes
        self.size = 1 << max(1, math.ceil(math.log2(dims + (top is not None))))
        random = np.random.default_rng(seed)
        self.signs = random.choice([-1.0, 1.0], (tables, hashes, 3, self.size))

    def unit(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.size))
        norms = np.linalg.norm(x, axis=1, keepdims=True)
        scale = norms if self.top is None or query else self.top
        out[:, : x.shape[1]] = x / scale
        if self.top is not None and not query:
            rest = 1 - np.square(norms[:, 0] / self.top)
            out[:, x.shape[1]] = np.sqrt(np.maximum(rest, 0))
        return out

    def nearest_axes(self, x: np.ndarray, table: int, i: int, count: int) -> np.ndarray:
        """The ``count`` signed axes nearest to each rotated vector, nearest first."""
        for signs in self.signs[table, i]:
            x = hadamard(x * signs)
        both = np.concatenate([x, -x], axis=1)
        if count == 1:
            return both.argmax(axis=1)[:, None]
        near = np.argpartition(-both, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(both, near, axis=1), axis=1, kind="stable")
        return np.take_along_axis(near, order, axis=1)

    def buckets(self, x: np.ndarray, probes: int, query: bool) -> np.ndarray:
        """Bucket numbers (rows, tables * probes ** hashes)."""
        x = self.unit(x, query)
        count = min(probes, 2 * self.size)
        found = []
        for table in range(self.tables):
            axes = [self.nearest_axes(x, table, i, count) for i in range(self.hashes)]
            for pick in itertools.product(range(count), repeat=self.hashes):
                code = np.full(len(x), 0, np.int64)
                for a, p in zip(axes, pick, strict=True):
                    code = code * (2 * self.size) + a[:, p]
                found.append(code + table * _WIDE)
        return np.stack(found, axis=1)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row."""
    rows, n = x.shape
    step = 1
    while step < n:
        x = x.reshape(rows, n // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, n)
        step *= 2
    return x / math.sqrt(n)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, repeated ids and rows included.

    Out are null ids and vectors that are null, empty, zero or hold a null or non-finite component.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )


def nearest(
    vectors: DataFrame,
    query: Column,
    *,
    k: int = 20,
    tables: int = TABLES,
    probes: int = PROBES,
    hashes: int = HASHES,
    seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest other rows of every row for which ``query`` (over vec_id) holds.

    Input: ``vec_id``, ``embedding`` (array of float or double) and any other columns. Result:
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (inner product in double precision,
    summed in order of components), best first, ties to the smaller ``vec_id``.

    A row is a candidate of every other row, also of one with its ``vec_id``: rows that share an id
    ask and are found one by one, each asking row with ranks from 1. Vectors are compared with those
    of their own length, each length in an index of its own; models give one or a few.

    ``hashes`` per bucket stay the same whatever the number of vectors, so that the share of them
    that a query is compared with, and with it the recall, does too; more need more probes. Equal
    vectors are searched once and their ids expanded afterwards; a bucket of many vectors is dealt
    over several tasks. A query that the tables give fewer than ``k`` rows is searched against all
    vectors of its length in blocks. Vectors that take part are those of ``usable``; others neither
    ask nor are found. An empty table gives no rows.
    """
    rows = settle(usable(vectors))
    norm = F.sqrt(
        F.aggregate(
            "embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
        )
    )
    lengths = (
        rows.groupBy(F.size("embedding").alias("dims"))
        .agg(F.count("*").alias("n"), F.min(norm).alias("shortest"), F.max(norm).alias("longest"))
        .orderBy("dims")
        .collect()
    )
    kind = rows.schema["vec_id"].dataType.simpleString()
    found = rows.sparkSession.createDataFrame(
        [], f"query_id {kind}, rank int, vec_id {kind}, score double"
    )
    for dims, n, shortest, longest in lengths:
        one = rows.where(F.size("embedding") == dims)
        uneven = longest - shortest > 1e-3 * longest
        hasher = Hasher(dims, longest if uneven else None, tables, hashes, seed)
        found = found.unionByName(_nearest_of(one, query, n, hasher, k, probes))
    return found


def _nearest_of(
    one: DataFrame, query: Column, n: int, hasher: Hasher, k: int, probes: int
) -> DataFrame:
    """The result for ``n`` rows whose vectors are of one length."""
    # ``place`` numbers the rows of a class of equal vectors, which tells apart rows of one id.
    places = Window.partitionBy("embedding").orderBy("vec_id")
    placed = settle(one.withColumn("place", F.row_number().over(places)))
    classes = placed.where(F.col("place") <= k + 1).groupBy("embedding").agg(
        F.min("vec_id").alias("first"), F.array_sort(F.collect_list("vec_id")).alias("ids")
    )
    # Class numbers rise with the smallest id, so that ties cut short keep the smaller one.
    classes = settle(
        classes.repartitionByRange("first", "embedding")
        .sortWithinPartitions("first", "embedding")
        .withColumn("cid", F.monotonically_increasing_id())
        .drop("first")
    )
    asking = settle(
        placed.where(query)
        .join(classes.select("embedding", "cid"), "embedding")
        .select(F.col("vec_id").alias("query_id"), F.col("place").alias("own"), "cid")
    )
    asked = classes.join(asking.select("cid").distinct(), "cid").select("cid", "embedding")
    index = classes.select("cid", "embedding")
    filed = _filed(index, hasher, 1, False)
    sizes = _filed(index, hasher, 1, False, with_vectors=False).groupBy("block").count()
    parts = settle(
        sizes.where(F.col("count") > BUCKET).select(
            "block", F.ceil(F.col("count") / BUCKET).cast("int").alias("parts")
        )
    )
    found = _compared(filed, _filed(asked, hasher, probes, True), parts, k)
    ranked = settle(_ranked(found, classes, asking, k))
    due = min(k, n - 1)
    short = settle(
        asking.join(
            ranked.groupBy("cid", "own").agg(F.count("*").alias("found")), ["cid", "own"], "left"
        )
        .where(F.coalesce("found", F.lit(0)) < due)
        .select("query_id", "own", "cid")
    )
    result = ["query_id", "rank", "vec_id", "score"]
    if short.isEmpty():
        return ranked.select(*result)
    everything = classes.sparkSession.createDataFrame(
        [(0, max(1, math.ceil(n / BUCKET)))], "block long, parts int"
    )
    again = _compared(
        index.withColumn("block", F.lit(0).cast("long")),
        index.join(short.select("cid").distinct(), "cid", "left_semi").withColumn(
            "block", F.lit(0).cast("long")
        ),
        everything,
        k,
    )
    rest = ranked.join(short.select("cid", "own"), ["cid", "own"], "left_anti")
    return rest.unionByName(_ranked(again, classes, short, k)).select(*result)


def _filed(
    rows: DataFrame, hasher: Hasher, probes: int, query: bool, with_vectors: bool = True
) -> DataFrame:
    """Each vector once per bucket: (cid, embedding, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                blocks = hasher.buckets(_matrix(batch.column("embedding")), probes, query)
                again = pa.array(np.repeat(np.arange(len(batch)), blocks.shape[1]))
                columns = [pa.array(blocks.reshape(-1))]
                names = ["block"]
                if with_vectors:
                    columns += [batch.column(c).take(again) for c in ("cid", "embedding")]
                    names += ["cid", "embedding"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = rows.schema["embedding"].dataType.simpleString()
    schema = "block long" + (f", cid long, embedding {kind}" if with_vectors else "")
    return rows.select("cid", "embedding").mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _compared(filed: DataFrame, asked: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """(cid, other): the best classes for each query class, over all blocks that both are in."""
    split = F.coalesce("parts", F.lit(1))
    left = (
        filed.join(parts, "block", "left")
        .withColumn("part", F.pmod(F.xxhash64("cid"), split).cast("int"))
        .withColumn("asks", F.lit(False))
    )
    right = (
        asked.join(parts, "block", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), split - 1)))
        .withColumn("asks", F.lit(True))
    )
    order = ["block", "part", "asks"]
    rows = left.unionByName(right).select(*order, "cid", "embedding")
    best = k + 1 + SPARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, vectors = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(False).astype(np.int64) for c in order])
            cids, matrix = batch.column("cid").to_numpy(), _matrix(batch.column("embedding"))
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(cids)]):
                here = (keys[0, a], keys[1, a])
                if here != block:
                    block, ids, vectors = here, [], []
                if not keys[2, a]:
                    ids.append(cids[a:b])
                    vectors.append(matrix[a:b])
                elif ids:
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    for at in range(a, b, 256):
                        some = slice(at, min(at + 256, b))
                        yield _best(cids[some], matrix[some], ids[0], vectors[0], best)

    found = (
        rows.repartition("block", "part")
        .sortWithinPartitions(*order)
        .mapInArrow(run, "cid long, other long, score double")
        .groupBy("cid", "other")
        .agg(F.max("score").alias("score"))
    )
    first = Window.partitionBy("cid").orderBy(F.desc("score"), "other")
    return (
        found.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= best)
        .select("cid", "other")
    )


def _best(cids, queries, ids, vectors, best: int) -> pa.RecordBatch:
    scores = queries @ vectors.T
    count = min(best, len(ids))
    near = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(cids, count)),
            pa.array(ids[near].reshape(-1)),
            pa.array(np.take_along_axis(scores, near, axis=1).reshape(-1)),
        ],
        names=["cid", "other", "score"],
    )


def _ranked(found: DataFrame, classes: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """Exact scores of the candidate classes, their ids, and the first ``k`` of each query."""
    own = classes.select("cid", F.col("embedding").alias("q"))
    others = classes.select(F.col("cid").alias("other"), F.col("embedding").alias("v"), "ids")
    product = F.aggregate(
        F.zip_with("q", "v", lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda a, x: a + x,
    )
    scored = found.join(own, "cid").join(others, "other").select(
        "cid", "other", product.alias("score"), F.posexplode("ids").alias("at", "vec_id")
    )
    best = Window.partitionBy("cid", "own").orderBy(F.desc("score"), "vec_id", "other", "at")
    return (
        scored.join(asking, "cid")
        .where("other <> cid OR at + 1 <> own")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("cid", "own", "query_id", "rank", "vec_id", "score")
    )
