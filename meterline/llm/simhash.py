"""SimHash near-duplicates through deletion-variant signatures.

Two 64-bit fingerprints with at most two differing bits have a 32-bit half that differs by at most
one. So each distinct fingerprint is indexed under its two halves with each bit left out in turn:
64 keys, which any two linked fingerprints share at least one of. Fingerprints that share a key
are verified. A key with many fingerprints is dealt out again under every pair of left-out bits of
the other half, after which at most eight share a key, so no group grows with a cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import settle
from meterline.llm.components import components

HALF = 32
GROUP = 1024


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text, as a signed integer.

    ASCII letters are lower-cased; shingles of words, joined by a space and counted with repeats,
    vote by the bits of their XXH64. A text with fewer words votes as a whole; without words the
    fingerprint is 0.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-shingle].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(line[a:b], seed)
            for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)
        ]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 100_000):
        some = np.array(hashes[at : at + 100_000], "<u8").view(np.uint8).reshape(-1, 8)
        # Sums of bytes holding one bit each, added in 8-bit lanes of 255 rows at most.
        bits = np.unpackbits(some, axis=1, bitorder="little")
        for row in range(0, len(bits), 255):
            counts += bits[row : row + 255].sum(axis=0, dtype=np.uint8)
    set_bits = np.flatnonzero(2 * counts > len(hashes)).tolist()
    value = sum(1 << bit for bit in set_bits)
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``fp``, the fingerprint of its ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column("__text")]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.int64())], names=[*keep, "fp"]
            )

    schema = docs.select(*keep).schema.add("fp", "long")
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def linked(distinct: DataFrame, group: int = GROUP) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that differ by at most two bits.

    In a group that shares a key only as many links are returned as connect what its links
    connect. Groups of more than ``group`` fingerprints are split by pairs of bits instead.
    """
    variants = distinct.select("fp", F.explode(_halves("fp")).alias("key"))
    first = _grouped(variants, group)
    large = first.where("b IS NULL").select("fp", "key")
    pairs = first.where("b IS NOT NULL").select("fp", "b")
    again = large.select("fp", F.explode(_pairs("fp", "key")).alias("key"))
    return pairs.unionByName(_grouped(again, None).select("fp", "b")).distinct()


def _grouped(keyed: DataFrame, group: int | None) -> DataFrame:
    kind = keyed.schema["key"].dataType.simpleString()
    packed = pa.int64() if kind == "bigint" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, key in _links_by_key(batches, group):
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(key, packed)],
                    names=["fp", "b", "key"],
                )

    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, f"fp long, b long, key {kind}")


def _links_by_key(batches, group):
    """Links of each run of equal keys; the members of a run above ``group`` with b null."""
    current, members, passing = None, [], False
    for batch in batches:
        fps = batch.column("fp").to_numpy()
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        sizes = np.diff(bounds)
        # Runs of two that lie wholly inside the batch, all at once.
        inner = np.asarray(bounds[1:-2], np.int64)[sizes[1:-1] == 2]
        a, b = fps[inner], fps[inner + 1]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= 2
        yield a[near], b[near], [None] * int(near.sum())
        others = np.flatnonzero(sizes > 2).tolist()
        for i in sorted({0, *others, len(sizes) - 1}):
            if keys[bounds[i]] != current:
                if members:
                    yield _inside(np.concatenate(members))
                current, members, passing = keys[bounds[i]], [], False
            members.append(fps[bounds[i] : bounds[i + 1]])
            if group and (passing or sum(map(len, members)) > group):
                many = np.concatenate(members)
                yield many, [None] * len(many), [current] * len(many)
                members, passing = [], True
    if members:
        yield _inside(np.concatenate(members))


def _inside(fps: np.ndarray):
    """A spanning set of the links among a few fingerprints."""
    left, a, b = fps, [], []
    if len(fps) < 2:
        return a, b, []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count((left ^ front[0]).view(np.uint64)) <= 2
            found = left[near]
            a += [int(front[0])] * len(found)
            b += found.tolist()
            front, left = np.concatenate([front[1:], found]), left[~near]
    return a, b, [None] * len(a)


def _halves(fp: str):
    """Keys: a half of the fingerprint with one bit left out, and which."""
    return F.expr(
        f"""transform(sequence(0, {2 * HALF - 1}), v ->
              ((shiftrightunsigned({fp}, {HALF} * (v DIV {HALF})) & 4294967295L)
                 & ~shiftleft(1L, v % {HALF}))
              | shiftleft(CAST(v AS BIGINT), {HALF}))"""
    )


def _pairs(fp: str, key: str):
    """Keys: a key above with the other half, less two of its bits, and which."""
    other = f"""(shiftrightunsigned({fp}, IF(shiftrightunsigned({key}, {HALF}) < {HALF}, {HALF}, 0))
                 & 4294967295L)"""
    return F.expr(
        f"""flatten(transform(sequence(0, {HALF - 2}), i ->
              transform(sequence(i + 1, {HALF - 1}), j ->
                concat_ws('.', hex({key}), hex(i), hex(j),
                          hex({other} & ~(shiftleft(1L, i) | shiftleft(1L, j)))))))"""
    )


def near_duplicates(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Documents with their ``fingerprint`` and ``component_id``.

    Input: ``doc_id``, ``text`` and any other columns; returned are ``keep`` (``doc_id`` if not
    given), ``fp`` (the fingerprint as a number), ``fingerprint`` (16 hex digits),
    ``component_id`` (the smallest ``doc_id`` that links reach) and ``root`` (a fingerprint that
    is the same in all the component).

    A null or empty text has fingerprint 0, linked like any other. Rows that are equal are in one
    component. A null ``doc_id`` counts only where nothing else is reachable: ``component_id`` is
    then null. An empty table gives an empty one.
    """
    keep = keep or ["doc_id"]
    marked = settle(fingerprints(docs, list(dict.fromkeys(["doc_id", *keep]))))
    classes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("__least")))
    links = settle(linked(classes.select("fp")))
    found = components(links).join(
        classes.withColumnRenamed("fp", "node"), "node"
    )
    smallest = found.groupBy("root").agg(F.min("__least").alias("__reached"))
    joined = found.join(smallest, "root").select(
        F.col("node").alias("fp"), "root", "__reached"
    )
    named = classes.join(joined, "fp", "left").select(
        "fp",
        F.coalesce("__reached", "__least").alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )
    return marked.join(named, "fp").select(
        *keep,
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one, that of the smallest ``doc_id``.

    Columns stay as they are. Of several rows with that ``doc_id`` one with the smallest text hash
    stays; a component of null ids keeps one row. An empty table stays empty.
    """
    tagged = docs.withColumn("__tag", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = near_duplicates(tagged, ["doc_id", "__tag"])
    first = Window.partitionBy("root").orderBy(F.asc_nulls_last("doc_id"), "__tag")
    winners = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .withColumn("__place", F.row_number().over(first))
        .where("__place = 1")
        .select(F.col("doc_id").alias("__doc"), F.col("__tag").alias("__won"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__tag") == F.col("__won"))
    return (
        tagged.join(winners, same, "left_semi")
        .dropDuplicates(["doc_id", "__tag"])
        .drop("__tag")
    )
