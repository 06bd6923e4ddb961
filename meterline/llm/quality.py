"""Quality rules: base rules, and a hashed n-gram likelihood ratio.

Two multinomials over hashed byte n-grams are counted, one over the texts labelled as trusted, one
over the whole corpus. A document's score is the mean over its n-grams of the log ratio of the
two, so its length does not matter. The threshold comes from labelled documents that the trusted
model was not counted on, and every document is then decided by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import SPACES

SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 16
SIZES = (3, 4)
MIN_WORDS = 50
BASE = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "score double"
)


@dataclass(frozen=True)
class Model:
    """Log ratios per bucket, and the least score a document may have (None: any)."""

    ratios: np.ndarray
    threshold: float | None


def grams(text: str | None) -> np.ndarray:
    """Buckets of the byte 3- and 4-grams of a text, in order of size and place."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    found = []
    for n in SIZES:
        if len(raw) >= n:
            h = np.full(len(raw) - n + 1, n, np.uint32)
            for i in range(n):
                h = h * np.uint32(0x01000193) ^ raw[i : i + len(h)]
            h = h * np.uint32(0x9E3779B1)
            found.append(h >> np.uint32(16))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
    )


def _repeated(words: list[bytes]) -> int:
    """Words in three-word windows that the text holds more than once."""
    n = len(words)
    if n < 4:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    # Pairs get dense numbers first, so that three words never overflow 64 bits.
    pairs = np.unique(at[:-1] * len(ids) + at[1:], return_inverse=True)[1]
    _, which, times = np.unique(
        pairs[:-1] * len(ids) + at[2:], return_inverse=True, return_counts=True
    )
    again = times[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def sampled_labels(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` trusted and ``rows`` rejected ``doc_id`` values, smallest hash first.

    A document labelled twice counts as trusted if one label says so. Half of them, by hash, are
    held out (``held``) from counting, to set the threshold on.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg((F.max("quality") > 0).alias("trusted"))
        .withColumn("__hash", F.xxhash64("__doc"))
        .withColumn("held", F.shiftrightunsigned("__hash", 63) == 1)
    )
    sides = [
        known.where(F.col("trusted") == side).orderBy("__hash", "__doc").limit(rows)
        for side in (True, False)
    ]
    return sides[0].unionByName(sides[1]).drop("__hash")


def fit(
    docs: DataFrame, labels: DataFrame, *, label_rows: int = 50_000, bins: int = 4096
) -> Model:
    """Count both models over all of ``docs`` and set the threshold.

    ``labels`` has ``doc_id`` and ``quality`` (1: trusted). At most ``label_rows`` labels of each
    kind are used, which bounds what is broadcast; the raw model counts every document. The
    threshold separates held-out trusted from rejected documents best (the sum of both rates,
    trusted counting ten times, the lowest of equals); without rejected ones it lies below
    every held-out trusted document, without trusted ones there is none. Null texts count nothing.
    """
    sample = F.broadcast(sampled_labels(labels, label_rows))
    marked = docs.select("doc_id", "text").join(
        sample, F.col("doc_id") == F.col("__doc"), "left"
    )
    target = F.col("trusted") & ~F.col("held")
    counted = (
        marked.select("text", F.coalesce(target, F.lit(False)).alias("target"))
        .mapInArrow(_count, "bucket int, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    # One row per bucket at most.
    ratios = _ratios(counted.collect())
    scored = score(marked.where("held"), Model(ratios, None), ["trusted"]).where(
        "n_words >= %d" % MIN_WORDS
    )
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    if low is None:
        return Model(ratios, None)
    width = max(high - low, 1e-9) / bins
    place = F.least(F.floor((F.col("score") - low) / width), F.lit(bins - 1)).cast("int")
    counts = scored.groupBy("trusted", place.alias("bin")).count().collect()
    return Model(ratios, _threshold(counts, low, width, bins))


def _ratios(rows) -> np.ndarray:
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in rows:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    # The trusted counts lean on the corpus where they are thin.
    blend = target + raw / max(raw.sum(), 1) * 1000
    return np.log((blend + 0.01) / (blend + 0.01).sum()) - np.log((raw + 0.01) / (raw + 0.01).sum())


def _threshold(counts, low: float, width: float, bins: int) -> float | None:
    good, bad = np.zeros(bins), np.zeros(bins)
    for row in counts:
        (good if row["trusted"] else bad)[row["bin"]] += row["count"]
    if not good.sum():
        return None
    first_good = int(np.flatnonzero(good)[0])
    if not bad.sum():
        return low + first_good * width
    lost = np.concatenate([[0], np.cumsum(good)[:-1]]) / good.sum()
    caught = np.concatenate([[0], np.cumsum(bad)[:-1]]) / bad.sum()
    gain = caught - 10 * lost
    return low + int(np.argmax(gain)) * width


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, trusted in zip(batch.column("text"), batch.column("target").to_pylist()):
            found = np.bincount(grams(text.as_py()), minlength=BUCKETS)
            raw += found
            if trusted:
                target += found
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
        names=["bucket", "raw", "target"],
    )


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, the base counts and the length-normalised ``score``."""
    ratios = docs.sparkSession.sparkContext.broadcast(model.ratios.astype(np.float64))
    own = "text" if "text" in keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column(own):
                text = cell.as_py()
                places = grams(text)
                mean = float(ratios.value[places].mean()) if len(places) else 0.0
                rows.append((*base_counts(text), mean))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, *made], names=[*keep, *(c.split()[0] for c in BASE.split(", "))]
            )

    schema = docs.select(*keep).schema
    for column in BASE.split(", "):
        schema = schema.add(*column.split())
    read = docs.select(*keep) if own == "text" else docs.select(*keep, F.col("text").alias(own))
    return read.mapInArrow(run, schema)


def judge(
    docs: DataFrame, labels: DataFrame, keep: list[str], *, label_rows: int = 50_000
) -> DataFrame:
    """The columns ``keep`` of every document, its base counts, ``score`` and ``kept``.

    Adds ``base_failed`` (fewer than 50 words, or more than half of them in repeated windows) and
    ``kept``: not failed and a score of at least the threshold. Names in ``keep`` must differ
    from the added ones. A null or empty text has no words and fails. Null and repeated
    ``doc_id`` values are documents of their own, sharing a label if their id has one. Without
    trusted labels only the base rules decide. An empty table gives an empty one.
    """
    model = fit(docs, labels, label_rows=label_rows)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    good = F.lit(True) if model.threshold is None else F.col("score") >= model.threshold
    return (
        score(docs, model, keep)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & good)
    )
