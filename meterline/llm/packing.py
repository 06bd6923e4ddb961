"""Packing token sequences by the sum-of-squares rule.

Documents come one after the other. Whole windows are cut off a long one; the rest goes to the
fill level that makes the sum of squared counts of partly filled windows smallest. Only the counts
per level (an array) and the open windows are held. When a task's documents end, or too many
windows are open, the emptiest open windows are cut up to fill the fullest ones, so a task leaves
at most one window that is not full.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterline.llm.common import slices
from meterline.llm.vocab import encoder, public_path

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_TASK_SHIFT = 36


class Packer:
    """Sum-of-squares packing of pieces (doc, start, ids, doc_tokens) into windows of ``size``."""

    def __init__(self, size: int, emit: Callable, first: int = 0, most_open: int = 4096):
        self.size, self.emit, self.next, self.most_open = size, emit, first, most_open
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list] = [[] for _ in range(size + 1)]
        self.opened = 0

    def add(self, doc, ids: bytes, tokens: int) -> None:
        start, whole = 0, tokens - tokens % self.size
        while start < whole:
            self._close([(doc, start, ids[4 * start : 4 * (start + self.size)], tokens)])
            start += self.size
        if tokens > whole:
            self._place((doc, whole, ids[4 * whole :], tokens), tokens - whole)
        if self.opened > self.most_open:
            self.drain()

    def _place(self, piece, length: int) -> None:
        level = self.choose(length)
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
            self.opened -= 1
        else:
            window = []
        window.append(piece)
        self._put(window, level + length)

    def choose(self, length: int) -> int:
        """The level to fill; 0 opens a window. Among equals the fullest window."""
        levels = np.arange(self.size - length + 1)
        after = np.where(levels + length < self.size, 2 * self.count[levels + length] + 1, 0)
        change = after - (2 * self.count[levels] - 1)
        change[0] = after[0]
        change[1:][self.count[1 : len(levels)] == 0] = np.iinfo(np.int64).max
        return int(len(levels) - 1 - np.argmin(change[::-1]))

    def _put(self, window: list, level: int) -> None:
        if level == self.size:
            self._close(window)
        else:
            self.open[level].append(window)
            self.count[level] += 1
            self.opened += 1

    def drain(self) -> None:
        """Fill the fullest open windows with the last pieces of the emptiest ones."""
        left = [(n, w) for n in range(1, self.size) for w in self.open[n]]
        self.open = [[] for _ in range(self.size + 1)]
        self.count[:] = 0
        self.opened = 0
        low, high = 0, len(left) - 1
        while low < high:
            (have, window), (spare, donor) = left[high], left[low]
            while have < self.size and spare:
                doc, start, ids, tokens = donor.pop()
                move = min(self.size - have, len(ids) // 4)
                stay = len(ids) // 4 - move
                if stay:
                    donor.append((doc, start, ids[: 4 * stay], tokens))
                window.append((doc, start + stay, ids[4 * stay :], tokens))
                have, spare = have + move, spare - move
            left[high], left[low] = (have, window), (spare, donor)
            if have == self.size:
                self._close(window)
                high -= 1
            if not spare:
                low += 1
        if low == high and left[low][0]:
            self._put(left[low][1], left[low][0])

    def finish(self) -> None:
        self.drain()
        for windows in self.open:
            for window in windows:
                self._close(window)
        self.open = [[] for _ in range(self.size + 1)]

    def _close(self, window: list) -> None:
        offset = 0
        for doc, start, ids, tokens in window:
            self.emit(doc, start, ids, tokens, self.next, offset)
            offset += len(ids) // 4
        self.next += 1


def pack(
    docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", size: int = 1024, end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens.

    Input: ``doc_id``, ``text`` and any other columns, which are left out. A document's ids are
    the tokenizer's, then ``end_id``. One row per piece: ``doc_id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, and with ``with_ids`` also
    ``ids``. Each task packs its own partition as a stream, without a shuffle, and numbers its
    sequences from its own range; memory is bounded by the open windows and one document.

    A null text counts as an empty one and gives the end id alone. Null and repeated ``doc_id``
    values are documents like others. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codec = encoder(public_path(tokenizer))
        end = end_id.to_bytes(4, "little")
        out: list[tuple] = []

        def emit(doc, start, ids, tokens, sequence, offset):
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), tokens, sequence, offset)
            out.append((*row, np.frombuffer(ids, "<u4").tolist()) if with_ids else row)

        packer = Packer(size, emit, TaskContext.get().partitionId() << _TASK_SHIFT)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch.column("text")):
                found = codec.encode([t or "" for t in texts])
                for doc, ids in zip(keys[first : first + len(texts)], found, strict=True):
                    packer.add(doc, ids + end, len(ids) // 4 + 1)
                if out:
                    yield _batch(out, schema)
                    out.clear()
        packer.finish()
        codec.forget()
        if out:
            yield _batch(out, schema)

    ddl = SCHEMA + (", ids array<long>" if with_ids else "")
    schema = pa.schema(
        [(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")]
        + ([("ids", pa.list_(pa.int64()))] if with_ids else [])
    )
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
