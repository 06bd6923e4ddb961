"""How often 64-bit hashes occur, in a table of fixed size.

Tasks count into buckets by the upper bits and pass on slices of their table, which are added up
slice by slice. The sum is as large as the table, whatever the corpus, and so may go to the driver
and to all tasks. It tells rare hashes from common ones; results must not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS, SLICE = 18, 4096
_KIND = "<u4"


class Counter:
    """One task's table."""

    def __init__(self):
        self.table = np.zeros(1 << BITS, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        self.table += np.bincount(buckets(hashes), minlength=len(self.table))

    def slices(self) -> tuple[list[int], list[bytes]]:
        """Numbers and contents of the slices that are not empty."""
        parts = self.table.astype(_KIND).reshape(-1, SLICE)
        used = np.flatnonzero(parts.any(axis=1)).tolist()
        return used, [parts[i].tobytes() for i in used]


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _added(batches) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, raw in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
            sums[i] = sums.get(i, 0) + np.frombuffer(raw.as_py(), _KIND).astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()])],
            names=["slice", "counts"],
        )


def summed(parts: DataFrame) -> np.ndarray:
    """The table from rows with ``slice`` and ``counts`` of all tasks."""
    table = np.zeros(1 << BITS, np.int64)
    dealt = parts.select("slice", "counts").repartition("slice")
    for i, raw in dealt.mapInArrow(_added, "slice int, counts binary").collect():
        table[i * SLICE : (i + 1) * SLICE] += np.frombuffer(raw, np.int64)
    return table
