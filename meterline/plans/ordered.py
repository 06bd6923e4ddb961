"""Running values per key in a total order, safe when one key holds much of the table.

A window over a key puts all its rows into one task. Here rows are dealt by (key, time cell)
instead: the totals of each cell, combined before the shuffle, are added up over a key's earlier
cells, and the sum enters the cell's window as its first row. So no task holds more than one
cell's rows, whatever the key; the cells of a key are as many as its span has cell widths. The
plan is the same at any size, starts no job while it is built and writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.durations import to_micros

# Rows of one key in one cell share a task: at 10,000 rides a second in one zone, 600,000.
CELL = "1 minute"
_BEFORE_ALL = -(2**63)


@dataclass(frozen=True)
class Running:
    """One running column.

    ``kind`` is ``count``, ``sum``, ``max`` or ``last`` (the latest non-NULL value).
    ``before`` leaves the current row out of its own value.
    """

    name: str
    kind: str
    value: Column | None = None
    before: bool = False

    def __post_init__(self):
        if self.kind not in ("count", "sum", "max", "last"):
            raise ValueError(f"unknown running value: {self.kind!r}")

    def operand(self) -> Column:
        return F.lit(1).cast("long") if self.kind == "count" else self.value

    def total(self, of: str, order: list[str]) -> Column:
        """The value over a whole cell, free of row order."""
        if self.kind == "last":
            return F.max_by(of, F.when(F.col(of).isNotNull(), F.struct(*order)))
        return F.max(of) if self.kind == "max" else F.sum(of)

    def over(self, of: str, window) -> Column:
        """The value over a window of ordered rows or cells."""
        if self.kind == "last":
            return F.last(of, ignorenulls=True).over(window)
        if self.kind == "max":
            return F.max(of).over(window)
        total = F.sum(of).over(window)
        return F.coalesce(total, F.lit(0)) if self.kind == "count" else total


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[Running],
    cell: str = CELL,
) -> DataFrame:
    """Add running ``columns`` to a static ``df``.

    ``order`` starts with a timestamp, which ``cell`` cuts, and must be total within a key: end
    it with a column that tells rows apart. Rows without a time come first. No keys means one
    order over the whole table; only its cells, one row each, then meet in one task.
    """
    own = [f"_k{i}" for i in range(len(keys))]
    by = [f"_o{i}" for i in range(len(order))]
    values = [f"_v{i}" for i in range(len(columns))]
    micros = F.unix_micros(F.col(order[0]).cast("timestamp"))
    rows = df.select(
        *(F.col(k).alias(name) for k, name in zip(keys, own, strict=True)),
        F.coalesce(F.floor(micros / to_micros(cell)), F.lit(_BEFORE_ALL)).alias("_cell"),
        *(F.col(o).alias(name) for o, name in zip(order, by, strict=True)),
        *(c.operand().alias(name) for c, name in zip(columns, values, strict=True)),
        F.struct(*df.columns).alias("_row"),
    )
    totals = rows.groupBy(*own, "_cell").agg(
        *(c.total(v, by).alias(v) for c, v in zip(columns, values, strict=True))
    )
    earlier = Window.partitionBy(*own).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *own, "_cell", *(c.over(v, earlier).alias(v) for c, v in zip(columns, values, strict=True))
    )
    merged = rows.unionByName(carried, allowMissingColumns=True)
    # A carried row has no row of the table and comes first in its cell.
    inside = Window.partitionBy(*own, "_cell").orderBy(F.col("_row").isNotNull(), *by)
    spans = [inside.rowsBetween(Window.unboundedPreceding, -1 if c.before else 0) for c in columns]
    found = merged.select(
        "_row",
        *(
            c.over(v, span).alias(c.name)
            for c, v, span in zip(columns, values, spans, strict=True)
        ),
    )
    return found.where("_row IS NOT NULL").select("_row.*", *(c.name for c in columns))
