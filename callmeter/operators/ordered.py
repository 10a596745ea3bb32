"""Running totals over an ordered value without sorting everything in one task.

The value range is cut into cells. Each cell is summed, the cell sums are accumulated
(a table with one row per cell), and a window inside each cell does the rest. The result
is the exact running total; the cells only decide how the work is spread.

Where to cut is told by mergeable sketches: each task keeps a quantile sketch and a sketch of the
distinct values of its rows, and one aggregate merges them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callmeter.operators.reshape import cell as named
from callmeter.schema import as_finite

#: Distinct values of a cell, and cells at most, as their borders pass through the driver. Beyond
#: that many values cells grow; a window sorts one, with spilling.
CELL_VALUES, CELLS = 512, 4096
#: Size of the quantile sketches: ranks are off by less than 0.1 %.
SKETCH = 4096


def cell_edges(
    df: DataFrame, columns: Sequence[str], *, cells: int | None = None
) -> list[list[float]]:
    """Cell borders per column at sketched quantiles of its finite values, from one aggregate.

    There are as many cells as the distinct values call for, or ``cells``. At most ``CELLS``
    numbers per column reach the driver. They go back into the plan as constants, so a recomputed
    task cuts its rows at the same places (sketching again would not).
    """
    found = df.agg(
        *[F.kll_sketch_agg_double(as_finite(c), F.lit(SKETCH)).alias(named(c, "sketch")) for c in columns],
        *[F.approx_count_distinct(as_finite(c)).alias(named(c, "distinct")) for c in columns],
    ).first()
    wanted = {
        c: cells or min(CELLS, math.ceil(found[named(c, "distinct")] / CELL_VALUES))
        for c in columns
        if found[named(c, "distinct")]
    }
    shares = lambda n: F.array(*[F.lit(i / n) for i in range(1, n)])
    asked = [c for c, n in wanted.items() if n > 1]
    if not asked:
        return [[] for _ in columns]
    sketches = df.sparkSession.createDataFrame(
        [tuple(found[named(c, "sketch")] for c in asked)], ", ".join(f"`{named(c, 'sketch')}` binary" for c in asked)
    )
    cuts = sketches.select(
        *[F.kll_sketch_get_quantile_double(f"`{named(c, 'sketch')}`", shares(wanted[c])).alias(named(c, "cuts")) for c in asked]
    ).first()
    return [sorted(set(cuts[named(c, "cuts")])) if c in asked else [] for c in columns]


def with_cells(
    df: DataFrame, columns: Sequence[str], outputs: Sequence[str], edges: Sequence[list[float]]
) -> DataFrame:
    """Add the cell number of each column, by binary search in its borders.

    Either infinity has a cell of its own, before the first and after the last.
    """
    infinity = float("inf")
    cut = Bucketizer(
        inputCols=list(columns),
        outputCols=list(outputs),
        splitsArray=[[-infinity, *(e or [0.0]), infinity] for e in edges],
        handleInvalid="keep",
    ).transform(df)
    return cut.withColumns(
        {
            out: F.when(F.col(c) == -infinity, -1).when(F.col(c) == infinity, len(e or [0.0]) + 1).otherwise(F.col(out).cast("int"))
            for c, out, e in zip(columns, outputs, edges, strict=True)
        }
    )


def running_totals(
    df: DataFrame,
    *,
    value: str,
    cell: str,
    amounts: Sequence[str],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Per row, the sum of each amount over all smaller values, and over the whole group.

    ``df`` must hold one row per group and value, so that a value which fills a third of
    the source is one row here. Adds ``<amount>_before`` and ``<amount>_total``.
    ``cell`` must not decrease as ``value`` grows, and no group may be null.
    """
    place = [*groups, cell]
    sums = df.groupBy(*place).agg(*[F.sum(a).alias(a) for a in amounts])
    # One row per group and cell, so this window never sees more than the cell count.
    group = Window.partitionBy(*groups)
    ahead = group.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *groups,
        cell,
        *[F.coalesce(F.sum(a).over(ahead), F.lit(0)).alias(f"_{a}_ahead") for a in amounts],
        *[F.sum(a).over(group).alias(f"{a}_total") for a in amounts],
    )
    inside = (
        Window.partitionBy(*place)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = df.select(
        "*",
        *[F.coalesce(F.sum(a).over(inside), F.lit(0)).alias(f"_{a}_inside") for a in amounts],
    )
    # Every row finds its cell. A left join adds no null filters, so both sides keep the
    # same aggregate below them and Spark computes it once.
    joined = running.join(offsets, place, "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"_{a}_ahead") + F.col(f"_{a}_inside")).alias(f"{a}_before") for a in amounts],
        *[f"{a}_total" for a in amounts],
    )
