"""Turning one wide row of aggregates into one row per column.

Aggregating all columns side by side reads each input row once; only the finished
aggregates are turned, so no input row is multiplied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cell(column: str, metric: str) -> str:
    """Name of the wide column that holds ``metric`` of ``column``."""
    return f"{column}__{metric}"


def one_row_per_column(
    wide: DataFrame,
    columns: Sequence[str],
    metrics: Sequence[str],
    *,
    name: str = "column",
    keep: Sequence[str] = (),
) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias(name),
                *[F.col(cell(c, m)).alias(m) for m in metrics],
            )
            for c in columns
        ]
    )
    return wide.select(*keep, F.inline(rows))
