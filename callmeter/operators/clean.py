"""Preparing rows: identifier and label, duplicates, and setting extreme rows apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.functions.columns import any_of
from callmeter.operators.reshape import cell, one_row_per_column
from callmeter.schema import as_finite, as_number

EXTREME_THRESHOLD = 6.0
CLEAN, ANOMALY, UNKNOWN = "clean", "anomaly", "unknown"


def base(df: DataFrame, *, drop: Sequence[str], label: str) -> DataFrame:
    """Drop identifiers and turn the boolean label into 0/1."""
    return df.drop(*drop).withColumn(label, F.col(label).cast("int"))


def dedup(df: DataFrame, *, enabled: bool = False) -> DataFrame:
    """Drop exact copies if asked; accounts with equal usage are legitimate by default."""
    return df.dropDuplicates() if enabled else df


def fill_zero(df: DataFrame, *, columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(0, subset=list(columns) if columns is not None else None)


def _stats_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        *[F.avg(as_finite(c)).alias(cell(c, "mean")) for c in columns],
        *[F.stddev_samp(as_finite(c)).alias(cell(c, "stddev")) for c in columns],
    )


def zscore_stats(df: DataFrame, *, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of a column's finite values, from one pass."""
    return one_row_per_column(_stats_row(df, columns), columns, ["mean", "stddev"])


def _extreme(
    df: DataFrame, columns: Sequence[str], threshold: float
) -> dict[str, Column]:
    # Two numbers per column come back as constants, so the row pass is a plain projection
    # and a filter on its result can be pushed below it.
    stats = _stats_row(df, columns).first()
    return {
        c: F.abs(F.try_divide(as_number(c) - stats[cell(c, "mean")], F.lit(stats[cell(c, "stddev")])))
        > F.lit(threshold)
        # A column without spread (or with a single value) has no scores and no extremes.
        if stats[cell(c, "stddev")]
        else F.lit(None).cast("boolean")
        for c in columns
    }


def zscore_flags(
    df: DataFrame, *, columns: Sequence[str], threshold: float = EXTREME_THRESHOLD
) -> DataFrame:
    """Add ``<column>_flag``: more than ``threshold`` deviations from the mean."""
    flags = _extreme(df, columns, threshold)
    return df.select("*", *[flag.alias(f"{c}_flag") for c, flag in flags.items()])


def zscore_status(
    df: DataFrame, *, columns: Sequence[str], threshold: float = EXTREME_THRESHOLD
) -> DataFrame:
    """Add ``status``: anomaly if any column is extreme, unknown if that cannot be told
    because a value is missing (null or NaN), else clean. An infinite value is extreme, in
    its own row alone. Every row gets exactly one."""
    extreme = any_of(list(_extreme(df, columns, threshold).values()))
    missing = any_of([as_number(c).isNull() for c in columns])
    return df.withColumn(
        "status",
        F.when(extreme, ANOMALY).when(missing, UNKNOWN).otherwise(CLEAN),
    )


def _with_status(df: DataFrame, status: str) -> DataFrame:
    return df.filter(F.col("status") == status).drop("status")


def clean_rows(df: DataFrame) -> DataFrame:
    return _with_status(df, CLEAN)


def anomaly_rows(df: DataFrame) -> DataFrame:
    return _with_status(df, ANOMALY)


def unknown_rows(df: DataFrame) -> DataFrame:
    return _with_status(df, UNKNOWN)


def anomaly_rate(df: DataFrame) -> DataFrame:
    """Rows by status and the anomalous percentage, to two decimals."""
    counted = df.agg(
        F.count("*").alias("rows"),
        *[
            F.count_if(F.col("status") == s).alias(s)
            for s in (CLEAN, ANOMALY, UNKNOWN)
        ],
    )
    return counted.select(
        "*",
        F.round(F.try_divide(F.col(ANOMALY), F.col("rows")) * 100, 2).alias(
            "anomaly_pct"
        ),
    )
