"""Usage features: totals over all periods, and ratios with guarded denominators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.functions.columns import guarded_ratio
from callmeter.operators.clean import fill_zero
from callmeter.schema import DERIVED

PERIODS = ("day", "eve", "night", "intl")

# What each ratio divides by what.
RATIO_PARTS = {
    "intl_charge_ratio": ("intl_charge", "total_charge"),
    "avg_call_duration": ("total_mins", "total_calls"),
    "custserv_rate": ("custserv_calls", "account_length"),
    "night_day_ratio": ("night_mins", "day_mins"),
    "charge_per_min": ("total_charge", "total_mins"),
}


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that names the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def add_features(df: DataFrame, *, zero_only: bool = False) -> DataFrame:
    """Add three totals and five ratios; one projection, no shuffle.

    By default a ratio is 0.0 unless its denominator is positive. With ``zero_only`` only
    a zero denominator is guarded, and nulls in the added columns become 0.
    """

    def total(kind: str):
        first, *others = [F.col(f"{p}_{kind}") for p in PERIODS]
        for other in others:
            first = first + other
        return first

    summed = df.withColumns(
        {f"total_{kind}": total(kind) for kind in ("mins", "calls", "charge")}
    )
    ratios = summed.withColumns(
        {
            name: guarded_ratio(F.col(top), F.col(bottom), zero_only=zero_only)
            for name, (top, bottom) in RATIO_PARTS.items()
        }
    )
    return fill_zero(ratios, columns=DERIVED) if zero_only else ratios
