"""Data-quality checks over the prepared table, as one table of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.schema import FEATURES, LABEL, RATIOS, SPLITS, as_number

# What the checks accept.
MIN_ROWS = 1000
POSITIVE_RATE = (0.05, 0.30)
TRAIN_SHARE = (0.60, 0.80)
POSITIVE_MEAN = (
    "account_length",
    "day_mins",
    "eve_mins",
    "night_mins",
    "intl_mins",
    "custserv_calls",
)
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _check(name: str, dataset: Column, observed: Column, bound: str, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        dataset.alias("dataset"),
        observed.cast("double").alias("observed"),
        F.lit(bound).alias("bound"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def run_checks(
    df: DataFrame,
    *,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    min_rows: int = MIN_ROWS,
    positive_rate: tuple[float, float] = POSITIVE_RATE,
    train_share: tuple[float, float] = TRAIN_SHARE,
) -> DataFrame:
    """All checks on a table with a ``split`` column: one grouping by split.

    Returns ``(check, dataset, observed, bound, passed)`` for each check of each split that is
    expected, and of others that are there. A split without rows fails all its checks, and so do
    comparisons with it. A column that is missing is counted as such rather than raising; NaN is
    a missing value like null.
    """
    kinds = dict(df.dtypes)
    present = [c for c in features if c in kinds]
    numeric = [c for c in present if kinds[c] in NUMERIC]
    y = F.col(label) if label in kinds else F.lit(None).cast("int")
    # Faults are added up within the row, so each kind needs one counter only.
    marks = lambda conditions: sum((c.cast("int") for c in conditions), F.lit(0))
    value = lambda c: as_number(c) if c in numeric else F.col(c)
    gaps = marks(value(c).isNull() for c in present)
    infinite = marks(
        F.coalesce(F.abs(F.col(c)) == F.lit(float("inf")), F.lit(False))
        for c in RATIOS
        if c in numeric
    )
    measured = [c for c in (*POSITIVE_MEAN, "total_mins") if c in numeric]
    per_split = df.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.sum(gaps).alias("nulls"),
        F.count_if(y.isNull() | ~y.isin(0, 1)).alias("bad_labels"),
        F.avg(y).alias("rate"),
        F.sum(infinite).alias("infinite"),
        *[F.stddev_samp(as_number(c)).alias(f"std_{c}") for c in measured],
        *[F.avg(as_number(c)).alias(f"mean_{c}") for c in measured],
        *[F.count_if(as_number(c).isNull()).alias(f"null_{c}") for c in measured],
    )
    # What is expected stands on the left, so an absent split is seen.
    expected = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    per_split = expected.join(per_split, "split", "full").fillna(0, subset=["rows"])
    here = F.col("split")
    in_range = lambda c, bounds: c.between(*bounds)
    split_checks = [
        _check("rows", here, F.col("rows"), f">= {min_rows}", F.col("rows") >= min_rows),
        _check("feature_nulls", here, F.col("nulls"), "= 0", F.col("nulls") == 0),
        _check("labels_not_0_or_1", here, F.col("bad_labels"), "= 0", F.col("bad_labels") == 0),
        _check(
            "positive_rate",
            here,
            F.round("rate", 6),
            f"{positive_rate[0]:.2f} to {positive_rate[1]:.2f}",
            in_range(F.col("rate"), positive_rate),
        ),
        _check("infinite_ratios", here, F.col("infinite"), "= 0", F.col("infinite") == 0),
        *[
            _check(
                f"{c}_varies",
                here,
                F.round(f"std_{c}", 6),
                "> 0, no null",
                (F.col(f"std_{c}") > 0) & (F.col(f"null_{c}") == 0),
            )
            for c in measured
        ],
        *[
            _check(f"{c}_mean", here, F.round(f"mean_{c}", 6), "> 0", F.col(f"mean_{c}") > 0)
            for c in measured
            if c in POSITIVE_MEAN
        ],
    ]
    size = lambda s: F.coalesce(F.sum(F.when(here == s, F.col("rows"))), F.lit(0))
    whole = per_split.agg(*[size(s).alias(s) for s in SPLITS])
    train, val, test = (F.col(s) for s in SPLITS)
    share = F.try_divide(train, train + val + test)
    all_splits = F.lit("all")
    whole_checks = [
        _check("train_minus_val", all_splits, train - val, "> 0", (train > val) & (val > 0)),
        _check("train_minus_test", all_splits, train - test, "> 0", (train > test) & (test > 0)),
        _check(
            "train_share",
            all_splits,
            F.round(share, 6),
            f"{train_share[0]:.2f} to {train_share[1]:.2f}",
            in_range(share, train_share),
        ),
        _check(
            "features_present",
            all_splits,
            F.lit(len(present)),
            f"= {len(features)}",
            F.lit(len(present) == len(features)),
        ),
        _check(
            "features_numeric",
            all_splits,
            F.lit(len(numeric)),
            f"= {len(features)}",
            F.lit(len(numeric) == len(features)),
        ),
        _check(
            "label_present", all_splits, F.lit(int(label in kinds)), "= 1", F.lit(label in kinds)
        ),
    ]
    return per_split.select(F.inline(F.array(*split_checks))).unionByName(
        whole.select(F.inline(F.array(*whole_checks)))
    )


def score_checks(df: DataFrame, *, scores: Sequence[str]) -> DataFrame:
    """Every score present (no null, no NaN) and a probability: counted in one aggregate."""
    bad = lambda c: F.count_if(as_number(c).isNull() | ~as_number(c).between(0, 1))
    wide = df.agg(*[bad(c).alias(c) for c in scores])
    return wide.select(
        F.inline(
            F.array(
                *[
                    _check("not_a_probability", F.lit(c), F.col(c), "= 0", F.col(c) == 0)
                    for c in scores
                ]
            )
        )
    )


def column_diff(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Columns that some dataset lacks, from the schemas alone: no data is read.

    One row per dataset and column that is not shared by all: ``dataset``, ``column``, ``type``.
    """
    shared = set.intersection(*[set(df.columns) for df in datasets.values()])
    rows = [(name, c, kind) for name, df in datasets.items() for c, kind in df.dtypes if c not in shared]
    spark = next(iter(datasets.values())).sparkSession
    return spark.createDataFrame(rows, "dataset string, column string, type string")


def schema_diff(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Columns that some dataset lacks, with the values they hold where they exist.

    One row per dataset and column that is not shared by all; ``column_diff`` names them without
    counting their values.
    """
    shared = set.intersection(*[set(df.columns) for df in datasets.values()])
    found = []
    for name, df in datasets.items():
        extra = [c for c in df.columns if c not in shared]
        if extra:
            wide = df.agg(*[F.count(c).alias(c) for c in extra])
            rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("values")) for c in extra]
            found.append(
                wide.select(F.lit(name).alias("dataset"), F.inline(F.array(*rows)))
            )
    if not found:
        any_df = next(iter(datasets.values()))
        return any_df.sparkSession.createDataFrame(
            [], "dataset string, column string, values bigint"
        )
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result
