"""Column lists and schemas of the usage record, one row per account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The header of a usage file, in file order, with its types.
SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("Phone Number", T.StringType()),
        T.StructField("Account Length", T.IntegerType()),
        T.StructField("VMail Message", T.IntegerType()),
        T.StructField("Day Mins", T.DoubleType()),
        T.StructField("Day Calls", T.IntegerType()),
        T.StructField("Day Charge", T.DoubleType()),
        T.StructField("Eve Mins", T.DoubleType()),
        T.StructField("Eve Calls", T.IntegerType()),
        T.StructField("Eve Charge", T.DoubleType()),
        T.StructField("Night Mins", T.DoubleType()),
        T.StructField("Night Calls", T.IntegerType()),
        T.StructField("Night Charge", T.DoubleType()),
        T.StructField("Intl Mins", T.DoubleType()),
        T.StructField("Intl Calls", T.IntegerType()),
        T.StructField("Intl Charge", T.DoubleType()),
        T.StructField("CustServ Calls", T.IntegerType()),
        T.StructField("Churn", T.BooleanType()),
    ]
)


def snake(name: str) -> str:
    """``Day Mins`` -> ``day_mins``: no name needs quoting, in Spark or elsewhere."""
    return name.strip().lower().replace(" ", "_")


USAGE_SCHEMA = T.StructType(
    [T.StructField(snake(f.name), f.dataType) for f in SOURCE_SCHEMA]
)
RECORD = USAGE_SCHEMA.names
IDENTIFIER = "phone_number"
LABEL = "churn"
KEY = "account_id"
MEASURES = [c for c in RECORD if c not in (IDENTIFIER, LABEL)]

TOTALS = ["total_mins", "total_calls", "total_charge"]
RATIOS = [
    "intl_charge_ratio",
    "avg_call_duration",
    "custserv_rate",
    "night_day_ratio",
    "charge_per_min",
]
DERIVED = TOTALS + RATIOS
FEATURES = MEASURES + DERIVED

SPLITS = ("train", "val", "test")

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("mlp_prob", T.DoubleType()),
        T.StructField("rf_prob", T.DoubleType()),
        T.StructField("ensemble_prob", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("predicted", T.IntegerType()),
    ]
)


def snake_names(df: DataFrame) -> DataFrame:
    """Rename every column of a usage file to its snake_case name."""
    return df.toDF(*[snake(c) for c in df.columns])


def as_double(name: str) -> Column:
    return F.col(name).cast("double")


def as_number(name: str) -> Column:
    """As double, with NaN counted as missing."""
    value = as_double(name)
    return F.when(~F.isnan(value), value)


def as_finite(name: str) -> Column:
    """As double, with NaN and the infinities counted as missing."""
    value = as_double(name)
    return F.when(F.abs(value) < F.lit(float("inf")), value)
