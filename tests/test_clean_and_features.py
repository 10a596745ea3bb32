import pytest
from pyspark.sql import functions as F

from callmeter.functions.columns import decide, risk_action, risk_tier
from callmeter.operators import clean, features
from callmeter.schema import DERIVED, KEY, LABEL, MEASURES


def collect(df, column):
    return {r[KEY]: r[column] for r in df.collect()}


def test_status_is_total_when_values_are_missing(spark, usage_rows):
    rows = [{"day_mins": float(i % 5), LABEL: i % 2} for i in range(100)]
    rows += [{"day_mins": 10_000.0}, {"day_mins": None}, {"day_mins": 10_000.0, "eve_mins": None}]
    df = usage_rows(*rows)
    found = clean.zscore_status(df, columns=["day_mins", "eve_mins"], threshold=3.0)
    by_key = collect(found, "status")
    assert by_key[100] == clean.ANOMALY
    assert by_key[101] == clean.UNKNOWN
    assert by_key[102] == clean.ANOMALY  # extreme in one column, whatever is missing
    assert set(by_key[i] for i in range(100)) == {clean.CLEAN}
    parts = [f(found).count() for f in (clean.clean_rows, clean.anomaly_rows, clean.unknown_rows)]
    assert parts == [100, 2, 1]
    rate = clean.anomaly_rate(found).first()
    assert (rate["rows"], rate["unknown"], rate["anomaly_pct"]) == (103, 1, 1.94)


def test_constant_column_is_never_extreme(spark, usage_rows):
    df = usage_rows(*[{"day_mins": 7.0}] * 5)
    found = clean.zscore_status(df, columns=["day_mins"])
    assert clean.clean_rows(found).count() == 5
    flags = clean.zscore_flags(df, columns=["day_mins"])
    assert [r["day_mins_flag"] for r in flags.collect()] == [None] * 5


def test_single_row_and_empty_table(spark, usage_rows):
    one = usage_rows({"day_mins": 3.0})
    assert clean.zscore_status(one, columns=MEASURES).first()["status"] == clean.CLEAN
    none = one.limit(0)
    assert clean.zscore_status(none, columns=MEASURES).count() == 0
    assert clean.anomaly_rate(clean.zscore_status(none, columns=MEASURES)).first()["rows"] == 0


def test_dedup_is_off_unless_asked(spark, usage_rows):
    df = usage_rows({}, {}, {"day_mins": 2.0}).drop(KEY)
    assert clean.dedup(df).count() == 3
    assert clean.dedup(df, enabled=True).count() == 2


def test_zero_denominators(spark, usage_rows):
    zero = {c: 0.0 if c.endswith(("mins", "charge")) else 0 for c in MEASURES}
    df = usage_rows(zero, {**zero, "night_mins": 3.0})
    for zero_only in (False, True):
        rows = features.add_features(df, zero_only=zero_only).orderBy(KEY).collect()
        assert [rows[0][c] for c in DERIVED] == [0.0] * len(DERIVED)
        assert rows[1]["night_day_ratio"] == 0.0


def test_negative_denominator_divides_only_with_zero_only(spark, usage_rows):
    df = usage_rows({"day_mins": -2.0, "night_mins": 3.0, "account_length": -4})
    guarded = features.add_features(df).first()
    assert (guarded["night_day_ratio"], guarded["custserv_rate"]) == (0.0, 0.0)
    divided = features.add_features(df, zero_only=True).first()
    assert (divided["night_day_ratio"], divided["custserv_rate"]) == (-1.5, -0.25)


def test_null_inputs(spark, usage_rows):
    df = usage_rows({"day_mins": None}, {"account_length": None})
    rows = features.add_features(df).orderBy(KEY).collect()
    assert rows[0]["total_mins"] is None
    assert rows[0]["night_day_ratio"] == 0.0
    assert rows[1]["custserv_rate"] == 0.0
    filled = features.add_features(df, zero_only=True).orderBy(KEY).first()
    assert filled["total_mins"] == 0.0
    assert filled["day_mins"] is None  # only added columns are filled
    assert clean.fill_zero(df).orderBy(KEY).first()["day_mins"] == 0.0


def test_required_columns_are_named(spark, usage_rows):
    df = usage_rows({})
    assert features.require_columns(df, MEASURES) is df
    with pytest.raises(ValueError, match="total_mins.*total_calls"):
        features.require_columns(df, [*MEASURES, "total_mins", "total_calls"])


def test_features_need_no_shuffle(spark, usage_rows):
    plan = features.add_features(usage_rows({}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_base(spark, usage_rows):
    df = usage_rows({LABEL: 1}).withColumn(LABEL, F.col(LABEL).cast("boolean"))
    df = df.withColumn("phone_number", F.lit("555"))
    found = clean.base(df, drop=["phone_number"], label=LABEL)
    assert "phone_number" not in found.columns
    assert dict(found.dtypes)[LABEL] == "int"


def test_one_bad_cell_spoils_only_its_row(spark):
    rows = [(i, float(i % 7), 1.0) for i in range(100)]
    rows += [(200, float("nan"), 1.0), (201, float("inf"), 1.0), (202, None, 1.0)]
    table = spark.createDataFrame(rows, "k int, x double, y double")
    status = {r.k: r.status for r in clean.zscore_status(table, columns=["x", "y"]).collect()}
    assert [status[k] for k in (200, 201, 202)] == ["unknown", "anomaly", "unknown"]
    assert {status[k] for k in range(100)} == {"clean"}


def test_nan_scores_are_not_decided(spark):
    row = spark.createDataFrame([(float("nan"),)], "s double").select(
        decide(F.col("s")).alias("d"), risk_tier(F.col("s")).alias("t"), risk_action(F.col("s")).alias("a")
    ).first()
    assert (row.d, row.t, row.a) == (None, None, None)
