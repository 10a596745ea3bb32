import pytest
from pyspark.sql import functions as F

from callmeter.functions.columns import label_text
from callmeter.operators import checks, score
from callmeter.operators.features import add_features
from callmeter.schema import FEATURES, KEY, LABEL, MEASURES

TIERS = [
    (0.0, "low", 0),
    (0.2499, "low", 0),
    (0.25, "moderate", 0),
    (0.40, "moderate", 1),
    (0.45, "high", 1),
    (0.65, "critical", 1),
    (1.0, "critical", 1),
    (None, None, None),
]


def test_tier_edges(spark):
    df = spark.createDataFrame([(p,) for p, *_ in TIERS], "p double")
    found = score.score_table(df, score="p").collect()
    assert [(r["p"], r["risk_level"], r["predicted"]) for r in found] == TIERS
    assert found[-1]["action"] is None
    french = score.score_table(df, score="p", wording="fr").collect()
    assert [r["risk_level"][2:] for r in french[:-1:2]] == ["Faible", "Modéré", "Élevé", "Critique"]


@pytest.mark.parametrize("p,level", [(0.10, "low"), (0.30, "moderate"), (0.55, "high"), (0.80, "critical")])
def test_tier_examples(spark, p, level):
    df = spark.createDataFrame([(p,)], "p double")
    assert score.score_table(df, score="p").first()["risk_level"] == level


def test_summary_counts_threshold_and_tiers_apart(spark):
    df = spark.createDataFrame([(0.41, 1), (0.44, 0), (0.5, 1), (0.1, 0)], "p double, y int")
    rows = {r["risk_level"]: r for r in score.risk_summary(df, score="p", label="y").collect()}
    assert (rows["moderate"]["predicted"], rows["moderate"]["at_risk"]) == (2, 0)
    assert (rows["high"]["predicted"], rows["high"]["at_risk"]) == (1, 1)
    assert rows["moderate"]["churn_rate"] == 0.5


def test_ensemble_and_rounding(spark):
    df = spark.createDataFrame([(0.12344, 0.5, 1)], "a double, b double, y int")
    mixed = score.ensemble(df, scores=["a", "b"])
    assert mixed.first()["ensemble_prob"] == (0.12344 + 0.5) / 2
    assert score.round_scores(mixed, scores=["a", "ensemble_prob"]).first()["a"] == 0.1234
    named = score.score_table(mixed, score="a", label="y").first()
    assert named["actual"] == "Churn"


def test_label_text(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "y boolean")
    assert [r[0] for r in df.select(label_text(F.col("y"))).collect()] == ["Churn", "Non-churn", None]


@pytest.fixture
def healthy(usage_rows):
    rows = [
        {c: (i * 7 + j) % 11 + 1.0 if c.endswith(("mins", "charge")) else (i + j) % 5 + 1 for j, c in enumerate(MEASURES)}
        | {LABEL: int(i % 6 == 0)}
        for i in range(200)
    ]
    part = F.when(F.col(KEY) % 20 < 14, "train").when(F.col(KEY) % 20 < 17, "val").otherwise("test")
    return add_features(usage_rows(*rows)).withColumn("split", part)


def failed(df):
    return {(r["check"], r["dataset"]) for r in df.filter("not passed").collect()}


def test_healthy_table_passes(healthy):
    assert failed(checks.run_checks(healthy, min_rows=30)) == set()
    assert failed(checks.run_checks(healthy)) == {("rows", s) for s in ("train", "val", "test")}


def test_each_fault_is_found(healthy):
    in_val = F.col("split") == "val"
    first = F.col(KEY) == 0
    broken = healthy.withColumns(
        {
            "eve_mins": F.when(in_val & (F.col(KEY) % 20 == 14), None).otherwise(F.col("eve_mins")),
            LABEL: F.when(first, 3).otherwise(F.col(LABEL)),
            "night_day_ratio": F.when(first, float("inf")).otherwise(F.col("night_day_ratio")),
            "day_mins": F.when(F.col("split") == "test", 5.0).otherwise(F.col("day_mins")),
        }
    ).drop("custserv_rate").withColumn("total_calls", F.lit("many"))
    assert failed(checks.run_checks(broken, min_rows=30)) == {
        ("feature_nulls", "val"),
        ("eve_mins_varies", "val"),
        ("labels_not_0_or_1", "train"),
        ("infinite_ratios", "train"),
        ("day_mins_varies", "test"),
        ("features_present", "all"),
        ("features_numeric", "all"),
    }


def test_lopsided_splits_fail(healthy):
    swapped = healthy.withColumn(
        "split", F.when(F.col("split") == "train", "val").when(F.col("split") == "val", "train").otherwise("test")
    )
    found = failed(checks.run_checks(swapped, min_rows=1))
    assert ("train_minus_val", "all") in found and ("train_share", "all") in found


def test_missing_label_is_reported(healthy):
    found = failed(checks.run_checks(healthy.drop(LABEL), min_rows=1))
    assert ("label_present", "all") in found


def test_score_checks(spark):
    df = spark.createDataFrame([(0.0, 0.5), (1.0, 1.5), (0.3, None)], "a double, b double")
    found = {r["dataset"]: (r["observed"], r["passed"]) for r in checks.score_checks(df, scores=["a", "b"]).collect()}
    assert found == {"a": (0.0, True), "b": (2.0, False)}


def test_schema_diff(spark, healthy):
    same = checks.schema_diff({"a": healthy, "b": healthy.filter("split = 'val'")})
    assert same.count() == 0
    other = checks.schema_diff({"a": healthy, "b": healthy.drop(FEATURES[0])})
    assert [tuple(r) for r in other.collect()] == [("a", FEATURES[0], 200)]


def test_an_absent_split_fails(healthy):
    found = checks.run_checks(healthy.where("split != 'val'"), min_rows=30)
    lost = {(r["check"], r["dataset"]) for r in found.where("not passed").collect()}
    each = {r["check"] for r in found.where("dataset = 'val'").collect()}
    assert {c for c, d in lost if d == "val"} == each and "rows" in each
    assert ("train_minus_val", "all") in lost and ("train_minus_test", "all") not in lost
    assert found.where("dataset = 'val' and check = 'rows'").first()["observed"] == 0.0


def test_nan_is_missing(healthy):
    holed = healthy.withColumn("day_mins", F.when(F.col(KEY) == 0, float("nan")).otherwise(F.col("day_mins")))
    assert failed(checks.run_checks(holed, min_rows=30)) == {("feature_nulls", "train"), ("day_mins_varies", "train")}


def test_other_splits_are_seen(healthy):
    odd = healthy.withColumn("split", F.when(F.col(KEY) < 3, "spare").otherwise(F.col("split")))
    assert ("rows", "spare") in failed(checks.run_checks(odd, min_rows=30))


def test_nan_is_no_probability(spark):
    df = spark.createDataFrame([(0.5,), (float("nan"),), (None,)], "a double")
    assert checks.score_checks(df, scores=["a"]).first()["observed"] == 2.0


def test_rows_that_cannot_be_scored_are_set_apart(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1.0, 2), (2, None, 2), (3, nan, None), (4, inf, 1), (5, -1.0, 0)]
    df = spark.createDataFrame(rows, "k int, x double, y int")
    fit, unfit = score.route(df, str(tmp_path / "routed"), columns=["x", "y"])
    assert sorted(r["k"] for r in fit.collect()) == [1, 5] and fit.columns == ["k", "x", "y"]
    assert {r["k"]: r["blocked_by"] for r in unfit.collect()} == {2: ["x"], 3: ["x", "y"], 4: ["x"]}
    assert score.route(df.limit(0), str(tmp_path / "none"), columns=["x"])[0].count() == 0
