import math

import pytest
from pyspark.sql import functions as F

from callmeter.operators import evaluate, models, score
from callmeter.operators.split import random_split
from callmeter.plans import stages
from callmeter.plans.usage_table import prepared, records
from callmeter.schema import KEY, LABEL, MEASURES, RECORD, SOURCE_SCHEMA
from callmeter.sources import usage_io
from conftest import SF_DIR

COLUMNS = ["day_mins", "custserv_calls", "intl_mins", "night_calls"]


@pytest.fixture(scope="module")
def rows(spark):
    return prepared(spark, SF_DIR).select(KEY, LABEL, "split", *COLUMNS).cache()


@pytest.fixture(scope="module")
def trained(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("best") / "mlp")
    return path, *models.fit_mlp(
        rows.filter("split = 'train'"),
        rows.filter("split = 'val'"),
        columns=COLUMNS,
        hidden=(4,),
        rounds=6,
        patience=2,
        iterations=8,
        save_best=path,
    )


def test_scaler_uses_train_only_and_keeps_constants_at_zero(spark, rows):
    fixed = rows.withColumn("same", F.lit(3.0))
    train = fixed.filter("split = 'train'")
    model = models.fit_scaler(train, columns=["day_mins", "same"])
    params = {r["column"]: r for r in models.fitted_scaler_params(train, model).collect()}
    direct = {r["column"]: r for r in models.scaler_params(train, columns=["day_mins"]).collect()}
    assert math.isclose(params["day_mins"]["mean"], direct["day_mins"]["mean"])
    assert math.isclose(params["day_mins"]["stddev"], direct["day_mins"]["stddev"])
    scaled = models.scaled_columns(fixed, model)
    assert scaled.agg(F.max(F.abs("same_scaled"))).first()[0] == 0.0
    at_train = scaled.filter("split = 'train'").agg(F.avg("day_mins_scaled"), F.stddev("day_mins_scaled")).first()
    assert abs(at_train[0]) < 1e-9 and math.isclose(at_train[1], 1.0)


def test_nulls_are_not_scored_silently(spark, rows):
    model = models.fit_scaler(rows, columns=COLUMNS)
    holed = rows.withColumn("day_mins", F.lit(None).cast("double"))
    with pytest.raises(Exception):
        models.scale(holed, model).collect()


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "y int")
    assert tuple(models.class_weights(df, label="y").first()) == (8, 2, 4 * 0.4, 10 / 16, 10 / 4)
    weighted = models.balanced_weight(df, label="y")
    assert weighted.agg(F.sum("weight")).first()[0] == 10.0


@pytest.mark.parametrize("weight", [0.25, 1.0, 1.83, 3.0])
def test_resampling_carries_the_weight(spark, weight):
    df = spark.range(8000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    found = models.weighted_resample(df, label="y", key="k", weight=weight)
    sizes = {r["y"]: r["count"] for r in found.groupBy("y").count().collect()}
    assert sizes[0] == 4000
    assert abs(sizes[1] - 4000 * weight) < 120
    assert found.repartition(3).exceptAll(
        models.weighted_resample(df.repartition(5), label="y", key="k", weight=weight)
    ).count() == 0


def test_rounds_stop_early_and_keep_the_best(rows, trained):
    path, model, history = trained
    figures = history.orderBy("round").collect()
    assert [r["round"] for r in figures] == list(range(1, len(figures) + 1))
    losses = [r["val_loss"] for r in figures]
    best = losses.index(min(losses))
    assert len(losses) == 6 or len(losses) - 1 - best == 2
    weight = models.class_weights(rows.filter("split = 'train'"), label=LABEL).first()["pos_weight"]
    val = score.positive_score(rows.filter("split = 'val'"), model, "p")
    loss = evaluate.log_loss(val, label=LABEL, score="p", pos_weight=weight).first()[0]
    assert math.isclose(loss, min(losses), rel_tol=1e-6)
    assert models.parameter_count(model) == (4 + 1) * 4 + (4 + 1) * 2


def test_no_patience_left(rows):
    # With nothing to learn from, the loss cannot fall for long.
    noise = rows.withColumns({c: F.lit(1.0) for c in COLUMNS})
    _, history = models.fit_mlp(
        noise.filter("split = 'train'"),
        noise.filter("split = 'val'"),
        columns=COLUMNS,
        hidden=(2,),
        rounds=30,
        patience=1,
        iterations=20,
    )
    assert history.count() < 30


SMALL = dict(columns=COLUMNS, hidden=(4,), patience=3, iterations=4)


def test_an_interrupted_fit_goes_on_where_it_was(spark, rows, tmp_path, monkeypatch):
    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    whole, history = models.fit_mlp(train, val, rounds=6, **SMALL)
    path, real, calls = str(tmp_path / "mlp"), models._round_figures, []

    def cut(*args):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("the driver is lost")
        return real(*args)

    monkeypatch.setattr(models, "_round_figures", cut)
    with pytest.raises(RuntimeError, match="lost"):
        models.fit_mlp(train, val, rounds=6, save_best=path, **SMALL)
    monkeypatch.setattr(models, "_round_figures", real)
    resumed, again = models.fit_mlp(train.repartition(5), val, rounds=6, save_best=path, resume=True, **SMALL)
    figures = lambda df: [tuple(r) for r in df.orderBy("round").collect()]
    assert len(figures(history)) > 3
    for a, b in zip(figures(history), figures(again), strict=True):
        assert a == pytest.approx(b, abs=1e-7)
    both = score.positive_score(score.positive_score(rows, whole, "a"), resumed, "b")
    assert both.filter("abs(a - b) > 1e-6").count() == 0
    # Nothing is left to do: the published result comes back as it is.
    monkeypatch.setattr(models, "_round_figures", None)
    last, figures_again = models.fit_mlp(train, val, rounds=6, save_best=path, resume=True, **SMALL)
    assert figures(figures_again) == figures(again)
    with pytest.raises(ValueError, match="other settings"):
        models.fit_mlp(train, val, rounds=9, save_best=path, resume=True, **{**SMALL, "hidden": (5,)})


def test_fits_name_what_they_lack(rows):
    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    with pytest.raises(ValueError, match="no validation rows"):
        models.fit_mlp(train, val.limit(0), rounds=2, **SMALL)
    with pytest.raises(ValueError, match="both classes"):
        models.fit_mlp(train.filter(F.col(LABEL) == 0), val, rounds=2, **SMALL)
    with pytest.raises(ValueError, match="both classes"):
        models.weighted_resample(train.filter(F.col(LABEL) == 1), label=LABEL, key=KEY)


def test_saved_best_scores_the_same(spark, rows, trained):
    path, model, _ = trained
    again = usage_io.load_model(path)
    both = score.positive_score(score.positive_score(rows, model, "a"), again, "b")
    assert both.filter("a != b").count() == 0
    batch = both.orderBy(KEY).limit(32)
    assert batch.count() == 32 and batch.filter("a < 0 or a > 1").count() == 0


def test_fits_do_not_depend_on_partitioning(rows):
    train = rows.filter("split = 'train'")
    fits = [
        models.fit_forest(t, columns=COLUMNS, trees=5, depth=4)
        for t in (train.repartition(2), train.repartition(7, "day_mins"))
    ]
    scored = score.positive_score(score.positive_score(rows, fits[0], "a"), fits[1], "b")
    assert scored.filter("abs(a - b) > 1e-9").count() == 0


def partition_sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_placement_is_one_shuffle_sized_by_the_data(spark):
    ids = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(7).alias("k"), F.col("id").alias("x"))
    placed = models._placed(ids, "k")  # three in four rows share a key
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Aggregate" not in plan
    sizes = partition_sizes(placed)
    assert len(sizes) == -(-200_000 * 16 // models._SMALL_PART) and sum(sizes) == 200_000
    assert max(sizes) < 2 * 200_000 / len(sizes)
    assert models._placed(ids.limit(100), "k").rdd.getNumPartitions() == 1


def test_rows_equal_in_full_are_spread_and_kept(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), F.when(F.col("id") % 4 == 0, F.col("id") % 100).alias("x"), F.lit("text").alias("t")
    )
    placed = [models._placed(df, "k") for df in (rows.repartition(2), rows.repartition(7, "x"))]
    assert placed[0]._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2  # the other is this test's own
    for df in placed:
        sizes = partition_sizes(df)
        assert sum(sizes) == 200_000 and max(sizes) < 2 * 200_000 / len(sizes)
        assert df.exceptAll(rows).count() == 0
    where = [df.groupBy(F.spark_partition_id().alias("p"), "k", "x").count() for df in placed]
    assert where[0].exceptAll(where[1]).count() == 0


def test_sizes_of_placements():
    assert [models._parts(n) for n in (0, 1, 1 << 20, (1 << 20) + 1)] == [1, 1, 1, 2]
    assert models._parts(10 << 30) == 1024 and models._parts(1 << 40) == 8192


def test_stages_from_csv_to_predictions(spark, tmp_path):
    source = records(spark, SF_DIR).select(*RECORD)
    path = lambda name: str(tmp_path / name)
    usage_io.write_csv(source.toDF(*SOURCE_SCHEMA.names), path("cdr.csv"))

    report = stages.convert(spark, path("cdr.csv"), path("cdr")).first()
    assert report["csv_rows"] == report["parquet_rows"] == 1500

    rate = stages.preprocess(usage_io.read_usage(spark, path("cdr")), path("out")).first()
    rows = usage_io.read_usage(spark, path("out/prepared"))
    assert rows.count() == rate["clean"]
    assert usage_io.read_usage(spark, path("out/anomalies")).count() == rate["anomaly"]
    assert set(MEASURES) <= set(rows.columns)

    compared = stages.train(rows, path("models"), hidden=(6,), rounds=3, iterations=10, trees=10, depth=5)
    figures = {r["model"]: r for r in compared.collect()}
    assert set(figures) == {"mlp_prob", "rf_prob", "ensemble_prob"}
    assert all(r["auc"] > 0.5 for r in figures.values())
    metrics = usage_io.read_usage_csv(spark, path("models/metrics")).first()
    assert metrics["rounds"] <= 3 and 0 < metrics["accuracy"] <= 1

    test = rows.filter("split = 'test'")
    found = stages.predict(test, path("models"), path("predictions.csv"))
    assert found.columns == [
        "client_id",
        "mlp_prob",
        "rf_prob",
        "ensemble_prob",
        "risk_level",
        "action",
        "predicted",
    ]
    assert found.count() == test.count()
    assert random_split(test.drop("split"), key="phone_number").filter("split != 'test'").count() == 0
