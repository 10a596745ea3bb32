import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from callmeter.functions.columns import sigmoid
from callmeter.operators import evaluate
from callmeter.operators.ordered import running_totals

BY = {"label": "y", "score": "p"}


def frame(spark, pairs):
    return spark.createDataFrame([(y, p) for y, p in pairs], "y int, p double")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score, the rest crowd near 0."""
    rng = np.random.default_rng(3)
    p = np.concatenate([np.full(1000, 1e-9), rng.random(1500) ** 8, rng.random(500)])
    y = (rng.random(3000) < 0.1 + 0.6 * p).astype(int)
    return y, p


def rank_auc(y, p):
    order = np.sort(p)
    rank = (np.searchsorted(order, p, "left") + np.searchsorted(order, p, "right") + 1) / 2
    pos, neg = y.sum(), (1 - y).sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)


@pytest.mark.parametrize("cells", [2, 16, 2048])
def test_auc_is_exact_for_any_cell_count(spark, skewed, cells):
    y, p = skewed
    df = frame(spark, zip(y.tolist(), p.tolist())).repartition(6)
    found = evaluate.roc_auc(df, **BY, cells=cells).first()["auc"]
    assert math.isclose(found, rank_auc(y, p), rel_tol=1e-12)
    spark_auc = BinaryClassificationEvaluator(
        rawPredictionCol="p", labelCol="y", numBins=0
    ).evaluate(df)
    assert math.isclose(found, spark_auc, rel_tol=1e-9)


def test_auc_of_rounded_scores(spark, skewed):
    y, p = skewed
    df = frame(spark, zip(y.tolist(), p.tolist()))
    found = evaluate.roc_auc(df, **BY, digits=4).first()["auc"]
    assert math.isclose(found, rank_auc(y, np.round(p, 4)), rel_tol=1e-9)


def test_auc_per_group(spark, skewed):
    y, p = skewed
    df = frame(spark, zip(y.tolist(), p.tolist())).withColumn("m", F.lit("a"))
    both = df.unionByName(df.withColumn("p", -F.col("p")).withColumn("m", F.lit("b")))
    found = {r["m"]: r["auc"] for r in evaluate.roc_auc(both, **BY, groups=["m"]).collect()}
    assert math.isclose(found["a"] + found["b"], 1.0, rel_tol=1e-9)


def test_ties_count_half(spark):
    df = frame(spark, [(0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5)])
    assert evaluate.roc_auc(df, **BY).first()["auc"] == 0.5
    assert [tuple(r) for r in evaluate.roc_points(df, **BY).collect()] == [(0.5, 1.0, 1.0)]


def test_one_class(spark):
    df = frame(spark, [(0, 0.1), (0, 0.5), (0, 0.9)])
    assert evaluate.roc_auc(df, **BY).first()["auc"] is None
    assert evaluate.binary_metrics(df, **BY).first()["f1"] == 0.0
    assert evaluate.best_threshold(evaluate.threshold_sweep(df, **BY)).first()["threshold"] == 0.4
    report = {r["class"]: r for r in evaluate.report(df, **BY).collect()}
    assert report["Churn"]["recall"] == 0.0 and report["Churn"]["support"] == 0


def test_empty_and_null_scores(spark):
    df = frame(spark, [(1, None), (None, 0.4), (1, 0.9), (0, 0.1)])
    assert evaluate.roc_auc(df, **BY).first()["auc"] == 1.0
    assert tuple(evaluate.confusion(df, **BY).first()) == (1, 0, 0, 1)
    none = df.limit(0)
    assert evaluate.roc_auc(none, **BY).first()["auc"] is None
    assert evaluate.binary_metrics(none, **BY).first()["accuracy"] is None
    assert evaluate.roc_points(none, **BY).count() == 0


@pytest.mark.parametrize("cells", [3, 2048])
def test_roc_curve_keeps_what_a_plot_needs(spark, skewed, cells):
    y, p = skewed
    df = frame(spark, zip(y.tolist(), p.tolist()))
    levels = np.unique(p)[::-1]
    fps = np.array([((p >= t) & (y == 0)).sum() for t in levels])
    tps = np.array([((p >= t) & (y == 1)).sum() for t in levels])
    bend = (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0)
    keep = np.concatenate([[True], bend, [True]])
    expected = [(math.inf, 0.0, 0.0)] + [
        (t, f / fps[-1], s / tps[-1]) for t, f, s in zip(levels[keep], fps[keep], tps[keep])
    ]
    found = evaluate.roc_points(df, **BY, cells=cells, drop_collinear=True)
    rows = sorted((tuple(r) for r in found.collect()), reverse=True)
    assert np.allclose(np.array(rows)[1:], np.array(expected)[1:]) and rows[0] == expected[0]
    every = evaluate.roc_points(df, **BY, cells=cells)
    assert every.count() == len(levels)


def test_sweep_matches_brute_force(spark, skewed):
    y, p = skewed
    found = evaluate.threshold_sweep(frame(spark, zip(y.tolist(), p.tolist())), **BY)
    rows = {r["threshold"]: r for r in found.collect()}
    assert sorted(rows) == [round(0.1 + 0.05 * i, 2) for i in range(16)]
    for t, r in rows.items():
        tp, fp, fn = ((p >= t) & (y == 1)).sum(), ((p >= t) & (y == 0)).sum(), ((p < t) & (y == 1)).sum()
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert math.isclose(r["f1"], 2 * tp / (2 * tp + fp + fn))
    best = evaluate.best_threshold(found).first()
    assert best["f1"] == max(r["f1"] for r in rows.values())


def test_first_of_equal_thresholds_wins(spark):
    df = frame(spark, [(1, 0.95), (0, 0.05)])
    assert tuple(evaluate.best_threshold(evaluate.threshold_sweep(df, **BY)).first()) == (0.1, 1.0)


def test_log_loss_of_certain_scores_is_finite(spark):
    df = frame(spark, [(1, 0.0), (0, 1.0)])
    assert evaluate.log_loss(df, **BY, pos_weight=2.0).first()[0] > 30
    half = frame(spark, [(1, 0.5), (0, 0.5)])
    assert math.isclose(
        evaluate.log_loss(half, **BY, pos_weight=3.0).first()[0], 2 * math.log(2)
    )


def test_metrics_row_carries_training_figures(spark):
    df = frame(spark, [(1, 0.9), (0, 0.1)])
    row = evaluate.metrics_row(df, **BY, rounds=7, best_val_loss=0.25).first()
    assert row.asDict() == {
        "accuracy": 1.0,
        "f1_score": 1.0,
        "auc_roc": 1.0,
        "rounds": 7,
        "best_val_loss": 0.25,
    }


def test_running_totals_match_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = {(g, float(v)): int(n) for g, v, n in zip("abc" * 200, rng.integers(0, 400, 600), rng.integers(1, 9, 600))}
    df = spark.createDataFrame([(g, v, n) for (g, v), n in rows.items()], "g string, v double, n bigint")
    found = running_totals(
        df.withColumn("c", F.floor(F.col("v") / 37)), value="v", cell="c", amounts=["n"], groups=["g"]
    )
    for r in found.collect():
        same = {v: n for (g, v), n in rows.items() if g == r["g"]}
        assert r["n_before"] == sum(n for v, n in same.items() if v < r["v"])
        assert r["n_total"] == sum(same.values())


def test_sigmoid(spark):
    rows = spark.createDataFrame([(0.0,), (800.0,), (-800.0,)], "x double")
    assert [r[0] for r in rows.select(sigmoid(F.col("x"))).collect()] == [0.5, 1.0, 0.0]


def test_infinite_scores_are_ordered(spark):
    inf = float("inf")
    rows = [(0, -inf), (0, -3.0), (1, -3.0), (0, 0.5), (1, 2.0), (1, inf), (1, inf)]
    df = spark.createDataFrame(rows, "y int, p double")
    won = sum((p > n) + (p == n) / 2 for y, p in rows if y for z, n in rows if not z)
    assert math.isclose(evaluate.roc_auc(df, label="y", score="p", cells=5).first()["auc"], won / 12)
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_points(df, label="y", score="p").collect()}
    assert points[inf] == (0.0, 0.5) and points[-inf] == (1.0, 1.0)


def test_rows_are_read_once_for_any_score(spark, tmp_path):
    path = str(tmp_path / "scores")
    spark.range(5000).select((F.col("id") % 2).alias("y"), F.rand(1).alias("p")).write.parquet(path)
    totals = evaluate.roc_auc(spark.read.parquet(path), label="y", score="p")
    files = totals.inputFiles()
    assert files and all("score-counts" in f and path not in f for f in files)
