import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from callmeter.operators import models, perceptron
from callmeter.plans.usage_table import prepared
from callmeter.schema import KEY, LABEL
from conftest import SF_DIR

SIZES = [3, 4, 2]


@pytest.fixture
def held(spark):
    """24 rows in five partitions; every fourth is only measured, one has no label."""
    random = np.random.default_rng(5)
    rows = [
        (Vectors.dense(random.normal(size=3)), None if i == 3 else float(i % 3 == 0), int(i % 4 != 3) * (1 + i % 2), i % 4 != 3)
        for i in range(24)
    ]
    return spark.createDataFrame(rows, ["features", "_y", "_n", "_train"]).repartition(5)


def test_gradient_is_that_of_the_loss_and_the_network_is_sparks(spark, held):
    weights = np.random.default_rng(7).normal(size=4 * 4 + 5 * 2)
    rows = perceptron.blocks(held)
    at = lambda w: perceptron.measure(rows, w, SIZES, 1.5, 0.4)
    found = at(weights)
    network = models._network(spark, SIZES, 1, weights.tolist())
    assert np.array_equal(network.weights.toArray(), weights)
    p = models.vector_to_array("mlp_probability")
    scored = network.transform(held).select("*", p[1].alias("p"), F.when(F.col("_y") == 1, p[1]).otherwise(p[0]).alias("own"))
    loss = scored.filter("_n > 0").agg(F.sum(-F.col("_n") * F.log("own")) / F.sum("_n")).first()[0]
    assert found.loss == pytest.approx(loss, rel=1e-12)
    for i in (0, 5, 13, 16, 25):
        step = np.zeros(len(weights))
        step[i] = 1e-5
        assert found.gradient[i] == pytest.approx((at(weights + step).loss - at(weights - step).loss) / 2e-5, abs=1e-8)
    for figures, part in ((found.train, scored.filter("_train")), (found.val, scored.filter("not _train"))):
        y, guess = F.col("_y"), (F.col("p") >= 0.4).cast("int")
        row_loss = -(1.5 * y * F.log("p") + (1 - y) * F.log1p(-F.col("p")))
        want = part.agg(F.avg(row_loss), 2 * F.sum(y * guess) / (F.sum(y) + F.sum(guess))).first()
        assert figures == pytest.approx(tuple(want), rel=1e-9)
    assert np.array_equal(at(weights).gradient, found.gradient)


def test_many_partitions_are_summed_as_few(held, monkeypatch):
    weights = np.random.default_rng(7).normal(size=4 * 4 + 5 * 2)
    rows = perceptron.blocks(held)
    few = perceptron.measure(rows, weights, SIZES, 1.5, 0.4)
    monkeypatch.setattr(perceptron, "FEW", 2)
    many = perceptron.measure(rows, weights, SIZES, 1.5, 0.4)
    assert np.allclose(few.gradient, many.gradient, rtol=0, atol=1e-15) and few.loss == pytest.approx(many.loss)


def test_a_wrong_label_raises(spark):
    rows = spark.createDataFrame([(Vectors.dense([0.0]), 2.0, 1, True)], ["features", "_y", "_n", "_train"])
    with pytest.raises(Exception, match="must be 0 or 1"):
        perceptron.blocks(rows).count()


def test_steps_find_a_minimum():
    loss = lambda w: (float((w[0] - 1) ** 2 + 10 * (w[1] - w[0] ** 2) ** 2), np.array([2 * (w[0] - 1) - 40 * w[0] * (w[1] - w[0] ** 2), 20 * (w[1] - w[0] ** 2)]))
    weights, pairs = np.array([-1.2, 1.0]), []
    for _ in range(12):
        weights, pairs = perceptron.steps(loss, weights, pairs, 5)
    assert np.allclose(weights, 1, atol=1e-4)


def test_a_fit_passes_over_its_rows_about_once_an_iteration(spark, monkeypatch):
    rows, passes, real = prepared(spark, SF_DIR), [], perceptron.measure
    monkeypatch.setattr(perceptron, "measure", lambda *a: passes.append(1) or real(*a))
    columns = ["day_mins", "custserv_calls", "intl_mins", "night_calls"]
    part = lambda name: rows.filter(F.col("split") == name).select(KEY, LABEL, *columns)
    _, history = models.fit_mlp(part("train"), part("val"), columns=columns, hidden=(4,), rounds=8, patience=8, iterations=5)
    assert history.count() == 8 and len(passes) <= 1.5 * 8 * 5


@pytest.mark.parametrize("fit, most", [("forest", 32), ("perceptron", 128)])
def test_fits_take_few_partitions_until_these_are_large(spark, monkeypatch, fit, most):
    rows, placed, real = prepared(spark, SF_DIR).select(KEY, LABEL, "split", "day_mins"), [], models._placed
    monkeypatch.setattr(models, "_placed", lambda df, key, *sizes: placed.append(sizes) or real(df, key, *sizes))
    if fit == "forest":
        models.fit_forest(rows, columns=["day_mins"], trees=2, depth=2)
    else:
        train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
        models.fit_mlp(train, val, columns=["day_mins"], hidden=(2,), rounds=1, iterations=1)
    parts = lambda size: models._parts(size, *[n for sizes in placed for s in sizes for n in s])
    assert (parts(1 << 20), parts(2 << 30), parts(64 << 30)) == (1, most, 512)


def test_placing_rows_takes_few_tasks_however_many_partitions_a_shuffle_has(spark):
    rows = prepared(spark, SF_DIR).select(KEY, LABEL, "day_mins")
    sc, before = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    sc.setJobGroup("placing", "placing")
    try:
        models._placed(rows, KEY, (1 << 10, 4))
    finally:
        sc._jsc.clearJobGroup()
        spark.conf.set("spark.sql.shuffle.partitions", before)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("placing")]
    assert sum(sc.statusTracker().getStageInfo(s).numTasks for s in {s for j in jobs for s in j.stageIds}) < 300


def test_passes_in_32_bits_find_the_same(spark, held, monkeypatch):
    weights = np.random.default_rng(7).normal(size=4 * 4 + 5 * 2)
    rows = perceptron.blocks(held)
    wide = perceptron.measure(rows, weights, SIZES, 1.5, 0.4)
    narrow = perceptron.measure(rows, weights, SIZES, 1.5, 0.4, np.float32)
    assert narrow.loss == pytest.approx(wide.loss, rel=1e-6) and np.allclose(narrow.gradient, wide.gradient, rtol=0, atol=1e-6)
    for a, b in ((narrow.train, wide.train), (narrow.val, wide.val)):
        assert a == pytest.approx(b, rel=1e-6) and a[1] == b[1]
    x = np.random.default_rng(9).normal(size=(50, 3))
    scores = perceptron._outputs(perceptron._layers(weights, SIZES), x)[-1][:, 1]
    for threshold in np.concatenate([scores - 1e-11, scores + 1e-11]):  # as 32 bits cannot tell
        cells = tuple(v.tobytes() for v in (x, np.ones(50), np.ones(50), np.ones(50)))
        one = spark.sparkContext.parallelize([cells], 1)
        monkeypatch.setattr(perceptron, "_summed", lambda rows, task: task(perceptron._arrays(iter([cells]))))
        same = [perceptron.measure(one, weights, SIZES, 1.5, float(threshold), kind).train[1] for kind in (np.float64, np.float32)]
        assert same[0] == same[1]


def test_rows_that_are_only_measured_come_last_in_a_block(held):
    found = perceptron.blocks(held).collect()
    taken = [np.frombuffer(n, np.float64) > 0 for _, _, n, _ in found]
    assert all((np.diff(t.astype(int)) <= 0).all() for t in taken) and sum(t.sum() for t in taken) == 18


def test_a_fit_computes_its_passes_in_32_bits(spark, monkeypatch):
    rows, kinds, real = prepared(spark, SF_DIR).select(KEY, LABEL, "split", "day_mins"), [], perceptron.measure
    monkeypatch.setattr(perceptron, "measure", lambda *a: kinds.append(a[-1]) or real(*a))
    models.fit_mlp(rows.filter("split = 'train'"), rows.filter("split = 'val'"), columns=["day_mins"], hidden=(2,), rounds=1, iterations=1)
    assert set(kinds) == {np.float32}
