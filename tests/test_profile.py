import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from callmeter.operators import profile


@pytest.fixture(scope="module")
def numbers(spark):
    """Skewed values: a third of the rows share one value."""
    rng = np.random.default_rng(7)
    x = np.round(rng.lognormal(0, 1.5, 3000), 3)
    x[:1000] = 0.25
    y = rng.integers(0, 6, 3000).astype(float)
    label = rng.random(3000) < 0.3
    rows = [(float(a), float(b), bool(c)) for a, b, c in zip(x, y, label)]
    rows += [(None, 1.0, True), (2.0, None, None)]
    return spark.createDataFrame(rows, "x double, y double, churn boolean").repartition(5)


def values(df, column, **where):
    rows = df.collect()
    return np.array(
        [r[column] for r in rows if r[column] is not None and all(r[k] == v for k, v in where.items())]
    )


def test_histogram_matches_numpy(numbers):
    found = {(r["column"], r["bin"]): r for r in profile.histogram(numbers, columns=["x", "y"]).collect()}
    for c in ("x", "y"):
        counts, edges = np.histogram(values(numbers, c), bins=30)
        assert [found[c, i]["count"] for i in range(30)] == counts.tolist()
        assert np.allclose([found[c, i]["bin_start"] for i in range(30)], edges[:-1])


def test_histogram_edges(spark):
    rows = [(float(i), 4.0, None) for i in range(31)] + [(None, 4.0, None), (math.nan, 4.0, math.nan)]
    df = spark.createDataFrame(rows, "a double, constant double, empty double")
    found = profile.histogram(df, columns=["a", "constant", "empty"]).collect()
    a = {r["bin"]: r["count"] for r in found if r["column"] == "a"}
    assert a == {**{i: 1 for i in range(29)}, 29: 2}
    constant = {r["bin"]: r["count"] for r in found if r["column"] == "constant"}
    assert constant == {i: 33 if i == 15 else 0 for i in range(30)}
    assert not [r for r in found if r["column"] == "empty"]


@pytest.mark.parametrize("cells", [2, 7, 2048])
def test_box_stats_match_brute_force(numbers, cells):
    found = profile.box_stats(numbers, columns=["x", "y"], by="churn", cells=cells).collect()
    assert len(found) == 4
    for r in found:
        v = values(numbers, r["column"], churn=r["class"] == "Churn")
        q1, median, q3 = np.percentile(v, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert np.allclose([r["q1"], r["median"], r["q3"]], [q1, median, q3])
        assert r["count"] == len(v)
        assert r["whisker_low"] == min(v[v >= low].min(), q1)
        assert r["whisker_high"] == max(v[v <= high].max(), q3)
        assert r["outliers"] == ((v < low) | (v > high)).sum()


def test_approximate_box_stats_are_close(numbers):
    exact = profile.box_stats(numbers, columns=["x"], by="churn")
    close = profile.box_stats(numbers, columns=["x"], by="churn", approx=True)
    a = {r["class"]: r for r in exact.collect()}
    for r in close.collect():
        assert math.isclose(r["median"], a[r["class"]]["median"], rel_tol=0.05)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame(
        [(float(i), 2.0 * i, 5.0) for i in range(5)], "a double, b double, c double"
    )
    r = {(x["col_a"], x["col_b"]): x["r"] for x in profile.correlation(df, columns=["a", "b", "c"]).collect()}
    assert math.isclose(r["a", "b"], 1.0)
    assert r["a", "c"] is None and r["c", "c"] == 1.0


def test_correlation_with_nulls(numbers):
    with pytest.raises(Exception):
        profile.correlation(numbers, columns=["x", "y"]).collect()
    skipped = profile.correlation(numbers, columns=["x", "y"], handle_invalid="skip")
    assert skipped.count() == 4


def test_nulls_duplicates_and_shape(spark, numbers):
    assert {r["column"]: r["nulls"] for r in profile.nulls(numbers).collect()} == {
        "x": 1,
        "y": 1,
        "churn": 1,
    }
    pairs = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, 3), (4, 4), (5, 5)], "a int, b int")
    assert tuple(profile.duplicates(pairs).first()) == (6, 4, 2)
    assert tuple(profile.shape(pairs).first()) == (6, 2)
    assert tuple(profile.duplicates(pairs.limit(0)).first()) == (0, 0, 0)


def test_describe(numbers):
    r = profile.describe(numbers, columns=["x"]).first()
    v = values(numbers, "x")
    assert (r["count"], r["min"], r["max"]) == (len(v), v.min(), v.max())
    assert math.isclose(r["mean"], v.mean()) and math.isclose(r["stddev"], v.std(ddof=1))


def test_partitions_and_dtypes(numbers):
    parts = profile.partitions(numbers).collect()
    assert len(parts) == 5 and sum(p["rows"] for p in parts) == 3002
    kinds = [(r["position"], r["column"], r["type"], r["present"]) for r in profile.dtypes(numbers).collect()]
    assert kinds[0] == (1, "x", "double", 3001)


def test_class_distribution_is_ordered(numbers):
    assert [r["churn"] for r in profile.class_distribution(numbers, label="churn").collect()] == [
        None,
        False,
        True,
    ]


def test_correlation_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 1, (500, 4))
    x[:, 1] += x[:, 0]
    x[:, 3] = 7.25
    holes = rng.random((500, 4)) < 0.2
    names = ["a", "b", "c", "d"]
    rows = [tuple(None if h else float(v) for v, h in zip(r, hr)) for r, hr in zip(x, holes)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    kept = {
        "skip": lambda i, j: ~holes.any(1),
        "pairwise": lambda i, j: ~holes[:, i] & ~holes[:, j],
    }
    for mode, mask in kept.items():
        found = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation(df, columns=names, handle_invalid=mode).collect()}
        assert len(found) == 16
        for i, a in enumerate(names):
            for j, b in enumerate(names):
                m = mask(i, j)
                if i == j:
                    assert found[a, b] == 1.0
                elif 3 in (i, j):
                    assert found[a, b] is None
                else:
                    assert math.isclose(found[a, b], np.corrcoef(x[m, i], x[m, j])[0, 1], abs_tol=1e-9)
    with pytest.raises(ValueError, match="missing in a, b, c, d"):
        profile.correlation(df, columns=names)


def test_co_moments_are_one_aggregate(numbers):
    plain = numbers.select(F.col("x").alias("x0"), F.col("y").alias("x1"))
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    sums = profile._co_moments(plain, [0.0, 0.0], gaps=True)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert shuffles(sums) == shuffles(plain) + 1 and "ObjectHashAggregate" not in plan and "DeserializeToObject" not in plan


def test_correlation_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b double")
    for mode in ("error", "skip", "pairwise"):
        found = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation(df, columns=["a", "b"], handle_invalid=mode).collect()}
        assert found == {("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): None, ("b", "a"): None}
    inf = spark.createDataFrame([(1.0, 2.0, 5.0), (float("inf"), 3.0, 7.5), (2.0, 9.0, 1.0)], "a double, b double, c double")
    found = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation(inf, columns=["a", "b", "c"]).collect()}
    assert found["a", "b"] is None and math.isclose(found["b", "c"], np.corrcoef([2, 3, 9], [5, 7.5, 1])[0, 1])


def test_histogram_with_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (-inf, 0.0, 1.0, 2.0, 4.0, inf, inf, float("nan"), None)], "x double")
    found = profile.histogram(df, columns=["x"], bins=4).orderBy("bin").collect()
    assert [(r["bin_start"], r["count"]) for r in found] == [(0.0, 2), (1.0, 1), (2.0, 1), (3.0, 3)]
    none = df.where("x = double('inf')")
    assert profile.histogram(none, columns=["x"], bins=4).collect() == []


def test_box_stats_with_infinities(spark):
    inf = float("inf")
    rows = [(float(v), True) for v in range(101)] + [(inf, True), (-inf, True)]
    found = profile.box_stats(spark.createDataFrame(rows, "x double, y boolean"), columns=["x"], by="y", cells=7).first()
    assert (found["median"], found["count"], found["outliers"]) == (50.0, 103, 2)
    assert (found["whisker_low"], found["whisker_high"]) == (0.0, 100.0)


def test_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 4).alias("day"), F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    parts = profile.quantile_sketches(df, columns=["x", "y"], by=["day"])
    assert parts.count() == 8
    found = profile.sketched_quantiles(profile.merged_sketches(parts), quantiles=[0.1, 0.5, 0.9]).collect()
    got = {(r["column"], r["quantile"]): (r["values"], r["value"]) for r in found}
    for q in (0.1, 0.5, 0.9):
        assert got["x", q][0] == 20_000 and abs(got["x", q][1] - q * 20_000) < 0.002 * 20_000
        assert got["y", q] == (0, None)


def test_cells_follow_the_values_and_end_at_infinity(spark):
    from callmeter.operators import ordered

    inf = float("inf")
    df = spark.range(10_000).select((F.col("id") % 5000).cast("double").alias("x"))
    edges = ordered.cell_edges(df, ["x"])
    assert 8 <= len(edges[0]) + 1 <= 11  # 5,000 values, 512 of them to a cell, by sketch
    odd = spark.createDataFrame([(-inf,), (-1.0,), (9999.0,), (inf,)], "x double")
    cells = [r["c"] for r in ordered.with_cells(odd, ["x"], ["c"], edges).orderBy("x").collect()]
    assert cells == [-1, 0, len(edges[0]), len(edges[0]) + 1]
    assert ordered.cell_edges(df.select(F.lit(inf).alias("x")), ["x"]) == [[]]


def test_duplicates_tell_nulls_and_zeros_apart(spark):
    rows = [(1, None), (None, 1), (None, None), (None, None), (0, 1), (0, 1)]
    assert tuple(profile.duplicates(spark.createDataFrame(rows, "a int, b int")).first()) == (6, 4, 2)
    zeros = spark.createDataFrame([(0.0, "x"), (-0.0, "x"), (float("nan"), ""), (float("nan"), "")], "a double, b string")
    assert tuple(profile.duplicates(zeros).first()) == (4, 2, 2)


def test_duplicates_shuffle_digests_only(spark):
    wide = spark.range(100).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(16)])
    plan = profile.duplicates(wide)._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan.split("\n") if "Exchange hashpartitioning" in line)
    assert "c15" not in exchange and plan.count("Exchange hashpartitioning") == 1
