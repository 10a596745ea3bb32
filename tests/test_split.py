import pytest
from pyspark.sql import functions as F

from callmeter.operators import split
from callmeter.schema import KEY, LABEL, SPLITS


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.range(5000).select(
        F.col("id").alias(KEY),
        F.when(F.col("id") % 7 == 0, 1).when(F.col("id") % 11 == 0, None).otherwise(0).alias(LABEL),
        (F.col("id") % 500).cast("double").alias("x"),
    )


def assigned(df):
    return {r[KEY]: r["split"] for r in df.collect()}


@pytest.mark.parametrize("how", ["random", "stratified", "content"])
def test_split_does_not_depend_on_partitioning(accounts, how):
    cut = {
        "random": lambda df: split.random_split(df, key=KEY),
        "stratified": lambda df: split.stratified_split(df, key=KEY, label=LABEL),
        "content": lambda df: split.content_split(df, columns=["x"]),
    }[how]
    first = assigned(cut(accounts.repartition(1)))
    assert len(first) == 5000 and set(first.values()) == set(SPLITS)
    assert assigned(cut(accounts.repartition(8, "x"))) == first
    assert assigned(cut(accounts.orderBy(F.desc(KEY)))) == first


def test_random_split_shares_and_seed(accounts):
    one = assigned(split.random_split(accounts, key=KEY))
    other = assigned(split.random_split(accounts, key=KEY, seed=7))
    assert one != other
    train = sum(s == "train" for s in one.values()) / 5000
    assert 0.67 < train < 0.73
    halves = assigned(split.random_split(accounts, key=KEY, shares=(1, 1, 0)))
    assert set(halves.values()) == {"train", "val"}


@pytest.mark.parametrize("shares", [(70, 15, 15), (1, 1, 1), (8, 2, 0)])
def test_stratified_quotas_are_exact_per_class(accounts, shares):
    found = split.stratified_split(accounts, key=KEY, label=LABEL, shares=shares)
    sizes = {(r[LABEL], r["split"]): r["count"] for r in found.groupBy(LABEL, "split").count().collect()}
    whole = sum(shares)
    for y in (0, 1, None):
        n = sum(v for (label, _), v in sizes.items() if label == y)
        train, val = n * shares[0] // whole, n * (shares[0] + shares[1]) // whole
        assert [sizes.get((y, s), 0) for s in SPLITS] == [train, val - train, n - val]


def test_stratified_split_with_a_hot_key(accounts):
    # A third of the rows share one key: they stay together, the rest fills the shares.
    hot = accounts.withColumn(KEY, F.when(F.col(KEY) % 3 == 0, 77).otherwise(F.col(KEY)))
    hot = hot.filter(F.col(LABEL) == 0).select(KEY, LABEL)
    found = split.stratified_split(hot, key=KEY, label=LABEL)
    homes = found.groupBy(KEY).agg(F.countDistinct("split").alias("n"))
    assert homes.filter("n > 1").count() == 0
    ordered = [r["split"] for r in found.orderBy(F.sha2(F.concat(F.lit("42|"), F.col(KEY)), 256)).collect()]
    assert ordered == sorted(ordered, key=list(SPLITS).index)
    copies = found.filter(F.col(KEY) == 77).count()
    sizes = {r["split"]: r["count"] for r in found.groupBy("split").count().collect()}
    assert sizes["train"] <= len(ordered) * 0.7 < sizes["train"] + copies + 1


def test_stratified_split_of_few_rows(accounts):
    few = accounts.filter(F.col(KEY) < 3)
    found = split.stratified_split(few, key=KEY, label=LABEL)
    assert found.count() == 3
    assert split.stratified_split(few.limit(0), key=KEY, label=LABEL).count() == 0


def test_rows_are_not_shuffled_by_any_split(accounts, tmp_path, spark):
    accounts.write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(split.random_split(df, key=KEY))
    assert "Exchange" not in plan(split.content_split(df, columns=["x"]))


def test_equal_contents_stay_together(accounts):
    found = split.content_split(accounts, columns=["x"])
    assert split.overlap(found, columns=["x"]).agg(F.sum("shared_contents")).first()[0] == 0
    by_key = split.random_split(accounts, key=KEY)
    shared = {(r[0], r[1]): r[2] for r in split.overlap(by_key, columns=["x"]).collect()}
    homes = {}
    for r in by_key.collect():
        homes.setdefault(r["x"], set()).add(r["split"])
    for (a, b), n in shared.items():
        assert n == sum({a, b} <= h for h in homes.values())


def test_row_hash_reads_null_as_text(spark):
    df = spark.createDataFrame([(1, None), (1, "NULL"), (None, "1")], "a int, b string")
    hashes = [r["row_hash"] for r in split.row_hash(df, columns=["a", "b"]).collect()]
    assert hashes[0] == hashes[1] != hashes[2]
    assert len(hashes[0]) == 64
    assert split.distinct_contents(df, columns=["a", "b"]).count() == 2


def test_reconcile_finds_lost_rows(accounts):
    found = split.random_split(accounts, key=KEY)
    assert split.reconcile(accounts, found).first()["difference"] == 0
    lost = found.filter(F.col("split") != "val")
    r = split.reconcile(accounts, lost).first()
    assert r["difference"] == 5000 - lost.count() and r["val_rows"] == 0


def test_contrast_sample(accounts):
    rows = split.contrast_sample(accounts, label=LABEL, key=KEY).collect()
    assert [(r["client_id"], r[KEY], r[LABEL]) for r in rows] == [
        (1, 0, 1),
        (2, 7, 1),
        (3, 14, 1),
        (4, 1, 0),
        (5, 2, 0),
    ]
    few = accounts.filter(F.col(LABEL) == 0)
    assert split.contrast_sample(few, label=LABEL, key=KEY).count() == 2


def test_split_by_ids_and_summary(accounts):
    ids = split.random_split(accounts.select(KEY), key=KEY)
    joined = split.split_by_ids(accounts, ids.filter("split = 'val'"), key=KEY)
    direct = split.random_split(accounts, key=KEY).filter("split = 'val'")
    assert assigned(joined) == assigned(direct)
    parts = split.summary(split.random_split(accounts, key=KEY), label=LABEL).collect()
    assert abs(sum(p["share"] for p in parts) - 1) < 1e-12
