"""Scaling, class weights and the two classifiers, on Spark ML.

Scaling is a stage of the model itself, so training and scoring always share it.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.functions.columns import DECISION_THRESHOLD, content_digest, decide, hash_number
from callmeter.operators import perceptron
from callmeter.operators.reshape import cell, one_row_per_column
from callmeter.schema import KEY, LABEL
from callmeter.sources.folders import Publication
from callmeter.sources.scratch import scratch_path

# Widths of the network's hidden layers, rounds, patience, weight factor.
HIDDEN = (128, 64, 32)
ROUNDS = 50
PATIENCE = 5
WEIGHT_FACTOR = 0.4
SEED = 42


def preprocess_stages(columns: Sequence[str]) -> list:
    """Assemble the columns and standardise them by mean and sample deviation.

    A null raises, as a model cannot score it; a constant column becomes 0.
    """
    return [
        VectorAssembler(
            inputCols=list(columns), outputCol="features_raw", handleInvalid="error"
        ),
        StandardScaler(
            inputCol="features_raw", outputCol="features", withMean=True, withStd=True
        ),
    ]


def fit_scaler(df: DataFrame, *, columns: Sequence[str]) -> PipelineModel:
    """Fit on the train rows only."""
    return Pipeline(stages=preprocess_stages(columns)).fit(df)


def scale(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add the scaled vector ``features``; all splits go through in one pass."""
    return model.transform(df).drop("features_raw")


def scaled_columns(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Like ``scale``, with one ``<column>_scaled`` per input instead of a vector."""
    values = vector_to_array("features")
    names = model.stages[0].getInputCols()
    return scale(df, model).select(
        *df.columns, *[values[i].alias(f"{c}_scaled") for i, c in enumerate(names)]
    )


def fitted_scaler_params(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Mean and deviation held by a fitted scaler, one row per column."""
    assembler, scaler = model.stages
    rows = [
        (c, float(m), float(s))
        for c, m, s in zip(assembler.getInputCols(), scaler.mean, scaler.std)
    ]
    return df.sparkSession.createDataFrame(rows, "column string, mean double, stddev double")


def scaler_params(
    df: DataFrame, *, columns: Sequence[str], population: bool = False
) -> DataFrame:
    """Mean and deviation per column; ``population`` divides by n instead of n - 1."""
    deviation = F.stddev_pop if population else F.stddev_samp
    wide = df.agg(
        *[F.avg(c).alias(cell(c, "mean")) for c in columns],
        *[deviation(c).alias(cell(c, "stddev")) for c in columns],
    )
    return one_row_per_column(wide, columns, ["mean", "stddev"])


def class_weights(
    df: DataFrame, *, label: str, factor: float = WEIGHT_FACTOR
) -> DataFrame:
    """Class sizes, the weight of positives in the loss, and balanced class weights."""
    counted = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    neg, pos = F.col("negatives"), F.col("positives")
    return counted.select(
        "*",
        (F.try_divide(neg, pos) * factor).alias("pos_weight"),
        F.try_divide(neg + pos, 2 * neg).alias("negative_weight"),
        F.try_divide(neg + pos, 2 * pos).alias("positive_weight"),
    )


def balanced_weight(df: DataFrame, *, label: str, name: str = "weight") -> DataFrame:
    """Add each row's balanced class weight, n / (2 * rows of its class)."""
    weights = class_weights(df, label=label).first()
    return df.withColumn(
        name,
        F.when(F.col(label) == 1, F.lit(weights["positive_weight"])).when(
            F.col(label) == 0, F.lit(weights["negative_weight"])
        ),
    )


def copies(label: Column, key: Column, weight: float, *, seed: int) -> Column:
    """How often a row is taken so that positives count ``weight`` times on average.

    The whole part of the weight for sure, one more if the hash of the key falls into the
    fraction: the same answer on every run.
    """
    whole = math.floor(weight)
    chance = hash_number(key, seed=seed) / F.lit(float(1 << 32))
    return F.when(label == 1, F.when(chance < weight - whole, whole + 1).otherwise(whole)).otherwise(1)


def weighted_resample(
    df: DataFrame,
    *,
    label: str,
    key: str,
    weight: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Repeat positive rows to carry their weight into a model without weights.

    Adds ``copy`` (from 1). A weight below 1 thins the positives out. No shuffle. Without
    ``weight`` it is the ``pos_weight`` of ``class_weights``; a ValueError if a class has no rows.
    """
    if weight is None:
        weight = class_weights(df, label=label).first()["pos_weight"]
        if not weight:
            raise ValueError("a weight follows from rows of both classes; give one")
    n = copies(F.col(label), F.col(key), weight, seed=seed)
    taken = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return df.select("*", F.explode(taken).alias("copy"))


#: Bytes of a partition of a fit: small ones up to a number of partitions, since fits are heavy on
#: computing, then as many partitions until they are of the larger size.
_SMALL_PART, _MANY_PARTS, _LARGE_PART = 1 << 20, 1024, 128 << 20
#: Where hundreds of passes follow, fewer and larger ones: every task of every pass costs its start
#: and reports to the driver.
_PASSES = (4 << 20, 128)
#: Where trees grow: every partition sends the counts of every node of a level, however few its rows.
_LEVELS = (2 << 20, 32)


def _parts(size: int, small: int = _SMALL_PART, many: int = _MANY_PARTS) -> int:
    """How many partitions rows of ``size`` bytes take; nothing but the data decides."""
    return max(1, min(-(-size // small), many), -(-size // _LARGE_PART))


def _bytes(df: DataFrame) -> Column:
    """Bytes of a row: eight for each value, and the letters of texts."""
    letters = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    return sum(letters, F.lit(8 * len(df.columns)).cast("long"))


def _placed(df: DataFrame, key: str, sizes: tuple[int, int] = (_SMALL_PART, _MANY_PARTS)) -> DataFrame:
    """Rows placed by their content, in partitions sized by the data, ordered by key and content.

    Where a row goes depends on nothing but the row, so that fits do not depend on how the input
    lay, and rows that share a key, or have none, spread as others do. Rows move once. Counts
    taken beforehand say how many bytes there are and which contents fill more than half a
    partition (fewer than two for each partition); those rows are left out of the shuffle and
    made anew from one copy and their count, in portions of a quarter of a partition at most.
    """
    columns = df.columns
    size = df.select(_bytes(df).alias("_bytes")).agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    parts, heavy = _parts(size[0], *sizes), {}
    if parts > 1:
        # Counts are not held: what is held keeps all its shuffle's partitions, and each reports to the driver.
        counted = df.select(content_digest(df).alias("_content"), _bytes(df).alias("_bytes"))
        counted = counted.groupBy("_content").agg(F.count("*").alias("_n"), F.sum("_bytes").alias("_bytes"))
        frequent = counted.where((F.col("_bytes") * 2 * parts > size[0]) & (F.col("_n") > 1))
        heavy = {tuple(r["_content"]): r for r in frequent.collect()}
    rows = df.select("*", content_digest(df).alias("_content"), F.lit(0).alias("_portion"), F.lit(1).alias("_copies"))
    if heavy:
        spark = df.sparkSession
        listed = F.array(*(F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in heavy))
        is_heavy = F.array_contains(listed, F.col("_content"))
        made = []
        for row in rows.where(is_heavy).dropDuplicates(["_content"]).collect():
            found = heavy[tuple(row["_content"])]
            n, portions = found["_n"], min(parts, found["_n"], -(-4 * parts * found["_bytes"] // size[0]))
            made += [(*row[: len(columns)], row["_content"], i, n // portions + (i < n % portions)) for i in range(portions)]
        rows = rows.where(~is_heavy).unionByName(spark.createDataFrame(made, rows.schema))
    placed = rows.repartitionById(parts, F.pmod(F.col("_content.a") + F.col("_portion"), F.lit(parts)).cast("int"))
    placed = placed.sortWithinPartitions(key, "_content", "_portion")
    if not heavy:
        return placed.select(*columns)
    return placed.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_one")).drop("_one")


def parameter_count(model: PipelineModel) -> int:
    return model.stages[-1].weights.size


@dataclass
class Training:
    """Where a fit in rounds stands: all it needs to go on."""

    settings: str
    pos_weight: float
    weights: list[float] | None = None
    best_loss: float = math.inf
    stale: int = 0
    history: list[tuple] = field(default_factory=list)
    pairs: list[dict] = field(default_factory=list)

    HISTORY = "round int, train_loss double, val_loss double, train_f1 double, val_f1 double"

    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.settings, self.pos_weight, self.weights, self.best_loss, self.stale, self.history, self.pairs)
        history = "array<struct<round:int,train_loss:double,val_loss:double,train_f1:double,val_f1:double>>"
        kind = f"settings string, pos_weight double, weights array<double>, best_loss double, stale int, history {history}, pairs array<struct<s:array<double>,y:array<double>>>"
        spark.createDataFrame([row], kind).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Training:
        row = spark.read.parquet(path).first()
        return cls(**{**row.asDict(), "history": [tuple(h) for h in row["history"]], "pairs": list(row["pairs"])})


def _settings(**what) -> str:
    """Names what must be the same for a fit to be continued."""
    return hashlib.sha256(json.dumps(what, sort_keys=True).encode()).hexdigest()


def fit_mlp(
    train: DataFrame,
    val: DataFrame,
    *,
    columns: Sequence[str],
    label: str = LABEL,
    key: str = KEY,
    hidden: Sequence[int] = HIDDEN,
    rounds: int = ROUNDS,
    patience: int = PATIENCE,
    iterations: int = 5,
    threshold: float = DECISION_THRESHOLD,
    factor: float = WEIGHT_FACTOR,
    seed: int = SEED,
    save_best: str | None = None,
    resume: bool = False,
) -> tuple[PipelineModel, DataFrame]:
    """Train a perceptron in rounds and keep the one with the lowest validation loss.

    Each round continues from the weights of the last for a few solver iterations (L-BFGS,
    which keeps what it learnt of the loss's curvature from round to round), then
    one pass measures loss and F1 on both sets. Training ends after ``patience`` rounds
    without a lower validation loss. Positives are weighted by repetition: a row counts as
    often as ``copies`` tells. The best weights become Spark's network.

    With ``save_best`` every round publishes the state of the training there, and the best
    model if it is new. ``resume`` continues from what was published last: with the scaler,
    weights, history and count of stale rounds of then, so that the rounds are those of a
    fit that was never interrupted. ``rounds`` and ``patience`` may differ; if anything else
    does, or the data has other class sizes, it raises. Without a state it starts anew.

    Returns the best model (assembler, scaler, network) and the history, a row per round.
    Raises ValueError if there are no validation rows, or no rows of either class to train on.
    """
    spark = train.sparkSession
    published = Publication(spark, save_best) if save_best else None
    sizes = class_weights(train, label=label, factor=factor).first()
    if not (sizes["positives"] and sizes["negatives"]):
        raise ValueError(f"training needs rows of both classes, it has {sizes['positives']} positives and {sizes['negatives']} negatives")
    settings = _settings(
        columns=list(columns), label=label, key=key, hidden=list(hidden), iterations=iterations,
        threshold=threshold, factor=factor, seed=seed, sizes=[sizes["negatives"], sizes["positives"]],
    )
    parts = published.current() if published and resume else {}
    if parts:
        state, best = Training.load(spark, parts["state"]), PipelineModel.load(parts["model"])
        if state.settings != settings:
            raise ValueError(f"{save_best} holds a training with other settings or other rows")
        scaler, best = PipelineModel(stages=best.stages[:2]), best.stages[2]
    else:
        state, best = Training(settings, float(sizes["pos_weight"])), None
        scaler = fit_scaler(train, columns=columns)
    finished = lambda: len(state.history) >= rounds or state.stale >= patience
    if finished():
        return PipelineModel(stages=[*scaler.stages, best]), spark.createDataFrame(state.history, Training.HISTORY)

    # The solver reads its rows once per step, so both sets are scaled and held once. A pass is computed
    # in 32 bits, which its sums over many rows even out; sums, losses and decisions are as in 64.
    # Rows are placed before they are scaled: the scaler's last digits depend on the input's layout.
    both = (
        train.select(*columns, label, key)
        .withColumn("_part", F.lit("train"))
        .unionByName(val.select(*columns, label, key).withColumn("_part", F.lit("val")))
    )
    is_train, y = F.col("_part") == "train", F.col(label).cast("double")
    taken = copies(y, F.col(key), state.pos_weight, seed=seed)
    rows = perceptron.blocks(
        scale(_placed(both, key, _PASSES), scaler).select(
            "features", y.alias("_y"), F.when(is_train, taken).otherwise(0).alias("_n"), is_train.alias("_train")
        )
    )
    sizes = [len(columns), *hidden, 2]
    try:
        find = perceptron.remembered(lambda weights: perceptron.measure(rows, weights, sizes, state.pos_weight, threshold, np.float32))
        if state.weights is None:
            state.weights = _network(spark, sizes, seed).weights.toArray().tolist()
        while not finished():
            before = [(np.array(p["s"]), np.array(p["y"])) for p in state.pairs]
            weights, pairs = perceptron.steps(lambda at: find(at)[:2], np.array(state.weights), before, iterations)
            figures = _round_figures(find(weights))
            state.weights, state.pairs = weights.tolist(), [{"s": s.tolist(), "y": y.tolist()} for s, y in pairs]
            state.history.append((len(state.history) + 1, *figures))
            better = figures[1] < state.best_loss
            if better:
                best, state.best_loss, state.stale = state.weights, figures[1], 0
            else:
                state.stale += 1
            if best is None:
                raise ValueError(f"the validation loss of the first round is {figures[1]}")
            if published:
                if better:
                    best = _network(spark, sizes, seed, best)
                found = PipelineModel(stages=[*scaler.stages, best])
                published.publish(
                    {"model": found.save if better else None, "state": lambda path: state.save(spark, path)}
                )
    finally:
        rows.unpersist()
    if isinstance(best, list):
        best = _network(spark, sizes, seed, best)
    return PipelineModel(stages=[*scaler.stages, best]), spark.createDataFrame(state.history, Training.HISTORY)


def _network(
    spark: SparkSession, sizes: Sequence[int], seed: int, weights: Sequence[float] | None = None
) -> MultilayerPerceptronClassificationModel:
    """Spark's network with these weights, or with those it begins with: a fit of no iteration."""
    network = MultilayerPerceptronClassifier(
        layers=list(sizes),
        featuresCol="features",
        labelCol="_y",
        predictionCol="mlp_prediction",
        probabilityCol="mlp_probability",
        rawPredictionCol="mlp_raw",
        maxIter=0,
        seed=seed,
    )
    if weights is not None:
        network.setInitialWeights(Vectors.dense(weights))
    return network.fit(spark.createDataFrame([(Vectors.dense([0.0] * sizes[0]), float(c)) for c in (0, 1)], ["features", "_y"]).coalesce(1))


def _round_figures(found: perceptron.Measured) -> tuple[float, float, float, float]:
    """Train and validation loss, then train and validation F1."""
    if found.val is None:
        raise ValueError("there are no validation rows to measure a round on")
    return tuple(part[i] for i in range(2) for part in (found.train, found.val))


def fit_forest(
    train: DataFrame,
    *,
    columns: Sequence[str],
    label: str = LABEL,
    key: str = KEY,
    trees: int = 100,
    depth: int = 10,
    seed: int = SEED,
) -> PipelineModel:
    """Random forest with balanced class weights, on unscaled columns.

    Spark grows trees level by level to a set depth (30 at most), so ``depth`` is the size
    control that an unlimited single-machine tree lacks.
    """
    ready = _placed(balanced_weight(train.select(*columns, label, key), label=label), key, _LEVELS)
    forest = RandomForestClassifier(
        featuresCol="features_rf",
        labelCol=label,
        predictionCol="rf_prediction",
        probabilityCol="rf_probability",
        rawPredictionCol="rf_raw",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
    )
    assembler = VectorAssembler(
        inputCols=list(columns), outputCol="features_rf", handleInvalid="error"
    )
    fitted = Pipeline(stages=[assembler, forest]).fit(ready)
    # What comes back is read from files: the summary of a fit holds on to the session, which
    # cannot go to tasks any more once a write of that session has been observed.
    path = scratch_path(train.sparkSession, "forest")
    fitted.save(path)
    return PipelineModel.load(path)
