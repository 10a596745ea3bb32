"""The work from raw file to predictions, one function per stage.

Stages meet in files, as a user would run them: convert a CSV, prepare the rows, train and
measure, score. Each is a handful of operators; none passes rows through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmeter.functions.columns import DECISION_THRESHOLD, FOREST_THRESHOLD
from callmeter.operators import clean, evaluate, features, models, score, split
from callmeter.schema import FEATURES, IDENTIFIER, LABEL, MEASURES, SOURCE_SCHEMA
from callmeter.sources import usage_io
from callmeter.sources.scratch import scratch_path

PROBABILITIES = ["mlp_prob", "rf_prob"]


def convert(
    spark: SparkSession, csv_path: str, out: str, *, schema: T.StructType = SOURCE_SCHEMA
) -> DataFrame:
    """CSV to Parquet in one pass, columns renamed; returns the storage comparison.

    Lines that are no rows and rows with a cell that is not of its column's type go to
    ``<out>_rejects`` with the names of their faults.
    """
    return usage_io.convert_csv(spark, csv_path, out, schema=schema)


def preprocess(
    df: DataFrame,
    out: str,
    *,
    key: str = IDENTIFIER,
    threshold: float = clean.EXTREME_THRESHOLD,
    seed: int = split.SEED,
) -> DataFrame:
    """Set extreme rows apart, split the rest, add features; returns the counts by status.

    Writes ``prepared`` (partitioned by split), ``anomalies`` and ``unknown`` below
    ``out``. The key decides the split and stays as row identity; no model reads it.
    """
    labelled = clean.base(df, drop=[c for c in [IDENTIFIER] if c != key], label=LABEL)
    flagged = clean.zscore_status(labelled, columns=MEASURES, threshold=threshold)
    rows = split.random_split(clean.clean_rows(flagged), key=key, seed=seed)
    usage_io.write_usage(
        features.add_features(rows), f"{out}/prepared", partition_by=["split"]
    )
    usage_io.write_usage(clean.anomaly_rows(flagged), f"{out}/anomalies")
    usage_io.write_usage(clean.unknown_rows(flagged), f"{out}/unknown")
    return clean.anomaly_rate(flagged)


def train(prepared: DataFrame, out: str, *, key: str = IDENTIFIER, **options) -> DataFrame:
    """Fit both models, save them, and measure them on the test rows.

    The threshold of the ensemble is chosen on validation rows. Writes ``mlp``, ``rf``,
    ``history`` and ``metrics`` below ``out``; returns the comparison of the models.
    ``options`` go to the network (``hidden``, ``rounds``, ``patience``, ``iterations``)
    and to the forest (``trees``, ``depth``).
    """
    forest_options = {k: options.pop(k) for k in ("trees", "depth") if k in options}
    features.require_columns(prepared, [*FEATURES, LABEL, key, "split"])
    part = lambda name: prepared.filter(F.col("split") == name)
    mlp, history = models.fit_mlp(
        part("train"),
        part("val"),
        columns=FEATURES,
        key=key,
        save_best=f"{out}/mlp",
        **options,
    )
    forest = models.fit_forest(part("train"), columns=FEATURES, key=key, **forest_options)
    usage_io.save_model(forest, f"{out}/rf")
    usage_io.write_usage(history, f"{out}/history")

    # Scored once and stored: every figure below reads three columns of it.
    usage_io.write_usage(
        _scored(prepared.filter(F.col("split") != "train"), mlp, forest).select(
            key, LABEL, "split", *PROBABILITIES, "ensemble_prob"
        ),
        f"{out}/scores",
        partition_by=["split"],
    )
    scores = usage_io.read_usage(prepared.sparkSession, f"{out}/scores")
    test = scores.filter("split = 'test'")
    chosen = evaluate.best_threshold(
        evaluate.threshold_sweep(
            scores.filter("split = 'val'"), label=LABEL, score="ensemble_prob"
        )
    ).first()["threshold"]
    run = history.agg(F.max("round").alias("rounds"), F.min("val_loss").alias("loss")).first()
    metrics = evaluate.metrics_row(
        test, label=LABEL, score="mlp_prob", rounds=run["rounds"], best_val_loss=run["loss"]
    )
    usage_io.write_csv(metrics, f"{out}/metrics")
    return evaluate.compare(
        test.unpivot([LABEL], [*PROBABILITIES, "ensemble_prob"], "model", "score"),
        model="model",
        label=LABEL,
        score="score",
        thresholds={
            "mlp_prob": DECISION_THRESHOLD,
            "rf_prob": FOREST_THRESHOLD,
            "ensemble_prob": chosen,
        },
    )


def predict(
    accounts: DataFrame, models_path: str, out: str, *, key: str = IDENTIFIER, wording: str = "en"
) -> DataFrame:
    """Score accounts with the saved models and write the predictions as CSV.

    ``accounts`` are usage rows; features are added if they are not there yet. Accounts with a
    missing or infinite feature cannot be scored: they go to ``<out>_unscored`` with the names
    of those features, and the others are scored all the same.
    """
    if not set(FEATURES) <= set(accounts.columns):
        accounts = features.add_features(accounts)
    mlp = usage_io.load_model(f"{models_path}/mlp")
    forest = usage_io.load_model(f"{models_path}/rf")
    fit, unfit = score.route(accounts, scratch_path(accounts.sparkSession, "routed"), columns=FEATURES)
    usage_io.write_usage(unfit, f"{out.rstrip('/')}_unscored")
    tiers = score.score_table(
        _scored(fit, mlp, forest), score="ensemble_prob", wording=wording
    )
    predictions = score.round_scores(tiers, scores=[*PROBABILITIES, "ensemble_prob"]).select(
        F.col(key).alias("client_id"),
        *PROBABILITIES,
        "ensemble_prob",
        "risk_level",
        "action",
        "predicted",
    )
    usage_io.write_csv(predictions, out)
    return usage_io.read_usage_csv(
        accounts.sparkSession, out, schema=predictions.schema
    )


def _scored(df: DataFrame, mlp, forest) -> DataFrame:
    return score.ensemble(score.score_both(df, mlp, forest), scores=PROBABILITIES)
