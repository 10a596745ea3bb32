"""Scoring accounts and turning scores into risk tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmeter.functions.columns import (
    DECISION_THRESHOLD,
    RISK_BOUNDS,
    decide,
    label_text,
    risk_action,
    risk_tier,
)
from callmeter.schema import as_finite

PROBABILITY = {"mlp": "mlp_prob", "rf": "rf_prob"}


def blockers(columns: Sequence[str]) -> Column:
    """Names of the columns that keep a row from being scored: null, NaN or infinite."""
    bad = [F.when(as_finite(c).isNull(), F.lit(c)) for c in columns]
    return F.filter(F.array(*bad), lambda name: name.isNotNull())


def route(df: DataFrame, path: str, *, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows fit for scoring, and the others with the columns that stop them as ``blocked_by``.

    One pass writes both below ``path``; each side is then read from its own files.
    """
    marked = df.withColumn("blocked_by", blockers(columns)).withColumn("scorable", F.size("blocked_by") == 0)
    marked.write.partitionBy("scorable").parquet(path)
    kind = T.StructType([*marked.schema.fields])
    routed = df.sparkSession.read.schema(kind).parquet(path)
    fit, unfit = (routed.where(F.col("scorable") == side).drop("scorable") for side in (True, False))
    return fit.drop("blocked_by"), unfit


def positive_score(df: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    """Add the probability of class 1 as column ``name``; the model's own columns go."""
    scored = model.transform(df)
    vector = model.stages[-1].getProbabilityCol()
    return scored.select(*df.columns, vector_to_array(vector)[1].alias(name))


def score_both(df: DataFrame, mlp: PipelineModel, forest: PipelineModel) -> DataFrame:
    """Probabilities of both models beside every row: two projections, no join."""
    return positive_score(
        positive_score(df, mlp, PROBABILITY["mlp"]), forest, PROBABILITY["rf"]
    )


def ensemble(df: DataFrame, *, scores: Sequence[str], name: str = "ensemble_prob") -> DataFrame:
    """Add the mean of several probabilities."""
    total: Column = F.col(scores[0])
    for other in scores[1:]:
        total = total + F.col(other)
    return df.withColumn(name, total / len(scores))


def round_scores(df: DataFrame, *, scores: Sequence[str], digits: int = 4) -> DataFrame:
    return df.withColumns({s: F.round(s, digits) for s in scores})


def score_table(
    df: DataFrame,
    *,
    score: str,
    label: str | None = None,
    threshold: float = DECISION_THRESHOLD,
    wording: str = "en",
) -> DataFrame:
    """Add tier, action and decision; with ``label`` also the real class by name."""
    p = F.col(score)
    return df.withColumns(
        {
            "risk_level": risk_tier(p, wording=wording),
            "action": risk_action(p, wording=wording),
            "predicted": decide(p, threshold=threshold),
            **({"actual": label_text(F.col(label))} if label else {}),
        }
    )


def risk_summary(
    df: DataFrame, *, score: str, label: str, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Accounts and real churn rate per tier, with the number over the threshold.

    The threshold lies inside a tier, so ``predicted`` and ``at_risk`` (tiers from high
    up) are different counts.
    """
    p = F.col(score)
    return df.groupBy(risk_tier(p).alias("risk_level")).agg(
        F.count("*").alias("accounts"),
        F.sum(decide(p, threshold=threshold)).alias("predicted"),
        F.count_if(p >= RISK_BOUNDS[1]).alias("at_risk"),
        F.avg(F.col(label)).alias("churn_rate"),
    )
