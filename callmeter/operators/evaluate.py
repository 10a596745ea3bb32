"""Evaluating scores of a binary classifier: every figure is an aggregate.

``label`` is 0/1 and ``score`` the probability of 1. Rows in which either is null cannot
be judged and are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.functions.columns import (
    DECISION_THRESHOLD,
    NEGATIVE_TEXT,
    POSITIVE_TEXT,
    decide,
)
from callmeter.operators.ordered import cell_edges, running_totals, with_cells
from callmeter.sources.scratch import stored

COUNTS = ("tn", "fp", "fn", "tp")


def _judged(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())


def _counts(label: Column, predicted: Column) -> list[Column]:
    cases = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return [
        F.count_if((label == truth) & (predicted == guess)).alias(name)
        for name, (truth, guess) in cases.items()
    ]


def _accuracy() -> Column:
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    return F.try_divide(tn + tp, tn + fp + fn + tp)


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _f1() -> Column:
    _, fp, fn, tp = (F.col(c) for c in COUNTS)
    return _or_zero(2 * tp, 2 * tp + fp + fn)


def confusion(
    df: DataFrame, *, label: str, score: str, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    return df.agg(*_counts(F.col(label), decide(F.col(score), threshold=threshold)))


def binary_metrics(
    df: DataFrame, *, label: str, score: str, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Accuracy and F1 at a threshold; F1 is 0 where it is undefined."""
    counted = confusion(df, label=label, score=score, threshold=threshold)
    return counted.select(
        F.lit(threshold).alias("threshold"), _accuracy().alias("accuracy"), _f1().alias("f1")
    )


def _score_totals(
    df: DataFrame,
    *,
    label: str,
    score: str,
    groups: Sequence[str],
    digits: int | None,
    cells: int | None,
) -> DataFrame:
    """Per distinct score, its positives and negatives and those of all smaller scores."""
    judged = _judged(df, label, score).select(
        *groups, F.col(label).alias("_y"), F.col(score).cast("double").alias("score")
    )
    totals = [F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg")]
    if digits is None:
        # One row per distinct score, stored: the rows behind it are read (and scored) once,
        # and both the sketch that sizes the cells and the totals start from there.
        counted = stored(judged.groupBy(*groups, "score").agg(*totals), "score-counts")
        per_score = with_cells(counted, ["score"], ["_cell"], cell_edges(counted, ["score"], cells=cells))
    else:
        # Rounded probabilities: about a thousand cells, each with at most
        # 10 ** (digits - 3) distinct scores, so no sketch pass is needed.
        rounded = judged.withColumn("score", F.round("score", digits))
        marked = rounded.withColumn("_cell", F.floor(F.col("score") * 1000))
        per_score = marked.groupBy(*groups, "_cell", "score").agg(*totals)
    return running_totals(
        per_score, value="score", cell="_cell", amounts=["pos", "neg"], groups=groups
    )


def roc_auc(
    df: DataFrame,
    *,
    label: str,
    score: str,
    groups: Sequence[str] = (),
    digits: int | None = None,
    cells: int | None = None,
) -> DataFrame:
    """Area under the ROC curve; ties count half, null if only one class is present.

    Scores are grouped first and ordered cell by cell, so no task sorts all of them.
    ``digits`` rounds probabilities beforehand, which saves storing the counts by score.
    """
    totals = _score_totals(
        df, label=label, score=score, groups=groups, digits=digits, cells=cells
    )
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    won = F.sum(pos * (F.col("neg_before") + neg / 2))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return totals.groupBy(*groups).agg(F.try_divide(won, pairs).alias("auc"))


def roc_points(
    df: DataFrame,
    *,
    label: str,
    score: str,
    digits: int | None = None,
    cells: int | None = None,
    drop_collinear: bool = False,
) -> DataFrame:
    """False and true positive rate at each distinct score taken as threshold.

    ``drop_collinear`` keeps only the points a drawn curve needs, as is usual for plots:
    a point is dropped if the steps before and after it are the same; the curve then also
    gets its origin, with an infinite threshold.
    """
    totals = _score_totals(df, label=label, score=score, groups=(), digits=digits, cells=cells)
    points = totals.select(
        "*",
        F.try_divide(F.col("neg_total") - F.col("neg_before"), F.col("neg_total")).alias("fpr"),
        F.try_divide(F.col("pos_total") - F.col("pos_before"), F.col("pos_total")).alias("tpr"),
    )
    if drop_collinear:
        return _needed_points(points)
    return points.select(F.col("score").alias("threshold"), "fpr", "tpr")


def _needed_points(points: DataFrame) -> DataFrame:
    step = F.struct("pos", "neg")
    # The next lower score is in the same cell, or is the highest of an earlier cell.
    tops = points.groupBy("_cell").agg(F.max_by(step, "score").alias("_top"))
    below = tops.select("_cell", F.lag("_top").over(Window.orderBy("_cell")).alias("_earlier"))
    inside = Window.partitionBy("_cell").orderBy("score")
    stepped = points.withColumn("_lower", F.lag(step).over(inside)).join(below, "_cell")
    lower = F.coalesce("_lower", "_earlier")
    first = (F.col("pos_before") + F.col("pos") == F.col("pos_total")) & (
        F.col("neg_before") + F.col("neg") == F.col("neg_total")
    )
    kept = stepped.filter(first | lower.isNull() | (lower != step))
    # The origin belongs to the curve once: it rides on the highest score.
    point = lambda threshold, fpr, tpr: F.struct(
        threshold.alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr")
    )
    own = point(F.col("score"), F.col("fpr"), F.col("tpr"))
    origin = point(F.lit(float("inf")), F.lit(0.0), F.lit(0.0))
    return kept.select(F.inline(F.when(first, F.array(own, origin)).otherwise(F.array(own))))


def report(
    df: DataFrame, *, label: str, score: str, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted rows."""
    counted = confusion(df, label=label, score=score, threshold=threshold)
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    neg_support, pos_support = tn + fp, fn + tp
    support = neg_support + pos_support

    def entry(name: str, figures: Sequence[Column], rows: Column) -> Column:
        names = ("precision", "recall", "f1")
        return F.struct(
            F.lit(name).alias("class"),
            *[f.cast("double").alias(n) for f, n in zip(figures, names)],
            rows.alias("support"),
        )

    neg = [_or_zero(tn, tn + fn), _or_zero(tn, neg_support), _or_zero(2 * tn, 2 * tn + fn + fp)]
    pos = [_or_zero(tp, tp + fp), _or_zero(tp, pos_support), _f1()]
    macro = [(a + b) / 2 for a, b in zip(neg, pos)]
    weighted = [_or_zero(a * neg_support + b * pos_support, support) for a, b in zip(neg, pos)]
    return counted.select(
        F.inline(
            F.array(
                entry(NEGATIVE_TEXT, neg, neg_support),
                entry(POSITIVE_TEXT, pos, pos_support),
                entry("accuracy", [_accuracy()] * 3, support),
                entry("macro avg", macro, support),
                entry("weighted avg", weighted, support),
            )
        )
    )


def threshold_grid(*, start: float = 0.1, stop: float = 0.85, step: float = 0.05) -> list[float]:
    return [round(start + step * i, 6) for i in range(int(round((stop - start) / step)) + 1)]


def threshold_sweep(
    df: DataFrame,
    *,
    label: str,
    score: str,
    start: float = 0.1,
    stop: float = 0.85,
    step: float = 0.05,
) -> DataFrame:
    """Confusion counts and F1 at every threshold of a grid, from one grouping.

    Each row adds to one counter: how many thresholds its score reaches. The grid is only
    spread over those counters, a handful of rows whatever the size of the table.
    """
    grid = threshold_grid(start=start, stop=stop, step=step)
    reached = sum(((F.col(score) >= t).cast("int") for t in grid), F.lit(0))
    counters = (
        _judged(df, label, score)
        .groupBy(F.col(label).alias("_y"), reached.alias("_reached"))
        .agg(F.count("*").alias("n"))
    )
    steps = F.array(*[F.lit(t) for t in grid])
    spread = counters.select(
        "_y", "n", "_reached", F.posexplode(steps).alias("_at", "threshold")
    )
    predicted = F.col("_at") < F.col("_reached")
    counts = [
        F.coalesce(F.sum(F.when((F.col("_y") == y) & (predicted == p), F.col("n"))), F.lit(0)).alias(name)
        for name, (y, p) in zip(COUNTS, ((0, False), (0, True), (1, False), (1, True)))
    ]
    return spread.groupBy("threshold").agg(*counts).select("threshold", *COUNTS, _f1().alias("f1"))


def best_threshold(sweep: DataFrame, *, fallback: float = DECISION_THRESHOLD) -> DataFrame:
    """The threshold with the highest F1, the smallest of equals.

    ``fallback`` stands where no threshold has an F1 above 0.
    """
    best = F.max_by("threshold", F.struct("f1", -F.col("threshold")))
    return sweep.agg(
        F.when(F.max("f1") > 0, best).otherwise(fallback).alias("threshold"),
        F.coalesce(F.max("f1"), F.lit(0.0)).alias("f1"),
    )


def compare(
    df: DataFrame,
    *,
    model: str,
    label: str,
    score: str,
    thresholds: Mapping[str, float],
    digits: int | None = None,
    cells: int | None = None,
) -> DataFrame:
    """F1 at each model's own threshold, and AUC, from rows of ``(model, label, score)``."""
    limit = F.lit(None).cast("double")
    for name, value in thresholds.items():
        limit = F.when(F.col(model) == name, F.lit(value)).otherwise(limit)
    predicted = (F.col(score) >= limit).cast("int")
    counted = (
        df.groupBy(model)
        .agg(F.max(limit).alias("threshold"), *_counts(F.col(label), predicted))
        .select(model, "threshold", _f1().alias("f1"))
    )
    areas = roc_auc(
        df, label=label, score=score, groups=[model], digits=digits, cells=cells
    )
    return counted.join(areas, model, "left")


def log_loss(df: DataFrame, *, label: str, score: str, pos_weight: float | Column) -> DataFrame:
    """Mean log-loss over rows, with positives weighted; scores are kept off 0 and 1."""
    return df.agg(F.avg(row_loss(F.col(label), F.col(score), pos_weight)).alias("log_loss"))


def row_loss(label: Column, score: Column, pos_weight: float | Column) -> Column:
    weight = pos_weight if isinstance(pos_weight, Column) else F.lit(pos_weight)
    p = F.least(F.greatest(score, F.lit(1e-15)), F.lit(1 - 1e-15))
    return -(weight * label * F.log(p) + (1 - label) * F.log(1 - p))


def metrics_row(
    df: DataFrame,
    *,
    label: str,
    score: str,
    threshold: float = DECISION_THRESHOLD,
    digits: int | None = None,
    cells: int | None = None,
    **training: float | int | None,
) -> DataFrame:
    """Accuracy, F1 and AUC in one row, to four decimals.

    What only the training run knows (rounds run, best validation loss) is given by name.
    """
    measured = confusion(df, label=label, score=score, threshold=threshold).select(
        _accuracy().alias("accuracy"), _f1().alias("f1_score")
    )
    area = roc_auc(df, label=label, score=score, digits=digits, cells=cells).scalar()
    return measured.select(
        F.round("accuracy", 4).alias("accuracy"),
        F.round("f1_score", 4).alias("f1_score"),
        F.round(area, 4).alias("auc_roc"),
        *[F.lit(v).alias(k) for k, v in training.items()],
    )
