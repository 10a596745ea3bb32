"""Column expressions: ratios, labels, hashes, scores and risk tiers.

All are built-in Spark functions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Risk tiers by upper bound (exclusive; the last has none), with wording.
RISK_BOUNDS = (0.25, 0.45, 0.65)
RISK_WORDING = {
    "en": {
        "levels": ("low", "moderate", "high", "critical"),
        "actions": (
            "No action needed",
            "Watch: monthly follow-up",
            "Targeted retention offer",
            "Priority contact: urgent personal offer",
        ),
    },
    "fr": {
        "levels": ("🟢 Faible", "🟡 Modéré", "🟠 Élevé", "🔴 Critique"),
        "actions": (
            "Aucune action requise",
            "Surveillance — suivi mensuel",
            "Offre de rétention ciblée",
            "Contact prioritaire — offre personnalisée urgente",
        ),
    },
}

# Decision threshold of the network and the ensemble, and of the forest.
DECISION_THRESHOLD = 0.4
FOREST_THRESHOLD = 0.5

# Class names.
POSITIVE_TEXT = "Churn"
NEGATIVE_TEXT = "Non-churn"


def guarded_ratio(top: Column, bottom: Column, *, zero_only: bool = False) -> Column:
    """``top / bottom``; 0.0 where the denominator is not positive (or null).

    With ``zero_only`` negative denominators divide, and every null result becomes 0.0.
    """
    if zero_only:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def label_text(label: Column) -> Column:
    """Class name of a boolean or 0/1 label; null stays null."""
    truth = label.cast("boolean")
    return F.when(truth, POSITIVE_TEXT).when(~truth, NEGATIVE_TEXT)


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def decide(score: Column, *, threshold: float = DECISION_THRESHOLD) -> Column:
    """1 where the score reaches the threshold, else 0; null if the score is null or NaN."""
    return F.when(~F.isnan(score), (score >= F.lit(threshold)).cast("int"))


def _by_tier(score: Column, texts: Sequence[str]) -> Column:
    steps = F
    for bound, text in zip(RISK_BOUNDS, texts):
        steps = steps.when(score < F.lit(bound), F.lit(text))
    return steps.when(score.isNotNull() & ~F.isnan(score), F.lit(texts[-1]))


def risk_tier(score: Column, *, wording: str = "en") -> Column:
    """Tier name of a probability; lower bounds belong to the tier above."""
    return _by_tier(score, RISK_WORDING[wording]["levels"])


def risk_action(score: Column, *, wording: str = "en") -> Column:
    """Recommended action for the tier of a probability."""
    return _by_tier(score, RISK_WORDING[wording]["actions"])


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256, in hex, of the values joined by ``||``; a null value reads ``NULL``."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]
    return F.sha2(F.concat_ws("||", *texts), 256)


def content_digest(df: DataFrame) -> Column:
    """A row's content in 128 bits: two hashes of its values and of which of them are missing.

    Values that group together have one digest: 0.0 and -0.0 do, and a null is no other value.
    """
    floats = {c for c, kind in df.dtypes if kind in ("float", "double")}
    values = [F.col(c) + F.lit(0.0) if c in floats else F.col(c) for c in df.columns]
    missing = F.array(*[F.col(c).isNull() for c in df.columns])
    return F.struct(*[F.xxhash64(F.lit(i), missing, *values).alias(name) for i, name in enumerate(("a", "b"))])


def hash_text(key: Column, *, seed: int) -> Column:
    """SHA-256, in hex, of ``seed`` and ``key``.

    Depends on the value alone, never on partitioning or row order.
    """
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("NULL")))
    # Never null; saying so spares a second hash in the null checks of joins.
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def hash_number(key: Column, *, seed: int) -> Column:
    """A stable number from 0 to 2^32 - 1: the first 8 hex digits of ``hash_text``."""
    return F.conv(F.substring(hash_text(key, seed=seed), 1, 8), 16, 10).cast("long")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
