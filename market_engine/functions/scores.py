"""Arithmetic of the two sentiment scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the constant that maps a sum of word valences into (-1, 1).
COMPOUND_ALPHA = 15.0


def softmax(logits: Column) -> Column:
    # Subtracting the largest logit keeps every exponential finite.
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(shifted, lambda x: x / total)


def label_of(probabilities: Column, labels: Sequence[str]) -> Column:
    """Label of the largest probability; the first one wins a tie."""
    names = F.array(*[F.lit(name) for name in labels])
    return F.get(names, (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int"))


def score_of(probabilities: Column, labels: Sequence[str]) -> Column:
    return F.get(probabilities, F.lit(labels.index("positive"))) - F.get(
        probabilities, F.lit(labels.index("negative"))
    )


def compound(total: Column) -> Column:
    return total / F.sqrt(total * total + COMPOUND_ALPHA)
