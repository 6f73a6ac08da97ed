"""Rates, percentages, scores and decisions over class probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    """``part`` of ``total`` in percent; null where the total is zero."""
    return F.round(F.try_divide(part, total) * 100, digits)


def percent_or_zero(part: Column, total: Column, digits: int = 2) -> Column:
    return F.coalesce(percent(part, total, digits), F.lit(0.0))


def rate(count: Column, seconds: float, digits: int = 2) -> Column:
    return F.round(count / F.lit(float(seconds)), digits)


def risk_score(hate_percent: Column, hate_likes: Column) -> Column:
    """The hate percentage, raised by one percent for each like it earned."""
    return F.round(hate_percent * (1 + hate_likes * 0.01), 2)


def probability_array(probas: Column, labels: Sequence[str]) -> Column:
    """A map of probabilities as an array in label order; a missing label is 0."""
    return F.array(*[F.coalesce(probas[label], F.lit(0.0)) for label in labels])


def first_highest(scores: Column, labels: Sequence[str]) -> Column:
    """The label of the highest score; of equal ones the first in label order.

    Null where there are no scores.
    """
    names = F.array(*[F.lit(label) for label in labels])
    return F.get(names, F.array_position(scores, F.array_max(scores)).cast("int") - 1)
