"""Lenient conversions: bad values become defaults, they never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmullo.schemas import UNKNOWN_AUTHOR


def _number(value: Column) -> Column:
    """Text as a double, null where it is none. The cast alone would also read
    ``1d`` and ``2f``, which are numbers in Java source and nowhere else."""
    text = value.cast("string")
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def safe_int(value: Column) -> Column:
    """A whole number, truncated toward zero; null, NaN, inf and junk give 0."""
    number = F.nanvl(_number(value), F.lit(0.0))
    return F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))


def safe_double(value: Column) -> Column:
    return F.coalesce(F.nanvl(_number(value), F.lit(0.0)), F.lit(0.0))


def safe_bool(value: Column) -> Column:
    return F.coalesce(value.cast("string").try_cast("boolean"), F.lit(False))


def author_or_unknown(author: Column) -> Column:
    return F.coalesce(author.cast("string"), F.lit(UNKNOWN_AUTHOR))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def unified_text(comment: Column, message: Column) -> Column:
    """The video comment, or the chat message where there is no comment."""
    return F.coalesce(comment, message)

