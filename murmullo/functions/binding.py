"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    Spark copies a derived column into every expression that reads it when it
    pushes a filter down. An expression that reads its input once keeps that to
    a single copy, so a filter on a score stays cheap.
    """
    return F.transform(F.array(value), body)[0]


def generated(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns through one generator, that is, computed once per row.

    A filter on them stays above the generator and reads what it gave; a filter
    on any other column is pushed below it, down to the scan. Each row gives
    exactly one row, on a table and on a stream.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*rest, F.inline(F.array(values)))
