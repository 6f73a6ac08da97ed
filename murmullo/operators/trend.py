"""Hate by hour of the day."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmullo.functions.measures import percent

# Accepted date formats, first match wins, and the zone shift.
DATE_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)
HOURS_BEHIND_UTC = 5


def _marks(date_format: str) -> set[str]:
    """The fixed characters of a format: quoted text and punctuation."""
    if set("[]{}#") & set(date_format):
        return set()
    quoted = "".join(date_format.split("'")[1::2])
    plain = "".join(date_format.split("'")[0::2])
    return {c.upper() for c in quoted} | {c for c in plain if not c.isalpha()}


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The timestamp by the first format that matches, else null.

    A format is tried only on texts that hold its fixed characters. A failed
    attempt costs an exception inside Spark, many times the price of this check.
    """

    def attempt(date_format: str) -> Column:
        parsed = F.try_to_timestamp(text, F.lit(date_format))
        marks = [F.upper(text).contains(c) for c in sorted(_marks(date_format))]
        return F.when(functools.reduce(Column.__and__, marks), parsed) if marks else parsed

    return F.coalesce(*[attempt(f) for f in formats])


def local_hour(
    text: Column, hours_behind: int = HOURS_BEHIND_UTC, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    shift = F.make_dt_interval(hours=F.lit(hours_behind))
    return F.hour(parse_date(text, formats) - shift)


def hourly_trend(
    df: DataFrame, date: str = "fecha", flag: str = "es_odio",
    hours_behind: int = HOURS_BEHIND_UTC, formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Comments and hate comments per local hour.

    Rows without a readable date are left out, unless no row has one: then all
    of them count as hour 0. Both cases come from one aggregation, whose
    unreadable dates form a group of their own. The window runs over that
    result, which has 25 rows at most.
    """
    per_hour = df.groupBy(
        local_hour(F.col(date), hours_behind, formats).alias("hora_dia")
    ).agg(
        F.count("*").alias("total_comentarios"),
        F.sum(F.col(flag).cast("int")).alias("comentarios_odio"),
    )
    any_date = F.max(F.col("hora_dia")).over(Window.partitionBy()).isNotNull()
    return (
        per_hour.withColumn("_dated", any_date)
        .filter(F.col("hora_dia").isNotNull() | ~F.col("_dated"))
        .select(
            F.coalesce("hora_dia", F.lit(0)).alias("hora_dia"),
            "total_comentarios",
            "comentarios_odio",
            percent(F.col("comentarios_odio"), F.col("total_comentarios")).alias(
                "porcentaje_odio"
            ),
        )
        .orderBy("hora_dia")
    )


def peak_hour(trend: DataFrame) -> DataFrame:
    """The hour with the highest percentage, the earliest one if several tie."""
    order = F.struct("porcentaje_odio", -F.col("hora_dia"))
    best = F.max_by(F.struct("hora_dia", "porcentaje_odio"), order)
    return trend.agg(best.alias("p")).select("p.*")


def hourly_mean(trend: DataFrame) -> DataFrame:
    """The mean of the hourly percentages, every hour counting the same."""
    return trend.agg(F.round(F.avg("porcentaje_odio"), 1).alias("promedio"))
