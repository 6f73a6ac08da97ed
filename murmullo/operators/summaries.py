"""Counts, shares, top rows and series summaries for reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmullo.functions.labels import (
    category_name, clock, flag_name, hate_band, named,
)
from murmullo.functions.measures import first_highest, percent_or_zero
from murmullo.sources.records import decode
from murmullo.sources.topics import last_messages
from murmullo.wordlists import SENTIMENT_NAMES

# What the reports call the counts of a window and the flags below.
_WINDOW_COUNTS = {"positivos": "Positivo", "negativos": "Negativo", "neutrales": "Neutral"}


def value_counts(df: DataFrame, key: str, count: str = "cantidad") -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias(count))
        .orderBy(F.desc(count), F.asc(key))
    )


def flag_counts(df: DataFrame, flag: str = "es_odio") -> DataFrame:
    label = flag_name(F.col(flag), "Discriminatorio", "Sin discriminación")
    return value_counts(df, flag).withColumn("etiqueta", label)


def category_counts(df: DataFrame, category: str = "categoria_odio", flag: str = "es_odio") -> DataFrame:
    """Hate comments per category, with its display name."""
    counts = value_counts(df.filter(F.col(flag)), category)
    return counts.withColumn("categoria", category_name(F.col(category)))


def sentiment_counts(df: DataFrame, sentiment: str = "sentimiento") -> DataFrame:
    counts = value_counts(df, sentiment)
    return counts.withColumn(
        "label", named(F.col(sentiment), SENTIMENT_NAMES, F.lit(None).cast("string"))
    )


def hate_share(df: DataFrame, flag: str = "es_odio") -> DataFrame:
    """Total, hate comments and their share, in one pass."""
    return df.agg(
        F.count("*").alias("total"), F.count_if(F.col(flag)).alias("n_odio")
    ).withColumn("pct_odio", percent_or_zero(F.col("n_odio"), F.col("total"), 1))


def clean_rate(df: DataFrame, text: str = "comentario_limpio") -> DataFrame:
    """How many records carry cleaned text."""
    return df.agg(
        F.count("*").alias("recibidos"), F.count(text).alias("limpios")
    ).withColumn("tasa", percent_or_zero(F.col("limpios"), F.col("recibidos"), 1))


def complete_rows(df: DataFrame, columns: Sequence[str], names: Mapping[str, str] | None = None) -> DataFrame:
    """The given columns of the rows that have all of them, renamed."""
    return df.select(*columns).na.drop().withColumnsRenamed(dict(names or {}))


def first_complete(df: DataFrame, columns: Sequence[str], order: str, k: int = 6) -> DataFrame:
    """The first ``k`` complete rows in the given order."""
    return (
        df.select(order, *columns).na.drop(subset=list(columns)).orderBy(order).limit(k)
        .select(*columns)
    )


def top_hate_rows(df: DataFrame, k: int = 10, tie: str = "autor") -> DataFrame:
    """The hate comments with the highest probability."""
    columns = ["autor", "comentario_limpio", "categoria_odio", "prob_odio"]
    order = [F.desc("prob_odio"), F.asc(tie)]
    return (
        df.filter(F.col("es_odio"))
        .select(*dict.fromkeys([*columns, tie]))
        .orderBy(*order)
        .limit(k)
        .select(
            F.col("autor").alias("Autor"),
            F.col("comentario_limpio").alias("Comentario"),
            category_name(F.col("categoria_odio")).alias("Tipo"),
            F.col("prob_odio").alias("Prob"),
        )
    )


def scatter_points(df: DataFrame) -> DataFrame:
    """Confidence against hate probability, complete rows only."""
    columns = ["comentario_limpio", "prob_sentimiento", "prob_odio", "sentimiento", "es_odio"]
    unknown = F.lit(None).cast("string")
    return complete_rows(df, columns).withColumn(
        "Sentimiento_nombre", named(F.col("sentimiento"), SENTIMENT_NAMES, unknown)
    )


def series_summary(df: DataFrame, value: str, count: str, time: str = "ventana_fin") -> DataFrame:
    """Last, highest and mean value of a series, and the sum of its counts."""
    return df.agg(
        F.max_by(value, time).alias("actual"),
        F.max(value).alias("maximo"),
        F.round(F.avg(value), 2).alias("promedio"),
        F.sum(count).alias("total"),
    )


def with_clock(df: DataFrame, time: str = "ventana_fin", target: str = "hora") -> DataFrame:
    return df.withColumn(target, clock(F.col(time)))


def window_long(windows: DataFrame, time: str = "ventana_fin") -> DataFrame:
    """One row per window and sentiment."""
    named_counts = windows.select(time, *_WINDOW_COUNTS).withColumnsRenamed(_WINDOW_COUNTS)
    return named_counts.unpivot([time], list(_WINDOW_COUNTS.values()), "tipo", "cantidad")


def _last(windows: DataFrame, *columns: str, time: str = "ventana_fin") -> DataFrame:
    picked = F.max_by(F.struct(time, *columns), F.col(time))
    return windows.agg(picked.alias("w")).select("w.*")


def dominant_sentiment(windows: DataFrame, time: str = "ventana_fin") -> DataFrame:
    """The most frequent sentiment of the last window; ties: POS, NEG, NEU."""
    last = _last(windows, *_WINDOW_COUNTS, time=time)
    dominant = first_highest(F.array(*_WINDOW_COUNTS), list(_WINDOW_COUNTS.values()))
    return last.select(time, dominant.alias("dominante"))


def last_window(windows: DataFrame, time: str = "ventana_fin") -> DataFrame:
    """The newest window with its clock time, counts and percentage: one row."""
    last = _last(windows, "total_comentarios", *_WINDOW_COUNTS, "odio", "porcentaje_odio", time=time)
    return with_clock(last.withColumn("porcentaje_odio", F.round("porcentaje_odio", 1)), time)


def window_table(windows: DataFrame, time: str = "ventana_fin") -> DataFrame:
    """Clock time, comments, hate comments and percentage of each window, oldest first."""
    return with_clock(windows, time, "Hora").orderBy(time).select(
        "Hora", F.col("total_comentarios").alias("Total"), F.col("odio").alias("Discriminatorio"),
        F.col("porcentaje_odio").alias("% Discrim."),
    )


def with_hate_band(windows: DataFrame, pct: str = "porcentaje_odio") -> DataFrame:
    return windows.withColumn("banda", hate_band(F.col(pct)))


def hate_delta(windows: DataFrame, pct: str = "porcentaje_odio", time: str = "ventana_fin") -> DataFrame:
    """The last window's percentage against the mean of all windows."""
    mean: Column = F.avg(pct)
    last = F.max_by(pct, time)
    return windows.agg(
        last.alias("ultimo"),
        F.round(mean, 2).alias("promedio"),
        F.round(last - mean, 2).alias("delta"),
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def metric_records(messages: DataFrame, schema: T.StructType, n: int) -> DataFrame:
    """The newest ``n`` records of a metric topic (``partition``, ``offset``,
    ``value``), with their types, for any of the summaries above."""
    return decode(last_messages(messages, n).select("value"), schema)
