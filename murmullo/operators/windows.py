"""Tumbling-window metrics, the same for tables and streams.

A stream needs ``withWatermark`` before these functions; ``streaming.jobs``
adds it. Only windows that hold rows appear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.functions.measures import percent_or_zero, rate
from murmullo.schemas import SENTIMENT_SECONDS, THROUGHPUT_SECONDS


def _tumbling(time: str, seconds: int) -> Column:
    # No cast here: it would hide the watermark of a stream from the window.
    return F.window(F.col(time), f"{seconds} seconds")


def _window_end() -> Column:
    return F.unix_timestamp(F.col("window.end")).alias("ventana_fin")


def throughput_windows(
    df: DataFrame, time: str = "timestamp", seconds: int = THROUGHPUT_SECONDS
) -> DataFrame:
    """Messages and messages per second of each window.

    Each task counts before the shuffle, so the state and the shuffle hold one
    small row per window, not the messages.
    """
    counted = df.groupBy(_tumbling(time, seconds)).agg(
        F.count("*").alias("cantidad_mensajes")
    )
    return counted.select(
        _window_end(), "cantidad_mensajes",
        rate(F.col("cantidad_mensajes"), seconds).alias("throughput_msg_seg"),
    )


def sentiment_windows(
    df: DataFrame, time: str = "timestamp", seconds: int = SENTIMENT_SECONDS,
    sentiment: str = "sentimiento", flag: str = "es_odio",
) -> DataFrame:
    """Sentiment and hate counts of each window.

    Whatever is neither positive nor negative counts as neutral; a missing hate
    flag counts as no hate.
    """
    counted = df.groupBy(_tumbling(time, seconds)).agg(
        F.count("*").alias("total_comentarios"),
        F.count_if(F.col(sentiment) == "POS").alias("positivos"),
        F.count_if(F.col(sentiment) == "NEG").alias("negativos"),
        F.count_if(F.col(flag)).alias("odio"),
    )
    total = F.col("total_comentarios")
    return counted.select(
        _window_end(), "total_comentarios", "positivos", "negativos",
        (total - F.col("positivos") - F.col("negativos")).alias("neutrales"),
        "odio",
        percent_or_zero(F.col("odio"), total).alias("porcentaje_odio"),
    )
