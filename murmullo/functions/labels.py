"""Display columns: names, bands, severity and clock time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmullo.wordlists import CATEGORY_NAMES

# The conclusions drawn from the correlation.
MORE_LIKES = "Los comentarios discriminatorios tienden a recibir MAS likes"
FEWER_LIKES = "Los comentarios discriminatorios tienden a recibir MENOS likes"
NO_RELATION = (
    "No hay correlacion significativa entre likes y discurso discriminatorio"
)
CORRELATION_LIMIT = 0.1


def correlation_text(r: Column, limit: float = CORRELATION_LIMIT) -> Column:
    return (
        F.when(r > limit, MORE_LIKES).when(r < -limit, FEWER_LIKES).otherwise(NO_RELATION)
    )


def correlation_label(r: Column, limit: float = CORRELATION_LIMIT) -> Column:
    return (
        F.when(F.coalesce(F.abs(r), F.lit(0.0)) < limit, "Sin correlación")
        .when(r > 0, "Positiva")
        .otherwise("Negativa")
    )


def named(code: Column, names: Mapping[str, str], default: Column | None = None) -> Column:
    """The code's display name; an unknown code stays, or becomes ``default``."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    fallback = code if default is None else default
    return F.coalesce(F.element_at(table, code), fallback)


def category_name(code: Column) -> Column:
    return named(code, CATEGORY_NAMES)


def flag_name(flag: Column, if_true: str, if_false: str) -> Column:
    return F.when(flag, if_true).otherwise(if_false)


def clock(epoch: Column) -> Column:
    """Epoch seconds as ``HH:MM:SS`` of the session zone; bad input gives null."""
    seconds = epoch.cast("string").try_cast("double").try_cast("bigint")
    return F.date_format(F.timestamp_seconds(seconds), "HH:mm:ss")


def severity(flag: Column, sentiment: Column) -> Column:
    """Hate first, then negative, then positive, then the rest."""
    return (
        F.when(flag, "odio")
        .when(sentiment == "NEG", "negativo")
        .when(sentiment == "POS", "positivo")
        .otherwise("neutral")
    )


def hate_band(pct: Column) -> Column:
    return F.when(pct < 25, "bajo").when(pct < 50, "medio").when(pct <= 100, "alto")
