"""The newest messages and their shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmullo.functions.labels import category_name, named, severity
from murmullo.functions.measures import percent_or_zero
from murmullo.functions.text import shorten
from murmullo.operators.ordered import with_running_sums
from murmullo.schemas import NEUTRAL, NO_HATE
from murmullo.wordlists import CATEGORY_NAMES

BUFFER_SIZE = 60


def last_rows(df: DataFrame, k: int, *order: str) -> DataFrame:
    """The ``k`` rows with the highest order key, newest first.

    Each task keeps its own ``k`` rows; only those meet.
    """
    return df.orderBy(*[F.desc(c) for c in order]).limit(k)


def _counters(flag: Column, sentiment: Column) -> dict[str, Column]:
    return {
        "n_odio": F.coalesce(flag, F.lit(False)),
        "n_pos": F.coalesce(sentiment == "POS", F.lit(False)),
        "n_neg": F.coalesce(sentiment == "NEG", F.lit(False)),
    }


def _shares(total: Column) -> dict[str, Column]:
    rest = total - F.col("n_pos") - F.col("n_neg")
    return {
        "pct_odio": percent_or_zero(F.col("n_odio"), total, 1),
        "pct_pos": percent_or_zero(F.col("n_pos"), total, 1),
        "pct_neg": percent_or_zero(F.col("n_neg"), total, 1),
        "pct_neu": percent_or_zero(rest, total, 1),
    }


def recent_shares(
    df: DataFrame, *order: str, size: int = BUFFER_SIZE,
    flag: str = "es_odio", sentiment: str = "sentimiento",
) -> DataFrame:
    """Hate and sentiment shares of the last ``size`` messages: one row."""
    newest = last_rows(df.select(*order, flag, sentiment), size, *order)
    tests = _counters(F.col(flag), F.col(sentiment))
    return newest.agg(
        F.count("*").alias("total"),
        *[F.count_if(test).alias(name) for name, test in tests.items()],
    ).select("total", *[c.alias(n) for n, c in _shares(F.col("total")).items()])


def rolling_shares(
    df: DataFrame, seq: str, size: int = BUFFER_SIZE, flag: str = "es_odio",
    sentiment: str = "sentimiento", chunk: int = 1 << 16,
) -> DataFrame:
    """The same shares after every message, over it and the ``size - 1`` before.

    ``seq`` is a unique number or time that gives the order; its values may lie
    any distance apart. One ordered window would put all rows in one task.
    Instead each row gets its position from range partitions and their counts,
    positions are cut in chunks, and the last ``size - 1`` rows of a chunk are
    also sent to the next one. Every chunk is then complete on its own and holds
    ``chunk + size`` rows at most.
    """
    if chunk < size:
        raise ValueError("a chunk must hold at least one buffer")
    rows = df.select(
        F.col(seq).alias("_seq"),
        *[t.alias(n) for n, t in _counters(F.col(flag), F.col(sentiment)).items()],
        F.lit(1).alias("_one"),
    )
    placed = with_running_sums(rows, [F.col("_seq")], {"_place": "_one"}, "rolling").withColumn(
        "_pos", F.col("_place") - 1
    )
    own = F.floor(F.col("_pos") / chunk)
    is_tail = F.pmod(F.col("_pos"), F.lit(chunk)) > chunk - size
    spread = placed.withColumn("_own", own).withColumn(
        "_chunk",
        F.explode(F.when(is_tail, F.array(own, own + 1)).otherwise(F.array(own))),
    )
    buffer = Window.partitionBy("_chunk").orderBy("_pos").rowsBetween(-(size - 1), 0)
    summed = spread.select(
        "_seq", "_own", "_chunk",
        F.count("*").over(buffer).alias("total"),
        *[
            F.sum(F.col(n).cast("bigint")).over(buffer).alias(n)
            for n in ("n_odio", "n_pos", "n_neg")
        ],
    )
    return summed.filter(F.col("_chunk") == F.col("_own")).select(
        F.col("_seq").alias(seq), "total",
        *[c.alias(n) for n, c in _shares(F.col("total")).items()],
    )


def recent_messages(
    df: DataFrame, *order: str, k: int = 30, length: int = 130, text: str = "comentario",
    other_text: str = "comentario_limpio",
) -> DataFrame:
    """The last messages as a chat view shows them, with a shortened text."""
    body = F.coalesce(F.col(text), F.col(other_text), F.lit(""))
    return last_rows(df, k, *order).select(
        *order, "autor", shorten(body, length).alias("texto"),
        category_name(F.coalesce("categoria_odio", F.lit("ninguna"))).alias("categoria"),
        severity(F.col("es_odio"), F.col("sentimiento")).alias("nivel"),
    )


def processed_messages(df: DataFrame, *order: str, k: int = 6, length: int = 120) -> DataFrame:
    """The last processed messages: cleaned text, or the original where that is
    empty, with category, probability and sentiment."""
    body = F.coalesce(F.nullif(F.col("comentario_limpio"), F.lit("")), "comentario", F.lit(""))
    no_hate = F.lit(CATEGORY_NAMES[NO_HATE])
    return last_rows(df, k, *order).select(
        *order, "autor", shorten(body, length).alias("texto"),
        named(F.col("categoria_odio"), CATEGORY_NAMES, no_hate).alias("categoria"),
        F.coalesce("prob_odio", F.lit(0.0)).alias("prob_odio"),
        F.coalesce("sentimiento", F.lit(NEUTRAL)).alias("sentimiento"),
        severity(F.col("es_odio"), F.col("sentimiento")).alias("nivel"),
    )
