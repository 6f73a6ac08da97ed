"""The three record stages: clean, hate decision, sentiment decision.

Each stage is ``DataFrame -> DataFrame`` and keeps every other column, so it
runs on a table, on a stream and inside ``foreachBatch`` alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmullo.functions.binding import generated
from murmullo.functions.measures import first_highest, probability_array
from murmullo.functions.text import clean_text, has_text
from murmullo.operators.scorers import LexiconScorer, Scorer, score_together
from murmullo.schemas import (
    FINAL, HATE_LABELS, HATE_THRESHOLD, NEUTRAL, NO_HATE, NO_TEXT, SENTIMENT_LABELS,
)
from murmullo.wordlists import EMOJI_NAMES


def clean(df: DataFrame, emoji: Mapping[str, str] = EMOJI_NAMES) -> DataFrame:
    return generated(df, {"comentario_limpio": clean_text(F.col("comentario"), emoji)})


def _with_scores(df: DataFrame, probas: str, labels: Sequence[str]) -> DataFrame:
    """The probabilities as an array in label order, whether given so or as a map."""
    given = F.col(probas)
    is_map = isinstance(df.schema[probas].dataType, T.MapType)
    return df.withColumn("_p", probability_array(given, labels) if is_map else given)


def decide_hate(
    df: DataFrame, probas: str = "probas_odio", text: str = "comentario_limpio",
    threshold: float = HATE_THRESHOLD, labels: Sequence[str] = HATE_LABELS,
) -> DataFrame:
    """Flag, probability and category from the label probabilities.

    The threshold is strict and applies to the unrounded maximum. None of the
    three is ever null, so a null check on them costs nothing.
    """
    top = F.coalesce(F.array_max("_p"), F.lit(0.0))
    some_text = has_text(F.col(text))
    over = top > F.lit(threshold)
    category = F.coalesce(first_highest(F.col("_p"), labels), F.lit(NO_HATE))
    return _with_scores(df, probas, labels).withColumns({
        "es_odio": over & some_text,
        "prob_odio": F.when(some_text, F.coalesce(F.round(top, 3), F.lit(0.0))).otherwise(0.0),
        "categoria_odio": F.when(~some_text, NO_TEXT).when(over, category).otherwise(NO_HATE),
    }).drop("_p")


def decide_sentiment(
    df: DataFrame, probas: str = "probas_sentimiento", text: str = "comentario_limpio",
    labels: Sequence[str] = SENTIMENT_LABELS,
) -> DataFrame:
    """Most probable class and its probability; blank text is neutral."""
    some_text = has_text(F.col(text))
    label = F.coalesce(first_highest(F.col("_p"), labels), F.lit(NEUTRAL))
    top = F.coalesce(F.round(F.array_max("_p"), 3), F.lit(0.0))
    return _with_scores(df, probas, labels).withColumns({
        "sentimiento": F.when(some_text, label).otherwise(NEUTRAL),
        "prob_sentimiento": F.when(some_text, top).otherwise(0.0),
    }).drop("_p")


def classify_hate(df: DataFrame, scorer: Scorer, threshold: float = HATE_THRESHOLD) -> DataFrame:
    scored = scorer(df, "comentario_limpio", "probas_odio")
    return decide_hate(scored, threshold=threshold).drop("probas_odio")


def classify_sentiment(df: DataFrame, scorer: Scorer) -> DataFrame:
    scored = scorer(df, "comentario_limpio", "probas_sentimiento")
    return decide_sentiment(scored).drop("probas_sentimiento")


def with_counts(df: DataFrame, name: str) -> DataFrame:
    """Count all rows and the hate rows under ``name`` while they pass.

    The counts arrive with the result: a ``QueryExecutionListener`` or
    ``Observation`` in a batch job, ``lastProgress.observedMetrics`` in a
    stream. No second scan is needed, but as all rows are counted, a later filter
    cannot be pushed below this point; a name can be used once in a query.
    """
    return df.observe(
        name, F.count(F.lit(1)).alias("total"), F.count_if("es_odio").alias("n_odio")
    )


def _scored(df: DataFrame, hate: Scorer, sentiment: Scorer) -> DataFrame:
    if isinstance(hate, LexiconScorer) and isinstance(sentiment, LexiconScorer):
        return score_together(
            df, "comentario_limpio", {"probas_odio": hate, "probas_sentimiento": sentiment}
        )
    scored = hate(df, "comentario_limpio", "probas_odio")
    return sentiment(scored, "comentario_limpio", "probas_sentimiento")


def enrich(
    raw: DataFrame, hate: Scorer, sentiment: Scorer,
    threshold: float = HATE_THRESHOLD, emoji: Mapping[str, str] = EMOJI_NAMES,
    metrics: str | None = None,
) -> DataFrame:
    """Raw records to final records in one plan.

    The cleaned text and the words found in it are computed once per row, whatever
    is read or filtered later; a filter on a raw column reaches the scan.
    With ``metrics`` the rows are counted under that name.
    """
    scored = _scored(clean(raw, emoji), hate, sentiment)
    final = decide_sentiment(decide_hate(scored, threshold=threshold)).drop(
        "probas_odio", "probas_sentimiento"
    )
    return final if metrics is None else with_counts(final, metrics)


def final_columns(df: DataFrame) -> DataFrame:
    return df.select(*FINAL.names)
