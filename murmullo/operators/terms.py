"""Word frequencies and top terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.functions.text import is_term, letter_tokens, loose_tokens
from murmullo.wordlists import NEGATIVE_STOPWORDS, TERM_STOPWORDS


def word_counts(
    df: DataFrame, words: Column, longer_than: int, stopwords: Sequence[str] | DataFrame,
    word: str = "palabra", count: str = "count",
) -> DataFrame:
    """Occurrences of each word.

    Words are counted inside each task before the shuffle, so a word that makes
    up a third of the text costs one row per task. Stop words are a list, or a
    table with a column of the same name for lists too long for ``isin``; the
    table meets the counts, where every word is one row.
    """
    listed = () if isinstance(stopwords, DataFrame) else stopwords
    counts = (
        df.select(F.explode(words).alias(word))
        .filter(is_term(F.col(word), longer_than, listed))
        .groupBy(word)
        .agg(F.count("*").alias(count))
    )
    if isinstance(stopwords, DataFrame):
        counts = counts.join(stopwords.select(word), word, "left_anti")
    return counts


def top(counts: DataFrame, k: int, word: str = "palabra", count: str = "count") -> DataFrame:
    """The ``k`` most frequent; equal counts in word order."""
    return counts.orderBy(F.desc(count), F.asc(word)).limit(k)


def top_hate_terms(
    df: DataFrame, k: int = 30, text: str = "comentario_limpio", flag: str = "es_odio",
    stopwords: Sequence[str] | DataFrame = TERM_STOPWORDS, longer_than: int = 2,
) -> DataFrame:
    hate = df.filter(F.col(flag))
    return top(word_counts(hate, loose_tokens(F.col(text)), longer_than, stopwords), k)


def top_negative_terms(
    df: DataFrame, k: int = 15, text: str = "comentario_limpio",
    sentiment: str = "sentimiento",
    stopwords: Sequence[str] | DataFrame = NEGATIVE_STOPWORDS, longer_than: int = 3,
) -> DataFrame:
    negative = df.filter((F.col(sentiment) == "NEG") & F.col(text).isNotNull())
    counts = word_counts(
        negative, letter_tokens(F.col(text)), longer_than, stopwords, count="frecuencia"
    )
    return top(counts, k, count="frecuencia")

