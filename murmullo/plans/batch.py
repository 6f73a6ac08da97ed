"""The batch jobs: read a table, compute one result, write it, once each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from murmullo.operators.cooccurrence import word_vectors
from murmullo.operators.correlation import likes_correlation
from murmullo.operators.risk import user_risk_score
from murmullo.operators.similarity import (
    fit_word2vec, nearest_terms, save_model, saved_vectors, word_lists,
)
from murmullo.operators.stages import enrich, final_columns
from murmullo.operators.scorers import Scorer
from murmullo.operators.terms import top_hate_terms
from murmullo.operators.trend import hourly_trend
from murmullo.schemas import FINAL, HATE_THRESHOLD
from murmullo.sources.records import decode, encode
from murmullo.sources.tables import (
    coerce_export, export_table, normalize_comments, read_table, require_rows, write_table,
)
from murmullo.sources.topics import Topic
from murmullo.wordlists import KEY_TERMS

# What an export and a report need at least.
MIN_EXPORT_ROWS = 1
MIN_BATCH_ROWS = 10

REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "top_hate_terms": top_hate_terms,
    "user_risk_score": user_risk_score,
    "hourly_trend": hourly_trend,
    "likes_correlation": likes_correlation,
}


def run_report(
    spark: SparkSession, name: str, source: str, target: str,
    min_rows: int = MIN_BATCH_ROWS, **options,
) -> None:
    """One of ``REPORTS`` from a Parquet table of final records to another."""
    comments = read_table(spark, source, FINAL)
    require_rows(comments, min_rows)
    write_table(REPORTS[name](comments, **options), target)


def run_synonyms(
    spark: SparkSession, source: str, target: str, model_path: str,
    terms: Sequence[str] = KEY_TERMS, k: int = 5, min_rows: int = MIN_BATCH_ROWS,
    from_counts: bool = False, **training,
) -> None:
    """Train and save word vectors, then write the neighbours of the key terms.
    If no key term is in the vocabulary, the result is an empty table, so none of
    an earlier run is left in place. With ``from_counts`` the vectors come from
    co-occurrence counts, and the model is the table of them."""
    comments = read_table(spark, source, FINAL)
    require_rows(comments, min_rows)
    if from_counts:
        write_table(word_vectors(word_lists(comments), **training), model_path)
        write_table(nearest_terms(read_table(spark, model_path), terms, k), target)
        return
    model = fit_word2vec(word_lists(comments), **training)
    save_model(model, model_path)
    write_table(nearest_terms(saved_vectors(spark, model_path), terms, k), target)


def run_publish(spark: SparkSession, source: str, topic: Topic) -> None:
    """Normalise a table of mixed comments and publish it as JSON records."""
    topic.write_batch(encode(normalize_comments(read_table(spark, source))))


def run_export(
    spark: SparkSession, topic: Topic, paths: Sequence[str],
    max_messages: int | None = None, min_rows: int = MIN_EXPORT_ROWS,
) -> list[str]:
    """What is in a topic now, as a typed Parquet table at each path.
    Malformed and blank lines are skipped; an empty topic is an error. The topic is read
    once: bounds come from its offsets, and the rows that were written are counted."""
    records = coerce_export(decode(topic.read_batch(spark, max_messages), FINAL))
    return export_table(records, paths, min_rows)


def run_enrichment(
    spark: SparkSession, source: str, target: str, hate: Scorer, sentiment: Scorer,
    threshold: float = HATE_THRESHOLD,
) -> None:
    """A table of mixed comments to a table of final records, without topics."""
    raw = normalize_comments(read_table(spark, source))
    write_table(final_columns(enrich(raw, hate, sentiment, threshold)), target)
