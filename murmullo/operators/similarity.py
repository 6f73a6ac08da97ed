"""Word vectors and the nearest words of key terms."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmullo.functions.binding import generated
from murmullo.operators.skipgram import fit_skipgram
from murmullo.session import ship_package
from murmullo.wordlists import KEY_TERMS


class VocabularyTooLarge(ValueError):
    """The vocabulary is larger than was allowed; raise ``min_count``."""


class WordVectors:
    """A table of words and vectors, with the names that MLlib's model has for them."""

    def __init__(self, vectors: DataFrame):
        self._vectors = vectors

    def getVectors(self) -> DataFrame:  # noqa: N802
        return self._vectors

    def findSynonyms(self, word: str, num: int) -> DataFrame:  # noqa: N802
        return nearest_terms(self._vectors, [word], num).select(
            F.col("palabra_similar").alias("word"), F.col("similitud").alias("similarity"))


def word_lists(
    df: DataFrame, text: str = "comentario_limpio", keep: Sequence[str] = ()
) -> DataFrame:
    """The words of each text; empty words and empty texts are left out."""
    # Cleaned text has single spaces: a plain split of these takes a fraction of a pattern's time.
    words = F.when(F.col(text).rlike(r"[\t\n\x0b\f\r]"), F.split(text, r"\s")).otherwise(F.split(text, " "))
    # Through a generator: a filter on the size would otherwise split each text once more.
    lists = generated(df.filter(F.col(text).isNotNull()), {"tokens": F.array_remove(words, "")})
    return lists.select(*keep, "tokens").filter(F.size("tokens") > 0)


def vocabulary_size(lists: DataFrame, min_count: int) -> int:
    words = lists.select(F.explode("tokens").alias("w")).groupBy("w").agg(
        F.count("*").alias("n")
    )
    return words.filter(F.col("n") >= min_count).count()


def fit_word2vec(
    lists: DataFrame, vector_size: int = 50, min_count: int = 1, seed: int = 42,
    max_iter: int = 1, num_partitions: int = 2, max_vocabulary: int | None = None,
) -> WordVectors:
    """Train word vectors.

    Texts are trained in parts and the parts' vectors merged, so the model depends on
    ``num_partitions``, the least number of parts at once; more are made by the size of the
    texts, never by that of the cluster. With ``max_vocabulary`` the vocabulary is counted
    first and the job stops where it is larger, rather than dropping words on its own.
    """
    if max_vocabulary is not None:
        found = vocabulary_size(lists, min_count)
        if found > max_vocabulary:
            raise VocabularyTooLarge(
                f"{found} words occur {min_count} times or more; "
                f"raise min_count or max_vocabulary ({max_vocabulary})"
            )
    return WordVectors(fit_skipgram(lists, vector_size, min_count, seed, max_iter, num_partitions))


def _best_of(
    batches: Iterator[pa.RecordBatch], keys: Sequence[tuple[str, Sequence[float]]], k: int
) -> Iterator[pa.RecordBatch]:
    """Of each batch and key term, the words that can be among the ``k`` nearest: those up to
    the k-th highest cosine, ties included.

    Products are added up dimension by dimension, so equal vectors have equal cosines. Null
    vectors and those with a null are left out; those of another size have a null cosine.
    """
    for batch in batches:
        listed = batch.column("v")
        if listed.null_count or listed.flatten().null_count:
            whole = [v is not None and None not in v for v in listed.to_pylist()]
            batch = batch.filter(pa.array(whole, pa.bool_()))
            listed = batch.column("v")
        sizes = listed.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            some = pa.array(np.flatnonzero(sizes == size))
            words = batch.column("word").take(some)
            rows = listed.take(some).flatten().to_numpy(zero_copy_only=False).reshape(len(some), size)
            by_dimension = np.array(rows.T, np.float64, order="C")
            norm = np.sqrt(_added(by_dimension, by_dimension, len(some)))
            for term, vector in keys:
                at = np.flatnonzero(~(norm <= 0) & pc.not_equal(words, term).to_numpy(zero_copy_only=False))
                if len(vector) != size:
                    cosine = pa.nulls(len(at), pa.float64())
                else:
                    dot = _added(by_dimension, vector, len(some))
                    cosine = dot[at] / math.sqrt(sum(x * x for x in vector)) / norm[at]
                    if len(at) > k:
                        near = ~(cosine < np.partition(cosine, -k)[-k])
                        at, cosine = at[near], cosine[near]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([term] * len(at), pa.string()), words.take(pa.array(at)), pa.array(cosine)],
                    ["palabra_clave", "palabra_similar", "_cosine"])


def _added(rows: np.ndarray, others: Sequence, many: int) -> np.ndarray:
    total = np.zeros(many)
    for x, y in zip(rows, others):
        total += x * y
    return total


def nearest_terms(
    vectors: DataFrame, terms: Sequence[str] = KEY_TERMS, k: int = 5
) -> DataFrame:
    """The ``k`` words with the highest cosine for each key term.

    ``vectors`` has ``word`` and ``vector`` (an array or an ML vector). The few key vectors come to the
    driver (one row per key term) and go back with the tasks, so the vocabulary is
    read once and never joined. A term outside the vocabulary gives no rows; if
    none is in it, the result is empty.
    """
    kind = vectors.schema["vector"].dataType
    plain = F.col("vector") if isinstance(kind, T.ArrayType) else vector_to_array("vector")
    double = plain.cast("array<double>")
    words = vectors.select("word", double.alias("v"))
    # Most vectors are of floats, half as large.
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    keys = {
        row["word"]: row["v"]
        for row in words.filter(F.col("word").isin(list(terms))).collect()
    }
    entries = [(term, v) for term, v in sorted(keys.items()) if any(v)]
    if not entries or k < 1:
        return words.limit(0).select(
            F.lit("").alias("palabra_clave"), F.col("word").alias("palabra_similar"),
            F.lit(0.0).alias("similitud"),
        )
    ship_package(vectors.sparkSession)
    pairs = vectors.filter(F.col("word").isNotNull()).select(
        F.col("word").cast("string"), (plain if floats else double).alias("v")
    ).mapInArrow(
        lambda batches: _best_of(batches, entries, k),
        "palabra_clave string, palabra_similar string, _cosine double")
    best = Window.partitionBy("palabra_clave").orderBy(F.desc("_cosine"), "palabra_similar")
    return (
        pairs.withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= k)
        .select("palabra_clave", "palabra_similar", F.round("_cosine", 4).alias("similitud"))
        .orderBy("palabra_clave", F.desc("similitud"), "palabra_similar")
    )


def save_model(model: WordVectors, path: str) -> None:
    model.getVectors().write.mode("overwrite").parquet(f"{path.rstrip('/')}/data")


def saved_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The word vectors of a saved model, read by the executors."""
    return spark.read.parquet(f"{path.rstrip('/')}/data").select("word", "vector")


def load_model(path: str) -> WordVectors:
    return WordVectors(saved_vectors(SparkSession.active(), path))
