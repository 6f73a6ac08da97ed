"""Text scorers: each adds an array of probabilities, one per declared label.

A scorer is a function ``(df, text_column, target_column) -> df``. The array is
in label order, so the decision reads it without looking names up. Three kinds:

* ``lexicon_scorer``: native expressions over word lists,
* ``classifier_scorer``: an MLlib pipeline trained on labelled rows,
* ``model_scorer``: any Python model, run on Arrow batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmullo.functions.binding import bind, generated
from murmullo.schemas import HATE_LABELS

Scorer = Callable[[DataFrame, str, str], DataFrame]
Lexicon = Mapping[str, Sequence[str]]
# A loaded model: texts in, one probability list per text out (label order).
Model = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def _hits(words: Column, terms: Sequence[str]) -> Column:
    return F.size(F.filter(words, lambda word: word.isin(list(terms)))).cast("double")


@dataclass(frozen=True)
class LexiconScorer:
    """Word lists as a scorer; see ``lexicon_scorer``."""

    lexicon: Lexicon
    labels: Sequence[str]
    half_point: float
    rest_label: str | None

    def __call__(self, df: DataFrame, text: str, target: str) -> DataFrame:
        return score_together(df, text, {target: self})

    def listed(self) -> set[str]:
        return {term for terms in self.lexicon.values() for term in terms}

    def probabilities(self, found: Column) -> Column:
        """From the listed words of a text to the array of probabilities."""
        half = float(self.half_point)
        place = {label: i for i, label in enumerate(self.lexicon)}

        def shares(hits: Column) -> Column:
            total = sum((hits[i] for i in range(1, len(place))), hits[0]) + half

            def of(label: str) -> Column:
                if label == self.rest_label:
                    return F.lit(half) / total
                if label not in place:
                    return F.lit(0.0)
                h = hits[place[label]]
                return h / (h + half) if self.rest_label is None else h / total

            return F.array(*[of(label) for label in self.labels])

        hits = bind(found, lambda f: F.array(*[_hits(f, t) for t in self.lexicon.values()]))
        return bind(hits, shares)


def lexicon_scorer(
    lexicon: Lexicon, labels: Sequence[str] = HATE_LABELS, half_point: float = 2.0,
    rest_label: str | None = None,
) -> LexiconScorer:
    """Probability from the number of listed words in the text.

    Without ``rest_label`` the labels are independent: ``h / (h + half_point)``
    for ``h`` hits. With it they share one total, and ``rest_label`` gets what
    the others leave: ``half_point / (all hits + half_point)``. A label without
    a word list has probability 0.
    """
    unknown = set(lexicon) - set(labels)
    if unknown:
        raise ValueError(f"not among the labels: {sorted(unknown)}")
    return LexiconScorer(lexicon, labels, half_point, rest_label)


def score_together(
    df: DataFrame, text: str, scorers: Mapping[str, LexiconScorer]
) -> DataFrame:
    """Several word-list scorers in one pass: ``target: scorer``.

    The text is split and searched once for all lists; the few words found are
    then sorted out by scorer and label.
    """
    listed = sorted(set().union(*[s.listed() for s in scorers.values()]))
    words = F.split(F.coalesce(F.lower(F.col(text)), F.lit("")), " ")
    found = F.filter(words, lambda word: word.isin(listed))
    searched = generated(df, {"_found": found})
    return searched.withColumns({
        target: scorer.probabilities(F.col("_found")) for target, scorer in scorers.items()
    }).drop("_found")


def fit_classifier(
    labelled: DataFrame, text: str = "comentario_limpio", label: str = "label",
    features: int = 1 << 18, max_iter: int = 20, reg: float = 0.01,
) -> PipelineModel:
    """TF-IDF and logistic regression over labelled texts (label 0 or 1)."""
    pipeline = Pipeline(stages=[
        Tokenizer(inputCol="_text", outputCol="_tok"),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(
            featuresCol="_tfidf", labelCol="_label", maxIter=max_iter, regParam=reg,
            probabilityCol="_prob", rawPredictionCol="_raw", predictionCol="_pred",
        ),
    ])
    return pipeline.fit(
        labelled.select(
            F.coalesce(F.col(text), F.lit("")).alias("_text"),
            F.col(label).cast("double").alias("_label"),
        )
    )


def classifier_scorer(
    model: PipelineModel, label: str, labels: Sequence[str] = HATE_LABELS
) -> Scorer:
    """Score with a fitted pipeline; its positive class becomes ``label``."""

    def score(df: DataFrame, text: str, target: str) -> DataFrame:
        ready = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        positive = vector_to_array("_prob")[1]
        scores = F.array(*[positive if x == label else F.lit(0.0) for x in labels])
        scored = model.transform(ready).withColumn(target, scores)
        return scored.select(*[c for c in df.columns if c != target], target)

    return score


_models: dict[tuple[str, str], Model] = {}


def _loaded(key: str, version: str, load: Callable[[], Model]) -> Model:
    """One model per key in a worker process, loaded when the first batch arrives.

    Another version under the same key takes the place of the old one.
    """
    if (key, version) not in _models:
        for old in [k for k in _models if k[0] == key]:
            del _models[old]
        _models[key, version] = load()
    return _models[key, version]


def model_scorer(
    spark: SparkSession, key: str, load: Callable[[], Model], model_labels: Sequence[str],
    labels: Sequence[str] = HATE_LABELS, batch_size: int = 256,
) -> Scorer:
    """Score with a Python model that ``load`` creates inside the worker.

    The model is never serialised with the job and is reused by all tasks of a
    worker. It sees batches of non-blank texts; blank texts get no scores. Its
    probabilities come in the order of ``model_labels``. The version in the key is a
    hash of ``load`` with what it refers to, so a changed model is loaded anew.
    """
    from murmullo.session import ship_package

    ship_package(spark)
    version = hashlib.sha256(cloudpickle.dumps(load)).hexdigest()
    given = list(model_labels)
    order = [given.index(label) if label in given else None for label in labels]

    @F.pandas_udf("array<double>")
    def probabilities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model: Any = None
        for batch in batches:
            texts = batch.fillna("").tolist()
            wanted = [i for i, one in enumerate(texts) if one.strip()]
            found: list[list[float] | None] = [None] * len(texts)
            for start in range(0, len(wanted), batch_size):
                if model is None:
                    model = _loaded(key, version, load)
                part = wanted[start:start + batch_size]
                for i, row in zip(part, model([texts[i] for i in part])):
                    found[i] = [0.0 if j is None else float(row[j]) for j in order]
            yield pd.Series(found, dtype=object)

    def score(df: DataFrame, text: str, target: str) -> DataFrame:
        return df.withColumn(target, probabilities(F.col(text)))

    return score
