"""Scorers trained for all labels of a decision, with calibrated probabilities.

Features are made once for all labels and written. Independent labels (the hate
categories) get one binary model each over them, exclusive ones (the sentiments) one
multinomial model. A part of the texts that the models have not seen calibrates each
label: its scores are put into bins, and an isotonic regression over the bins gives the
share of true cases. The calibrated probabilities of that part then add up to its
labelled cases, label by label. Another part gives the errors in ``report``.

Parts are taken by a hash of the text, so copies of a text are never on both sides. A
label without a case has probability 0. Blank texts get no scores, and the decision
treats them as it does with any scorer; equal probabilities too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from murmullo.functions.text import has_text
from murmullo.operators.ordered import stage

# Of ten parts of the texts: two calibrate, one tells the errors, the others train.
PARTS = 10
CALIBRATES, TELLS = (0, 1), (2,)
BINS = 512
# A model of exclusive classes multiplies rows in blocks, and each block fills a whole table
# of coefficients: blocks of the default size, 1 MB, hold little more than that. Binary models
# have no such table, so 0, the default, is left to them.
_BLOCK_MB = {"multinomial": 8.0, "binomial": 0.0}


def part_of(text: Column) -> Column:
    """The part of a text, from its MD5."""
    start = F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 4)
    return F.pmod(F.conv(start, 16, 10).cast("int"), F.lit(PARTS))


@dataclass(frozen=True)
class TrainedScorer:
    """A fitted scorer for ``labels``; call it like any other."""

    features: PipelineModel
    models: Sequence[LogisticRegressionModel]
    labels: Sequence[str]
    exclusive: bool
    curves: Sequence[Sequence[float]] = ()
    report: Sequence[Row] = field(default=())

    def _raw(self, df: DataFrame) -> tuple[DataFrame, Column]:
        """Scores of all labels from the features, not calibrated."""
        for model in self.models:
            df = model.transform(df)
        if self.exclusive:
            return df, vector_to_array("_p0")
        return df, F.array(*[vector_to_array(f"_p{i}")[1] for i in range(len(self.labels))])

    def calibrated(self, raw: Column) -> Column:
        """The share of true cases in the bin of each label's score."""
        steps = F.array(*[F.array(*[F.lit(float(x)) for x in curve]) for curve in self.curves])
        return F.zip_with(raw, steps, lambda p, curve: F.get(curve, _bin(p)))

    def probabilities(self, raw: Column) -> Column:
        found = self.calibrated(raw)
        if not self.exclusive:
            return found
        total = F.aggregate(found, F.lit(0.0), lambda a, x: a + x)
        return F.when(total > 0, F.transform(found, lambda x: x / total)).otherwise(raw)

    def __call__(self, df: DataFrame, text: str, target: str) -> DataFrame:
        ready = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        scored, raw = self._raw(self.features.transform(ready))
        found = F.when(has_text(F.col(text)), self.probabilities(raw))
        return scored.withColumn(target, found).select(*[c for c in df.columns if c != target], target)


def _bin(p: Column) -> Column:
    return F.least(F.floor(p * BINS), F.lit(BINS - 1)).cast("int")


def fit_labels(
    labelled: DataFrame, labels: Mapping[str, Column], text: str = "comentario_limpio",
    exclusive: bool = False, features: int = 1 << 16, max_iter: int = 30, reg: float = 1e-3,
) -> TrainedScorer:
    """Train on texts with, per label, a boolean column; null is no case.

    With ``exclusive`` the first label that holds is the class of a text, and the last
    one where none does.
    """
    names = list(labels)
    true = [F.coalesce(c, F.lit(False)) for c in labels.values()]
    if exclusive:
        first = F.array_position(F.array(*true[:-1], F.lit(True)), F.lit(True)) - 1
        cases = [first == i for i in range(len(names))]
    else:
        cases = true
    rows = labelled.filter(has_text(F.col(text))).select(
        F.col(text).alias("_text"), part_of(F.col(text)).alias("_part"),
        F.array(*[c.cast("double") for c in cases]).alias("_y"))
    # Texts are cut and hashed once: the weights are found from the stored terms, and the
    # models start from the stored features.
    terms = PipelineModel(stages=[
        Tokenizer(inputCol="_text", outputCol="_tok"),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=features),
    ])
    trains = ~F.col("_part").isin(*CALIBRATES, *TELLS)
    counted = stage(terms.transform(rows).select("_tf", "_part", "_y"), "trained-terms")
    weights = IDF(inputCol="_tf", outputCol="_f").fit(counted.filter(trains))
    fitted = PipelineModel(stages=[*terms.stages, weights])
    table = stage(weights.transform(counted).select("_f", "_part", "_y"), "trained-features")
    # Every model reads them twice: from memory, as far as there is room, not from the files.
    known = table.filter(trains).select("_f", "_y").persist()

    def model(i: int, label: Column, family: str) -> LogisticRegressionModel:
        return LogisticRegression(
            featuresCol="_f", labelCol="_label", maxIter=max_iter, regParam=reg, family=family,
            probabilityCol=f"_p{i}", rawPredictionCol=f"_r{i}", predictionCol=f"_c{i}",
            maxBlockSizeInMB=_BLOCK_MB[family],
        ).fit(known.select("_f", label.alias("_label")))

    try:
        if exclusive:
            place = F.array_position("_y", F.lit(1.0)) - 1
            models = [model(0, place.cast("double"), "multinomial")]
            # A class that no text of the training part has would be missing at the end.
            if models[0].numClasses < len(names):
                raise ValueError(f"no text to train on is {names[-1]}")
        else:
            models = [model(i, F.get("_y", F.lit(i)), "binomial") for i in range(len(names))]
    finally:
        known.unpersist()
    plain = TrainedScorer(fitted, models, names, exclusive)
    curves = _curves(plain, table)
    ready = TrainedScorer(fitted, models, names, exclusive, curves)
    return TrainedScorer(fitted, models, names, exclusive, curves, _errors(ready, table))


def _by_label(scorer: TrainedScorer, table: DataFrame, parts: Sequence[int], value) -> DataFrame:
    """``label`` (its number), score ``p`` and case ``y`` of the texts of some parts."""
    scored, raw = scorer._raw(table.filter(F.col("_part").isin(*parts)))
    met = F.arrays_zip(value(raw).alias("p"), F.col("_y").alias("y"))
    return scored.select(F.posexplode(met).alias("label", "_x")).select("label", "_x.p", "_x.y")


def _curves(scorer: TrainedScorer, table: DataFrame) -> list[list[float]]:
    """For each label the calibrated probability of every bin; a row per bin and label
    comes to the driver."""
    binned = _by_label(scorer, table, CALIBRATES, lambda raw: raw).groupBy(
        "label", _bin(F.col("p")).alias("bin")).agg(F.avg("y").alias("y"), F.count("*").cast("double").alias("n"))
    spark = table.sparkSession
    found = binned.orderBy("label", "bin").collect()
    curves = []
    for i in range(len(scorer.labels)):
        own = [(float(r.bin), r.y, r.n) for r in found if r.label == i]
        if not own:
            curves.append([0.0] * BINS)
            continue
        steps = IsotonicRegression(featuresCol="bin", labelCol="y", weightCol="n").fit(
            spark.createDataFrame(own, "bin double, y double, n double"))
        curves.append(np.interp(
            np.arange(BINS), steps.boundaries.toArray(), steps.predictions.toArray()).tolist())
    return curves


def _errors(scorer: TrainedScorer, table: DataFrame) -> list[Row]:
    """Per label, over texts that neither trained nor calibrated: cases, mean squared
    error of the probability, and the share decided wrongly at one half."""
    p, y = F.col("p"), F.col("y")
    found = _by_label(scorer, table, TELLS, scorer.probabilities).groupBy("label").agg(
        F.count("*").alias("texts"), F.sum("y").cast("bigint").alias("cases"),
        F.avg((p - y) * (p - y)).alias("squared_error"),
        F.avg(((p > 0.5) != (y > 0.5)).cast("double")).alias("wrong"))
    rows = found.orderBy("label").collect()
    return [Row(label=scorer.labels[r.label], texts=r.texts, cases=r.cases,
                squared_error=r.squared_error, wrong=r.wrong) for r in rows]


def calibration_sums(scorer: TrainedScorer, labelled: DataFrame, labels: Mapping[str, Column], text: str) -> DataFrame:
    """Per label over the texts that calibrated it: texts, cases, and the sum of the
    calibrated probabilities, which is the number of cases."""
    rows = labelled.filter(has_text(F.col(text)) & part_of(F.col(text)).isin(*CALIBRATES)).select(
        F.col(text).alias("_text"), F.array(*labels.values()).alias("_cases"))
    scored, raw = scorer._raw(scorer.features.transform(rows))
    names = F.array(*[F.lit(x) for x in scorer.labels])
    met = F.arrays_zip(names.alias("label"), scorer.calibrated(raw).alias("p"), F.col("_cases").alias("y"))
    return scored.select(F.inline(met)).groupBy("label").agg(
        F.count("*").alias("texts"), F.count_if("y").alias("cases"), F.sum("p").alias("expected"))
