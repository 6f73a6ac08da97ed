import os

import pytest
from pyspark.sql import functions as F

from murmullo.operators.scorers import (
    classifier_scorer, fit_classifier, lexicon_scorer, model_scorer,
)
from murmullo.operators.stages import decide_hate, decide_sentiment, enrich, final_columns
from murmullo.schemas import FINAL, NEUTRAL, SENTIMENT_LABELS

KIND = "i int, comentario_limpio string, p map<string,double>"


@pytest.fixture(scope="module")
def decided(spark):
    rows = [
        (0, "x", {"CALLS": 0.3, "WOMEN": 0.1}),
        (1, "x", {"CALLS": 0.30000001}),
        (2, "x", {"LGBTI": 0.7, "RACISM": 0.7}),
        (3, "x", {"OTHER": 0.9}),
        (4, "  ", {"CALLS": 0.9}),
        (5, None, {"CALLS": 0.9}),
        (6, "x", None),
        (7, "x", {"CLASS": 0.12345, "WOMEN": None}),
        (8, "x", {"POLITICS": 0.2995, "CRIMINAL": 0.9996}),
    ]
    df = spark.createDataFrame(rows, KIND)
    return {
        r.i: (r.es_odio, r.prob_odio, r.categoria_odio)
        for r in decide_hate(df, probas="p").collect()
    }


def test_threshold_is_strict_on_the_unrounded_value(decided):
    assert decided[0] == (False, 0.3, "ninguna")
    assert decided[1] == (True, 0.3, "CALLS")


def test_ties_go_to_the_first_declared_label(decided):
    assert decided[2] == (True, 0.7, "RACISM")


def test_labels_that_are_not_declared_do_not_count(decided):
    assert decided[3] == (False, 0.0, "ninguna")


def test_blank_text(decided):
    assert decided[4] == decided[5] == (False, 0.0, "sin_texto")


def test_missing_scores(decided):
    assert decided[6] == (False, 0.0, "ninguna")
    assert decided[7] == (False, 0.123, "ninguna")
    assert decided[8] == (True, 1.0, "CRIMINAL")


def test_other_threshold(spark):
    df = spark.createDataFrame([(0, "x", {"CALLS": 0.5})], KIND)
    assert not decide_hate(df, probas="p", threshold=0.5).first().es_odio
    assert decide_hate(df, probas="p", threshold=0.4).first().es_odio


def test_sentiment(spark):
    rows = [
        (0, "x", {"POS": 0.2, "NEG": 0.5, "NEU": 0.3}),
        (1, "x", {"POS": 0.4, "NEG": 0.4, "NEU": 0.2}),
        (2, "", {"POS": 0.9}),
        (3, "x", {"NEU": 0.98765, "POS": 0.01235}),
    ]
    found = decide_sentiment(spark.createDataFrame(rows, KIND), probas="p").orderBy("i").collect()
    assert [(r.sentimiento, r.prob_sentimiento) for r in found] == [
        ("NEG", 0.5), ("POS", 0.4), ("NEU", 0.0), ("NEU", 0.988)]


def test_scores_as_an_array(spark):
    rows = [(0, "x", [0.1, 0.4] + [0.0] * 6), (1, "x", None), (2, "x", [None] * 8), (3, "x", [])]
    df = spark.createDataFrame(rows, "i int, comentario_limpio string, p array<double>")
    found = decide_hate(df, probas="p").orderBy("i").collect()
    assert [(r.es_odio, r.prob_odio, r.categoria_odio) for r in found] == [
        (True, 0.4, "CRIMINAL")] + [(False, 0.0, "ninguna")] * 3
    found = decide_sentiment(df, probas="p").orderBy("i").collect()
    assert [(r.sentimiento, r.prob_sentimiento) for r in found] == [("NEG", 0.4)] + [("NEU", 0.0)] * 3


def test_lexicon_scorer(spark):
    score = lexicon_scorer({"B": ["tres"], "A": ["uno", "dos"]}, ["A", "B", "C"], half_point=1.0)
    df = spark.createDataFrame([("Uno dos cuatro dos",), ("",), (None,), ("unos",)], "t string")
    found = [r.s for r in score(df, "t", "s").collect()]
    assert found == [[0.75, 0.0, 0.0]] + [[0.0, 0.0, 0.0]] * 3
    shared = lexicon_scorer({"POS": ["bien"], "NEG": ["mal"]}, SENTIMENT_LABELS, 1.0, "NEU")
    df = spark.createDataFrame([("bien bien mal",), ("x",)], "t string")
    assert [r.s for r in shared(df, "t", "s").collect()] == [[0.5, 0.25, 0.25], [0.0, 0.0, 1.0]]
    with pytest.raises(ValueError, match="OTRA"):
        lexicon_scorer({"OTRA": ["x"]})


def test_model_is_loaded_in_the_worker_and_skips_blank_text(spark):
    def load():
        import os

        pid = float(os.getpid())

        def predict(texts):
            assert all(t.strip() for t in texts) and len(texts) <= 3
            return [[pid, min(1.0, len(t) / 10), 0.7] for t in texts]

        return predict

    labels = ["CALLS", "RACISM", "WOMEN"]
    scorer = model_scorer(spark, "lengths", load, ["WOMEN", "CALLS", "other"], labels, batch_size=3)
    df = spark.range(20).select(
        F.when(F.col("id") % 5 == 0, F.lit("  ")).when(F.col("id") % 5 == 1, F.lit(None))
        .otherwise(F.repeat(F.lit("a"), F.col("id").cast("int"))).alias("t"), "id")
    found = {r.id: r.s for r in scorer(df, "t", "s").collect()}
    assert all(found[i] is None for i in range(20) if i % 5 < 2)
    assert found[2][:2] == [0.2, 0.0] and found[19][:2] == [1.0, 0.0]
    assert all(v[2] != float(os.getpid()) for v in found.values() if v)


def test_classifier_learns_the_labelled_words(spark):
    rows = [(f"texto {'idiota' if i % 3 == 0 else 'amable'} {i % 7}", int(i % 3 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "comentario_limpio string, label int")
    model = fit_classifier(df, features=1 << 10)
    scorer = classifier_scorer(model, "CALLS")
    probe = spark.createDataFrame([("eres idiota",), ("muy amable",), (None,)], "t string")
    bad, good, none = [r.s[0] for r in scorer(probe, "t", "s").collect()]
    assert bad > 0.5 > good and 0.0 <= none <= 1.0


def test_enrich_gives_the_final_schema_and_counts(spark):
    raw = spark.createDataFrame(
        [("a", "IDIOTA!!! @x", 3, "", 0), ("b", "hola 😂", 1, "", 0), ("c", "https://x", 0, "", 0)],
        "autor string, comentario string, likes long, fecha string, respuestas long",
    )
    hate = lexicon_scorer({"CALLS": ["idiota"]})
    mood = lexicon_scorer({"POS": ["risa"], "NEG": ["idiota"]}, SENTIMENT_LABELS, rest_label=NEUTRAL)
    found = final_columns(enrich(raw, hate, mood))
    assert found.columns == FINAL.names
    assert [f.dataType for f in found.schema] == [f.dataType for f in FINAL]
    rows = {r.autor: r for r in found.collect()}
    assert rows["a"].es_odio and rows["a"].categoria_odio == "CALLS" and rows["a"].prob_odio == 0.333
    assert rows["b"].comentario_limpio == "hola cara llorando de risa"
    assert rows["c"].categoria_odio == "sin_texto" and rows["c"].sentimiento == "NEU"
