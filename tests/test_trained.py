"""Scorers for all labels: calibrated sums, unseen texts, decisions, ties and blank texts."""

import random

import pytest
from pyspark.sql import functions as F

from checks import registry
from murmullo.operators import trained
from murmullo.operators.stages import decide_hate, decide_sentiment
from murmullo.schemas import HATE_LABELS, SENTIMENT_LABELS

SIGNS = {label: f"sign{label.lower()}" for label in HATE_LABELS}
MOODS = {"POS": "bueno", "NEG": "malo"}


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    plain = [f"palabra{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        words = rng.choices(plain, k=rng.randint(3, 12))
        words += [s for s in SIGNS.values() if rng.random() < 0.12]
        words += [m for m in MOODS.values() if rng.random() < 0.35]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(2000 + i, None if i % 2 else "  ") for i in range(10)]
    return spark.createDataFrame(rows, "id int, comentario_limpio string").cache()


def says(term):
    return F.array_contains(F.split("comentario_limpio", " "), term)


@pytest.fixture(scope="module")
def hate(texts):
    return trained.fit_labels(texts, {x: says(t) for x, t in SIGNS.items()}, reg=1e-4)


@pytest.fixture(scope="module")
def mood(texts):
    # Texts with both words are of the first class that holds.
    return trained.fit_labels(
        texts, {"POS": says(MOODS["POS"]), "NEG": says(MOODS["NEG"]), "NEU": F.lit(True)}, exclusive=True, reg=1e-4)


def test_probabilities_add_up_to_the_labels(texts, hate):
    rows = trained.calibration_sums(hate, texts, {x: says(t) for x, t in SIGNS.items()}, "comentario_limpio").collect()
    assert {r.label for r in rows} == set(HATE_LABELS)
    for r in rows:
        assert 0 < r.cases < r.texts and r.expected == pytest.approx(r.cases, abs=1e-6)


def test_errors_on_unseen_texts(hate, mood):
    assert [r.label for r in hate.report] == list(HATE_LABELS) and all(r.texts > 80 for r in hate.report)
    assert all(r.wrong <= 0.03 and r.squared_error <= 0.03 for r in hate.report)
    assert [r.label for r in mood.report] == list(SENTIMENT_LABELS)
    assert all(r.wrong <= 0.05 for r in mood.report)


def test_every_label_has_a_probability_and_decisions_follow(texts, hate, mood):
    scored = mood(hate(texts, "comentario_limpio", "probas_odio"), "comentario_limpio", "probas_sentimiento")
    assert scored.columns == ["id", "comentario_limpio", "probas_odio", "probas_sentimiento"]
    rows = decide_sentiment(decide_hate(scored)).collect()
    right = 0
    for r in rows:
        if not (r.comentario_limpio or "").strip():
            assert r.probas_odio is None and r.categoria_odio == "sin_texto" and r.sentimiento == "NEU"
            continue
        assert len(r.probas_odio) == 8 and all(0 <= p <= 1 for p in r.probas_odio)
        assert len(r.probas_sentimiento) == 3 and sum(r.probas_sentimiento) == pytest.approx(1)
        # The first of equal labels, as the decision has it for every scorer.
        top = max(r.probas_odio)
        if top > 0.3:
            assert r.categoria_odio == HATE_LABELS[r.probas_odio.index(top)]
        else:
            assert r.categoria_odio == "ninguna"
        words = r.comentario_limpio.split()
        true = "POS" if MOODS["POS"] in words else "NEG" if MOODS["NEG"] in words else "NEU"
        right += (r.es_odio == any(s in words for s in SIGNS.values())) and r.sentimiento == true
    assert right / (len(rows) - 10) > 0.95


def test_a_label_without_cases_has_probability_zero(texts):
    scorer = trained.fit_labels(texts, {"A": says(SIGNS["CALLS"]), "B": F.lit(False), "C": F.lit(None).cast("boolean")})
    found = scorer(texts.filter("id < 50"), "comentario_limpio", "p").collect()
    assert all(r.p[1] == 0 and r.p[2] == 0 for r in found)


def test_copies_are_in_one_part(spark):
    parts = spark.createDataFrame([("x",)] * 5 + [(None,), ("",)], "t string").select(trained.part_of(F.col("t")).alias("p"))
    found = [r.p for r in parts.collect()]
    assert len(set(found[:5])) == 1 and found[5] == found[6] and all(0 <= p < 10 for p in found)


def test_texts_are_hashed_once(texts, monkeypatch):
    """The weights and the models read stored vectors; no text is stored to be hashed again."""
    written, plans = [], []
    plain, fit = trained.stage, trained.IDF.fit
    monkeypatch.setattr(trained, "stage", lambda df, purpose: written.append(df.columns) or plain(df, purpose))
    monkeypatch.setattr(trained.IDF, "fit", lambda self, df: plans.append(
        df._jdf.queryExecution().toString()) or fit(self, df))
    scorer = trained.fit_labels(texts, {"A": says(SIGNS["CALLS"])}, max_iter=2)
    assert written == [["_tf", "_part", "_y"], ["_f", "_part", "_y"]]
    assert len(plans) == 1 and "UDF" not in plans[0]
    assert len(scorer.features.stages) == 3
    assert scorer(texts.limit(3), "comentario_limpio", "p").count() == 3


def test_models_read_their_features_from_memory(spark, texts, monkeypatch):
    """The files are read for the first model; when all are trained, nothing stays in memory."""
    plans, fit = [], trained.LogisticRegression.fit
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr(trained.LogisticRegression, "fit", lambda self, df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or fit(self, df))
    trained.fit_labels(texts, {x: says(SIGNS[x]) for x in ("CALLS", "WOMEN")}, max_iter=2)
    assert len(plans) == 2 and all("InMemoryTableScan" in plan for plan in plans)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_words_of_all_labels_are_looked_up_once(spark):
    lexicon = {"A": ["x", "y z"], "B": ["w"], "C": ["x", "w", ""]}
    rows = [(t,) for t in ("x", "w x w", "xw", "", "y z", "q  r", None)]
    found = spark.createDataFrame(rows, "comentario_limpio string").select(
        "comentario_limpio", *[c.alias(k) for k, c in registry._says(lexicon).items()])
    for r in found.collect():
        words = None if r[0] is None else r[0].split(" ")
        assert list(r[1:]) == [None if words is None else any(w in words for w in lexicon[k]) for k in "ABC"]
