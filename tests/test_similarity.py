import math

import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors

from murmullo.operators.similarity import (
    VocabularyTooLarge, _best_of, fit_word2vec, load_model, nearest_terms, save_model, saved_vectors,
    vocabulary_size, word_lists,
)

VECTORS = {
    "rey": [1.0, 0.0, 0.2], "reina": [0.9, 0.1, 0.2], "perro": [0.0, 1.0, 0.0],
    "gato": [0.1, 0.9, -0.1], "nulo": [0.0, 0.0, 0.0], "anti": [-1.0, 0.0, -0.2],
}


def _cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def _expected(term, k):
    scores = [(w, _cosine(VECTORS[term], v)) for w, v in VECTORS.items() if w != term and any(v)]
    return [(term, w, round(s, 4)) for w, s in sorted(scores, key=lambda p: (-p[1], p[0]))[:k]]


@pytest.mark.parametrize("kind", ["array<float>", "vector"])
def test_nearest_terms_against_brute_force(spark, kind):
    if kind == "vector":
        df = spark.createDataFrame([(w, Vectors.dense(v)) for w, v in VECTORS.items()], ["word", "vector"])
    else:
        df = spark.createDataFrame(list(VECTORS.items()), f"word string, vector {kind}")
    found = [tuple(r) for r in nearest_terms(df, ["rey", "gato", "ausente", "nulo"], 3).collect()]
    expected = _expected("gato", 3) + _expected("rey", 3)
    assert [f[:2] for f in found] == [e[:2] for e in expected]
    assert [f[2] for f in found] == pytest.approx([e[2] for e in expected], abs=1e-4)


def test_no_key_term_gives_an_empty_table(spark):
    df = spark.createDataFrame(list(VECTORS.items()), "word string, vector array<float>")
    found = nearest_terms(df, ["ausente"])
    assert found.collect() == []
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "string", "double"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(f"voto {'bueno' if i % 2 else 'malo'} palabra{i % 5}  del  dia",) for i in range(60)]
    return spark.createDataFrame([*rows, ("",), (None,), ("   ",)], "comentario_limpio string")


def test_word_lists_have_no_empty_words(texts):
    lists = word_lists(texts)
    assert lists.count() == 60
    assert all(w for r in lists.collect() for w in r.tokens)


def test_train_save_and_read_back(spark, texts, tmp_path):
    lists, path = word_lists(texts), str(tmp_path / "m")
    model = fit_word2vec(lists)
    save_model(model, path)
    save_model(model, path)  # overwrites
    vectors = saved_vectors(spark, path)
    assert vectors.count() == vocabulary_size(lists, 1) == load_model(path).getVectors().count() == 10
    assert len(vectors.first().vector) == 50
    near = nearest_terms(vectors, ["voto", "malo"], 4).collect()
    for term in ("voto", "malo"):
        rows = [r for r in near if r.palabra_clave == term]
        assert len(rows) == 4 and term not in {r.palabra_similar for r in rows}
        values = [r.similitud for r in rows]
        assert values == sorted(values, reverse=True) and all(-1 <= v <= 1 for v in values)
    told = {r.word: r.similarity for r in load_model(path).findSynonyms("voto", 4).collect()}
    mine = {r.palabra_similar: r.similitud for r in near if r.palabra_clave == "voto"}
    assert mine == pytest.approx(told, abs=1e-3)


def test_large_vocabulary_stops_with_advice(texts):
    with pytest.raises(VocabularyTooLarge, match="min_count"):
        fit_word2vec(word_lists(texts), max_vocabulary=9)
    fit_word2vec(word_lists(texts), max_vocabulary=9, min_count=20)


def test_each_text_is_split_once(texts):
    plan = word_lists(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_remove") == 1


def test_nearest_of_odd_and_equal_vectors(spark):
    """Ties go by word over several batches; what has no numbers is left out, another size has no cosine."""
    rows = [(f"w{i:05d}", [1.0 + i % 2, 2.0]) for i in range(30_000)]
    odd = [("k", [1.0, 2.0]), ("nulo", None), ("hueco", [1.0, None]), ("largo", [1.0, 2.0, 3.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "word string, vector array<float>")
    found = [tuple(r) for r in nearest_terms(df, ["k"], 4).collect()]
    assert found == [("k", f"w{i:05d}", 1.0) for i in (0, 2, 4, 6)]
    few = [tuple(r) for r in nearest_terms(spark.createDataFrame(odd, df.schema), ["k"], 4).collect()]
    assert few == [("k", "largo", None)]


def test_a_batch_sends_only_words_that_may_be_near():
    values = pa.array([[float(i), 1.0] for i in range(500)], pa.list_(pa.float32()))
    batch = pa.RecordBatch.from_arrays([pa.array([f"w{i}" for i in range(500)]), values], ["word", "v"])
    sent = list(_best_of(iter([batch]), [("k", [1.0, 0.0]), ("w0", [0.0, 1.0])], 3))
    assert [sorted(b.column(1).to_pylist()) for b in sent] == [["w497", "w498", "w499"], ["w1", "w2", "w3"]]
