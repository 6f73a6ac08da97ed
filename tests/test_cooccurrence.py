"""Co-occurrence counts and information against plain loops, factors against numpy, and
neighbours against those of Word2Vec."""

import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import murmullo.operators.cooccurrence as co
from murmullo.operators.similarity import fit_word2vec, nearest_terms

WINDOW = 3


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    return [[rng.choice(words[: rng.choice([5, 15, 40])]) for _ in range(rng.randint(0, 30))] for _ in range(80)]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(3)


def brute(texts, window=WINDOW):
    both = Counter()
    for t in texts:
        for i, a in enumerate(t):
            for b in t[i + 1:i + 1 + window]:
                both[a, b] += 1
                both[b, a] += 1
    total, of = sum(both.values()), Counter()
    for (a, _), n in both.items():
        of[a] += n
    return {(a, b): v for (a, b), n in both.items() if (v := math.log(n * total / (of[a] * of[b]))) > 0}, both


def matrix_of(spark, lists, window=WINDOW):
    words = {r.id: r.word for r in co.word_ids(lists).collect()}
    matrix = co.positive_information(co.pair_counts(lists, window))
    return {(words[r.a], words[r.b]): r.value for r in matrix.collect()}, matrix, words


@pytest.mark.parametrize("piece", [8192, 7])
def test_information_of_all_pairs(spark, texts, monkeypatch, piece):
    monkeypatch.setattr(co, "_PIECE", piece)
    found, _, _ = matrix_of(spark, frame(spark, texts))
    want, _ = brute(texts)
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k]) for k in want)


def test_rare_words_are_left_out(spark, texts):
    lists = frame(spark, texts + [["once", "w1"]])
    words = co.word_ids(lists, min_count=2)
    assert "once" not in {r.word for r in words.collect()}
    matrix = co.positive_information(co.pair_counts(lists, WINDOW), words)
    ids = {r.id for r in words.collect()}
    assert all(r.a in ids and r.b in ids for r in matrix.collect())


def test_factors_are_those_of_the_matrix(spark, texts):
    """Inner products of factors of full width give back the matrix' positive part."""
    found, matrix, words = matrix_of(spark, frame(spark, texts))
    names = sorted({a for a, _ in found})
    dense = np.array([[found.get((a, b), 0.0) for b in names] for a in names])
    vectors = {words[r.id]: r.vector for r in co.factorise(matrix, 40, rounds=3).collect()}
    assert sorted(vectors) == names
    got = np.array([vectors[a] for a in names])
    values, turn = np.linalg.eigh(dense)
    assert np.linalg.norm(got @ got.T - (turn * np.abs(values)) @ turn.T) < 1e-6 * np.linalg.norm(dense)
    few = np.array([r.vector for r in co.factorise(matrix, 5, rounds=4).collect()])
    assert few.shape[1] == 5
    top = np.sort(np.abs(values))[::-1][:5]
    assert np.sort((few ** 2).sum(axis=0))[::-1] == pytest.approx(top, rel=0.02)


def test_exact_neighbours(spark, texts):
    found, matrix, words = matrix_of(spark, frame(spark, texts))
    table = spark.createDataFrame(list(words.items()), "id bigint, word string")
    rows = co.nearest_rows(matrix, table, ["w1", "w30", "absent"], 3).collect()
    names = sorted({a for a, _ in found})
    dense = {a: np.array([found.get((a, b), 0.0) for b in names]) for a in names}
    for key in ("w1", "w30"):
        cosine = {a: float(dense[a] @ dense[key] / np.linalg.norm(dense[a]) / np.linalg.norm(dense[key]))
                  for a in names if a != key}
        best = sorted(cosine, key=lambda a: (-round(cosine[a], 6), a))[:3]
        assert [r.palabra_similar for r in sorted(
            (r for r in rows if r.palabra_clave == key), key=lambda r: (-r.similitud, r.palabra_similar))] == best
    assert {r.palabra_clave for r in rows} == {"w1", "w30"}


def test_neighbours_are_of_the_same_topic_as_those_of_word2vec(spark):
    rng = random.Random(2)
    topics = [[f"t{k}_{i}" for i in range(20)] for k in range(6)]
    texts = [[rng.choice(topics[k]) if rng.random() < 0.9 else rng.choice(topics[rng.randrange(6)])
              for _ in range(25)] for _ in range(400) for k in [rng.randrange(6)]]
    lists = frame(spark, texts).cache()
    keys = ["t0_1", "t3_7", "t5_19"]

    def share(vectors):
        rows = nearest_terms(vectors, keys, 10).collect()
        assert len(rows) == 30
        return sum(r.palabra_similar.split("_")[0] == r.palabra_clave.split("_")[0] for r in rows) / len(rows)

    counted = share(co.word_vectors(lists, dimensions=10))
    trained = share(fit_word2vec(lists, vector_size=10, max_iter=3).getVectors())
    assert counted >= 0.95 and counted >= trained - 0.05


def test_edges(spark):
    for texts in ([], [[]], [["solo"]]):
        lists = spark.createDataFrame([(t,) for t in texts], "tokens array<string>")
        assert co.word_vectors(lists).collect() == []
    again = spark.createDataFrame([(["a", "a", "a", "b"],)], "tokens array<string>")
    pairs = {(r.a, r.b): r.n for r in co.both_ways(co.pair_counts(again, 1)).collect()}
    ids = {r.word: r.id for r in co.word_ids(again).collect()}
    assert pairs == {(ids["a"], ids["a"]): 4, (ids["a"], ids["b"]): 1, (ids["b"], ids["a"]): 1}
    with pytest.raises(ValueError):
        co.factorise(spark.createDataFrame([], "a bigint, b bigint, value double"), 65)
    null = spark.createDataFrame([(None,)], "tokens array<string>")
    assert co.pair_counts(null).count() == 0


def test_nothing_per_word_comes_to_the_driver(spark, texts):
    """The plan of a round joins and sums by word; no side is collected for it."""
    _, matrix, _ = matrix_of(spark, frame(spark, texts))
    plan = co.factorise(matrix, 4, rounds=1)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and F.broadcast.__name__ not in plan


def test_pairs_are_counted_in_parts(spark, texts, monkeypatch):
    """Counts of a task leave it in parts, which add up; a part is never all of its words."""
    monkeypatch.setattr(co, "_AT_ONCE", 50)
    monkeypatch.setattr(co, "_PIECE", 7)
    found, _, _ = matrix_of(spark, frame(spark, texts))
    want, _ = brute(texts)
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k]) for k in want)


def test_the_matrix_is_made_once_for_neighbours(spark, texts, monkeypatch):
    _, matrix, words = matrix_of(spark, frame(spark, texts))
    table = spark.createDataFrame(list(words.items()), "id bigint, word string")
    written, plain = [], co.stage
    monkeypatch.setattr(co, "stage", lambda df, purpose: written.append(purpose) or plain(df, purpose))
    rows = co.nearest_rows(matrix, table, ["w1", "w30"], 3)
    assert written.count("nearest-matrix") == 1 and rows.count() == 6
    assert "cooccurrence" not in rows._jdf.queryExecution().toString()
    assert co.nearest_rows(matrix, table, ["absent"], 3).collect() == []


@pytest.mark.parametrize("connected", [1, 7])
def test_factors_where_few_words_are_sent_to_all_tasks(spark, texts, monkeypatch, connected):
    """Links between two of the other words, and those that stand in one row only, count."""
    monkeypatch.setattr(co, "_CONNECTED", connected)
    found, matrix, words = matrix_of(spark, frame(spark, texts))
    names = sorted({a for a, _ in found})
    dense = np.array([[found.get((a, b), 0.0) for b in names] for a in names])
    vectors = {words[r.id]: r.vector for r in co.factorise(matrix, 40, rounds=3).collect()}
    got = np.array([vectors[a] for a in names])
    values, turn = np.linalg.eigh(dense)
    assert np.linalg.norm(got @ got.T - (turn * np.abs(values)) @ turn.T) < 1e-6 * np.linalg.norm(dense)


def test_chunks_keep_their_pairs(spark):
    """Packed, dealt by classes and read again, pairs are the same; any ids and values will do."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(-2 ** 63, 2 ** 63 - 1, (2, 500))
    n = rng.integers(1, 2 ** 40, 500)
    a[7], b[9] = b[7], a[8]
    parts = [part for part in co._deal(co._chunk_of(a, b, n), 4)]
    assert len(parts) == 10
    found = [c for part in parts for c in co._chunks(iter([part]), np.int64)]
    assert all(len(np.unique(c.ids)) == len(c.ids) == len(np.unique(np.concatenate(c.sides()))) for c in found)
    pairs = {(int(c.ids[x]), int(c.ids[y]), int(v)) for c in found for x, y, v in zip(*c.sides(), c.values)}
    assert pairs == set(zip(a.tolist(), b.tolist(), n.tolist()))


def test_tables_of_factors_take_little_room(spark):
    """Each pair is written packed and once, not as rows in both directions, and vectors that
    are no longer read do not stay."""
    rng = random.Random(4)
    texts = [[f"w{int(rng.paretovariate(0.3)) % 20000}" for _ in range(100)] for _ in range(1500)]
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    size = lambda: sum(p.stat().st_size for p in root.rglob("*.parquet"))
    before = size()
    vectors = co.word_vectors(frame(spark, texts))
    written = size() - before
    words = len({w for t in texts for w in t})
    assert vectors.count() == words
    assert written < 700 * words, written / words


def test_a_matrix_of_neighbours_is_kept_once_and_packed(spark, monkeypatch):
    rng = random.Random(6)
    texts = [[f"w{int(rng.paretovariate(0.4)) % 5000}" for _ in range(100)] for _ in range(400)]
    _, matrix, words = matrix_of(spark, frame(spark, texts))
    table = spark.createDataFrame(list(words.items()), "id bigint, word string")
    written, plain = [], co.stage
    monkeypatch.setattr(co, "stage", lambda df, purpose: written.append((purpose, plain(df, purpose))) or written[-1][1])
    assert co.nearest_rows(matrix, table, ["w1", "w30"], 3).count() == 6
    kept = dict(written)["nearest-matrix"]
    assert kept.count() <= 20
    assert kept.agg(F.sum("many")).first()[0] == matrix.filter("a <= b").count() < matrix.count() * 0.6
