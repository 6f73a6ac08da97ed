"""Skip-gram training against plain loops, and parts that hold only words of their own."""

import heapq
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from murmullo.operators import skipgram as sg
from murmullo.operators.similarity import fit_word2vec, nearest_terms


def _huffman_bits(counts):
    heap, bits = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        two = heapq.heappop(heap) + heapq.heappop(heap)
        bits += two
        heapq.heappush(heap, two)
    return bits


@pytest.mark.parametrize("seed", range(6))
def test_codes_cost_what_a_huffman_tree_costs(seed):
    rng = random.Random(seed)
    counts = sorted((int(rng.paretovariate(0.7)) for _ in range(rng.choice([2, 3, 7, 500, 4000]))), reverse=True)
    lengths = sg.code_lengths(Counter(counts))
    each = [n for n, many in lengths for _ in range(many)]
    assert len(each) == len(counts) and sum(2.0 ** -n for n in each) == 1
    assert sum(n * c for n, c in zip(each, counts)) == _huffman_bits(counts)


def test_ways_are_the_nodes_above_each_word():
    codes = sg.canonical(sg.code_lengths({1: 9, 2: 3, 5: 2, 40: 1}))
    numbers = np.array([0, 2, 3, 7, 13, 14])
    ways, signs, lengths, places = sg.ways_of(numbers, codes)
    leaves = codes.leaves(np.arange(15))[0]
    assert len({int(x) for x in leaves}) == 15 and len(set(places)) == len(places)
    for row, number in enumerate(numbers):
        text = format(int(leaves[number]), "b")  # a one, then the turns
        assert len(text) == lengths[row] + 1
        for d in range(ways.shape[1]):
            if d < lengths[row]:
                assert places[ways[row, d]] == int(text[:d + 1], 2) and signs[row, d] == (text[d + 1] == "0")
            else:
                assert ways[row, d] == len(places)


def test_one_word_has_no_way():
    codes = sg.canonical(sg.code_lengths({7: 1}))
    ways, _, lengths, places = sg.ways_of(np.array([0]), codes)
    assert lengths.tolist() == [0] and not len(places) and ways.tolist() == [[0]]


def test_a_batch_against_loops():
    """All steps of a batch are taken from its start; the rate is small, so none is shortened much."""
    rng = np.random.default_rng(3)
    counts = [9, 7, 5, 3, 2, 2, 1, 1]
    words = rng.permutation(np.repeat(np.arange(8), counts)).astype(np.int32)
    sentence = np.repeat(np.arange(3, dtype=np.int32), [11, 1, 18])
    ways, signs, lengths, places = sg.ways_of(np.arange(8), sg.canonical(sg.code_lengths(Counter(counts))))
    syn0 = rng.normal(size=(8, 6)).astype(np.float32)
    syn1 = np.r_[rng.normal(size=(len(places), 6)), np.zeros((1, 6))].astype(np.float32)
    rate = 1e-6
    reach = np.random.default_rng(8).integers(1, 6, len(words))
    move0, move1 = np.zeros((8, 6)), np.zeros((len(places) + 1, 6))
    for i, center in enumerate(words):
        for j in range(max(0, i - reach[i]), min(len(words), i + reach[i] + 1)):
            if j == i or sentence[j] != sentence[i]:
                continue
            for d in range(lengths[center]):
                node = ways[center, d]
                f = float(syn0[words[j]] @ syn1[node])
                if abs(f) < 6:
                    g = rate * (signs[center, d] - 1 / (1 + math.exp(-f)))
                    move0[words[j]] += g * syn1[node]
                    move1[node] += g * syn0[words[j]]
    # The steps alone: on vectors of this size they would drown in rounding.
    end0, end1 = syn0.astype(np.float64), syn1.astype(np.float64)
    sg.train(words, sentence, ways, signs, lengths, end0, end1, (rate, rate), np.random.default_rng(8))
    assert np.allclose(end0 - syn0, move0, rtol=2e-3, atol=1e-9)
    assert np.allclose(end1 - syn1, move1, rtol=2e-3, atol=1e-9)


@pytest.mark.parametrize("top", [1, 4, 7])
def test_upper_and_lower_levels_against_loops(monkeypatch, top):
    """The first levels are trained as whole matrices, the others word by word; far pairs are left out in both."""
    monkeypatch.setattr(sg, "_TOP", top)
    rng = np.random.default_rng(4)
    counts = sorted((int(300 / (i + 1)) + 1 for i in range(260)), reverse=True)
    words = rng.permutation(np.repeat(np.arange(260), counts)).astype(np.int32)[:1200]
    sentence = np.repeat(np.arange(3, dtype=np.int32), [500, 1, 699])
    ways, signs, lengths, places = sg.ways_of(np.arange(260), sg.canonical(sg.code_lengths(Counter(counts))))
    assert lengths.min() < 4 and lengths.max() > 8
    syn0 = rng.normal(size=(260, 6)).astype(np.float32)
    syn1 = np.r_[rng.normal(size=(len(places), 6)) * 2, np.zeros((1, 6))].astype(np.float32)
    reach = np.random.default_rng(8).integers(1, 6, len(words))
    move0, move1, far = np.zeros((260, 6)), np.zeros((len(places) + 1, 6)), Counter()
    for i, center in enumerate(words):
        for j in range(max(0, i - reach[i]), min(len(words), i + reach[i] + 1)):
            if j == i or sentence[j] != sentence[i]:
                continue
            way = ways[center, :lengths[center]]
            f = syn1[way].astype(np.float64) @ syn0[words[j]]
            g = 1e-7 * (signs[center, :lengths[center]] - 1 / (1 + np.exp(-f))) * (np.abs(f) < 6)
            far.update(np.flatnonzero(np.abs(f) >= 6).tolist())
            move0[words[j]] += g @ syn1[way]
            np.add.at(move1, way, g[:, None] * syn0[words[j]])
    assert far[0] and far[8]
    end0, end1 = syn0.astype(np.float64), syn1.astype(np.float64)
    sg.train(words, sentence, ways, signs, lengths, end0, end1, (1e-7, 1e-7), np.random.default_rng(8))
    assert np.allclose(end0 - syn0, move0, rtol=2e-3, atol=1e-9)
    assert np.allclose(end1 - syn1, move1, rtol=2e-3, atol=1e-9) and not end1[-1].any()


def test_many_steps_of_one_vector_do_not_go_too_far():
    vectors = np.zeros((2, 3), np.float32)
    rows = np.r_[np.zeros(400, np.int64), 1]
    sg._apply(vectors, rows, np.ones((401, 3), np.float32), np.full(401, 0.5, np.float32))
    assert np.allclose(vectors[0], 2, rtol=1e-3) and 0.7 < vectors[1, 0] < 1


def test_merged_changes_lie_between_mean_and_sum():
    rng = np.random.default_rng(1)
    key = np.repeat(np.arange(40), rng.integers(1, 9, 40))
    change = rng.normal(size=(len(key), 5)).astype(np.float32) + 0.5
    found, merged = sg._merged(key, change)
    assert found.tolist() == list(range(40))
    for k in range(40):
        own = change[key == k]
        total, length = own.sum(0), np.linalg.norm(merged[k])
        assert np.linalg.norm(total) / len(own) * 0.999 <= length <= np.linalg.norm(total) * 1.001
    same = sg._merged(np.zeros(4, int), np.ones((4, 2), np.float32))[1]
    apart = sg._merged(np.zeros(2, int), np.eye(2, dtype=np.float32))[1]
    assert np.allclose(same, 1) and np.allclose(apart, 1)


def test_large_texts_are_trained_in_more_parts(spark, monkeypatch):
    """Each part has words of its own only; together they give the same topics as two parts."""
    rng = random.Random(5)
    texts = []
    for i in range(600):
        k = i % 4
        texts.append([f"t{k}_{rng.randrange(15)}" for _ in range(30)] + [f"solo{i}"])
    lists = spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(4)
    parts, whole = [], sg._part
    monkeypatch.setattr(sg, "_part", lambda n: parts.append(n) or whole(n))
    monkeypatch.setattr(sg, "_PART_WORDS", 4000)
    monkeypatch.setattr(sg, "_WORDS", 20)  # most are merged at the end
    vectors = fit_word2vec(lists, vector_size=10, max_iter=4).getVectors()
    assert set(parts) == {5}
    found = {r.word: r.vector for r in vectors.collect()}
    assert set(found) == {w for t in texts for w in t}
    assert all(len(v) == 10 and all(map(math.isfinite, v)) for v in found.values())
    keys = ["t0_1", "t1_7", "t2_3", "t3_14"]
    known = vectors.filter("word LIKE 't%'")
    near = nearest_terms(known, keys, 10).collect()
    assert len(near) == 40
    assert sum(r.palabra_similar[:2] == r.palabra_clave[:2] for r in near) >= 36


def test_odd_words_and_equal_runs(spark):
    rows = [(["a b", "ñ", None, "a b", "", "x\x00y"],), ([None],), ([],), (None,), (["solo"],), (["ñ", "a b"] * 900,)]
    lists = spark.createDataFrame(rows, "tokens array<string>").coalesce(1)
    first, again = (
        {r.word: tuple(r.vector) for r in fit_word2vec(lists, vector_size=4).getVectors().collect()} for _ in "12")
    assert set(first) == {"a b", "ñ", "", "x\x00y", "solo"} and first == again
    seldom = fit_word2vec(lists, vector_size=4, min_count=2).getVectors().collect()
    assert {r.word for r in seldom} == {"a b", "ñ"}
    with pytest.raises(ValueError, match="min_count"):
        fit_word2vec(lists, min_count=10_000)


def test_words_know_their_parts_beyond_one_number(spark):
    rows = [(f"solo{i}", i) for i in range(70)] + [("todos", i) for i in range(70)] + [("dos", 3), ("dos", 65)]
    pieces = spark.createDataFrame([([w], [i + 1], i) for w, i in rows], "words array<string>, counts array<int>, key bigint")
    words = {r.word: (r.n, r.parts) for r in sg.vocabulary(pieces, 1, 70).collect()}

    def parts(masks):
        return [62 * at + bit for at, mask in enumerate(masks) for bit in range(62) if mask >> bit & 1]

    assert words["todos"][0] == sum(range(1, 71)) and parts(words["todos"][1]) == list(range(70))
    assert words["dos"][0] == 4 + 66 and parts(words["dos"][1]) == [3, 65]
    assert all(parts(words[f"solo{i}"][1]) == [i] for i in range(70))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["dos"]), pa.array([7]), pa.array([words["dos"][1]])], ["word", "number", "parts"])
    assert [b.column("part")[0].as_py() for b in sg._send_words(iter([batch]))] == [3, 65]
