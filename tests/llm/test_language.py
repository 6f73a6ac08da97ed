import random
import subprocess
import sys
import zlib
from itertools import product
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import murmullo.llm.language as language
from murmullo.llm.language import (
    BUCKETS, SCRIPTS, UNKNOWN, Model, best_paths, held_out, identified, in_a_language, language_table,
    learn, sample_shares, words_of,
)

# Cuts texts into pieces and knows no language.
NO_LANGUAGE = Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS) + 2, 0), bool))

TEXTS = {
    "es": "el perro come pan y la casa es grande pero el niño quiere agua para beber hoy",
    "en": "the dog eats bread and the house is big but this child wants water for drinking today",
    "de": "der hund frisst brot und das haus ist groß aber das kind möchte heute wasser trinken",
    "ru": "собака ест хлеб и дом большой но ребёнок хочет воды чтобы пить сегодня",
}


def _docs(spark, n=160):
    rng, rows = random.Random(1), []
    for i in range(n):
        lang = rng.choice(sorted(TEXTS))
        words = TEXTS[lang].split()
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(4, 30))), lang))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_documents_are_told(spark):
    rows, docs = _docs(spark)
    found = {r.doc_id: r for r in language_table(docs).collect()}
    for doc_id, _, lang in rows:
        assert found[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= found[doc_id].score <= 1
    held = [(found[i].lang_pred, lang) for i, _, lang in rows if found[i].held_out]
    assert len(held) > 15 and sum(a == b for a, b in held) / len(held) >= 0.95


def test_nothing_is_learned_from_held_out_or_unlabelled_rows(spark):
    _, docs = _docs(spark)
    poison = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert "xx" not in {r.lang_pred for r in language_table(poison).collect()}
    clean = sorted(map(tuple, language_table(docs).collect()))
    assert sorted(map(tuple, language_table(poison).collect())) == clean
    blind = language_table(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in blind} == {(UNKNOWN, 0.0)}


def test_spans_of_a_mixed_text(spark):
    _, docs = _docs(spark)
    model = learn(docs)
    text = "the dog eats bread and the house " + "der hund frisst brot und das haus ist groß " + "собака ест хлеб"
    (row,) = identified(spark.createDataFrame([(text,)], "text string"), model, switch=4.0).collect()
    spans = [(s.lang, s.first_word, s.n_words) for s in row.spans]
    assert spans == [("en", 0, 7), ("de", 7, 9), ("ru", 16, 3)]


def test_a_script_rules_languages_out(spark):
    _, docs = _docs(spark)
    model = learn(docs)
    scores = model.of_texts(pa.array(["хлеб dog 漢字"])).scores
    by_lang = dict(zip(model.languages, scores.T))
    assert by_lang["en"][0] < -1e5 and by_lang["ru"][0] > -1e5
    assert by_lang["ru"][1] < -1e5 and by_lang["en"][1] > -1e5
    assert min(v[2] for v in by_lang.values()) > -1e5  # no language has this script


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)
    for n_langs, switch in ((1, 1.0), (2, 0.7), (3, 1.5), (3, 0.0)):
        scores = rng.normal(size=(9, n_langs))
        count = np.array([3, 0, 1, 5, 0, 2])
        code = rng.integers(0, 9, count.sum())
        path, at = best_paths(scores, code, count, switch), 0
        for n in count.tolist():
            words = code[at:at + n]

            def total(p):
                changes = sum(a != b for a, b in zip(p, p[1:]))
                return sum(scores[w, s] for w, s in zip(words, p)) - switch * changes

            best = max((total(p) for p in product(range(n_langs), repeat=n)), default=0)
            assert total(tuple(path[at:at + n])) == pytest.approx(best)
            at += n


def test_words():
    words = NO_LANGUAGE.of_texts(pa.array(["Hola, MUNDO 12 ... hola", None, "", "ñ"]))
    assert words.count.tolist() == [3, 0, 0, 1]
    assert words.letters[words.code].tolist() == [4, 5, 4, 1]


def test_long_runs_are_read_whole(spark):
    _, docs = _docs(spark)
    rows, han = docs.collect(), "这是一个没有空格的段落"
    rows += [(1000 + i, han[i % 5:] * 3, "zh") for i in range(40)]
    model = learn(spark.createDataFrame(rows, docs.schema))
    texts = [han * 450 + " the dog eats bread and the house is big", "-" * 90 + "the,dog,eats,bread,and,the,house"]
    words = NO_LANGUAGE.of_texts(pa.array(texts))
    n = [sum(c.isalpha() for c in t) for t in texts]
    text_of = np.repeat(np.arange(2), words.count)
    assert np.bincount(text_of, weights=words.letters[words.code]).tolist() == n
    found = identified(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    assert {r._doc.text: r.lang_pred for r in found} == dict(zip(texts, ["zh", "en"]))
    assert all(r.score > 0.5 for r in found)


def test_pieces_keep_the_runs_of_their_word():
    """What lies across a cut is counted as anywhere else in the word."""
    word = "".join(chr(97 + i * 7 % 26) for i in range(130))
    words = NO_LANGUAGE.of_texts(pa.array([word]))
    assert words.count.tolist() == [4] and words.letters.tolist() == [40, 40, 40, 10]

    def runs(text):
        return [r for _, b in words_of(pa.array([text])).blocks() for found, _ in b.runs() for r in found.tolist()]

    assert len(runs(word)) == 4 * 130 + 1
    assert len(set(runs(word)) - set(runs("x" + word))) <= 6


def test_blocks_of_words_change_nothing(spark, monkeypatch):
    rows, docs = _docs(spark)
    model, texts = learn(docs), pa.array([t for _, t, _ in rows] + ["漢字" * 50, "", None])
    whole = model.of_texts(texts)
    monkeypatch.setattr(language, "_STEP", 3)
    cut = model.of_texts(texts)
    for name in ("code", "count", "letters", "scores", "clear"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name)), name


def test_memory_is_bounded_whatever_the_vocabulary():
    """800,000 distinct words in one slice take less than 300 MB above the texts."""
    code = """
import random, resource
import numpy as np, pyarrow as pa
from murmullo.llm.language import BUCKETS, SCRIPTS, Model, _labeller, _letters
rng = random.Random(1)
words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(800_000)]
texts = pa.array([" ".join(words[i:i + 800]) for i in range(0, 800_000, 800)])
batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["_doc", "text"])
scores = np.random.default_rng(0).normal(size=(BUCKETS, 4)).astype(np.float32)
model = Model(list("abcd"), scores, np.ones((len(SCRIPTS) + 2, 4), bool))
_letters()
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert sum(b.num_rows for b in _labeller(model, 12.0)(iter([batch]))) == len(texts)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2],
                         check=True, capture_output=True, text=True, timeout=300)
    assert int(out.stdout) < 300


def test_rare_languages_are_learned(spark):
    """One common language and ten rare ones; the sample is smaller than the common one."""
    rng, rows = random.Random(6), []
    for i in range(3000):
        rows.append((i, " ".join(rng.choices(TEXTS["es"].split(), k=12)), "es"))
    for k in range(10):
        own = ["".join(rng.choices("bcdfghjklmnpqrst"[k:k + 5] + "aeiou", k=6)) for _ in range(30)]
        rows += [(None if j % 3 == 0 else 5000 + 10 * k + j, " ".join(rng.choices(own, k=12)), f"r{k}")
                 for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(docs, sample=100)
    assert model.languages == sorted({r[2] for r in rows})
    found = identified(docs.filter("lang != 'es'"), model).select("_doc.lang", "lang_pred").collect()
    assert {r.lang_pred for r in found} >= {f"r{k}" for k in range(10)}


def test_shares_of_the_sample():
    shares = sample_shares({"a": 1000, "b": 10, "c": 500}, 210)
    assert shares == {"b": 1.0, "c": 100 / 500, "a": 100 / 1000}
    assert sample_shares({}, 10) == {} and sample_shares({"a": 3}, 10) == {"a": 1.0}


def test_bilingual_documents_stay(spark):
    rows, _ = _docs(spark)
    mixed = " ".join(TEXTS[x] for x in ("en", "de", "ru"))
    rows += [(1000, mixed, None), (1001, "12 ... 34", None)]
    kept = in_a_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(160), 1000]


def test_edges(spark, edges, nothing):
    found = language_table(edges).collect()
    assert len(found) == 10
    unknown = {r.doc_id for r in found if r.lang_pred == UNKNOWN}
    assert unknown == {1, 2, 5, 7} and all(r.score == 0 for r in found if r.doc_id in unknown)
    kept = in_a_language(edges)
    assert kept.columns == edges.columns
    assert {r.doc_id for r in kept.collect()} <= {0, 3, 4, 6, None}
    assert language_table(nothing).collect() == []
