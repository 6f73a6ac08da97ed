import re

import pytest
from pyspark.sql import functions as F

from murmullo.llm.mixing import mix_report, mixed, word_count

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _size(text):
    return len(WORDS.findall(text or ""))


def _targets(rows):
    """Shares by weight, again and again, until no source is above three times its size."""
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + _size(r[1])
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, free, target = float(sum(sizes.values())), list(order), {}
    while True:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return sizes, {**target, **{s: level * weight[s] for s in free}}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.remove(s)


def _check(rows, found):
    sizes, targets = _targets(rows)
    assert len(found) == len(rows)
    by_id = {r[0]: r for r in rows}
    taken = dict.fromkeys(sizes, 0)
    longest = max(_size(r[1]) for r in rows)
    for f in found:
        source = by_id[f.doc_id][3]
        assert f.size == _size(by_id[f.doc_id][1]) and f.source_size == sizes[source]
        assert f.target == pytest.approx(targets[source])
        assert f.taken in {k * f.size for k in range(4)}
        taken[source] += f.taken
    assert sum(taken.values()) <= sum(sizes.values())
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * longest


def test_targets_and_words_taken(corpus):
    rows, docs = corpus
    first = mix_report(docs).collect()
    _check(rows, first)
    assert sorted(map(tuple, first)) == sorted(map(tuple, mix_report(docs.repartition(7)).collect()))


def test_a_hot_and_many_tiny_sources(spark):
    rows = [(i, "w " * (i % 9 + 1), None, "hot" if i % 3 else f"s{i}", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n bigint")
    _check(rows, mix_report(docs).collect())


def test_mixed_gives_each_document_as_often_as_it_is_taken(corpus):
    _, docs = corpus
    report = {r.doc_id: r.taken // r.size for r in mix_report(docs).collect() if r.size}
    out = mixed(docs)
    assert out.columns == docs.columns
    found = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert found == {k: v for k, v in report.items() if v}


def test_edges(edges):
    found = mix_report(edges).collect()
    assert len(found) == 10
    assert {r.doc_id: r.taken for r in found if not r.size} == {1: 0, 2: 0, 5: 0}
    total = sum(r.size for r in found)
    assert sum(r.taken for r in found) <= total
    out = mixed(edges)
    assert out.columns == edges.columns
    assert out.select(F.sum(word_count(F.col("text")))).first()[0] == sum(r.taken for r in found)


def test_empty_tables(spark, nothing):
    assert mix_report(nothing).collect() == [] and mixed(nothing).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in mix_report(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_rows_without_id_are_shuffled(spark):
    """Short texts do not come first; reruns agree."""
    rows = [(None, "w" + str(i) + " x" * (i // 40), "s", "one") for i in range(200)]
    rows += [(1000 + i, "y", "s", "two") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    # A third of all words is less than "one" has, so only some of its texts are taken.
    taken = [(r.size, r.taken) for r in mix_report(docs).collect() if r.doc_id is None]
    assert 0.3 * 600 < sum(n for _, n in taken) < 0.6 * 600
    by_size = {size: sum(1 for s, n in taken if s == size and n) for size in range(1, 6)}
    assert all(by_size.values()), by_size
    again = [(r.size, r.taken) for r in mix_report(docs.repartition(5)).collect() if r.doc_id is None]
    assert sorted(taken) == sorted(again)
