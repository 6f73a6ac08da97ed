import hashlib
import random
import re

import pytest

from murmullo.llm.decontaminate import contamination, decontaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _expected(docs, items):
    """Every window of every item at every place of every document."""
    windows = []
    for item, text in items:
        w = _words(text)
        size = min(13, len(w))
        windows += [(item, w[i:i + size]) for i in range(len(w) - size + 1) if size]
    out = []
    for doc_id, text in docs:
        w, hit, found = _words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    if item is not None:
                        found.add(str(item))
        listed = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def _rows(df):
    return sorted((tuple(r) for r in df), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)] + ["É", "é", "ab1"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 5, 12, 13, 14, 20, 30])))) for i in range(25)]
    rows += [(100, None), (101, "?!"), (102, rows[8][1]), (None, "solo esta frase de seis"), (103, "Ññ " * 40)]
    return rows


def test_against_all_places(spark, items):
    rng = random.Random(4)
    docs = []
    for i in range(60):
        parts = [" ".join(f"w{rng.randint(0, 11)}" for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(items)[1] or ""
            cut = text.split()
            parts.append(rng.choice([text, text.upper(), ", ".join(cut[:15]), " ".join(cut[2:])]))
            parts.append(" ".join(f"x{rng.randint(0, 9)}" for _ in range(rng.randint(0, 60))))
        docs.append((i, ". ".join(parts)))
    docs += [(60, None), (61, ""), (62, docs[5][1]), (62, docs[5][1]), (None, docs[7][1]), (63, "ÑÑ ññ " * 30)]
    found = contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert _rows(found) == _rows(_expected(docs, items))
    assert any(r.contaminated for r in found) and not all(r.contaminated for r in found)


def test_clean_documents_stay(spark, items):
    docs = spark.createDataFrame(
        [(1, items[8][1], "x"), (2, "nada que ver", "y"), (3, None, None)], "doc_id long, text string, n_words string")
    kept = decontaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_edges(spark, edges, edge_rows, nothing, items):
    bench = spark.createDataFrame([(1, "dos tres cuatro"), (2, "largo " * 20), (3, "日本語")], "item_id long, text string")
    expected = _expected([r[:2] for r in edge_rows], [(1, "dos tres cuatro"), (2, "largo " * 20), (3, "日本語")])
    assert _rows(contamination(edges, bench).collect()) == _rows(expected)
    assert contamination(nothing, bench).collect() == []
    none = contamination(edges, bench.limit(0)).collect()
    assert len(none) == 10 and not any(r.n_hit for r in none)
    assert decontaminated(edges, bench.limit(0)).count() == 10


def test_a_window_of_many_items_at_many_places(spark):
    """One row does not carry the items once for each place."""
    import time

    items = spark.createDataFrame([(f"i{k:05d}", " ".join(["same"] * 13)) for k in range(3000)], "item_id string, text string")
    docs = spark.createDataFrame([(1, "same " * 30_000), (2, "other words")], "doc_id bigint, text string")
    start = time.time()
    rows = {r.doc_id: r for r in contamination(docs, items).collect()}
    assert rows[1].n_hit == rows[1].n_words == 30_000 and rows[1].n_items == 3000 and rows[1].contaminated
    assert rows[2].n_items == 0 and time.time() - start < 60
