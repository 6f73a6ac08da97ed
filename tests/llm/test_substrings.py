import random

import numpy as np
import pytest
import xxhash

from murmullo.llm.substrings import (
    LONGEST, REACH, SPAN, chunk_ends, gear_table, repeated_spans, rolling_hash, without_repeats,
)

GEAR = gear_table()


def _hash(data, i):
    h = 0
    for b in data[max(0, i - 15):i + 1]:
        h = 2 * h + int(GEAR[b])
    return h % (1 << 32)


def test_rolling_hash_depends_on_sixteen_bytes():
    data = random.Random(1).randbytes(200)
    found = rolling_hash(np.frombuffer(data, np.uint8), GEAR)
    assert [int(x) for x in found] == [_hash(data, i) for i in range(200)]


def _ends(data):
    """Each byte against its surroundings."""
    h, n, ends, start = [_hash(data, i) for i in range(len(data))], len(data), [], 0
    cuts = [i + 1 for i in range(n) if h[i] > max([0, *h[max(0, i - REACH):i]])
            and h[i] >= max([0, *h[i + 1:i + 1 + REACH]])]
    for cut in [*cuts, n]:
        while cut - start > LONGEST:
            start += LONGEST
            ends.append(start)
        if cut > start:
            ends.append(cut)
            start = cut
    return ends


@pytest.mark.parametrize("data", [
    random.Random(2).randbytes(3000), b"a", b"ab" * 500, b"x" * 10, "ñandú y más. ".encode() * 40,
])
def test_chunk_ends_against_brute_force(data):
    assert chunk_ends(data, GEAR, REACH, LONGEST) == _ends(data)


def test_an_insertion_moves_the_cuts_with_the_text():
    data = random.Random(3).randbytes(4000)
    cuts = set(chunk_ends(data, GEAR, REACH, LONGEST))
    moved = {e - 5 for e in chunk_ends(b"12345" + data, GEAR, REACH, LONGEST)}
    assert len(cuts & moved) >= len(cuts) - 2


def _expected(rows):
    """Spans by going through the documents in order."""
    first, per_doc = {}, {}
    for doc_id, text in sorted({(r[0], r[1]) for r in rows if r[1]}):
        data, begin = text.encode(), 0
        for end in _ends(data):
            key = xxhash.xxh3_128_digest(data[begin:end])
            first.setdefault(key, doc_id)
            per_doc.setdefault(doc_id, []).append((begin, end, key))
            begin = end
    out = []
    for doc_id, chunks in per_doc.items():
        run = []
        for begin, end, key in [*chunks, (None, None, None)]:
            if key is not None and first[key] != doc_id:
                run.append((begin, end, first[key]))
                continue
            if run and run[-1][1] - run[0][0] >= SPAN:
                size = {}
                for a, b, f in run:
                    size[f] = size.get(f, 0) + b - a
                enough = min(SPAN, max(size.values()))
                out.append((doc_id, run[0][0], run[-1][1] - run[0][0], len(run),
                            sorted(f for f, n in size.items() if n >= enough)))
            run = []
    return sorted(out)


def test_spans_against_brute_force(corpus):
    rows, docs = corpus
    assert sorted(tuple(r) for r in repeated_spans(docs).collect()) == _expected(rows)


def test_long_passages_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, marked = [], set()
    for i in range(150):
        passage = text(55)
        for j in range(2 + i % 3):
            rows.append((1000 + 10 * i + j, f"{text(rng.randint(0, 90))} {passage} {text(rng.randint(0, 90))}"))
            marked.add(rows[-1][0])
    rows += [(i, "Una línea que se repite en todas partes.\n" + text(rng.randint(5, 200))) for i in range(400)]
    found = repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} | {d for r in found for d in r.first_doc_ids} == marked


def test_texts_without_their_repeats(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 8)))
    passage = " ".join(word() for _ in range(80))
    rows = [(1, passage, "k"), (2, f"antes {passage} después", "k"), (3, None, None), (4, "solo", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, deduplicated string")
    found = {r._doc.doc_id: r.deduplicated for r in without_repeats(docs).collect()}
    assert found[1] == passage and found[3] is None and found[4] == "solo"
    assert found[2].startswith("antes") and found[2].endswith("después")
    assert len(found[2]) < len(passage) / 2


@pytest.mark.parametrize("shared", [None, 7, -(1 << 63), (1 << 63) - 1])
def test_texts_under_one_id_are_documents_of_their_own(spark, shared):
    rng = random.Random(10)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    known, passage, clean = text(), text(), [text() for _ in range(3)]
    rows = [(3, known), (shared, f"{clean[0]} {known}"), (shared, clean[1]),
            (shared, f"{passage} uno"), (shared, f"dos {passage}"), (shared, clean[2])]
    docs = spark.createDataFrame(rows + rows[2:3], "doc_id long, text string").repartition(3)
    spans = repeated_spans(docs).collect()
    # The smaller id comes first, so the copy of it is the one with the larger.
    low = shared is not None and shared < 3
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in spans) == sorted(
        [(shared is None, shared or 0), (False, 3) if low else (shared is None, shared or 0)])
    assert sorted(map(str, (r.first_doc_ids for r in spans))) == sorted(
        map(str, ([shared], [shared] if low else [3])))
    found = {r._doc.text: r.deduplicated for r in without_repeats(docs).collect()}
    assert len(found) == 6 and all(found[t] == t for t in clean[1:])
    cut = sorted(t for t in found if found[t] != t)
    assert len(cut) == 2 and all(len(found[t]) < len(t) - SPAN for t in cut)
    assert len({rows[3][1], rows[4][1]} & set(cut)) == 1 and (rows[0 if low else 1][1] in cut)


def test_edges(edges, nothing):
    found = repeated_spans(edges).collect()
    assert all(r.n_bytes >= SPAN for r in found)
    # The long text repeats itself only.
    assert 3 not in {r.doc_id for r in found}
    assert len(without_repeats(edges).collect()) == 10
    assert repeated_spans(nothing).collect() == [] and without_repeats(nothing).collect() == []
