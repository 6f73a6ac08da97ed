import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from murmullo.llm.syncmers import SKETCH, anchor_table, compare_edited, likeness, with_fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _h(values):
    """The hash of some columns: each is hashed with the hash so far as the seed."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def _print(text):
    words = WORD.findall(text or "")
    hashes = [_h([w]) for w in words]
    pairs = [_h(hashes[i:i + 2]) for i in range(len(hashes) - 1)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    found = set()
    for i in range(len(words) - 4):
        four = [signed(x) for x in pairs[i:i + 4]]
        if min(four) in (four[0], four[3]):
            found.add(_h(pairs[i:i + 4]) >> 32)
    if not found and words:
        found = {_h([" ".join(words)]) >> 32}
    return sorted(found)[:SKETCH]


def _text(values):
    return "".join(f"{v:08x}" for v in values)


def _alike(a, b):
    if not a and not b:
        return 1.0
    union = sorted({*a, *b})[:SKETCH]
    return len(set(union) & set(a) & set(b)) / len(union)


def _expected(rows):
    """Rows of (doc_id, text), equal ones once, in the ring of descending ids."""
    ring = sorted({(r[0], r[1] or "") for r in rows},
                  key=lambda r: (r[0] is None, -(r[0] or 0), _signed_hash(r[1])))
    out = {}
    for (doc_id, text), (_, after) in zip(ring, ring[1:] + ring[:1]):
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        a, b = _print(text), _print(edited)
        out[doc_id, text] = (
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), _text(a), _text(b),
            _alike(a, b), _alike(a, _print(after)))
    return [out[r[0], r[1] or ""] for r in rows]


def _signed_hash(text):
    x = xxhash.xxh64_intdigest(text.encode(), 42)
    return x - (1 << 64) if x >> 63 else x


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_against_brute_force(corpus):
    rows, docs = corpus
    found = _sorted(compare_edited(docs).collect())
    assert found == _sorted(_expected([r[:2] for r in rows]))
    near = [r[5] for r in found if r[1] > 300]
    assert sum(near) / len(near) > 0.35 and all(0 <= r[6] <= 1 for r in found)


def test_edges(spark, edges, edge_rows, nothing):
    rows = [r[:2] for r in edge_rows]
    assert _sorted(compare_edited(edges).collect()) == _sorted(_expected(rows))
    assert compare_edited(nothing).collect() == []
    one = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string")
    assert _sorted(compare_edited(one).collect()) == _sorted(_expected([(1, "a b c d e f g h i")]))


def test_a_passage_has_the_same_anchors_anywhere(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(passage,), ("x y z " + passage,), (passage + " q",)], "text string")
    prints = [set(re.findall("........", r[0])) for r in
              with_fingerprint(df, sketch=1000).select("fingerprint").collect()]
    assert prints[0] <= prints[1] and prints[0] <= prints[2]


def test_likeness_of_empty_prints(spark):
    df = spark.createDataFrame([("", ""), ("", "00000001"), ("00000001", "00000001")], "a string, b string")
    assert [r[0] for r in df.select(likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 1.0]


def test_all_anchors_of_long_texts_count(spark):
    line = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    passage = line("p", 60)
    one, two = f"{line('a', 3000)} {passage}", f"{passage} {line('b', 3000)}"
    docs = spark.createDataFrame([(2, one), (1, two)], "doc_id long, text string")
    for row in compare_edited(docs).collect():
        assert 0 < row.near_next < 0.05 and len(row.fingerprint) > 8 * 1000
    # A sketch on request still estimates it.
    assert all(len(r.fingerprint) == 8 * 48 for r in compare_edited(docs, sketch=48).collect())
    found = anchor_table(docs).collect()
    places = {i: {(r.anchor, r.position) for r in found if r._doc.doc_id == i} for i in (1, 2)}
    common = {a for a, _ in places[1]} & {a for a, _ in places[2]}
    assert len(common) > 10
    assert {q - p for a, p in places[1] for b, q in places[2] if a == b} == {3000}
