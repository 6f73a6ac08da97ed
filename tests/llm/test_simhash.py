import random
import re

import pytest
import xxhash

from murmullo.llm.components import components
from murmullo.llm.simhash import deduplicated, fingerprint, links, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _expected_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, distance=3):
    """Components by comparing all pairs."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    listed = sorted(root)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in listed}


def test_fingerprints(corpus):
    for row in corpus[0][:60]:
        assert fingerprint(row[1].encode()) == _expected_print(row[1])
    for text in ["", " \n", "a", "A b", "É é C d e f"]:
        assert fingerprint(text.encode()) == _expected_print(text)


def _check(rows, found):
    prints = {}
    for r in rows:
        prints.setdefault(_expected_print(r[1]), []).append(r[0])
    root = _groups(prints)
    first = {}
    for p, ids in prints.items():
        known = [i for i in ids if i is not None]
        if known:
            first[root[p]] = min([min(known), first.get(root[p], min(known))])
    expected = sorted((f"{_expected_print(r[1]):016x}", first.get(root[_expected_print(r[1])]), r[0] is None, r[0] or 0)
                      for r in rows)
    assert sorted((f.fingerprint, f.component_id, f.doc_id is None, f.doc_id or 0) for f in found) == expected


def test_against_all_pairs(corpus):
    _check(corpus[0], near_duplicates(corpus[1]).collect())


def _cluster(seed, n, near):
    """Fingerprints of which many lie close together, and some far off."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 20)]
    weak = [rng.sample(range(64), 9) for _ in centres]
    found = {0, 1, (1 << 64) - 1}
    while len(found) < n:
        i = rng.randrange(len(centres))
        value = centres[i]
        for bit in rng.sample(weak[i], rng.randint(0, near)):
            value ^= 1 << bit
        found.add(value)
    return sorted(found)


def _signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("most", [2048, 4])
def test_links_lose_no_component(spark, most):
    """Also where crowded keys are cut once more."""
    for seed, near in ((1, 3), (2, 6), (3, 9)):
        prints = _cluster(seed, 300, near)
        df = spark.createDataFrame([(_signed(p),) for p in prints], "_print long").repartition(3)
        found = links(df, most=most).collect()
        for a, b in found:
            assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 * 64  # a link may be through others
        root = {_signed(p): _signed(p) for p in prints}

        def top(p):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in found:
            x, y = sorted((top(a), top(b)))
            root[y] = x
        mine = {}
        for p in prints:
            mine.setdefault(top(_signed(p)), set()).add(p)
        theirs = {}
        for p, r in _groups(prints).items():
            theirs.setdefault(r, set()).add(p)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(25)] + [(7, 7), (1, 0)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    alone = {x for x in root if not any(a != b and x in (a, b) for a, b in edges)}
    assert found == {x: r for x, r in root.items() if x not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(corpus):
    rows, docs = corpus
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    groups = {(r.component_id) for r in near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_unrelated_rows_without_or_with_one_id_stay(spark):
    rng = random.Random(6)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    texts = [text() for _ in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(5, t) for t in texts[4:]]
    copies = [(None, texts[0]), (None, texts[5]), (9, texts[1]), (5, texts[6])]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in deduplicated(docs).collect()), key=lambda r: r[1])
    # One row of each text; the copy with an id stands for the one without.
    assert kept == sorted([(9, t) if t == texts[1] else (i, t) for i, t in rows], key=lambda r: r[1])


def test_edges(edges, edge_rows, nothing):
    _check(edge_rows, near_duplicates(edges).collect())
    kept = deduplicated(edges).collect()
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept)
    # 0 and its copies, 1 with the texts without words; the rest on their own.
    assert ids == [(False, 0), (False, 1), (False, 3), (False, 6), (False, 7), (True, 0)]
    assert near_duplicates(nothing).collect() == [] and deduplicated(nothing).collect() == []
