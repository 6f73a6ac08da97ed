"""Distances of sources against a plain computation with whole numbers."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

import murmullo.llm.divergence as divergence
from murmullo.llm.divergence import count_terms, shares, source_divergence, terms_of

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, term string, v string, _id int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=50):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER))))
            for text, lang, source in rows]
    df, by_group, by_lang = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        df[lang].update(words.keys())
        by_group[lang, source].update(words)
        by_lang[lang].update(words)
    kept = {lang: sorted(w for w, n in df[lang].items() if n >= least) for lang in df | {d[0]: 0 for d in docs}}

    def share(count, lang):
        terms = kept[lang]
        whole = sum(count[t] for t in terms) + 5 * len(terms)
        return {t: 1 + 1_000_000_000 * (count[t] + 5) // whole for t in terms}

    out = []
    for (lang, source), count in by_group.items():
        p, q = share(count, lang), share(by_lang[lang], lang)
        pairs = [(-sum(abs(p[t] - o[t]) for t in p), other) for (also, other), c in by_group.items()
                 if also == lang and other != source for o in [share(c, lang)]]
        terms = [(q[t] - p[t], t) for t in p if count[t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (x[0], x[1].encode()))
            out += [(lang, source, part, item, -value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, *r, 0, "t", "v", i) for i, r in enumerate(rows)], SCHEMA).repartition(4)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed=2, n=700):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéÉñ") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["es", "es", "en", None, "pt br"]), rng.choice(["a", "a", "a", "B", "é", None, "z"])
        size = rng.choice([0, 1, 5, 20, 60])
        text = " ".join(rng.choice(words[:rng.choice([10, 60, 120])]).title() for _ in range(size))
        rows.append((text if rng.random() < 0.97 else None, lang, source))
    rows += [("Uno, dos; tres 4x5_6 \x00 y\tmás <|fin|> 日本語", "es", "only here")] * 3
    return rows + [("raro", "xx", "p"), ("solo", "xx", "q"), ("", "yy", "alone")]


def test_equals_brute_force(spark):
    rows = corpus()
    assert found(source_divergence(frame(spark, rows))) == brute(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_TERMS", 7)
    monkeypatch.setattr(divergence, "_SOURCES", 2)
    rows = corpus(3, 400)
    assert found(source_divergence(frame(spark, rows))) == brute(rows)


def test_no_term_is_kept(spark, nothing):
    rows = [("uno dos", "es", "a"), ("tres", "es", "b"), (None, None, None)]
    assert found(source_divergence(frame(spark, rows))) == [
        ("es", "a", "pair", "b", 0, 1), ("es", "b", "pair", "a", 0, 1)]
    assert source_divergence(nothing).collect() == []


def test_edges(spark, edges, edge_rows):
    rows = [r[1:4] for r in edge_rows]
    assert found(source_divergence(edges, min_docs=1)) == brute(rows, 1)
    kept, cells = count_terms(edges, min_docs=2)
    assert {r.term for r in kept.collect() if r.lang == "es"} >= {"uno", "ocho"}
    assert cells.filter("n <= 0").count() == 0
    groups, found_shares = shares(edges, min_docs=1)
    assert groups.count() == len({(r[2] or "", r[3] or "") for r in edge_rows})
    assert found_shares.filter("p < 1 or q < 1").count() == 0


def test_terms_are_those_of_the_pattern():
    rng = random.Random(9)
    parts = ["Ab", "é", "É", "\u00a0", "\u3000", "\x85", "\u2028", "\x00", "\x1c", " ", "\t\n", "9", "_", "[", "`", "{",
             "\x7f", "@", "ſK", "İ", "日本", "😀", "z", "Z", ".", ""]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    for given in (pa.array(texts), pa.array(["pre"] + texts).slice(1), pa.array(texts, pa.large_string())):
        terms, counts = terms_of(given)
        want = [TERM.findall(t.translate(LOWER)) for t in texts]
        assert terms.to_pylist() == [w for found in want for w in found]
        assert counts.tolist() == [len(found) for found in want]
    assert terms_of(pa.array([], pa.string()))[1].tolist() == []
