import math
import os
import re
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from murmullo.llm.quality import (
    FEATURES, VOTERS, estimate, good_documents, hashers, measured, posterior, quality_table, scored, trained,
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_accuracies_are_recovered():
    """Votes drawn from known accuracies give these back, without a label."""
    rng = np.random.default_rng(0)
    truth = rng.random(60_000) < 0.8
    right = [0.95, 0.9, 0.85, 0.75, 0.8, 0.9]
    votes = np.stack([
        np.where(rng.random(len(truth)) < 0.2, -1, np.where(rng.random(len(truth)) < r, truth, ~truth))
        for r in right
    ], axis=1).astype(np.int64)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    good, rates = estimate(patterns, counts.astype(float))
    assert good == pytest.approx(0.8, abs=0.02)
    for v, r in enumerate(right):
        assert rates[v, 1, 2] / (rates[v, 1, 1] + rates[v, 1, 2]) == pytest.approx(r, abs=0.03)
    sure = posterior(votes, good, rates) > 0.5
    assert (sure == truth).mean() > 0.95


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_scores_agree_with_labels(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = quality_table(docs).join(labels, "doc_id").collect()
    for column, least in (("posterior", 0.95), ("score", 0.93)):
        good = sorted(r[column] for r in rows if r.quality)
        bad = np.array([r[column] for r in rows if not r.quality])
        below = np.searchsorted(good, bad, side="left") + 0.5 * (
            np.searchsorted(good, bad, side="right") - np.searchsorted(good, bad, side="left"))
        assert 1 - below.sum() / (len(good) * len(bad)) >= least, column
    kept = [r.quality for r in rows if r.keep]
    assert sum(kept) / sum(r.quality for r in rows) > 0.95


def test_edges(edges, nothing):
    found = quality_table(edges).collect()
    assert len(found) == 10
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in found)
    blank = [r for r in found if r.doc_id in (1, 2, 5)]
    assert all(getattr(r, v) == -1 for r in blank for v in VOTERS)
    assert good_documents(edges).columns == edges.columns
    assert quality_table(nothing).collect() == [] and good_documents(nothing).collect() == []


def plain_votes(text):
    """The heuristics, read literally."""
    shape = regex.sub(r"\p{Lu}?[\p{L}--\p{Lu}]+", "x", text or "", flags=regex.V1)
    shape = regex.sub(r"\p{N}+", "0", regex.sub(r"\p{Lu}{2,}", "X", shape))
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    shapes = re.findall(r"[^\x20\x09-\x0D]+", shape)
    n, joined = len(shapes), " ".join(shapes)
    if not n:
        return (-1,) * 6, words, shapes

    def vote(value, bad, good):
        return 0 if bad(value) else 1 if good(value) else -1

    def rate(pattern):
        return len(re.findall(pattern, joined)) / n

    variety = len(set(words)) / n
    ends = rate(r"x[.!?](?: |$)")
    return (
        vote(rate(r"[#$%&*=~^<>@]"), lambda v: v > 0.3, lambda v: v < 0.05),
        vote(rate(r"X"), lambda v: v > 0.3, lambda v: v < 0.05),
        vote(rate(r"\|"), lambda v: v > 0.2, lambda v: v < 0.02),
        vote(ends, lambda v: not 0.025 <= v <= 0.4, lambda v: 0.04 <= v <= 0.3) if n >= 10 else -1,
        vote(variety, lambda v: v < 0.2, lambda v: v > 0.35) if n >= 20 else -1,
        vote(sum(bool(re.fullmatch(r"x[.,;:]?", s)) for s in shapes) / n,
             lambda v: v < 0.7, lambda v: v > 0.9),
    ), words, shapes


def plain_posteriors(votes):
    """Two classes, independent votes, in plain loops."""
    good = 0.7
    rate = [[{-1: 0.3, 0: 0.45, 1: 0.25}, {-1: 0.3, 0: 0.15, 1: 0.55}] for _ in VOTERS]
    count = Counter(votes)
    for _ in range(201):
        p = {}
        for v in count:
            likely = [math.log(1 - good), math.log(good)]
            for k, x in enumerate(v):
                for c in (0, 1):
                    likely[c] += math.log(rate[k][c][x])
            p[v] = 1 / (1 + math.exp(likely[0] - likely[1]))
        new = []
        for k in range(len(VOTERS)):
            new.append([])
            for c in (0, 1):
                mass = {x: 0.1 + sum(n * (p[v] if c else 1 - p[v]) for v, n in count.items() if v[k] == x)
                        for x in (-1, 0, 1)}
                new[k].append({x: m / sum(mass.values()) for x, m in mass.items()})
        done = max(abs(new[k][c][x] - rate[k][c][x]) for k in range(6) for c in (0, 1) for x in (-1, 0, 1)) < 1e-7
        good = min(max(sum(n * p[v] for v, n in count.items()) / sum(count.values()), 1e-3), 1 - 1e-3)
        rate = new
        if done:
            break
    last = {}
    for v in count:
        likely = [math.log(1 - good), math.log(good)]
        for k, x in enumerate(v):
            for c in (0, 1):
                likely[c] += math.log(rate[k][c][x])
        last[v] = 1 / (1 + math.exp(likely[0] - likely[1]))
    return last


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_votes_posterior_and_score_against_brute_force(spark, edges):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(300)
    docs = docs.unionAll(edges.select("doc_id", "text")).unionAll(docs.limit(5))
    rows = scored(docs).select("_doc.text", *VOTERS, "posterior", "score").collect()
    read = [plain_votes(r.text) for r in rows]
    assert [tuple(r[v] for v in VOTERS) for r in rows] == [votes for votes, _, _ in read]
    soft = plain_posteriors([votes for votes, _, _ in read])
    for r, (votes, _, _) in zip(rows, read):
        assert r.posterior == pytest.approx(soft[votes], abs=1e-4)
    # The score, from the model's weights and the buckets of words and shapes.
    table = measured(docs)
    by_pattern = spark.createDataFrame([(*v, p) for v, p in soft.items()],
                                       ", ".join(f"{v} int" for v in VOTERS) + ", posterior double")
    model = trained(table.join(by_pattern, list(VOTERS)), len(rows))
    weights, base = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    words_of, shapes_of = hashers()
    for r, (_, words, shapes) in list(zip(rows, read))[::7]:
        pairs = [f"{a} {b}" for a, b in zip(shapes, shapes[1:])]
        again = ["="] * sum(a == b for a, b in zip(words, words[1:]))
        total = base
        for hasher, terms, first in ((words_of, words, 0), (shapes_of, shapes + pairs + again, FEATURES[0])):
            found = Counter(hasher.indexOf(t) for t in terms)
            length = math.sqrt(sum(n * n for n in found.values())) or 1.0
            total += sum(n / length * weights[first + i] for i, n in found.items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=2e-3)


def test_copies_of_one_page(spark):
    """The sample takes rows: a corpus of copies is neither wholly in it nor wholly out."""
    page = "Una página que se repite muchas veces, con sus frases. Y otra más para que conste. " * 3
    copies = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit(page).alias("text"))
    others = spark.createDataFrame([(100_000 + i, "### $$$ === " * (i + 8)) for i in range(10)],
                                   "doc_id bigint, text string")
    rows = quality_table(copies.unionAll(others), sample=400)
    found = rows.groupBy((F.col("doc_id") < 100_000).alias("copy")).agg(
        F.count("*").alias("n"), F.min("score").alias("least"), F.max("score").alias("most")).collect()
    by = {r["copy"]: r for r in found}
    assert by[True].n == 50_000 and by[False].n == 10
    assert by[True].least == by[True].most and 0 <= by[False].least <= by[False].most <= 1
    few = quality_table(copies.limit(400), sample=40).collect()
    assert len(few) == 400 and len({r.score for r in few}) == 1


def test_nothing_to_learn_gives_the_posterior(spark):
    docs = spark.createDataFrame([(1, "Solo una."), (2, "Otra.")], "doc_id bigint, text string")
    rows = quality_table(docs, sample=0).collect()
    assert len(rows) == 2 and all(r.score == r.posterior for r in rows)
