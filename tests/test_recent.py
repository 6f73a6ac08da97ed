import random

import pytest

from murmullo.operators import recent
from murmullo.operators.recent import last_rows, recent_messages, recent_shares, rolling_shares

KIND = "seq long, es_odio boolean, sentimiento string"


def _rows(n, step, seed):
    rng, seq, rows = random.Random(seed), 0, []
    for _ in range(n):
        seq += rng.randint(1, step)
        rows.append((seq, rng.choice([True, False, None]), rng.choice(["POS", "NEG", "NEU", None])))
    return rows


def _expected(rows, size):
    found = {}
    for i, row in enumerate(rows):
        part = rows[max(0, i - size + 1): i + 1]
        found[row[0]] = (
            len(part), sum(r[1] is True for r in part),
            sum(r[2] == "POS" for r in part), sum(r[2] == "NEG" for r in part))
    return found


@pytest.mark.parametrize("n,step,size,chunk", [
    (400, 1, 60, 64), (400, 5, 60, 64), (300, 200, 10, 16), (50, 1, 60, 64), (200, 3, 7, 7), (90, 1, 1, 4),
])
def test_rolling_shares_against_brute_force(spark, n, step, size, chunk):
    rows = _rows(n, step, n)
    df = spark.createDataFrame(random.Random(1).sample(rows, n), KIND).repartition(5)
    found = rolling_shares(df, "seq", size=size, chunk=chunk).collect()
    expected = _expected(rows, size)
    assert len(found) == n
    for r in found:
        total, hate, pos, neg = expected[r.seq]
        assert r.total == total
        assert r.pct_odio == pytest.approx(100 * hate / total, abs=0.0501)
        assert r.pct_pos == pytest.approx(100 * pos / total, abs=0.0501)
        assert r.pct_neg == pytest.approx(100 * neg / total, abs=0.0501)
        assert r.pct_neu == pytest.approx(100 * (total - pos - neg) / total, abs=0.0501)


def test_rolling_needs_room_for_one_buffer(spark):
    with pytest.raises(ValueError):
        rolling_shares(spark.createDataFrame([], KIND), "seq", size=60, chunk=59)


def test_rolling_shares_has_no_task_with_all_rows(spark):
    df = spark.createDataFrame(_rows(10, 1, 1), KIND)
    plan = rolling_shares(df, "seq")._jdf.queryExecution().optimizedPlan().toString()
    orders = [line.rsplit("], [", 2) for line in plan.splitlines() if "Window [" in line]
    # Partition and order close the line.
    split = ("_range", "_chunk")
    whole = [o for o in orders if len(o) < 3 or not o[1].startswith(split)]
    assert len(orders) == 2 and not whole


def test_rolling_shares_over_many_chunks(spark):
    rows = _rows(500, 4, 5)
    found = rolling_shares(spark.createDataFrame(rows, KIND), "seq", size=9, chunk=11).collect()
    expected = _expected(rows, 9)
    assert {r.seq: (r.total, r.pct_pos) for r in found} == {
        k: (t, pytest.approx(100 * pos / t, abs=0.0501)) for k, (t, _, pos, _) in expected.items()}


def test_rolling_shares_on_sparse_numbers(spark):
    rows = [((r[0] - 3) * (1 << 50), *r[1:]) for r in _rows(7, 1, 1)]
    found = rolling_shares(spark.createDataFrame(rows, KIND), "seq", size=3, chunk=4).collect()
    assert {r.seq: r.total for r in found} == {k: t for k, (t, *_) in _expected(rows, 3).items()}


def test_recent_shares_is_the_last_rolling_row(spark):
    df = spark.createDataFrame(_rows(200, 2, 9), KIND)
    last = rolling_shares(df, "seq").orderBy("seq").collect()[-1]
    assert tuple(recent_shares(df, "seq").first()) == tuple(last)[1:]
    assert tuple(recent_shares(df.limit(0), "seq").first()) == (0, 0.0, 0.0, 0.0, 0.0)


def test_recent_messages(spark):
    rows = [
        (1, "a", "x" * 200, "limpio", "CALLS", True, "POS"), (2, "b", None, "otro", None, False, "NEG"),
        (3, "c", None, None, "raro", None, None),
    ]
    df = spark.createDataFrame(rows, (
        "seq long, autor string, comentario string, comentario_limpio string, "
        "categoria_odio string, es_odio boolean, sentimiento string"))
    assert [tuple(r) for r in recent_messages(df, "seq", k=3).collect()] == [
        (3, "c", "", "raro", "neutral"), (2, "b", "otro", "Sin odio", "negativo"),
        (1, "a", "x" * 130, "Incitación", "odio")]
    assert [r.seq for r in last_rows(df, 2, "seq").collect()] == [3, 2]
