"""Repairs against a search through all edits, and long conversations in many chunks."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

import murmullo.llm.conversations as conversations
from murmullo.llm.conversations import (
    choices, damaged, matrix_of, power, repair_damaged, repair_report, repaired, runs_of, times,
)

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n int, _at string, edits int"
SHAPE = re.compile(r"(s?(ua)+)?")


def rows_of(table):
    """Damage and order, read literally."""
    out = {}
    for conv, turn, role, text in table:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out.setdefault(conv, [])
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def fault(rows, i):
    _, role, text = rows[i]
    said = text.strip(" \t\n\x0b\x0c\r")
    if not said:
        return "blank"
    if any(r[1:] == (role, text) for r in rows[:i]):
        return "duplicate"
    return "none" if said[-1] in ".!?" else "truncated"


def cheapest(rows):
    """Forward over all states with the best string of edits for each."""
    best = {"": (0, "", ())}  # what has been written, reduced to its shape
    after = {"": "us", "s": "u", "u": "a", "a": "u"}

    def add(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted(states):
        for _ in range(2):
            for state, (cost, audit, made) in list(states.items()):
                role = "a" if state == "u" else "u"
                add(states, role, (cost + 5, audit + "I", made + (("user:", "assistant:")[role == "a"],)))
        return states

    for i, (_, role, text) in enumerate(rows):
        found, f = {}, fault(rows, i)
        for state, (cost, audit, made) in inserted(best).items():
            add(found, state, (cost + 2, audit + "D", made))
            if f in ("blank", "duplicate"):
                continue
            extra = 5 if f == "truncated" else 0
            if role[:1] and role[0] in after[state]:
                add(found, role[0], (cost + extra, audit + "K", made + (f"{role}:{text}",)))
            to = "a" if state == "u" else "u"
            name = "assistant" if to == "a" else "user"
            add(found, to, (cost + 1 + extra, audit + "R", made + (f"{name}:{text}",)))
        best = found
    ends = [v for s, v in inserted(best).items() if s in ("", "a")]
    return min(ends, key=lambda v: v[:2])


def expected(table):
    out = {}
    for conv, rows in rows_of(table).items():
        turns = [r[0] for r in rows if r[0] is not None]
        faults = [fault(rows, i) for i in range(len(rows))]
        cost, audit, made = cheapest(rows)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
            cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest(),
        )
    return out


def found(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                       r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def noisy(rng, conv, n):
    texts = ["Sí.", "No!", "Tal vez", "", " \t", "Otra cosa?", "a.\nb", None, "Fin. "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    return [(conv, rng.choice([t, t, t + 1, None]) if rng.random() < 0.2 else t, rng.choice(roles),
             rng.choice(texts) if rng.random() < 0.5 else f"Frase {rng.randint(0, 99)}.") for t in range(n)]


@pytest.fixture(scope="module")
def table():
    rng = random.Random(4)
    rows = [r for conv in range(60) for r in noisy(rng, conv, rng.randint(1, 9))]
    rows += noisy(rng, None, 12) + noisy(rng, 777, 150) + [(5, 0, "user", "Sí.")] * 7
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"Bien {t}.") for t in range(40)]
    return rows


def frame(spark, table):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in table], SCHEMA).repartition(5)


def test_reports_equal_the_search(spark, table):
    assert found(repair_damaged(frame(spark, table))) == expected(table)


def test_chunks_change_nothing(spark, table, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 7)
    assert found(repair_damaged(frame(spark, table))) == expected(table)


def test_repaired_turns_have_the_shape(spark, table):
    df = frame(spark, table)
    report = {r.conv_id: r for r in repair_report(damaged(df)).collect()}
    turns = {}
    for r in sorted(repaired(damaged(df)).collect(), key=lambda r: (r._at, r._n)):
        turns.setdefault(r.conv_id, []).append(r)
    assert turns
    for conv, rows in turns.items():
        assert SHAPE.fullmatch("".join(r.role[0] for r in rows))
        whole = "\n".join(f"{r.role}:{r.text}" for r in rows)
        assert hashlib.sha256(whole.encode()).hexdigest() == report[conv].repaired_sha256


def test_powers_and_runs():
    for symbol in ("u", "a!", "x", "s", "o!"):
        step = power(symbol, 0)
        whole = step
        for n in range(2, 40):
            whole = times(whole, step)
            assert matrix_of(((symbol, n),)) == whole
    assert runs_of([("u", 1), ("u", 2), ("x", 1)]) == (("u", 3), ("x", 1))
    end = (0, 10, 5, 0)
    edits, state = choices((("u", 3000), ("x", 5000)), end, 0, True)
    assert len(edits.replace("I", "")) == 8000 and state in (0, 3)
    assert edits.endswith("D" * 4999)


def test_edges(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair_damaged(nothing).collect() == [] and repaired(nothing).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 > 4)
    long = [(gone, 0, "user", "Hola."), (kept, 0, "user", "palabra " * 50_000 + "."), (None, None, None, None)]
    assert found(repair_damaged(frame(spark, long))) == expected(long)
    assert found(repair_damaged(frame(spark, long)))[gone] == (
        0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
