"""Repair the structure of damaged conversations at the least cost.

A turn is kept, given the other role, or deleted; empty turns can be put in. What is
left must read ``system? (user assistant)+``, or be nothing. A turn is a symbol: its
role's initial and its first fault (blank, said before, cut off). For each symbol
a 4 x 4 matrix holds the cost of getting from one state of that pattern to another.
Equal symbols in a row are one run, and a run is crossed with the binary powers of its
matrix (smallest sum in place of the sum), which are kept. So the cost of a
conversation comes from its runs, back to front; then the choices are read off front to
back, the ASCII-least of the cheapest at every step.

A conversation may be longer than a task can hold: turns get a place in one global
order, and at most ``CHUNK`` of them make a chunk. Chunks become matrices in parallel;
per conversation only matrices and states are chained. The digest of a repaired
conversation has to read it in order, so that step runs as a stream with nothing kept.

Order: by ``turn``, null first; equal turns by role and text. A null text reads as one
space, so it is blank; a null role does too, and no pattern has it. A null ``conv_id`` is a conversation like any other.
Rows may repeat: all but the first of equal ones are duplicates. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.llm.common import PLAIN_WORD, stage, with_running_sums
from murmullo.session import ship_package

CHUNK = 1024
# Costs of the edits: reassign a role, delete, insert, and leave a cut-off turn in.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
# States: nothing yet, behind a system turn, behind a user turn, behind an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
         (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The role that a new or renamed turn gets, and the state behind it.
_WANTED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT),
           ASSISTANT: ("user", USER)}
_FAR = 1 << 60
_END = (0, 2 * INSERT, INSERT, 0)

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """First ``a``, then ``b``."""
    columns = list(zip(*b))
    return tuple(tuple(min(min(x + y for x, y in zip(row, col)), _FAR) for col in columns) for row in a)


def before(a: Matrix, behind: Sequence[int]) -> Vector:
    """The cost to the end from each state in front of ``a``, given those behind it."""
    return tuple(min(min(x + y for x, y in zip(row, behind)), _FAR) for row in a)


def moves(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Edit, cost and next state for a turn; a symbol is an initial, then ``!`` if it
    is cut off, or ``x`` if it has to go."""
    found = [("D", DELETE, state)]
    if symbol != "x":
        cut = CUT if symbol.endswith("!") else 0
        kept = _NEXT.get((state, symbol[0]))
        if kept is not None:
            found.append(("K", cut, kept))
        found.append(("R", REROLE + cut, _WANTED[state][1]))
    return found


_INSERTED: Matrix = tuple(
    tuple(0 if i == j else {1: INSERT, 2: 2 * INSERT}.get(
        1 if _WANTED[i][1] == j else 2 if _WANTED[_WANTED[i][1]][1] == j else 0, _FAR)
        for j in range(4)) for i in range(4)
)


@functools.lru_cache(maxsize=None)
def power(symbol: str, bit: int) -> Matrix:
    """The matrix of ``2 ** bit`` equal turns, with insertions in front of each."""
    if bit:
        half = power(symbol, bit - 1)
        return times(half, half)
    one = [[_FAR] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, to in moves(symbol, state):
            one[state][to] = min(one[state][to], cost)
    return times(_INSERTED, tuple(map(tuple, one)))


Runs = tuple[tuple[str, int], ...]


def runs_of(symbols: Iterable[tuple[str, int]]) -> Runs:
    """Equal neighbours as one run."""
    runs: list[tuple[str, int]] = []
    for symbol, n in symbols:
        if runs and runs[-1][0] == symbol:
            runs[-1] = (symbol, runs[-1][1] + n)
        else:
            runs.append((symbol, n))
    return tuple(runs)


_SAME: Matrix = tuple(tuple(0 if i == j else _FAR for j in range(4)) for i in range(4))


def crossed(symbol: str, n: int) -> Iterator[Matrix]:
    """The kept powers that make up ``n`` turns; their order does not matter."""
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            yield power(symbol, bit)


def matrix_of(runs: Runs) -> Matrix:
    whole = _SAME
    for symbol, n in runs:
        for m in crossed(symbol, n):
            whole = times(whole, m)
    return whole


def choices(runs: Runs, end: Vector, start: int, last: bool) -> tuple[str, int]:
    """The cheapest edits from ``start``, ASCII-least, and the state they end in.

    ``end`` holds the costs behind the runs. Costs between runs come from the powers;
    inside a run they are stepped through once, ``CHUNK`` turns at a time, while its
    choices are unrolled.
    """
    runs = tuple((symbol, min(CHUNK, n - i)) for symbol, n in runs for i in range(0, n, CHUNK))
    behind = [end]
    for symbol, n in reversed(runs):
        cost = behind[-1]
        for m in crossed(symbol, n):
            cost = before(m, cost)
        behind.append(cost)
    behind.reverse()
    state, edits = start, []
    for (symbol, n), after in zip(runs, behind[1:]):
        inside = [after]
        for _ in range(n - 1):
            inside.append(before(power(symbol, 0), inside[-1]))
        for rest in reversed(inside):
            ahead = before(power(symbol, 0), rest)
            while True:
                options = [(edit, to) for edit, cost, to in moves(symbol, state)
                           if cost + rest[to] == ahead[state]]
                into = _WANTED[state][1]
                if INSERT + ahead[into] == ahead[state]:
                    options.append(("I", into))
                edit, state = min(options)
                edits.append(edit)
                if edit != "I":
                    break
    while last and end[state]:
        edits.append("I")
        state = _WANTED[state][1]
    return "".join(edits), state


# Short conversations are alike; these remember theirs.
_short_matrix = functools.lru_cache(maxsize=1 << 14)(matrix_of)
_short_choices = functools.lru_cache(maxsize=1 << 14)(choices)


def _is_short(runs: Runs) -> bool:
    return sum(n for _, n in runs) <= 16


# -- tables ---------------------------------------------------------------------------------


def _readable(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with drops, blanks, cuts, repeats and wrong roles, by a checksum
    of conversation and turn (nulls read as one space)."""
    kind = F.pmod(F.crc32(F.concat(_readable("conv_id"), F.lit(":"), _readable("turn"))), F.lit(20))
    text = _readable("text")
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(_readable("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"), kind.alias("_kind"),
    )
    twice = F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return rows.filter(F.col("_kind") != 0).select("*", twice).select("conv_id", "turn", "role", "text")


def _ordered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal turns once with their number ``n``, in one order (``_at``): without and
    with what is said."""
    rows = turns.select("conv_id", "turn", _readable("role").alias("role"), _readable("text").alias("text"))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    words = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    marked = counted.select(
        "*", F.lit(1).cast("bigint").alias("_one"),
        F.sha2(F.concat("role", F.lit("\x00"), "text"), 256).alias("_said"),
        F.substring("role", 1, 1).alias("_initial"),
        (~F.col("text").rlike(PLAIN_WORD)).alias("_blank"),
        (~F.substring(words, -1, 1).rlike("[.!?]")).alias("_cut"),
    )
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = with_running_sums(marked, by, {"_at": "_one"}, "conversations")
    slim = stage(placed.select("conv_id", "turn", "n", "_said", "_initial", "_blank", "_cut", "_at"),
                 "conversation-turns")
    return slim, placed.select("_at", "role", "text")


_CHUNKS = "conv_id {id}, _chunk bigint, turns array<struct<_at: bigint, symbol: string, n: bigint>>, " \
    "m array<bigint>, first string, last string, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of turns as symbols, with their matrix and counts."""
    for batch in batches:
        out = []
        for conv, chunk, turns in zip(*(batch.column(i).to_pylist() for i in range(3))):
            symbols, counts, illegal = [], [0, 0, 0], 0
            for i, turn in enumerate(turns):
                initial, n, first = turn["_initial"], turn["n"], turn["_first"]
                illegal += (n - 1) + (i > 0 and not _legal(turns[i - 1]["_initial"] + initial))
                fresh = 1 if first and not turn["_blank"] else 0
                counts[0] += n if turn["_blank"] else 0
                counts[1] += 0 if turn["_blank"] else n - fresh
                counts[2] += fresh and turn["_cut"]
                if fresh:
                    known = initial if initial in ("s", "u", "a") else "o"
                    symbols.append({"_at": turn["_at"], "symbol": known + "!" * turn["_cut"], "n": 1})
                if n > fresh:
                    symbols.append({"_at": turn["_at"], "symbol": "x", "n": n - fresh})
            runs = _runs(symbols)
            m = (_short_matrix if _is_short(runs) else matrix_of)(runs)
            out.append((conv, chunk, symbols, [x for row in m for x in row], turns[0]["_initial"],
                        turns[-1]["_initial"], *map(int, counts), illegal))
        yield _batch(out, batch.schema.field(0).type, _CHUNKS)


_KINDS = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], id_type: pa.DataType, schema: str) -> pa.RecordBatch:
    """Rows as a batch of the fields of a schema line whose first is ``conv_id``."""
    names, kinds = _fields(schema)
    columns = list(zip(*rows)) if rows else [()] * len(names)
    turn = pa.list_(pa.struct([("_at", pa.int64()), ("symbol", pa.string()), ("n", pa.int64())]))
    types = [id_type, *[_KINDS.get(k, turn) for k in kinds[1:]]]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


def _fields(schema: str) -> tuple[list[str], list[str]]:
    """Names and kinds of a schema line."""
    parts, depth, last = [], 0, 0
    for i, c in enumerate(schema + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(schema[last:i].strip().split(" ", 1))
            last = i + 1
    return [p[0] for p in parts], [p[1] for p in parts]


_BEHIND = "conv_id {id}, _chunk bigint, _behind array<bigint>, _last int, cost bigint"
_PATHS = "conv_id {id}, _chunk bigint, _to array<bigint>"
_STATES = "conv_id {id}, _chunk bigint, _from bigint"
_EDITS = "conv_id {id}, _chunk bigint, _edits string, _by_turn array<struct<_at: bigint, symbol: string, n: bigint>>"


def _costs_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the matrices of a conversation from its end: costs behind each chunk."""
    for batch in batches:
        out = []
        for conv, chunks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            end, found = _END, []
            for c in reversed(chunks):
                found.append((conv, c["_chunk"], end, c is chunks[-1]))
                m = c["m"]
                end = before(tuple(tuple(m[i:i + 4]) for i in range(0, 16, 4)), end)
            out += [(*row[:2], list(row[2]), int(row[3]), end[START]) for row in found]
        yield _batch(out, batch.schema.field(0).type, _BEHIND)


def _runs(turns: list[dict]) -> Runs:
    return runs_of((t["symbol"], t["n"]) for t in turns)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each state in front of a chunk, the state its cheapest edits end in."""
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
        out = []
        for conv, chunk, turns, end in rows:
            runs, end = _runs(turns), tuple(end)
            chosen = _short_choices if _is_short(runs) else choices
            out.append((conv, chunk, [chosen(runs, end, s, False)[1] for s in range(4)]))
        yield _batch(out, batch.schema.field(0).type, _PATHS)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in front of each chunk of a conversation."""
    for batch in batches:
        out = []
        for conv, chunks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            state = START
            for c in chunks:
                out.append((conv, c["_chunk"], state))
                state = c["_to"][state]
        yield _batch(out, batch.schema.field(0).type, _STATES)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of a chunk, whole and by turn: ``symbol`` holds a turn's edits, ``n`` the
    state in front of them."""
    for batch in batches:
        out = []
        for conv, chunk, turns, end, last, state in zip(*(batch.column(i).to_pylist() for i in range(6))):
            runs = _runs(turns)
            chosen = _short_choices if _is_short(runs) else choices
            edits, _ = chosen(runs, tuple(end), state, bool(last))
            by_turn: list[dict] = []
            place, left = 0, 0
            for edit in edits:
                if not left and place < len(turns):
                    at, left = turns[place]["_at"], turns[place]["n"]
                    place += 1
                    if not by_turn or by_turn[-1]["_at"] != at:
                        by_turn.append({"_at": at, "symbol": "", "n": state})
                by_turn[-1]["symbol"] += edit
                left -= edit != "I" and left > 0
                state = _after(edit, state, turns[place - 1]["symbol"])
            out.append((conv, chunk, edits, by_turn))
        yield _batch(out, batch.schema.field(0).type, _EDITS)


def _after(edit: str, state: int, symbol: str) -> int:
    if edit == "K":
        return _NEXT[state, symbol[0]]
    return state if edit == "D" else _WANTED[state][1]


def repaired_turn(role: str, text: str, edits: str, state: int) -> Iterator[tuple[str, str]]:
    """What a turn becomes under its edits."""
    for edit in edits:
        if edit == "K":
            yield role, text
        elif edit in "RI":
            yield _WANTED[state][0], text if edit == "R" else ""
        state = _after(edit, state, role[:1])


def solved(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per conversation the report without its digest; per turn its edits; the texts."""
    spark = turns.sparkSession
    ship_package(spark)
    slim, said = _ordered(turns)
    kind = slim.schema["conv_id"].dataType.simpleString()

    def typed(schema: str) -> str:
        return schema.replace("{id}", kind)

    firsts = slim.groupBy(F.col("conv_id").alias("_conv"), F.col("_said").alias("_same")).agg(
        F.min("_at").alias("_first_at"))
    marked = slim.join(firsts, slim["conv_id"].eqNullSafe(firsts["_conv"])
                       & (slim["_said"] == firsts["_same"]))
    one = F.struct("_at", "_initial", "n", "_blank", "_cut",
                   (F.col("_at") == F.col("_first_at")).alias("_first"))
    chunked = (
        marked.groupBy("conv_id", F.floor(F.col("_at") / CHUNK).alias("_chunk"))
        .agg(F.sort_array(F.collect_list(one)).alias("turns"))
    )
    chunks = stage(chunked.mapInArrow(_summaries, typed(_CHUNKS)), "conversation-chunks")

    def listed(rows: DataFrame, value: str) -> DataFrame:
        """Numbers of the chunks of a conversation, in order; a few for each chunk."""
        return rows.groupBy("conv_id").agg(
            F.sort_array(F.collect_list(F.struct("_chunk", value))).alias("_chunks"))

    def beside(rows: DataFrame, more: DataFrame, *columns: str) -> DataFrame:
        other = more.select(F.col("conv_id").alias("_c"), F.col("_chunk").alias("_k"), *columns)
        return rows.join(other, rows["conv_id"].eqNullSafe(other["_c"])
                         & (rows["_chunk"] == other["_k"])).drop("_c", "_k")

    behind = stage(listed(chunks, "m").mapInArrow(_costs_behind, typed(_BEHIND)), "conversation-costs")
    known = beside(chunks.select("conv_id", "_chunk", "turns"), behind, "_behind", "_last")
    paths = known.mapInArrow(_ends, typed(_PATHS))
    states = listed(paths, "_to").mapInArrow(_chained, typed(_STATES))
    edited = stage(
        beside(known, states, "_from").mapInArrow(_edited, typed(_EDITS)), "conversation-edits")
    pieces = edited.groupBy("conv_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("_chunk", "_edits"))), lambda c: c["_edits"]), "")
        .alias("audit"))
    # Between two chunks of a conversation the last and the first turn also meet.
    meet = F.aggregate(
        F.sequence(F.lit(2), F.greatest(F.size("_ends"), F.lit(2))), F.lit(0).cast("bigint"),
        lambda n, i: n + F.when(
            (i <= F.size("_ends")) & ~F.concat(
                F.try_element_at("_ends", i - 1)["last"], F.try_element_at("_ends", i)["first"]
            ).isin("su", "ua", "au"), 1).otherwise(0))
    counts = chunks.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.sort_array(F.collect_list(F.struct("_chunk", "first", "last"))).alias("_ends"),
    ).withColumn("illegal", F.col("illegal") + meet).drop("_ends")
    gaps = slim.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
        .cast("bigint").alias("gaps"))
    costs = behind.groupBy("conv_id").agg(F.min("cost").alias("cost"))
    report = gaps
    for more in (counts, costs, pieces):
        other = more.withColumnRenamed("conv_id", "_c")
        report = report.join(other, report["conv_id"].eqNullSafe(other["_c"])).drop("_c")
    by_turn = edited.select("conv_id", F.inline("_by_turn")).select(
        "conv_id", F.col("_at").alias("_place"), F.col("symbol").alias("edits"), F.col("n").alias("state"))
    return report, by_turn, said


def _with_text(by_turn: DataFrame, said: DataFrame) -> DataFrame:
    return by_turn.join(said, by_turn["_place"] == said["_at"]).select(
        "conv_id", "_at", "role", "text", "edits", "state")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "_at", "_n", "role", "text"]
    for batch in batches:
        conv, at, made = [], [], []
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            for i, turn in enumerate(repaired_turn(*row[2:])):
                conv.append(row[0])
                at.append(row[1])
                made.append((i, *turn))
        columns = list(zip(*made)) if made else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv, batch.schema.field(0).type), pa.array(at, pa.int64()),
             pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.string())], names=names)


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``_at`` and ``_n`` (their order), ``role``, ``text``."""
    _, by_turn, said = solved(turns)
    kind = turns.schema["conv_id"].dataType.simpleString()
    return _with_text(by_turn, said).mapInArrow(
        _lines, f"conv_id {kind}, _at bigint, _n int, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation, in a stream of turns in order."""
    open_, digest, begun = None, None, False

    def closed(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in done], kind), pa.array([d for _, d in done], pa.string())],
            names=["conv_id", "repaired_sha256"])

    kind = None
    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if digest is None or row[0] != open_:
                if digest is not None:
                    done.append((open_, digest.hexdigest()))
                open_, digest, begun = row[0], hashlib.sha256(), False
            for role, text in repaired_turn(*row[2:]):
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
        yield closed(done)
    if digest is not None:
        yield closed([(open_, digest.hexdigest())])


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Per conversation: faults, cost, audit and the digest of what it becomes.

    ``conversations`` names conversations that have lost all their turns too.
    """
    report, by_turn, said = solved(turns)
    kind = turns.schema["conv_id"].dataType.simpleString()
    digests = (
        _with_text(by_turn, said).repartition("conv_id").sortWithinPartitions("conv_id", "_at")
        .mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")
        .withColumnRenamed("conv_id", "_d")
    )
    known = report.join(digests, report["conv_id"].eqNullSafe(digests["_d"])).drop("_d")
    if conversations is not None:
        every = conversations.select(F.col("conv_id").alias("_every")).distinct()
        known = every.join(known, every["_every"].eqNullSafe(known["conv_id"]), "left").drop(
            "conv_id").withColumnRenamed("_every", "conv_id")
    return known.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in _NUMBERS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage the conversations, then report on their repair."""
    return repair_report(damaged(conversations), conversations)
