"""Word vectors from counts: windowed co-occurrence, mutual information, factors.

Words that stand near each other are counted, the counts become positive pointwise
mutual information (how much more often than by chance), and the sparse symmetric
matrix of these is factorised by subspace iteration with random signs. Words are known by
their 64-bit hash, so no dictionary of them is sent anywhere.

Between two steps pairs are a plain table. Inside a step they move in chunks: the sorted
ids of the words, the places of a pair's two words among them, in order and as
differences, and the values, all compressed. A pair then takes some two bytes and its value,
a tenth of a row. Chunks are dealt by the classes of both words, so what a task needs to know about
words is about two classes of them.

What comes to the driver is square in the number of dimensions, and the vectors of the
131,072 words with the most neighbours, however many words there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmullo.operators.ordered import discard, shuffles_removed, stage
from murmullo.session import ship_package

WINDOW = 5
DIMENSIONS = 50
# More random directions than dimensions.
_SPARE = 10
# Words of a text that are paired at once, which bounds a row.
_PIECE = 8192
# Words whose pairs a task counts at once before it sends them on.
_AT_ONCE = 1 << 21
# Pairs of a chunk.
_CHUNK = 1 << 21
# Words, or pairs, for each block of two classes, and pairs that wait to be added up.
_BLOCK = 1 << 23
_WAITING = 1 << 22
# Words with the most neighbours, whose vectors all tasks get: 31 MB; of fewer words an eighth.
_CONNECTED = 1 << 17
_LEAST_CONNECTED = 1 << 10
# Entries of the matrix that a task multiplies, and the least number of tasks.
_ENTRIES = 1 << 22
_LEAST_PARTS = 4
# Vectors of a row, and entries that are multiplied at once.
_VECTORS = 4096
_STEP = 1 << 14


class _Chunk(NamedTuple):
    """Some pairs: the sorted ids of their words, the places of both words among these
    (the first one's times 2^32), in order, and a value for each."""

    ids: np.ndarray
    pairs: np.ndarray
    values: np.ndarray

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        return (self.pairs >> np.uint64(32)).astype(np.int64), (self.pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def some(self, at: np.ndarray) -> _Chunk:
        """Some of the pairs, with the ids of their own words only."""
        kept = _Chunk(self.ids, self.pairs[at], self.values[at])
        a, b = kept.sides()
        has = np.zeros(len(self.ids), np.bool_)
        has[a] = has[b] = True
        place = np.cumsum(has) - 1
        return _Chunk(self.ids[has], _coded(place[a], place[b]), kept.values)


def _coded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)


def _squeezed(numbers: np.ndarray, apart: bool = True) -> bytes:
    """Compressed; ``apart`` puts bytes of equal significance together."""
    data = np.ascontiguousarray(numbers)
    if apart:
        data = np.ascontiguousarray(data.view(np.uint8).reshape(-1, data.itemsize).T)
    return pa.compress(data.tobytes(), codec="zstd", asbytes=True)


def _expanded(data: bytes, kind: type, many: int, apart: bool = True) -> np.ndarray:
    kind = np.dtype(kind)
    if not many:
        return np.empty(0, kind)
    raw = np.frombuffer(pa.decompress(data, many * kind.itemsize, codec="zstd"), np.uint8)
    if apart:
        return np.ascontiguousarray(raw.reshape(kind.itemsize, many).T).view(kind).ravel()
    return raw.view(kind)


def _steps(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered.view(np.uint64), prepend=np.uint64(0))


_CLOSED = "part int, kind int, words bigint, many bigint, ids binary, pairs binary, data binary"
_KINDS = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
_NAMES = [c.split()[0] for c in _CLOSED.split(", ")]


def _closed(part: int, kind: int, chunk: _Chunk) -> pa.RecordBatch:
    # Whole numbers have mostly one byte that is not zero; the bytes of others are kept together.
    row = (part, kind, len(chunk.ids), len(chunk.pairs), _squeezed(_steps(chunk.ids)),
           _squeezed(_steps(chunk.pairs)), _squeezed(chunk.values, chunk.values.dtype == np.int64))
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _KINDS)], names=_NAMES)


def _opened(words: int, many: int, ids: bytes, pairs: bytes, data: bytes, kind: type) -> _Chunk:
    return _Chunk(
        np.cumsum(_expanded(ids, np.uint64, words), dtype=np.uint64).view(np.int64),
        np.cumsum(_expanded(pairs, np.uint64, many), dtype=np.uint64), _expanded(data, kind, many, kind is np.int64))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of packed tables."""
    for batch in batches:
        for i in range(len(batch)):
            yield tuple(column[i].as_py() for column in batch.columns)


def _chunks(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[_Chunk]:
    for _, _, *row in _read(batches):
        yield _opened(*row, kind)


def _sorted_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different ids, in the order of unsigned numbers, and the place of each among them."""
    found, place = np.unique(ids.view(np.uint64), return_inverse=True)
    return found.view(np.int64), place


def _place(known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.searchsorted(known.view(np.uint64), ids.view(np.uint64))


def _chunk_of(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> _Chunk:
    ids, place = _sorted_ids(np.concatenate([a, b]))
    pairs = _coded(place[:len(a)], place[len(a):])
    if (pairs[1:] < pairs[:-1]).any():
        order = np.argsort(pairs, kind="stable")
        pairs, values = pairs[order], values[order]
    return _Chunk(ids, pairs, values)


def _pack(df: DataFrame, value: str, kind: type) -> DataFrame:
    """A table of pairs (``a``, ``b`` and a value) in chunks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += len(batch)
            if rows >= _CHUNK:
                a, b, x = map(np.concatenate, zip(*held))
                yield _closed(0, 0, _chunk_of(a, b, x.astype(kind)))
                held, rows = [], 0
        if rows:
            a, b, x = map(np.concatenate, zip(*held))
            yield _closed(0, 0, _chunk_of(a, b, x.astype(kind)))

    ship_package(df.sparkSession)
    return df.select("a", "b", value).mapInArrow(pack, _CLOSED)


def _classes(many: int) -> int:
    """Classes of words, a power of two, so that blocks of more classes lie inside those of fewer."""
    classes = 4
    while classes * (classes + 1) // 2 < many / _BLOCK:
        classes *= 2
    return classes


def _block(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    low, high = np.minimum(one, other), np.maximum(one, other)
    return high * (high + 1) // 2 + low


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key, and where it stands, in order."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begin = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(keys) else np.empty(0, int)
    for i, j in zip(begin, np.append(begin[1:], len(keys))):
        yield int(ranked[i]), order[i:j]


def _class_of(ids: np.ndarray, classes: int) -> np.ndarray:
    return ids & np.int64(classes - 1)


def _deal(chunk: _Chunk, classes: int) -> Iterator[pa.RecordBatch]:
    """A chunk in parts, by the block of two classes."""
    own = _class_of(chunk.ids, classes)
    a, b = chunk.sides()
    for block, some in _groups(_block(own[a], own[b]).astype(np.uint16)):
        yield _closed(block, 0, chunk.some(some))


def _dealt_words(words: DataFrame, classes: int) -> DataFrame:
    """Rows of words, an ``id`` and doubles, to all blocks that have their class. Numbers go
    as they are, one column after the other."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            ids, *columns = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(ids.view(np.uint64))
            ids, table = ids[order], np.array(columns, np.float64)[:, order]
            for own, some in _groups(_class_of(ids, classes)):
                data = _squeezed(table[:, some].ravel(), False)
                for block in _block(np.full(classes, own), np.arange(classes)):
                    row = (int(block), 1, len(some), 0, _squeezed(_steps(ids[some])), b"", data)
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _KINDS)], names=_NAMES)

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += len(batch)
            if rows >= 1 << 18:
                yield from sent()
                held, rows = [], 0
        if rows:
            yield from sent()

    return words.mapInArrow(deal, _CLOSED)


def _in_blocks(
    chunks: DataFrame, words: DataFrame, classes: int, kind: type, many: int,
    use: Callable[[_Chunk, np.ndarray], Iterator[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """``use`` on each chunk, with the ``many`` numbers of its words from a table of these.

    Chunks of a block stay compressed until all of its words have come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, tables = [], [], []
        for _, is_words, *row in _read(batches):
            if is_words:
                own = _opened(*row[:4], b"", np.float64).ids
                ids.append(own)
                tables.append(_expanded(row[4], np.float64, many * len(own), False).reshape(many, -1))
            else:
                held.append(row)
        if not held:
            return
        known, place = _sorted_ids(np.concatenate(ids)) if ids else (np.empty(0, np.int64), np.empty(0, int))
        table = np.full((many, len(known) + 1), np.nan)  # the last one is of words without numbers
        if ids:
            table[:, place] = np.concatenate(tables, axis=1)
        while held:
            chunk = _opened(*held.pop(), kind)
            at = _place(known, chunk.ids)
            missing = np.flatnonzero(np.append(known, 0)[at] != chunk.ids)
            at[missing] = len(known)
            yield from use(chunk, table[:, at])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, kind):
            yield from _deal(chunk, classes)

    blocks = classes * (classes + 1) // 2
    return chunks.mapInArrow(deal, _CLOSED).unionByName(_dealt_words(words, classes)).repartitionById(
        blocks, "part").mapInArrow(run, schema)


def _in_rows(columns: Sequence[np.ndarray], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(columns[0]), 1 << 17):
        yield pa.RecordBatch.from_arrays([pa.array(c[begin:begin + (1 << 17)]) for c in columns], names=list(names))


def word_ids(lists: DataFrame, tokens: str = "tokens", min_count: int = 1) -> DataFrame:
    """``id``, ``word``, ``n`` of the words that occur ``min_count`` times or more."""
    counted = lists.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count).select(F.xxhash64("word").alias("id"), "word", "n")


def _pairs_of(ids: np.ndarray, sizes: np.ndarray, window: int, piece: int) -> _Chunk:
    """The pairs of some pieces and how often they occur. ``ids`` are the words of
    all pieces one after the other; only the first ``piece`` words of one begin pairs."""
    words, code = _sorted_ids(ids)
    code = code.astype(np.uint64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(ids))
    begins = np.repeat(ends - sizes, sizes) + piece > np.arange(len(ids))
    met = []
    for distance in range(1, window + 1):
        first = np.flatnonzero((left > distance) & begins)
        x, y = code[first], code[first + distance]
        met.append(np.minimum(x, y) << np.uint64(32) | np.maximum(x, y))
    met = np.concatenate(met)
    met.sort()
    starts = np.flatnonzero(np.concatenate(([True], met[1:] != met[:-1]))) if len(met) else np.zeros(0, int)
    # Codes are in the order of the ids, so the smaller one is the smaller id.
    return _Chunk(words, met[starts], np.diff(np.append(starts, len(met))).astype(np.int64))


def _count_pairs(
    batches: Iterator[pa.RecordBatch], window: int, piece: int, at_once: int, classes: int
) -> Iterator[pa.RecordBatch]:
    held, words = [], 0

    def counted() -> Iterator[pa.RecordBatch]:
        yield from _deal(_pairs_of(*map(np.concatenate, zip(*held)), window, piece), classes)

    for batch in batches:
        # A batch may be many words: it is taken by rows.
        sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
        ids = batch.column(0).flatten().to_numpy()
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            begin = ends[at] - sizes[at]
            upto = max(at + 1, int(np.searchsorted(ends, begin + at_once - words, "right")))
            held.append((ids[begin:ends[upto - 1]], sizes[at:upto]))
            words += int(ends[upto - 1] - begin)
            at = upto
            if words >= at_once * 9 // 10:
                yield from counted()
                held, words = [], 0
    if held:
        yield from counted()


def _added_up(chunks: Sequence[_Chunk]) -> _Chunk:
    ids, _ = _sorted_ids(np.concatenate([c.ids for c in chunks]))
    pairs = []
    for c in chunks:
        place = _place(ids, c.ids)
        a, b = c.sides()
        pairs.append(_coded(place[a], place[b]))
    pairs = np.concatenate(pairs)
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    begin = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return _Chunk(ids, pairs[begin], np.add.reduceat(np.concatenate([c.values for c in chunks])[order], begin))


def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows, most = [], 0, _WAITING
    for chunk in _chunks(batches, np.int64):
        if len(chunk.pairs):
            held.append(chunk)
            rows += len(chunk.pairs)
        if rows > most and len(held) > 1:
            held = [_added_up(held)]
            rows = len(held[0].pairs)
            most = max(_WAITING, 2 * rows)
    if not held:
        return
    whole = _added_up(held)
    del held
    a, b = whole.sides()
    for begin in range(0, len(a), 1 << 17):
        part = slice(begin, begin + (1 << 17))
        yield from _in_rows([whole.ids[a[part]], whole.ids[b[part]], whole.values[part]], "abn")


def pair_counts(lists: DataFrame, window: int = WINDOW, tokens: str = "tokens") -> DataFrame:
    """``a``, ``b`` (ids, the smaller unsigned one first) and ``n``: how often the two stand at
    most ``window`` words apart. Pairs are counted inside the tasks before they are dealt out."""
    words = lists.select(F.sum(F.size(tokens))).first()[0] or 0
    ids = F.transform(F.col(tokens), lambda word: F.xxhash64(word))
    pieces = lists.select(ids.alias("_ids")).filter(F.size("_ids") > 1).select(
        "_ids", F.explode(F.sequence(F.lit(0), F.size("_ids") - 1, F.lit(_PIECE))).alias("_from")
    ).select(F.slice("_ids", F.col("_from") + 1, F.lit(_PIECE + window)).alias("_ids"))

    ship_package(lists.sparkSession)
    piece, at_once, classes = _PIECE, _AT_ONCE, _classes(words)
    counted = pieces.mapInArrow(
        lambda batches: _count_pairs(batches, window, piece, at_once, classes), _CLOSED)
    return counted.repartitionById(classes * (classes + 1) // 2, "part").mapInArrow(
        _merge_counts, "a bigint, b bigint, n bigint")


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair of two words in both directions; a word beside itself counts twice."""
    other = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n").alias("n"))
    same = F.struct(F.col("a"), F.col("b"), (F.col("n") * 2).alias("n"))
    one = F.struct("a", "b", "n")
    return pairs.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(same))
                                 .otherwise(F.array(one, other))))


def _sums(chunks: DataFrame) -> DataFrame:
    """How many neighbours each word (``a``) has; a word beside itself counts twice."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, np.int64):
            a, b = chunk.sides()
            sums = np.zeros(len(chunk.ids), np.int64)
            np.add.at(sums, a, chunk.values)
            np.add.at(sums, b, chunk.values)
            yield from _in_rows([chunk.ids, sums], ["a", "_n"])

    return chunks.mapInArrow(add, "a bigint, _n bigint").groupBy("a").agg(F.sum("_n").alias("_na"))


def positive_information(pairs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """``a``, ``b``, ``value``: the positive pointwise mutual information of pairs, both
    ways, of the given words only."""
    known = pairs
    if words is not None:
        for side in ("a", "b"):
            known = known.join(words.select(F.col("id").alias(side)), side, "left_semi")
    # Each pair is kept once; both directions have the same value.
    with shuffles_removed(pairs.sparkSession):
        counts = stage(_pack(known, "n", np.int64), "cooccurrence")
        totals = stage(_sums(counts), "cooccurrence-totals")
        whole = float(totals.agg(F.sum("_na")).first()[0] or 0)
        many = counts.agg(F.sum("many")).first()[0] or 0

    def informed(chunk: _Chunk, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        for begin in range(0, len(chunk.pairs), _VECTORS * 32):
            part = slice(begin, begin + _VECTORS * 32)
            a, b = _Chunk(chunk.ids, chunk.pairs[part], chunk.values[part]).sides()
            same = a == b
            n = np.where(same, 2 * chunk.values[part], chunk.values[part])
            # In floating point from the start: the product of two totals may not fit a long.
            value = np.log(n * whole / (table[0, a] * table[0, b]))
            kept, turned = value > 0, (value > 0) & ~same
            yield from _in_rows([
                chunk.ids[np.concatenate([a[kept], b[turned]])], chunk.ids[np.concatenate([b[kept], a[turned]])],
                np.concatenate([value[kept], value[turned]])], ["a", "b", "value"])

    of_words = totals.select(F.col("a").alias("id"), F.col("_na").cast("double").alias("_na"))
    return _in_blocks(counts, of_words, _classes(many), np.int64, 1, informed, "a bigint, b bigint, value double")


def _part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % parts


def _signs(ids: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Random signs from an id: one bit for each, of at most 64."""
    with np.errstate(over="ignore"):
        z = ids.view(np.uint64) + np.uint64(seed % (1 << 32)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    bits = z[:, None] >> np.arange(size, dtype=np.uint64) & np.uint64(1)
    return 1.0 - 2.0 * bits


# What a part is sent: links of its words to the most connected ones, between two of these,
# and to others; vectors of its own words, and of others that they are linked to. What it
# gives the most connected ones goes out in slabs.
_TO_LISTED, _LISTED, _TO_OTHERS, _OWN, _COPY, _SLAB = range(6)


def _deal_entries(batches: Iterator[pa.RecordBatch], listed: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Entries of the matrix to the parts of their words that are not listed."""
    for chunk in _chunks(batches, np.float32):
        slot = np.minimum(_place(listed, chunk.ids), len(listed) - 1)
        top, home = listed[slot] == chunk.ids, _part_of(chunk.ids, parts)
        a, b = chunk.sides()

        def sent(kind, at, row, column, part, values, chunk=chunk):
            for to, some in _groups(part.astype(np.uint16) if parts < 1 << 16 else part):
                x, y = row[some], column[some]
                has = np.zeros(len(chunk.ids), np.bool_)
                if kind != _LISTED:
                    has[x] = True
                if kind == _TO_OTHERS:
                    has[y] = True
                place = np.cumsum(has) - 1
                x = slot[x] if kind == _LISTED else place[x]
                y = place[y] if kind == _TO_OTHERS else slot[y]
                pairs = _coded(x, y)
                order = np.argsort(pairs, kind="stable")
                yield _closed(to, kind, _Chunk(chunk.ids[has], pairs[order], values[at[some[order]]]))

        values, one, other = chunk.values, top[a], top[b]
        at = np.flatnonzero(one ^ other)
        row, column = np.where(one[at], b[at], a[at]), np.where(one[at], a[at], b[at])
        yield from sent(_TO_LISTED, at, row, column, home[row], values)
        at = np.flatnonzero(one & other)
        yield from sent(_LISTED, at, a[at], b[at], (slot[a[at]] + slot[b[at]]) % parts, values)
        at = np.flatnonzero(~one & ~other)
        at = np.concatenate([at, at[a[at] != b[at]]])
        here = np.arange(len(at)) < np.count_nonzero(~one & ~other)
        row, column = np.where(here, a[at], b[at]), np.where(here, b[at], a[at])
        yield from sent(_TO_OTHERS, at, row, column, home[row], values)


def _gain(out: np.ndarray, to: np.ndarray, vectors: np.ndarray, of: np.ndarray, by: np.ndarray) -> None:
    """Add vectors times ``by`` to the rows ``to``, which are in order."""
    for begin in range(0, len(to), _STEP):
        part = slice(begin, begin + _STEP)
        row = to[part]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] += np.add.reduceat(vectors.take(of[part], axis=0) * by[part, None], first, axis=0)


def _vector_row(part: int, kind: int, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    row = (part, kind, len(ids), len(vectors), ids.tobytes(), b"", vectors.astype(np.float32).tobytes())
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _KINDS)], names=_NAMES)


def _vectors_of(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, np.float32).reshape(-1, size).astype(np.float64)


def _multiply_part(
    batches: Iterator[pa.RecordBatch], table: np.ndarray, parts: int, turn: np.ndarray | None, seed: int, last: bool
) -> Iterator[pa.RecordBatch]:
    """The rows of the matrix of a part's words times the vectors, and what the listed words get from it."""
    size, part, held, ids, vectors = table.shape[1], 0, [], [], []
    for part, kind, words, many, own, pairs, data in _read(batches):
        if kind in (_OWN, _COPY):
            ids.append(np.frombuffer(own, np.int64))
            vectors.append(_vectors_of(data, size) @ turn)
        else:
            held.append((kind, _opened(words, many, own, pairs, data, np.float32)))
    if not held:
        return
    known, _ = _sorted_ids(np.concatenate([c.ids for _, c in held]))
    if turn is None:
        x = _signs(known, size, seed)
    else:
        x = np.zeros((len(known), size))
        for some, own in zip(ids, vectors):
            x[_place(known, some)] = own
    del ids, vectors
    y, gained = np.zeros((len(known), size)), np.zeros_like(table, np.float64)
    mine, links = _part_of(known, parts) == part, []
    while held:
        kind, chunk = held.pop()
        a, b = chunk.sides()
        by, place = chunk.values.astype(np.float64), _place(known, chunk.ids)
        if kind == _LISTED:
            _gain(gained, a, table, b, by)
            at = np.flatnonzero(a != b)
            at = at[np.argsort(b[at], kind="stable")]
            _gain(gained, b[at], table, a[at], by[at])
        elif kind == _TO_LISTED:
            a = place[a]
            _gain(y, a, table, b, by)
            at = np.argsort(b, kind="stable")
            _gain(gained, b[at], x, a[at], by[at])
        else:
            a, b = place[a], place[b]
            _gain(y, a, x, b, by)
            away = ~mine[b]
            links.append(np.unique(_coded(_part_of(known[b[away]], parts), a[away])))
    for begin in range(0, len(gained), _VECTORS):
        slab = gained[begin:begin + _VECTORS]
        if slab.any():
            yield _vector_row(begin // _VECTORS, _SLAB, np.empty(0, np.int64), slab)
    own = np.flatnonzero(mine)
    for begin in range(0, len(own), _VECTORS):
        some = own[begin:begin + _VECTORS]
        yield _vector_row(part, _OWN, known[some], y[some])
    # Where a word has a link to another part's, that part has one to it.
    if links and not last:
        links = _Chunk(known, np.unique(np.concatenate(links)), None)
        to, row = links.sides()
        for other, some in _groups(to):
            for begin in range(0, len(some), _VECTORS):
                at = row[some[begin:begin + _VECTORS]]
                yield _vector_row(other, _COPY, known[at], y[at])


def _slabs(vectors: DataFrame, listed: int, size: int) -> np.ndarray:
    """The vectors of the listed words: the sums of what each part gave them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part, data in _read(batches):
            sums[part] = sums.get(part, 0) + _vectors_of(data, size)
        for part, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "data"])

    found = vectors.filter(F.col("kind") == _SLAB).select("part", "data").repartition("part").mapInArrow(
        add, "part int, data binary").toArrow()
    table = np.zeros((listed, size))
    for part, data in zip(*(found.column(c).to_pylist() for c in ("part", "data"))):
        rows = np.frombuffer(data, np.float64).reshape(-1, size)
        table[part * _VECTORS:part * _VECTORS + len(rows)] = rows
    return table


def _gram(vectors: DataFrame, table: np.ndarray) -> np.ndarray:
    """Sums of products of the coordinates: a square the size of the dimensions."""
    size = table.shape[1]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for data, in _read(batches):
            y = _vectors_of(data, size)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["g"])

    cells = vectors.filter(F.col("kind") == _OWN).select("data").mapInArrow(products, "g array<double>").select(
        F.posexplode("g"))
    out = table.T @ table
    for row in cells.groupBy("pos").agg(F.sum("col").alias("g")).collect():
        out[divmod(row["pos"], size)] += row["g"]
    return out


def _given(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1])
    listed = pa.ListArray.from_arrays(offsets, pa.array(vectors.astype(np.float32).ravel()))
    return pa.RecordBatch.from_arrays([pa.array(ids), listed], names=["id", "vector"])


def factorise(
    matrix: DataFrame, dimensions: int = DIMENSIONS, rounds: int = 2, seed: int = 42
) -> DataFrame:
    """``id`` and ``vector``: the leading factors of a symmetric sparse matrix (``a``,
    ``b``, ``value``), each coordinate by the root of its singular value.

    Random signs are mixed by the rows, and the subspace they span is turned towards
    the leading one with every round. Words whose row is empty have no vector. Entries and
    vectors are kept as 32-bit floats, and added up as doubles.

    The most connected words, a bounded number, have their vectors sent to all tasks; the
    others are dealt out in parts. A part has the links of its words, and gives what the
    listed ones get from it in one table. Only of a link between the words of two
    parts a vector is sent to the other one, once for each part.
    """
    spark = matrix.sparkSession
    ship_package(spark)
    size = min(dimensions + _SPARE, 64)
    if not 1 <= dimensions <= size:
        raise ValueError("at most 64 dimensions")
    with shuffles_removed(spark):
        return _factorise(_half(matrix), dimensions, size, rounds, seed)


def _half(matrix: DataFrame) -> DataFrame:
    """Each entry of a symmetric matrix once."""
    return stage(_pack(matrix.filter("a <= b"), "value", np.float32), "factors-matrix")


def _factorise(entries: DataFrame, dimensions: int, size: int, rounds: int, seed: int) -> DataFrame:
    spark = entries.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, np.float32):
            a, b = chunk.sides()
            yield from _in_rows([chunk.ids, np.bincount(a, minlength=len(chunk.ids)) + np.bincount(
                b[a != b], minlength=len(chunk.ids))], ["id", "n"])

    degrees = stage(entries.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(
        F.sum("n").alias("degree")), "factors-degrees")
    words, links = degrees.agg(F.count("*"), F.sum("degree")).first()
    if not words:
        return spark.createDataFrame([], "id bigint, vector array<float>")
    most = degrees.orderBy(F.desc("degree"), "id").limit(min(_CONNECTED, max(_LEAST_CONNECTED, words // 8)))
    listed, _ = _sorted_ids(most.select("id").toArrow().column("id").to_numpy())
    parts = max(_LEAST_PARTS, math.ceil(links / 2 / _ENTRIES))
    known = spark.sparkContext.broadcast(listed)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _deal_entries(batches, known.value, parts)

    vectors, table, turn = None, _signs(listed, size, seed), None
    for step in range(rounds + 1):
        sent = entries.mapInArrow(deal, _CLOSED)
        if step:
            sent = sent.unionByName(vectors.filter(F.col("kind").isin(_OWN, _COPY)))
        held, last = spark.sparkContext.broadcast(table.astype(np.float32)), step == rounds

        def multiply(batches: Iterator[pa.RecordBatch], held=held, turn=turn, last=last) -> Iterator[pa.RecordBatch]:
            return _multiply_part(batches, held.value, parts, turn, seed, last)

        before, vectors = vectors, stage(
            sent.repartitionById(parts, "part").mapInArrow(multiply, _CLOSED), "factors", ["kind"])
        if before is not None:
            discard(before)
        held.unpersist()
        table = _slabs(vectors, len(listed), size)
        discard(vectors, f"/kind={_SLAB}")
        values, basis = np.linalg.eigh(_gram(vectors, table))
        if not last:
            kept = values > max(values.max(), 0) * 1e-12
            turn = basis * np.where(kept, 1 / np.sqrt(np.where(kept, values, 1)), 0)
            table = table @ turn
    order = np.argsort(-values)[:dimensions]
    # A vector times ``basis`` has length singular value by coordinate: keep its root.
    root = np.sqrt(np.sqrt(np.maximum(values[order], 0)))
    final = basis[:, order] * np.where(root > 0, 1 / np.where(root > 0, root, 1), 0)
    own = spark.sparkContext.broadcast((table @ final).astype(np.float32))

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data in _read(batches):
            yield _given(np.frombuffer(ids, np.int64), _vectors_of(data, size) @ final)

    def of_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for begin, in _read(batches):
            part = slice(begin, begin + _VECTORS)
            yield _given(known.value[part], own.value[part])

    schema = "id bigint, vector array<float>"
    return vectors.filter(F.col("kind") == _OWN).select("ids", "data").mapInArrow(turned, schema).unionByName(
        spark.range(0, len(listed), _VECTORS).mapInArrow(of_listed, schema))


def word_vectors(
    lists: DataFrame, dimensions: int = DIMENSIONS, window: int = WINDOW, min_count: int = 1,
    rounds: int = 2, seed: int = 42,
) -> DataFrame:
    """``word`` and ``vector`` of the words of token lists."""
    words = stage(word_ids(lists, min_count=min_count), "factors-words")
    pairs = pair_counts(lists, window)
    matrix = positive_information(pairs, words if min_count > 1 else None)
    vectors = factorise(matrix, dimensions, rounds, seed)
    discard(matrix)  # the counts behind it
    return vectors.join(words, "id").select("word", "vector")


def _beside(chunks: DataFrame, keys: Sequence[int]) -> DataFrame:
    """A row for each word beside a key term, with its value in the rows of all key terms."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, np.float64):
            a, b = chunk.sides()
            for i, key in enumerate(keys):
                place = int(_place(chunk.ids, np.array([key]))[0])
                if place == len(chunk.ids) or chunk.ids[place] != key:
                    continue
                one, other = a == place, (b == place) & (a != b)
                ids = chunk.ids[np.concatenate([b[one], a[other]])]
                yield from _in_rows(
                    [ids, np.full(len(ids), i, np.int32), np.concatenate([chunk.values[one], chunk.values[other]])],
                    ["id", "key", "value"])

    found = chunks.mapInArrow(find, "id bigint, key int, value double")
    return found.groupBy("id").agg(
        *[F.sum(F.when(F.col("key") == i, F.col("value"))).alias(f"_k{i}") for i in range(len(keys))])


def nearest_rows(matrix: DataFrame, words: DataFrame, terms: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` words whose rows of the symmetric matrix have the highest cosine with that of
    each key term: exact, for a few terms, without factors."""
    # The matrix is read twice, and what makes it is long. Half of it is kept: the other is the same.
    with shuffles_removed(matrix.sparkSession):
        matrix = stage(_pack(matrix.filter("a <= b"), "value", np.float64), "nearest-matrix")
        words = stage(words.select("id", "word"), "nearest-words")
    keys = words.filter(F.col("word").isin(list(terms))).orderBy("word").collect()
    if not keys:
        return words.limit(0).select(
            F.lit("").alias("palabra_clave"), F.col("word").alias("palabra_similar"), F.lit(0.0).alias("similitud"))
    ids, many = [k.id for k in keys], matrix.agg(F.sum("many")).first()[0] or 0

    def multiplied(chunk: _Chunk, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = chunk.sides()
        both, v, size = a != b, chunk.values, len(chunk.ids)
        squares = np.bincount(a, v * v, size) + np.bincount(b[both], (v * v)[both], size)
        columns = [pa.array(chunk.ids), pa.array(squares)]
        for row in table:
            there = ~np.isnan(row)
            row = np.where(there, row, 0)
            dot = np.bincount(a, v * row[b], size) + np.bincount(b[both], (v * row[a])[both], size)
            met = np.bincount(a, there[b], size) + np.bincount(b[both], there[a][both], size)
            columns.append(pa.array(dot, mask=met == 0))
        yield pa.RecordBatch.from_arrays(columns, names=["a", "_squares", *dots])

    dots = [f"_dot{i}" for i in range(len(keys))]
    schema = ", ".join(["a bigint", *[f"{c} double" for c in ["_squares", *dots]]])
    with shuffles_removed(matrix.sparkSession):
        found = _in_blocks(
            matrix, _beside(matrix, ids), _classes(many), np.float64, len(keys), multiplied, schema)
        sums = stage(found.groupBy("a").agg(
            F.sqrt(F.sum("_squares")).alias("_norm"), *[F.sum(c).alias(c) for c in dots]), "nearest-sums")
    norms = {r.a: r["_norm"] for r in sums.filter(F.col("a").isin(ids)).collect()}
    entries = F.array(*[
        F.struct(F.lit(k.word).alias("palabra_clave"), F.lit(k.id).alias("_key"), F.col(f"_dot{i}").alias("_dot"),
                 F.lit(norms[k.id]).alias("_key_norm"))
        for i, k in enumerate(keys) if k.id in norms])
    if not norms:
        return words.limit(0).select(
            F.lit("").alias("palabra_clave"), F.col("word").alias("palabra_similar"), F.lit(0.0).alias("similitud"))
    found = (
        sums.select("a", "_norm", F.inline(entries)).filter("_dot IS NOT NULL AND _key <> a")
        .join(words.select(F.col("id").alias("a"), F.col("word").alias("palabra_similar")), "a")
        .select("palabra_clave", "palabra_similar",
                (F.col("_dot") / (F.col("_norm") * F.col("_key_norm"))).alias("_cosine"))
    )
    similar = F.round("_cosine", 6)
    best = Window.partitionBy("palabra_clave").orderBy(similar.desc(), F.col("palabra_similar"))
    return found.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k).select(
        "palabra_clave", "palabra_similar", similar.alias("similitud"))
