"""Skip-gram with hierarchical softmax, trained in parts of the text that run at once.

The method and its settings are those of MLlib's ``Word2Vec``: windows of random width up
to five words in sentences of at most 1,000 words, a Huffman tree over the counts, a
learning rate that falls from 0.025, and parts that start alike and are merged after each
pass. What differs is where it runs:

- Words are numbered by a distributed sort, and a word's way through the tree follows from
  its number: codes of one length are consecutive, so a table with a row for each length is
  enough. Only the histogram of the counts comes to the driver.
- A part has at most some four million words. It holds the vectors of its own words and of
  the nodes on their ways, however large the whole vocabulary is.
- Vectors are merged and written by the executors, word by word. Between two passes the
  16,384 most frequent words and the 16,383 upper nodes go on from their merged vectors
  (6.5 MB); the changes of other words in all passes are merged at the end.
- Inside a part, a batch of words is trained at once, as products of small matrices, and of
  whole ones for the first levels of the tree.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.operators.ordered import shuffles_removed, stage, with_running_sums
from murmullo.session import ship_package

WINDOW = 5
SENTENCE = 1000
RATE = 0.025
# Beyond this the sigmoid counts as reached.
_FAR = 6.0
# Words of a part, of a piece of it, and those trained at once.
_PART_WORDS = 1 << 22
_PIECE_WORDS = 1 << 15
_BATCH = 4096
# Levels of the tree from the root down whose nodes are trained with all words of a batch.
_TOP = 7
# Steps of one vector in a batch from which they are summed on their own.
_MANY = 16
# Parts that are told by the bits of one number.
_BITS = 62
# Ends a sentence in a piece, whose words have smaller codes.
_END = (1 << 16) - 1
# What is merged between passes: words by number, nodes by place in the tree.
_WORDS = 1 << 14
_NODES = 1 << 14


class Codes(NamedTuple):
    """Of each code length that occurs: the first number, its code, and the length."""

    first: np.ndarray
    code: np.ndarray
    length: np.ndarray

    def leaves(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes with a leading one, so that a shift gives the nodes above, and lengths."""
        at = np.searchsorted(self.first, numbers, "right") - 1
        length = self.length[at]
        return (np.int64(1) << length) + self.code[at] + numbers - self.first[at], length


def code_lengths(histogram: Mapping[int, int]) -> list[tuple[int, int]]:
    """Huffman code lengths, shortest first, and how many words have each, from the number
    of words with each count. Equal weights are paired all at once, so the work grows with
    the different counts and not with the words."""
    # A node is (weight, how many, what one of them holds); at most a few kinds per weight.
    heap = [(n, i, many, None) for i, (n, many) in enumerate(sorted(histogram.items()))]
    tick = len(heap)
    heapq.heapify(heap)
    while heap:
        weight, name, many, below = heapq.heappop(heap)
        if not heap and many == 1:
            break
        if many > 1:
            heapq.heappush(heap, (2 * weight, tick, many // 2, ((weight, name, below),) * 2))
            tick += 1
            if many % 2:
                heapq.heappush(heap, (weight, name, 1, below))
            continue
        other, its, more, under = heapq.heappop(heap)
        heapq.heappush(heap, (weight + other, tick, 1, ((weight, name, below), (other, its, under))))
        tick += 1
        if more > 1:
            heapq.heappush(heap, (other, its, more - 1, under))
    found: dict[int, int] = {}
    # Kinds of nodes and how many of each lie at a depth, from the root down.
    level, depth = {name: (1, below)}, 0
    while level:
        deeper: dict[int, tuple[int, tuple | None]] = {}
        for here, kind in level.values():
            if kind is None:
                found[depth] = found.get(depth, 0) + here
            else:
                for _, child, under in kind:
                    deeper[child] = (deeper.get(child, (0,))[0] + here, under)
        level, depth = deeper, depth + 1
    return sorted(found.items())


def canonical(lengths: list[tuple[int, int]]) -> Codes:
    first, code, before, number, last = [], [], 0, 0, 0
    for length, many in lengths:
        number <<= length - last
        first.append(before)
        code.append(number)
        before, number, last = before + many, number + many, length
    return Codes(*(np.array(x, np.int64) for x in (first, code, [n for n, _ in lengths])))


def start_vectors(numbers: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Uniform between -0.5 and 0.5 over ``size``, from the word's number alone."""
    at = numbers.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(1, size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        z = (at + np.uint64(seed % (1 << 32) << 31)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(size)


def _any_far(f: np.ndarray) -> bool:
    return not (f.max() < _FAR and f.min() > -_FAR)


def _sigmoid(f: np.ndarray) -> np.ndarray:
    """In place: most of a batch's time would go into new arrays."""
    np.exp(np.negative(f, out=f), out=f)
    f += 1
    return np.reciprocal(f, out=f)


def _short(h: np.ndarray) -> np.ndarray:
    """A sum of many steps from one place would go too far; by its curvature ``h`` it is
    shortened to (1 - exp(-h)) / h, where small steps one after the other would end."""
    return np.where(h > 1e-3, -np.expm1(-h) / np.maximum(h, 1e-3), 1).astype(np.float32)


def _apply(vectors: np.ndarray, rows: np.ndarray, steps: np.ndarray, bend: np.ndarray) -> None:
    """Add the steps of each row of ``vectors``, shortened."""
    order = np.argsort(rows)
    ranked = rows[order]
    begin = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    many = np.diff(np.append(begin, len(rows)))
    short = _short(np.add.reduceat(bend[order], begin))
    # Rows with the most steps first: these one by one, the others step by step.
    by = np.argsort(-many)
    begin, many = begin[by], many[by]
    total = steps.take(order[begin], axis=0)
    few = int(np.searchsorted(-many, -_MANY))
    one = np.ones(many[0], np.float32)
    for i in range(few):
        total[i] = one[:many[i]] @ steps.take(order[begin[i]:begin[i] + many[i]], axis=0)
    for k in range(1, _MANY):
        end = int(np.searchsorted(-many, -k))
        if end <= few:
            break
        total[few:end] += steps.take(order[begin[few:end] + k], axis=0)
    total *= short[by, None]
    vectors[ranked[begin]] += total


def _top_of(
    ways: np.ndarray, signs: np.ndarray, lengths: np.ndarray, last: int
) -> tuple[np.ndarray, np.ndarray]:
    """The turns of each word in the first levels, as a number (shorter ways go on to the left),
    and the rows of the nodes there by their place in the tree."""
    levels = min(_TOP, ways.shape[1])
    turns, rows = np.zeros(len(ways), np.int64), np.full(1 << levels, last, np.int64)
    for d in range(levels):
        on = lengths > d
        rows[(1 << d) + turns[on]] = ways[on, d]
        turns = 2 * turns + (on & ~signs[:, d])
    return turns, rows


def _train_top(
    near: np.ndarray, x: np.ndarray, syn1: np.ndarray, rows: np.ndarray, rate: np.float32
) -> tuple[np.ndarray, np.ndarray]:
    """A batch of the first levels; steps and bends of the vectors ``x``.

    Most words of a batch meet most of these few nodes, so whole matrices take less than
    pairs. ``near`` has how often each word (column) is near a word with the same turns (row).
    """
    left = np.zeros((len(rows), len(x)), np.float32)
    both, below, first = np.zeros_like(left), near.astype(np.float32) * rate, len(rows)
    while first > 1:
        level = slice(first // 2, first)
        left[level] = below[0::2]
        np.add(below[0::2], below[1::2], out=both[level])
        below, first = both[level], first // 2
    last = len(syn1) - 1
    left[rows == last] = both[rows == last] = 0  # a way has ended above
    s = syn1.take(rows, axis=0)
    f = s @ x.T
    if _any_far(f):
        far = ~(np.abs(f) < _FAR)
        left[far] = both[far] = 0
    p = _sigmoid(f)
    both *= p
    left -= both
    both *= np.subtract(1, p, out=p)
    real = np.flatnonzero(rows != last)
    steps = (left @ x) * _short(both @ np.einsum("ij,ij->i", x, x))[:, None]
    syn1[rows[real]] += steps[real]
    return left.T @ s, np.einsum("ij,ij->i", s, s) @ both


def train(
    words: np.ndarray, sentence: np.ndarray, ways: np.ndarray, signs: np.ndarray, lengths: np.ndarray,
    syn0: np.ndarray, syn1: np.ndarray, rates: tuple[float, float], random: np.random.Generator,
) -> None:
    """One pass over ``words`` (with the number of its sentence for each), in place.

    ``ways`` has the nodes above each word and ``signs`` 1 for each left turn; both are
    padded, with the last row of ``syn1``, which stays zero, as the node.
    """
    size, last = syn0.shape[1], len(syn1) - 1
    turns, top = _top_of(ways, signs, lengths, last)
    levels = min(_TOP, ways.shape[1])
    room = np.empty((_BATCH * (ways.shape[1] - levels), size), np.float32)
    # Nothing is near across the margins.
    padded = np.pad(words, WINDOW)
    inside = np.pad(sentence, WINDOW, constant_values=-1)
    window = np.abs(np.arange(-WINDOW, WINDOW + 1))
    for begin in range(0, len(words), _BATCH):
        end = min(begin + _BATCH, len(words))
        rate = np.float32(rates[0] + (rates[1] - rates[0]) * begin / len(words))
        text, own = padded[begin:end + 2 * WINDOW], inside[begin:end + 2 * WINDOW]
        reach = random.integers(1, WINDOW + 1, end - begin)
        there = (sliding_window_view(own, len(window)) == own[WINDOW:WINDOW + end - begin, None]) & (
            window <= reach[:, None]) & (window > 0)
        known, at = np.unique(text, return_inverse=True)
        vectors = syn0.take(known, axis=0)
        around = vectors.take(at, axis=0)
        around_2 = np.einsum("ij,ij->i", around, around)
        moved, bent = np.zeros_like(around), np.zeros(len(around), np.float32)
        cells = (turns[words[begin:end], None] * len(known) + sliding_window_view(at, len(window)))[there]
        near = np.bincount(cells, minlength=len(top) * len(known)).reshape(len(top), len(known))
        steps, firm = _train_top(near, vectors, syn1, top, rate)
        long = lengths[words[begin:end]]
        nodes, bends, filled = [], [], 0
        for wide in range(1, WINDOW + 1):
            group = np.flatnonzero((reach == wide) & (long > levels))
            group = group[np.argsort(long[group])]
            offsets = np.r_[-wide:0, 1:wide + 1] + WINDOW
            for some in np.array_split(group, max(1, min(4, len(group) // 32))):
                if not len(some):
                    continue
                near, center = some[:, None] + offsets, words[begin + some]
                way = ways[center, levels:int(long[some[-1]])]
                x, s = around.take(near, axis=0), syn1.take(way, axis=0)
                f = x @ s.transpose(0, 2, 1)
                # A padding node is zero, so nothing follows from it.
                used = there[some[:, None], offsets][:, :, None] * rate
                if _any_far(f):
                    used = used * (np.abs(f) < _FAR)
                p = _sigmoid(f)
                c = 1 - p
                c *= p
                c *= used
                g = np.subtract(signs[center, levels:levels + way.shape[1]][:, None, :], p, out=p)
                g *= used
                full = filled + way.size
                np.matmul(g.transpose(0, 2, 1), x, out=room[filled:full].reshape(*way.shape, size))
                filled = full
                nodes.append(way.ravel())
                bends.append((around_2.take(near)[:, None, :] @ c).ravel())
                back, bend = g @ s, (c @ np.einsum("ijk,ijk->ij", s, s)[:, :, None])[:, :, 0]
                for k in range(len(offsets)):
                    moved[near[:, k]] += back[:, k]
                    bent[near[:, k]] += bend[:, k]
        if nodes:
            _apply(syn1, np.concatenate(nodes), room[:filled], np.concatenate(bends))
            syn1[last] = 0
        _apply(syn0, np.r_[text, known], np.r_[moved, steps], np.r_[bent, firm])


class _Pass(NamedTuple):
    """What all parts of a pass start from."""

    words: np.ndarray
    nodes: np.ndarray
    codes: Codes
    seed: int
    rates: tuple[float, float]
    last: bool


_PIECES = "words array<string>, counts array<int>, codes binary"
# What a part is sent: pieces, and (key -1) words with their numbers in place of the text.
_SENT = "part int, key bigint, names binary, sizes binary, codes binary"
_CHANGES = "key bigint, part int, change binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sentences in pieces: the different words of a piece, their counts, and the text as
    places among them."""
    for batch in batches:
        listed = batch.column("tokens")
        ends = np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False))
        tokens, begin = listed.flatten(), 0
        while begin < len(ends):
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + _PIECE_WORDS, "right")))
            coded = tokens.slice(before, int(ends[end - 1]) - before).dictionary_encode()
            codes = coded.indices.fill_null(_END).to_numpy(zero_copy_only=False).astype(np.uint16)
            counts = np.bincount(codes, minlength=_END + 1)[:len(coded.dictionary)].astype(np.int32)
            closed = np.insert(codes, ends[begin:end] - before, np.uint16(_END))
            if coded.null_count:  # a null is no word and ends no sentence
                null = np.insert(coded.indices.is_null().to_numpy(zero_copy_only=False), ends[begin:end] - before, False)
                closed = closed[~null]
            one = pa.array([0, len(coded.dictionary)], pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(one, coded.dictionary), pa.ListArray.from_arrays(one, pa.array(counts)),
                pa.array([closed.tobytes()], pa.binary()),
            ], ["words", "counts", "codes"])
            begin = end


def _closed(words: pa.Array) -> tuple[bytes, bytes]:
    """Words one after the other, and the bytes of each: a fraction of what a row with a list takes."""
    own = words.cast(pa.string()).take(pa.array(np.arange(len(words))))
    _, offsets, data = own.buffers()
    sizes = np.diff(np.frombuffer(offsets, np.int32, len(own) + 1))
    return data.to_pybytes()[:sizes.sum()] if data else b"", sizes.tobytes()


def _opened(names: bytes, sizes: bytes) -> pa.Array:
    offsets = np.append(0, np.cumsum(np.frombuffer(sizes, np.int32))).astype(np.int32)
    return pa.Array.from_buffers(
        pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(names)])


def _sent(rows: list[tuple[int, int, pa.Array, bytes]]) -> pa.RecordBatch:
    closed = [(part, key, *_closed(words), codes) for part, key, words, codes in rows]
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*closed), kinds)],
        ["part", "key", "names", "sizes", "codes"])


def _send_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, key, words, codes in zip(*(batch.column(c) for c in ("part", "key", "words", "codes"))):
            yield _sent([(part.as_py(), key.as_py(), words.values, codes.as_py())])


def _send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their numbers, a row for each part that has some of a batch."""
    for batch in batches:
        if not len(batch):
            continue
        numbers = batch.column("number").to_numpy(zero_copy_only=False)
        masks = batch.column("parts").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        for at in range(masks.shape[1]):
            for bit in range(_BITS):
                some = np.flatnonzero(masks[:, at] >> bit & 1)
                if len(some):
                    words = batch.column("word").take(pa.array(some))
                    yield _sent([(at * _BITS + bit, -1, words, numbers[some].tobytes())])


def _packed(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of numbers."""
    wide = rows.shape[1] * rows.itemsize
    data = pa.py_buffer(np.ascontiguousarray(rows))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(wide), len(rows), [None, data]).cast(pa.binary())


def _unpacked(column: pa.Array, kind: type, size: int) -> np.ndarray:
    """The rows of numbers in a column of binary values of one length, without nulls."""
    if not len(column):
        return np.empty((0, size), kind)
    fixed = column.cast(pa.binary(size * np.dtype(kind).itemsize))
    wide = fixed.type.byte_width
    held = np.frombuffer(fixed.buffers()[1], np.uint8)[fixed.offset * wide:(fixed.offset + len(fixed)) * wide]
    return held.view(kind).reshape(-1, size)


def ways_of(numbers: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For words by number: the rows of the nodes above each, 1 for each left turn, the
    code lengths, and the places of the nodes in the tree. The row after the last pads."""
    leaves, lengths = codes.leaves(numbers)
    deep = max(1, int(lengths.max()))
    ways = np.full((len(numbers), deep), -1, np.int32)
    signs = np.zeros((len(numbers), deep), np.bool_)
    places, known = [], 0
    for d in range(deep):
        # Longer codes come last, and those of one depth in their order: equal nodes are neighbours.
        some = np.flatnonzero(lengths > d)
        if not len(some):
            break
        place = leaves[some] >> (lengths[some] - d)
        new = np.r_[True, place[1:] != place[:-1]]
        ways[some, d] = known + np.cumsum(new) - 1
        signs[some, d] = (leaves[some] >> (lengths[some] - d - 1)) & 1 == 0
        places.append(place[new])
        known += len(places[-1])
    ways[ways < 0] = known
    return ways, signs, lengths, np.concatenate(places) if places else np.empty(0, np.int64)


def _train_part(batches: Iterator[pa.RecordBatch], start: _Pass) -> Iterator[pa.RecordBatch]:
    """Changes of the words (by number) and upper nodes (by minus their place) of a part,
    from its pieces and from its words with their numbers."""
    size = start.words.shape[1]
    names, numbers, texts, part = [], [], [], 0
    for batch in batches:
        for part, key, named, sizes, codes in zip(*(c.to_pylist() for c in batch.columns)):
            words = _opened(named, sizes)
            if key < 0:
                names.append(words)
                numbers.append(np.frombuffer(codes, np.int64))
            else:
                texts.append((key, words, np.frombuffer(codes, np.uint16)))
    if not texts or not sum(map(len, numbers)):
        return
    names, numbers = pa.chunked_array(names), np.concatenate(numbers)
    order = np.argsort(numbers)
    names, numbers = names.take(pa.array(order)), numbers[order]
    texts.sort(key=lambda t: t[0])  # the order in which they arrived does not matter
    found = pc.index_in(pa.chunked_array([t[1] for t in texts]), value_set=names).fill_null(-1)
    found, at, words = found.to_numpy().astype(np.int32), 0, []
    del names
    for _, own, codes in texts:
        places = np.full(_END + 1, -1, np.int32)
        places[:len(own)] = found[at:at + len(own)]
        places[_END] = -2
        words.append(places[codes])
        at += len(own)
    words, texts = np.concatenate(words), None
    sentence = np.cumsum(words == -2, dtype=np.int32)
    known = words >= 0  # others occur too seldom
    words, sentence = words[known], sentence[known]

    ways, signs, lengths, nodes = ways_of(numbers, start.codes)
    frequent, upper = numbers < len(start.words), nodes < len(start.nodes)

    def first(some: slice) -> np.ndarray:
        vectors = start_vectors(numbers[some], size, start.seed)
        vectors[frequent[some]] = start.words[numbers[some][frequent[some]]]
        return vectors

    def changes(keys: np.ndarray, change: np.ndarray) -> Iterator[pa.RecordBatch]:
        touched = change.any(axis=1)
        keys = keys[touched]
        yield pa.RecordBatch.from_arrays([
            pa.array(keys), pa.array(np.full(len(keys), part, np.int32)),
            _packed(change[touched].astype(np.float16)),
        ], ["key", "part", "change"])

    blocks = [slice(at, at + (1 << 14)) for at in range(0, len(numbers), 1 << 14)]
    syn0 = np.concatenate([first(some) for some in blocks])
    syn1 = np.zeros((len(nodes) + 1, size), np.float32)
    syn1[:-1][upper] = start.nodes[nodes[upper]]
    random = np.random.default_rng([start.seed % (1 << 32), part])
    train(words, sentence, ways, signs, lengths, syn0, syn1, start.rates, random)
    for some in blocks:
        yield from changes(numbers[some], syn0[some] - first(some))
    if not start.last:  # nothing starts from the nodes of the last pass
        yield from changes(-nodes[upper], syn1[:-1][upper] - start.nodes[nodes[upper]])


def _merged(key: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One change for each key, whose rows are neighbours.

    Changes from one start are added up where they differ in direction, and averaged where
    they agree and the sum would go too far: the sum is multiplied by the sum of their squared
    lengths over its own. It is never shorter than their mean nor longer than their sum.
    """
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    total = np.add.reduceat(change, begin, axis=0)
    squares = np.add.reduceat(np.einsum("ij,ij->i", change, change), begin)
    own = np.einsum("ij,ij->i", total, total)
    total *= np.minimum(1, squares / np.maximum(own, np.float32(1e-30)))[:, None]
    return key[begin], total


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, in batches that keep the rows of a key together."""
    kept = None
    for batch in batches:
        if not len(batch):
            continue
        table = batch if kept is None else pa.concat_batches([kept, batch])
        keys = table.column("key").to_numpy(zero_copy_only=False)
        whole = int(np.searchsorted(keys, keys[-1]))
        kept = table.slice(whole)
        if whole:
            yield table.slice(0, whole)
    if kept is not None:
        yield kept


def _merge(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in _by_key(batches):
        change = _unpacked(batch.column("change"), np.float16, size).astype(np.float32)
        key, total = _merged(batch.column("key").to_numpy(zero_copy_only=False), change)
        yield pa.RecordBatch.from_arrays([pa.array(key), _packed(total)], ["key", "change"])


def _vectors(batches: Iterator[pa.RecordBatch], start: _Pass) -> Iterator[pa.RecordBatch]:
    """The vector of each word: its start and its changes, which follow the row of the word."""
    size = start.words.shape[1]
    for batch in _by_key(batches):
        key, change = batch.column("key").to_numpy(zero_copy_only=False), batch.column("change")
        named = change.is_null()
        rows = named.to_numpy(zero_copy_only=False)
        numbers = key[rows]
        vectors = start_vectors(numbers, size, start.seed)
        frequent = numbers < len(start.words)
        vectors[frequent] = start.words[numbers[frequent]]
        if not rows.all():
            some, total = _merged(key[~rows], _unpacked(change.drop_null(), np.float16, size).astype(np.float32))
            vectors[np.searchsorted(numbers, some)] += total
        offsets = pa.array(np.arange(0, vectors.size + 1, size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([
            batch.column("word").filter(named), pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))],
            ["word", "vector"])


def cut(lists: DataFrame) -> DataFrame:
    """The texts in pieces of some 32,768 words, numbered by ``key``. Each is read once, here."""
    last = F.floor((F.size("tokens") - 1) / SENTENCE).cast("int")
    sentences = lists.filter(F.size("tokens") > 0).select(
        "tokens", F.explode(F.sequence(F.lit(0), last)).alias("at")
    ).select(F.slice("tokens", F.col("at") * SENTENCE + 1, SENTENCE).alias("tokens"))
    pieces = sentences.mapInArrow(_pieces, _PIECES)
    return stage(pieces.withColumn("key", F.monotonically_increasing_id()), "skipgram-pieces")


def vocabulary(pieces: DataFrame, min_count: int, parts: int) -> DataFrame:
    """``word``, ``n``, ``number``, from 0 by falling count, and the ``parts`` that have the
    word, as bits of one number or more: these are merged in place, a set is sorted for."""
    held = pieces.select(_part(parts), "counts", F.posexplode("words").alias("at", "word")).select(
        "word", F.get("counts", F.col("at")).alias("n"),
        *[F.expr(f"if(part div {_BITS} = {i}, shiftleft(1L, part % {_BITS}), 0L)").alias(f"_{i}")
          for i in range(math.ceil(parts / _BITS))])
    masks = [c for c in held.columns if c.startswith("_")]
    counted = (
        held.groupBy("word").agg(F.sum("n").alias("n"), *[F.bit_or(c).alias(c) for c in masks])
        .filter(F.col("n") >= min_count)
        .select("word", "n", F.array(*masks).alias("parts"), F.lit(1).alias("one"))
    )
    numbered = with_running_sums(counted, [F.desc("n"), F.asc("word")], {"number": "one"}, "skipgram-words")
    return stage(numbered.select("word", "n", (F.col("number") - 1).alias("number"), "parts"), "skipgram-vocabulary")


def _part(parts: int) -> Column:
    """Pieces of a task are dealt out one by one."""
    return F.pmod("key", F.lit(parts)).cast("int").alias("part")


def fit_skipgram(
    lists: DataFrame, vector_size: int = 50, min_count: int = 1, seed: int = 42,
    max_iter: int = 1, num_partitions: int = 2,
) -> DataFrame:
    """Train on ``tokens``; ``word`` and ``vector`` of all words, as a table of files.

    The texts are trained in ``num_partitions`` parts, and in more where these would be
    larger than 4,194,304 words.
    """
    ship_package(lists.sparkSession)
    with shuffles_removed(lists.sparkSession):
        return _fit(lists, vector_size, min_count, seed, max_iter, num_partitions)


def _fit(
    lists: DataFrame, vector_size: int, min_count: int, seed: int, max_iter: int, num_partitions: int
) -> DataFrame:
    pieces = cut(lists)
    total = pieces.agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda n, x: n + x))).first()[0] or 0
    parts = max(num_partitions, math.ceil(total / _PART_WORDS))
    words = vocabulary(pieces, min_count, parts)
    histogram = {r["n"]: r["many"] for r in words.groupBy("n").agg(F.count("*").alias("many")).collect()}
    if not histogram:
        raise ValueError(f"no word occurs {min_count} times or more; lower min_count")
    codes = canonical(code_lengths(histogram))
    rows = pieces.select(_part(parts), "key", "words", "codes").mapInArrow(_send_pieces, _SENT).unionByName(
        words.select("word", "number", "parts").mapInArrow(_send_words, _SENT)).repartitionById(parts, "part")

    start = _Pass(
        start_vectors(np.arange(min(_WORDS, sum(histogram.values()))), vector_size, seed),
        np.zeros((_NODES, vector_size), np.float32), codes, seed, (RATE, RATE), False)
    found = []
    for step in range(max_iter):
        rates = tuple(RATE * max(1e-4, 1 - at / max_iter) for at in (step, step + 1))
        start = start._replace(rates=rates, last=step == max_iter - 1)
        # Parts of all passes are told apart, so that merging has one order.
        changes = rows.mapInArrow(lambda batches, start=start: _train_part(batches, start), _CHANGES).withColumn(
            "part", F.col("part") + F.lit(step * parts))
        if start.last:
            found.append(changes)
            break
        changes = stage(changes, "skipgram-changes")
        found.append(changes.filter(F.col("key") >= len(start.words)))
        common = _sorted(changes.filter(F.col("key") < len(start.words))).mapInArrow(
            lambda batches: _merge(batches, vector_size), "key bigint, change binary").toArrow()
        frequent, nodes = start.words.copy(), start.nodes.copy()
        for r in common.to_batches():
            key, change = r.column("key").to_numpy(), _unpacked(r.column("change"), np.float32, vector_size)
            frequent[key[key >= 0]] += change[key >= 0]
            nodes[-key[key < 0]] += change[key < 0]
        start = start._replace(words=frequent, nodes=nodes)
    everything = words.select(
        F.col("number").alias("key"), F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("change"), "word")
    for changes in found:
        everything = everything.unionByName(changes, allowMissingColumns=True)
    return stage(_sorted(everything).mapInArrow(
        lambda batches: _vectors(batches, start), "word string, vector array<float>"), "skipgram-vectors")


def _sorted(changes: DataFrame) -> DataFrame:
    return changes.repartition("key").sortWithinPartitions("key", "part")
