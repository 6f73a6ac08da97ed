"""SimHash near-duplicates by deletion variants of two segments.

Fingerprint: 64 bits; a bit is set where more than half of a document's shingle
hashes have it set. Two fingerprints within three bits differ in at most one bit
of one of their two halves. So every distinct fingerprint is indexed under both
halves, each as it is and with each of its 32 bits in turn replaced by a
wildcard: 66 keys. Fingerprints that meet under a key are compared in full.

A key is shared by fingerprints that agree in 31 bits. Where more than ``most``
of them meet (a dense cluster), they are cut once more by the same rule, in
the other half; what meets there agrees in 46 bits, so at most 2^18 can, whatever
the number of documents. Within a key only a spanning forest of the links is
kept, which loses no component, and copies of a text are one fingerprint from
the start.

A null or empty text, or one without words, has fingerprint 0 and is linked like any
other. Rows may repeat; a null ``doc_id`` has a fingerprint and a component, and
is never the smallest id unless there is no other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmullo.llm.common import row_struct, sliced, stage
from murmullo.llm.components import components
from murmullo.session import ship_package

SHINGLE = 3
SEED = 42
DISTANCE = 3
MOST = 2048
# Hashes that are summed at a time: 64 bytes of bits each.
_BLOCK = 1 << 15

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_EXACT = 32


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text in UTF-8, as an unsigned number."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    last = ends[k - 1:].tolist()
    first = starts[:len(last)].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(last), _BLOCK):
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(first[i:i + _BLOCK], last[i:i + _BLOCK])],
            dtype=">u8",
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(total * 2 > len(last))
    return int.from_bytes(bits.tobytes(), "big")


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in sliced(whole, 1):
            prints = np.fromiter(
                (fingerprint((t.as_buffer() or b"") and t.as_buffer().to_pybytes())
                 if t.is_valid else 0 for t in batch.column(1)),
                dtype=np.uint64, count=batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["_row", "_print"]
            )


def _keys(prints: np.ndarray) -> np.ndarray:
    """The 66 keys of each fingerprint: half, wildcard place, half without it."""
    out = np.empty((len(prints), 66), np.int64)
    for half in (0, 1):
        value = (prints >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        for place in range(33):
            rest = value if place == _EXACT else value & ~np.uint64(1 << place)
            tag = np.uint64((half << 38) | (place << 32))
            out[:, half * 33 + place] = (rest | tag).view(np.int64)
    return out


def _finer_keys(keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The 34 keys of each fingerprint of a crowded key, cut in the other half."""
    half = (keys.view(np.uint64) >> np.uint64(38)) & np.uint64(1)
    other = (prints >> (np.uint64(32) * (np.uint64(1) - half))) & np.uint64(0xFFFFFFFF)
    out = np.empty((len(prints), 34, 2), np.int64)
    out[:, :, 0] = keys[:, None]
    for part in (0, 1):
        value = (other >> np.uint64(16 * part)) & np.uint64(0xFFFF)
        for place in range(17):
            rest = value if place == 16 else value & ~np.uint64(1 << place)
            tag = np.uint64((part << 24) | (place << 16))
            out[:, part * 17 + place, 1] = (rest | tag).view(np.int64)
    return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i in range(0, len(all_prints), 4096):
            prints = all_prints[i:i + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_keys(prints.view(np.uint64)).ravel()),
                 pa.array(np.repeat(prints, 66))],
                names=["_key", "_print"],
            )


def _index_finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        all_prints = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for i in range(0, len(all_keys), 4096):
            keys, prints = all_keys[i:i + 4096], all_prints[i:i + 4096]
            found = _finer_keys(keys, prints.view(np.uint64)).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(np.repeat(prints, 34))],
                names=["_key", "_sub", "_print"],
            )


def _forest(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Each linked fingerprint with the first of its component in this group."""
    n = len(prints)
    label = np.arange(n)
    block = max(1, (1 << 19) // n)
    while True:
        new = label.copy()
        for i in range(0, n, block):
            apart = np.bitwise_count(prints[i:i + block, None] ^ prints[None, :])
            new[i:i + block] = np.where(apart <= distance, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(n)
    return prints[own], prints[label[own]]


def _linker(distance: int, most: int | None, wide: int):
    """Links within runs of equal keys; rows come sorted by the ``wide`` key columns.

    Output ``kind, a, b``: 0 is a link; 1 is a key with a fingerprint, for a run
    of more than ``most``.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(kind, a, b):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)],
                names=["kind", "a", "b"],
            )

        def linked(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            """All runs in ``rows`` are whole."""
            if not len(rows):
                return
            change = np.any(rows[1:, :wide] != rows[:-1, :wide], axis=1)
            starts = np.concatenate(([0], np.flatnonzero(change) + 1))
            sizes = np.diff(np.append(starts, len(rows)))
            prints = np.ascontiguousarray(rows[:, wide]).view(np.uint64)
            pair = starts[sizes == 2]
            x, y = prints[pair], prints[pair + 1]
            near = np.bitwise_count(x ^ y) <= distance
            left, right = [x[near]], [y[near]]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if most is not None and size > most:
                    part = rows[start:start + size]
                    yield given(1, part[:, 0].copy(), part[:, wide].copy())
                    continue
                a, b = _forest(prints[start:start + size], distance)
                left.append(a)
                right.append(b)
            a, b = np.concatenate(left), np.concatenate(right)
            if len(a):
                both = np.unique(np.stack([a, b], axis=1), axis=0)
                yield given(0, both[:, 0].copy().view(np.int64), both[:, 1].copy().view(np.int64))

        kept, crowded = None, None
        for batch in batches:
            rows = np.stack([
                batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                for i in range(wide + 1)
            ], axis=1)
            if crowded is not None:
                # More of a run that was passed on already.
                same = np.all(rows[:, :wide] == crowded, axis=1)
                if same.any():
                    yield given(1, rows[same, 0].copy(), rows[same, wide].copy())
                    rows = rows[~same]
                    if not len(rows):
                        continue
                crowded = None
            if kept is not None and len(kept):
                rows = np.concatenate([kept, rows])
            if not len(rows):
                continue
            open_run = np.all(rows[:, :wide] == rows[-1, :wide], axis=1)
            first = int(np.argmax(open_run))
            yield from linked(rows[:first])
            kept = rows[first:]
            if most is not None and len(kept) > most:
                crowded = kept[0, :wide].copy()
                yield given(1, kept[:, 0].copy(), kept[:, wide].copy())
                kept = None
        if kept is not None:
            yield from linked(kept)

    return link


def links(prints: DataFrame, distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """A spanning forest of the links between distinct fingerprints (``_print``)."""
    keyed = prints.select("_print").mapInArrow(_index, "_key bigint, _print bigint")
    shape = "kind int, a bigint, b bigint"
    met = stage(
        keyed.repartition("_key").sortWithinPartitions("_key", "_print")
        .mapInArrow(_linker(distance, most, 1), shape),
        "simhash-links",
    )
    finer = (
        met.filter("kind = 1").select("a", "b")
        .mapInArrow(_index_finer, "_key bigint, _sub bigint, _print bigint")
        .repartition("_key", "_sub").sortWithinPartitions("_key", "_sub", "_print")
        .mapInArrow(_linker(distance, None, 2), shape)
    )
    return met.filter("kind = 0").unionByName(finer).select("a", "b")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``_row`` (whatever struct column it has) with ``_print``, a signed 64-bit number."""
    shape = f"_row {docs.schema['_row'].dataType.simpleString()}, _print bigint"
    ship_package(docs.sparkSession)
    return docs.select("_row", "text").mapInArrow(_print_batches, shape)


def grouped(docs: DataFrame, distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """``doc_id, _hash, _print, _root, component_id`` for every row; ``_root`` is its component."""
    rows = stage(
        fingerprints(docs.select(
            F.struct("doc_id", F.xxhash64("text").alias("_hash")).alias("_row"), "text"
        )).select("_row.*", "_print"),
        "simhash-prints",
    )
    classes = stage(
        rows.groupBy("_print").agg(F.min("doc_id").alias("_first")), "simhash-classes"
    )
    roots = components(links(classes, distance, most))
    rooted = classes.join(roots, classes["_print"] == roots["node"], "left").select(
        "_print", "_first", F.coalesce("root", "_print").alias("_root")
    )
    rooted = stage(rooted, "simhash-roots")
    smallest = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    known = stage(
        rooted.join(smallest, "_root").select(F.col("_print").alias("_p"), "_root", "component_id"),
        "simhash-known",
    )
    return rows.join(known, rows["_print"] == known["_p"]).select(
        "doc_id", "_hash", "_print", "_root", "component_id"
    )


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """Per row: ``doc_id``, the fingerprint in hexadecimal, its component."""
    return grouped(docs, **how).select(
        "doc_id", F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """One row of every component, the one with the smallest ``doc_id``, null last.

    Among rows that share this id the smallest text hash stays, and one of rows
    that are equal in both.
    """
    place = F.struct(
        F.col("doc_id").isNull().alias("_no_id"), F.coalesce("doc_id", F.lit(0)).alias("_id"), "_hash"
    )
    kept = grouped(docs, **how).groupBy("_root").agg(F.min(place).alias("_kept")).select("_kept.*")
    rows = docs.select(
        row_struct(docs).alias("_doc"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
        F.col("doc_id").isNull().alias("_no_id"), F.xxhash64("text").alias("_hash"),
    )
    same = Window.partitionBy("_id", "_no_id", "_hash").orderBy("_hash")
    return (
        rows.join(kept, ["_id", "_no_id", "_hash"])
        .withColumn("_nth", F.row_number().over(same)).filter("_nth = 1").select("_doc.*")
    )
