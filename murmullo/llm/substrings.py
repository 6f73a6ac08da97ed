"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; it depends on the last 16 bytes only.
A chunk ends where the hash is higher than at the ``REACH`` bytes before and not
lower than at as many after. So a cut depends on its surroundings alone: after
an insertion the cuts fall in the same places of the content again. Chunks have
more than ``REACH`` bytes (but for the ends of a text), about 49 on average, and
are compared by a 128-bit digest. Where no cut comes, as in the same word over
and over, a chunk ends after ``LONGEST`` bytes.

A chunk is a repeat where a document that comes before has it too. Chunks
are counted with partial aggregates, so a chunk that is in a third of all
documents sends one row per task. Only digests found in several documents
are joined back. A span is a run of repeated chunks without a gap; spans of
fewer than ``SPAN`` bytes stay, as short phrases repeat by chance. The ends of a
passage lie in chunks with other text, so a span is some 60 to 110 bytes
shorter than what two documents share.

Null and empty texts have no chunks. A document is a ``doc_id`` with a text: rows
that are equal in both are one document and never repeat each other, and equal
rows give each span once; other texts under the same or under no ``doc_id`` are
documents of their own. Their order is that of ``doc_id``, null last, then of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmullo.llm.common import row_struct, sliced, stage
from murmullo.session import ship_package

REACH, LONGEST, SPAN = 24, 192, 80
_WINDOW = 16
_GEAR_SEED = 7
# A document's key is its id, from 0 on, and below it so many values of a hash.
_HASHES, _LOWEST, _NO_ID = 1 << 62, 1 << 63, 1 << 64
_KEY = "decimal(38,0)"


def gear_table() -> np.ndarray:
    """One random number for each byte value; the seed fixes them."""
    return np.random.default_rng(_GEAR_SEED).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """The gear hash at every byte, ``h = 2 h + gear[byte]``, of the last 16 bytes.

    A window of 2 n bytes is a window of n plus the one before it, moved by n. The
    highest bits depend on all of them.
    """
    h = gear[data]
    width = 1
    while width < _WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h, width = longer, 2 * width
    return h


def _highest_before(h: np.ndarray, reach: int) -> np.ndarray:
    """The highest of the ``reach`` values before each one, 0 at the beginning."""
    best = np.concatenate((np.zeros(1, h.dtype), h[:-1]))
    width = 1
    while width < reach:
        step = min(width, reach - width)
        moved = np.concatenate((np.zeros(step, h.dtype), best[:-step]))[:len(best)]
        best, width = np.maximum(best, moved), width + step
    return best


def chunk_ends(data: bytes, gear: np.ndarray, reach: int, longest: int) -> list[int]:
    """Where the chunks of one text end."""
    n = len(data)
    h = rolling_hash(np.frombuffer(data, np.uint8), gear)
    after = _highest_before(h[::-1], reach)[::-1]
    cuts = np.flatnonzero((h > _highest_before(h, reach)) & (h >= after)) + 1
    ends, start = [], 0
    for cut in [*cuts.tolist(), n]:
        while cut - start > longest:
            start += longest
            ends.append(start)
        if cut > start:
            ends.append(cut)
            start = cut
    return ends


def _whole(value: int) -> Column:
    return F.lit(str(value)).cast(_KEY)


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """One number for ``doc_id`` (null last) and the hash of the text, in this order.

    A number is a fixed place in an aggregate, where a struct would have to be sorted.
    """
    own = F.col(doc_id).cast("bigint").cast(_KEY) + _whole(_LOWEST)
    place = F.coalesce(own, _whole(_NO_ID)).cast("decimal(20,0)")
    short = F.shiftrightunsigned(F.xxhash64(text), 2).cast("decimal(19,0)")
    return (place * F.lit(str(_HASHES)).cast("decimal(19,0)") + short).cast(_KEY)


def _id_of(key: Column) -> Column:
    """The ``doc_id`` of a document's key."""
    hashes = F.lit(str(_HASHES)).cast(_KEY)
    place = ((key - key % hashes) / hashes).cast("decimal(20,0)")
    return F.when(place < _whole(_NO_ID), (place - _whole(_LOWEST)).cast("bigint"))


def _chunker(reach: int, longest: int):
    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear, digest = gear_table(), xxhash.xxh3_128_digest
        for whole in batches:
            for batch in sliced(whole, 1):
                ids, starts, sizes, keys = [], [], [], []
                for row, text in enumerate(batch.column(1)):
                    if not text.is_valid:
                        continue
                    data = text.as_buffer().to_pybytes()
                    if not data:
                        continue
                    ends = chunk_ends(data, gear, reach, longest)
                    begins = [0, *ends[:-1]]
                    keys.extend([digest(data[a:b]) for a, b in zip(begins, ends)])
                    ids.append(np.full(len(ends), row))
                    starts.append(np.array(begins))
                    sizes.append(np.array(ends) - np.array(begins))
                if not keys:
                    continue
                halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                     batch.column(0).take(pa.array(np.concatenate(ids))),
                     pa.array(np.concatenate(starts) << 16 | np.concatenate(sizes))],
                    names=["_d0", "_d1", "_id", "_place"],
                )

    return chunk


def chunks(docs: DataFrame, reach: int = REACH, longest: int = LONGEST) -> DataFrame:
    """A row per chunk: digest in two halves, document, start and size in one number."""
    if not 0 < reach <= longest < 1 << 16:
        raise ValueError("0 < reach <= longest < 65536")
    ship_package(docs.sparkSession)
    return docs.select(document_key().alias("_key"), "text").mapInArrow(
        _chunker(reach, longest), f"_d0 bigint, _d1 bigint, _id {_KEY}, _place bigint"
    )


def repeated_spans(
    docs: DataFrame, span: int = SPAN, reach: int = REACH, longest: int = LONGEST
) -> DataFrame:
    """Spans of ``span`` bytes or more that documents before theirs have too.

    ``doc_id, start, n_bytes`` (in UTF-8), ``n_chunks``, and ``first_doc_ids``: the
    documents with the first occurrence of ``span`` bytes of it or, if there is none,
    of the most. Others share a phrase with it by chance.
    """
    return _spans(docs, span, reach, longest).drop("_id")


def _spans(docs: DataFrame, span: int, reach: int, longest: int) -> DataFrame:
    """The spans with the key of their document as ``_id``."""
    found = chunks(docs, reach, longest)
    shared = stage(
        found.groupBy("_d0", "_d1")
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_final"))
        .filter("_first < _final").select("_d0", "_d1", "_first"),
        "substrings",
    )
    repeats = (
        found.join(shared, ["_d0", "_d1"]).filter("_id > _first")
        .select("_id", F.shiftright("_place", 16).alias("_start"),
                F.col("_place").bitwiseAND(65535).alias("_size"), "_first")
        .distinct()
    )
    by_place = Window.partitionBy("_id").orderBy("_start", "_size")
    gap = F.coalesce(
        F.col("_start") > F.max(F.col("_start") + F.col("_size")).over(
            by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = repeats.withColumn("_gap", gap.cast("int")).withColumn(
        "_run", F.sum("_gap").over(by_place)
    )
    by_source = runs.groupBy("_id", "_run", "_first").agg(
        F.min("_start").alias("_from"), F.max(F.col("_start") + F.col("_size")).alias("_to"),
        F.sum("_size").alias("_bytes"), F.count("*").alias("_n"),
    )
    sources = F.col("_sources")
    enough = F.least(F.array_max(F.transform(sources, lambda x: x["_bytes"])), F.lit(span))
    main = F.filter(sources, lambda x: x["_bytes"] >= enough)
    return (
        by_source.groupBy("_id", "_run").agg(
            F.min("_from").alias("start"), (F.max("_to") - F.min("_from")).alias("n_bytes"),
            F.sum("_n").alias("n_chunks"),
            F.collect_list(F.struct("_bytes", "_first")).alias("_sources"),
        )
        .filter(F.col("n_bytes") >= span)
        .select(
            "_id", _id_of(F.col("_id")).alias("doc_id"), "start", "n_bytes", "n_chunks",
            F.array_sort(F.array_distinct(
                F.transform(main, lambda x: _id_of(x["_first"]))
            )).alias("first_doc_ids"),
        )
    )


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
            if not text.is_valid or not spans:
                out.append(text.as_py())
                continue
            data, kept, at = text.as_buffer().to_pybytes(), [], 0
            for s in sorted(spans, key=lambda s: s["start"]):
                kept.append(data[at:s["start"]])
                at = max(at, s["start"] + s["n_bytes"])
            kept.append(data[at:])
            # A cut may fall inside a character.
            out.append(b"".join(kept).decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.string())], names=["_doc", "deduplicated"]
        )


def without_repeats(
    docs: DataFrame, span: int = SPAN, reach: int = REACH, longest: int = LONGEST
) -> DataFrame:
    """The input's rows as ``_doc`` and their texts without the repeated spans."""
    spans = _spans(docs, span, reach, longest).groupBy(F.col("_id").alias("_span_id")).agg(
        F.collect_list(F.struct("start", "n_bytes")).alias("_spans")
    )
    rows = docs.select(row_struct(docs).alias("_doc"), "text", document_key().alias("_id"))
    joined = rows.join(spans, rows["_id"] == spans["_span_id"], "left").select(
        "_doc", "text", "_spans"
    )
    kind = joined.schema["_doc"].dataType.simpleString()
    return joined.mapInArrow(_cutter, f"_doc {kind}, deduplicated string")
