"""Token ids in binary files: frequency ranks in bytes, lengths in control bytes.

The ids of all documents are counted and ranked, the most frequent first. A
rank takes one to four bytes; two bits say how many, and the bits of four ranks
make a control byte. Control and data bytes lie apart, so a reader looks up 256
control bytes in a table and takes the data with numpy, without a loop.

A folder holds the ranks (Parquet), the parts and a manifest (Parquet, one row per
part, in ascending order of ``doc_id``, null first; equal ids by text hash). A part is
``MAGIC`` and blocks of whole documents, about a million ids each::

    u32 documents, u32 ids, u32 data bytes
    i64 doc_id for each document, u8 "is null" for each, u32 ids for each
    control bytes, data bytes

A null text is an empty one; each document ends with ``END``, so it has one id at
least. Rows may repeat. An empty table gives an empty folder and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmullo.llm.common import sliced, stage
from murmullo.llm.files import filesystem, part_name
from murmullo.llm.tokens import encoder
from murmullo.session import ship_package, work_dir

END = 2
MAGIC = b"RANKTOK1"
_BLOCK = 1 << 20
# Bytes of text encoded at once: a task needs several times as much for their pieces.
_ENCODED = 4 << 20
_HEAD = "<III"

# Bytes of the four ranks of each control byte.
_SIZES = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of some ranks."""
    sizes = np.ones(len(ranks), np.int64)
    for limit in (1 << 8, 1 << 16, 1 << 24):
        sizes += ranks >= limit
    ends = np.cumsum(sizes)
    at = ends - sizes
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[at] = ranks & 255
    for more in (1, 2, 3):
        long = np.flatnonzero(sizes > more)
        if not len(long):
            break
        data[at[long] + more] = (ranks[long] >> (8 * more)) & 255
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = sizes - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    sizes = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(sizes, dtype=np.int64) - sizes
    raw = np.frombuffer(data, np.uint8)
    ranks = raw[at].astype(np.uint32)
    for more in (1, 2, 3):
        long = np.flatnonzero(sizes > more)
        if not len(long):
            break
        ranks[long] |= raw[at[long] + more].astype(np.uint32) << np.uint32(8 * more)
    return ranks


def _tokenizing(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        tail = np.array([end], known.dtype).tobytes()
        width = len(tail)
        for whole in batches:
            for batch in sliced(whole, 2, _ENCODED):
                ids, counts = known.encode([t or "" for t in batch.column(2).to_pylist()])
                ends = np.cumsum(counts) * width
                values = [ids[a:b] + tail for a, b in zip((ends - counts * width).tolist(),
                                                          ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1),
                     pa.array(np.full(len(counts), width, np.int32)),
                     pa.array(values, pa.binary())],
                    names=["doc_id", "_hash", "_width", "_ids"],
                )
                # What a slice took must not lie beside the next one's.
                del ids, values
            pa.default_memory_pool().release_unused()

    return run


def _ids_of(values: pa.Array, width: int) -> np.ndarray:
    joined = b"".join(v.as_buffer() for v in values)
    return np.frombuffer(joined, np.uint16 if width == 2 else np.uint32)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            found = np.bincount(_ids_of(batch.column(1), batch.column(0)[0].as_py()))
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[:len(found)] += found
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])


def _writing(folder: str, by_rank: np.ndarray):
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = out = path = None
        docs = tokens = part = 0
        pending: list[pa.RecordBatch] = []
        size = 0

        def block(rows: list[pa.RecordBatch]) -> int:
            t = pa.Table.from_batches(rows).combine_chunks()
            ids = t.column(0).combine_chunks()
            width = t.column(1)[0].as_py()
            values = t.column(2).combine_chunks()
            ranks = rank_of[_ids_of(values, width)]
            counts = np.array([len(v.as_buffer()) // width for v in values], "<u4")
            control, data = pack(ranks)
            out.write(struct.pack(_HEAD, len(counts), len(ranks), len(data)))
            out.write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            out.write(ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
            out.write(counts.tobytes())
            out.write(control)
            out.write(data)
            return len(ranks)

        for whole in batches:
            for batch in sliced(whole, 2, 2 * _BLOCK):
                if out is None:
                    store, path, address, part = part_name(folder, ".tok")
                    out = store.open_output_stream(path)
                    out.write(MAGIC)
                pending.append(batch)
                docs += batch.num_rows
                size += batch.nbytes
                if size >= 2 * _BLOCK:
                    tokens += block(pending)
                    pending, size = [], 0
        if out is not None:
            if pending:
                tokens += block(pending)
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([address]), pa.array([docs], pa.int64()),
                 pa.array([tokens], pa.int64())],
                names=["part", "path", "n_docs", "n_tokens"],
            )

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end: int = END) -> None:
    """Encode all texts with the tokenizer file and write the folder."""
    spark = docs.sparkSession
    ship_package(spark)
    coded = stage(
        docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("_hash"), "text")
        .mapInArrow(_tokenizing(tokenizer, end),
                    "doc_id bigint, _hash bigint, _width int, _ids binary"),
        "tokens",
    )
    counts = coded.select("_width", "_ids").mapInArrow(_counting, "id bigint, n bigint")
    ranks = counts.groupBy("id").agg(F.sum("n").alias("n"))
    ranks.write.parquet(f"{folder}/ranks")
    by_rank = read_ranks(spark, folder)
    order = ["doc_id", "_hash"]
    (
        coded.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("doc_id", "_width", "_ids")
        .mapInArrow(_writing(f"{folder}/parts", by_rank),
                    "part int, path string, n_docs bigint, n_tokens bigint")
        .write.parquet(f"{folder}/manifest")
    )


def read_ranks(spark: SparkSession, folder: str) -> np.ndarray:
    """Ids by rank: a number for each id of the vocabulary that occurs, no more."""
    rows = spark.read.schema("id bigint, n bigint").parquet(f"{folder}/ranks").toPandas()
    rows = rows.sort_values(["n", "id"], ascending=[False, True])
    return rows["id"].to_numpy(np.uint32)


def _reading(by_rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = filesystem(path)
                with store.open_input_stream(name) as part:
                    if part.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"not a token file: {path}")
                    while head := part.read(struct.calcsize(_HEAD)):
                        docs, n, size = struct.unpack(_HEAD, head)
                        ids = np.frombuffer(part.read(8 * docs), "<i8")
                        null = np.frombuffer(part.read(docs), np.uint8).astype(bool)
                        counts = np.frombuffer(part.read(4 * docs), "<u4").astype(np.int64)
                        ranks = unpack(part.read(-(-n // 4)), part.read(size), n)
                        tokens = by_rank[ranks].astype("<u4")
                        ends = np.cumsum(counts)
                        pieces = [memoryview(tokens[a:b]) for a, b in
                                  zip((ends - counts).tolist(), ends.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, mask=null), pa.array(start + ends - counts),
                             pa.array(counts),
                             pa.array([zlib.crc32(p) for p in pieces], pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        start += n

    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: place of its first id, number, CRC-32 of its ids."""
    parts = spark.read.schema(
        "part int, path string, n_docs bigint, n_tokens bigint"
    ).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    many = max(1, parts.count())
    return placed.repartition(many, "path").mapInArrow(
        _reading(read_ranks(spark, folder)),
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    )


def token_table(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Write the folder into the shared folder and read it back."""
    folder = work_dir(docs.sparkSession, "token-files")
    write_tokens(docs, tokenizer, folder, end)
    return read_tokens(docs.sparkSession, folder)
