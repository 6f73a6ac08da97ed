"""Micro-batches as numbered folders: exactly once, for one sink or several, and bounded.

``batch=N`` holds what batch N wrote and counts once its mark is there, so a reader never
sees a half-written one, and a repeated batch replaces itself. A result with keys is
compacted now and then: the newest row of each key goes to a snapshot of its own name, a
mark makes it the current one, and the folders behind it go away one compaction later, so
that a reader who has just begun still finds them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmullo.operators.recent import BUFFER_SIZE, last_rows, rolling_shares
from murmullo.sources import store

_BATCHES, _SNAPSHOTS = "_batches", "_snapshots"


def _sub(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


def committed(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches that are whole."""
    return sorted(int(n) for n in store.names(spark, _sub(path, _BATCHES)))


def snapshots(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number of the last batch in each snapshot, and its name; the current one is last."""
    found = store.names(spark, _sub(path, _SNAPSHOTS))
    return sorted((int(name.split("-")[0]), name) for name in found)


def put_batch(batch: DataFrame, path: str, number: int) -> None:
    """Write a batch under its number, and mark it."""
    batch.write.mode("overwrite").parquet(_sub(path, f"batch={number}"))
    store.mark(batch.sparkSession, _sub(path, _BATCHES, str(number)))


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all whole batches, with the number of their ``batch``; behind a snapshot
    only those that are newer than it, and its own rows."""
    stamped = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    current = snapshots(spark, path)[-1:]
    upto = current[0][0] if current else -1
    newer = [n for n in committed(spark, path) if n > upto]
    parts = []
    if newer:
        reader = spark.read.schema(stamped).option("basePath", path)
        parts.append(reader.parquet(*[_sub(path, f"batch={n}") for n in newer]))
    if current:
        parts.append(spark.read.schema(stamped).parquet(_sub(path, current[0][1])))
    if not parts:
        return spark.createDataFrame([], stamped)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def newest_rows(rows: DataFrame, keys: Sequence[str], by: str = "batch") -> DataFrame:
    """The row of each key from its newest batch, all columns."""
    found = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max_by(F.struct(*rows.columns), by).alias("_row"))
    return found.select("_row.*")


def compact(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], number: int
) -> None:
    """Gather everything up to a batch in a new snapshot. Again for a batch that is in one
    already: nothing."""
    before = snapshots(spark, path)
    if before and before[-1][0] >= number:
        return
    name = f"{number}-{uuid.uuid4().hex}"
    gathered = newest_rows(read_batches(spark, path, schema), keys)
    gathered.write.parquet(_sub(path, name))
    store.mark(spark, _sub(path, _SNAPSHOTS, name))
    # What the snapshot before this one replaced: no reader begins with it any more.
    gone = before[-1][0] if before else -1
    for n in committed(spark, path):
        if n <= gone:
            store.remove(spark, _sub(path, _BATCHES, str(n)))
            store.remove(spark, _sub(path, f"batch={n}"))
    for _, old in before[:-1]:
        store.remove(spark, _sub(path, _SNAPSHOTS, old))
        store.remove(spark, _sub(path, old))


def keep_newest(
    path: str, schema: T.StructType, keys: Sequence[str] = (), every: int = 20
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes numbered batches, and with ``keys``
    compacts them every ``every`` batches."""

    def put(batch: DataFrame, number: int) -> None:
        put_batch(batch, path, number)
        if keys and number % every == every - 1:
            compact(batch.sparkSession, path, schema, keys, number)

    return put


def to_sinks(
    sinks: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for several sinks (name: path, transformation).

    The batch is computed once for all. The number of the batch is the transaction of
    every sink: one that has its mark is left alone when a batch is repeated, so a crash
    between two sinks loses nothing and writes nothing twice.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        open_sinks = [s for s in sinks.values() if number not in committed(spark, s[0])]
        if not open_sinks:
            return
        shared = batch.persist()
        try:
            for path, transform in open_sinks:
                put_batch(transform(shared), path, number)
        finally:
            shared.unpersist()

    return put


def rolling_batches(
    path: str, seq: str, schema: T.StructType, size: int = BUFFER_SIZE, flag: str = "es_odio",
    sentiment: str = "sentimiento", chunk: int = 1 << 16,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for the shares after every message of a stream.

    A batch needs the ``size - 1`` messages before it and no more. They are kept under
    the number of the batch they end, so a repeated batch starts from the same ones; the
    rows of the batch itself are spread as ``rolling_shares`` does it. Messages of a batch
    are in the order of ``seq``, and batches in that of the stream. Read with
    ``read_batches``; ``tail`` of the path holds what the next batch needs.
    """
    tail, kept = _sub(path, "tail"), T.StructType([schema[c] for c in (seq, flag, sentiment)])

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [n for n in committed(spark, tail) if n < number]
        new = batch.select(*kept.names).withColumn("_new", F.lit(True))
        if before:
            old = spark.read.schema(kept).parquet(_sub(tail, f"batch={before[-1]}"))
            rows = new.unionByName(old.withColumn("_new", F.lit(False)))
        else:
            rows = new
        shared = rows.persist()
        try:
            shares = rolling_shares(shared, seq, size, flag, sentiment, chunk)
            fresh = shared.filter("_new").select(seq)
            put_batch(shares.join(fresh, seq, "left_semi"), path, number)
            put_batch(last_rows(shared.drop("_new"), size - 1, seq).coalesce(1), tail, number)
        finally:
            shared.unpersist()
        for n in before[:-1]:
            store.remove(spark, _sub(tail, _BATCHES, str(n)))
            store.remove(spark, _sub(tail, f"batch={n}"))

    return put
