"""Windows that close by the clock, not by the next message.

A window of event time closes when a newer message moves the watermark, so the last
window of a stream that falls silent stays open. Here every window has a timer in the
state store. Windows of the machine's time end when their time is over. Windows of
message time end when nothing has come for them for a while; what comes later is added
and the window is given again, complete, with the next ``revision``: late messages
correct it, and none is lost.

Messages are counted inside the tasks, per Arrow batch, before they are dealt out by
window, so a window costs a few rows for each task however many messages it has.
State and timers are in the checkpoint: a restart goes on with them, and a window that
was given is not given again. RocksDB holds them, which timers require.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from murmullo.functions.measures import percent_or_zero, rate
from murmullo.schemas import SENTIMENT_SECONDS, THROUGHPUT_SECONDS
from murmullo.session import ship_package

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# How long a closed window can still be corrected.
KEEP_MS = 24 * 3600 * 1000


@contextlib.contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Start a query with timers inside this; other queries keep their state store."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class WindowCounts(StatefulProcessor):
    """Adds up the counters of a window until its timer ends it."""

    def __init__(self, counters: list[str], idle_ms: int | None, keep_ms: int) -> None:
        self.counters, self.idle_ms, self.keep_ms = counters, idle_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        names = ["revision", "timer", *self.counters]
        schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
        self.window = handle.getValueState("window", schema, self.keep_ms if self.idle_ms else None)

    def _known(self) -> list[int]:
        return list(self.window.get()) if self.window.exists() else [0] * (2 + len(self.counters))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        revision, timer, *counts = self._known()
        for row in rows:
            for i, name in enumerate(self.counters):
                counts[i] += row[name]
        if self.idle_ms is None:
            due = timer or key[0] * 1000
        else:
            due = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
        if due != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.window.update((revision, due, *counts))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.window.exists():
            return
        revision, _, *counts = self._known()
        if self.idle_ms is None:
            self.window.clear()
        else:
            self.window.update((revision + 1, 0, *counts))
        yield Row(ventana_fin=key[0], revision=revision, **dict(zip(self.counters, counts)))

    def close(self) -> None:
        pass


def _added_up(counters: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                summed = pa.Table.from_batches([batch]).group_by("ventana_fin").aggregate(
                    [(name, "sum") for name in counters])
                yield from summed.rename_columns(["ventana_fin", *counters]).to_batches()

    return run


def clock_windows(
    df: DataFrame, counters: Mapping[str, Column], seconds: int, time: str | None = None,
    idle: float | None = None, keep_ms: int = KEEP_MS,
) -> DataFrame:
    """``ventana_fin``, ``revision`` and the sums of whole-number ``counters``.

    Without ``time`` a message belongs to the window in which its batch is read. With it
    windows are of that column, and end after ``idle`` seconds without a message for them.
    Corrections are possible for ``keep_ms`` after a window's last message.
    """
    if (time is None) != (idle is None):
        raise ValueError("time and idle belong together")
    ship_package(df.sparkSession)
    if time is None:
        now = F.unix_micros(F.current_timestamp())
        end = (F.floor(now / (seconds * 1_000_000)) + 1) * seconds
    else:
        end = F.unix_timestamp(F.window(F.col(time).cast("timestamp"), f"{seconds} seconds")["end"])
    names = list(counters)
    counted = df.select(
        end.cast("bigint").alias("ventana_fin"),
        *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(n) for n, c in counters.items()],
    )
    kinds = "ventana_fin bigint, " + ", ".join(f"{n} bigint" for n in names)
    result = T.StructType([T.StructField(n, T.LongType()) for n in ("ventana_fin", "revision", *names)])
    return counted.mapInArrow(_added_up(names), kinds).groupBy("ventana_fin").transformWithState(
        statefulProcessor=WindowCounts(names, None if idle is None else int(idle * 1000), keep_ms),
        outputStructType=result, outputMode="Append", timeMode="ProcessingTime",
    )


def clock_throughput(
    df: DataFrame, seconds: int = THROUGHPUT_SECONDS, time: str | None = None, idle: float | None = None,
    **how,
) -> DataFrame:
    """Messages and messages per second of each window, with its ``revision``."""
    found = clock_windows(df, {"cantidad_mensajes": F.lit(1)}, seconds, time, idle, **how)
    return found.select(
        "ventana_fin", "cantidad_mensajes",
        rate(F.col("cantidad_mensajes"), seconds).alias("throughput_msg_seg"), "revision",
    )


def clock_sentiment(
    df: DataFrame, seconds: int = SENTIMENT_SECONDS, time: str | None = None, idle: float | None = None,
    sentiment: str = "sentimiento", flag: str = "es_odio", **how,
) -> DataFrame:
    """Sentiment and hate counts of each window, with its ``revision``."""
    found = clock_windows(df, {
        "total_comentarios": F.lit(1), "positivos": F.col(sentiment) == "POS",
        "negativos": F.col(sentiment) == "NEG", "odio": F.col(flag),
    }, seconds, time, idle, **how)
    total = F.col("total_comentarios")
    return found.select(
        "ventana_fin", "total_comentarios", "positivos", "negativos",
        (total - F.col("positivos") - F.col("negativos")).alias("neutrales"), "odio",
        percent_or_zero(F.col("odio"), total).alias("porcentaje_odio"), "revision",
    )


def last_revisions(windows: DataFrame) -> DataFrame:
    """Each window as it was given last."""
    columns = [c for c in windows.columns if c != "revision"]
    newest = windows.groupBy(F.col("ventana_fin").alias("_end")).agg(
        F.max_by(F.struct(*columns), "revision").alias("_row"))
    return newest.select("_row.*")
