"""Streaming jobs: the record stages and the window metrics.

Every ``start_*`` function returns a running ``StreamingQuery`` with its own
checkpoint, so several jobs can read one topic independently. A job that is
restarted with the same checkpoint goes on where it stopped. Delivery is at
least once to Kafka and exactly once to files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from murmullo.functions.text import clean_text
from murmullo.operators.scorers import Scorer
from murmullo.operators.stages import decide_hate, decide_sentiment, enrich, final_columns
from murmullo.operators.windows import sentiment_windows, throughput_windows
from murmullo.schemas import (
    HATE_THRESHOLD, RAW, SENTIMENT_SECONDS, THROUGHPUT_SECONDS,
)
from murmullo.sources.records import encode, parse_record, set_fields, text_field, typed
from murmullo.sources.topics import Topic
from murmullo.streaming.batches import (
    keep_newest, newest_rows, read_batches, rolling_batches, to_sinks,
)
from murmullo.streaming.clock import clock_sentiment, clock_throughput, timers
from murmullo.wordlists import EMOJI_NAMES

Stage = Callable[[DataFrame], DataFrame]


def trigger_options(trigger: str | None) -> dict:
    """``None``: as fast as possible; ``"available"``: what is there, then stop;
    anything else is an interval such as ``"20 seconds"``."""
    if trigger is None:
        return {}
    return {"availableNow": True} if trigger == "available" else {"processingTime": trigger}


def begin(
    writer: DataStreamWriter, checkpoint: str, name: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    options = trigger_options(trigger)
    return (writer.trigger(**options) if options else writer).start()


def parsed(df: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """Add ``record``, the parsed ``value``. Fail on a malformed one, or leave it out."""
    record = parse_record(F.col("value"))
    if on_malformed == "skip":
        some = F.filter(F.array(record), lambda r: r.isNotNull())
        return df.select("*", F.explode(some).alias("record"))
    if on_malformed != "fail":
        raise ValueError("on_malformed is 'fail' or 'skip'")
    wrong = F.raise_error(F.concat(F.lit("malformed record: "), F.col("value")))
    return df.withColumn("record", F.coalesce(record, wrong))


def _field(name: str) -> Column:
    return F.coalesce(text_field(F.col("record"), name), F.lit(""))


def _update(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    return df.withColumn("record", set_fields(F.col("record"), fields)).select("record")


def clean_stage(emoji: Mapping[str, str] = EMOJI_NAMES) -> Stage:
    """Parsed record in, the same record with its cleaned text out."""

    def run(df: DataFrame) -> DataFrame:
        return _update(df, {"comentario_limpio": clean_text(_field("comentario"), emoji)})

    return run


def _scored_stage(scorer: Scorer, decide: Stage, probas: str, names: list[str]) -> Stage:
    def run(df: DataFrame) -> DataFrame:
        texts = df.withColumn("comentario_limpio", _field("comentario_limpio"))
        decided = decide(scorer(texts, "comentario_limpio", probas))
        return _update(decided, {n: F.col(n) for n in names})

    return run


def hate_stage(scorer: Scorer, threshold: float = HATE_THRESHOLD) -> Stage:
    return _scored_stage(
        scorer, lambda df: decide_hate(df, threshold=threshold), "probas_odio",
        ["es_odio", "prob_odio", "categoria_odio"],
    )


def sentiment_stage(scorer: Scorer) -> Stage:
    return _scored_stage(
        scorer, decide_sentiment, "probas_sentimiento", ["sentimiento", "prob_sentimiento"]
    )


def start_stage(
    spark: SparkSession, source: Topic, sink: Topic, stage: Stage, checkpoint: str,
    name: str | None = None, trigger: str | None = None, on_malformed: str = "fail",
    max_per_trigger: int | None = None,
) -> StreamingQuery:
    """Read a topic, apply one stage to each record, write another topic.
    Fields the stage does not know pass through."""
    records = source.read_stream(spark, max_per_trigger=max_per_trigger, group=name)
    done = stage(parsed(records.select("value"), on_malformed))
    output = done.select(F.to_json("record").alias("value"))
    return begin(sink.write_stream(output).outputMode("append"), checkpoint, name, trigger)


def start_enrichment(
    spark: SparkSession, source: Topic, sink: Topic, hate: Scorer, sentiment: Scorer,
    checkpoint: str, name: str | None = None, trigger: str | None = None,
    threshold: float = HATE_THRESHOLD, on_malformed: str = "fail",
    max_per_trigger: int | None = None, metrics: str | None = None,
    emoji: Mapping[str, str] = EMOJI_NAMES,
) -> StreamingQuery:
    """All three stages in one query: the record is parsed and written once.
    With ``metrics`` its progress reports count rows and hate rows under that name."""
    messages = source.read_stream(spark, max_per_trigger=max_per_trigger, group=name)
    records = parsed(messages.select("value"), on_malformed)
    fields = [text_field(F.col("record"), n).alias(n) for n in RAW.names]
    raw = typed(records.select(*fields), RAW)
    final = final_columns(enrich(raw, hate, sentiment, threshold, emoji, metrics))
    return begin(sink.write_stream(encode(final)).outputMode("append"), checkpoint, name, trigger)


def throughput_stream(
    df: DataFrame, time: str = "timestamp", seconds: int = THROUGHPUT_SECONDS, *, late: str,
) -> DataFrame:
    """Window counts of a stream.

    Rows that come more than ``late`` after the newest are not counted any more;
    how many these were is in the progress reports. Partitions of a backlog that
    are read at different speed need a ``late`` that covers the difference.
    """
    timed = df.select(F.col(time).cast("timestamp").alias(time)).withWatermark(time, late)
    return throughput_windows(timed, time, seconds)


def sentiment_stream(
    df: DataFrame, time: str = "timestamp", seconds: int = SENTIMENT_SECONDS, *, late: str,
) -> DataFrame:
    timed = df.select(
        F.col(time).cast("timestamp").alias(time), "sentimiento", "es_odio"
    ).withWatermark(time, late)
    return sentiment_windows(timed, time, seconds)


def _metric(query: Callable[[], StreamingQuery], late: str | None, idle: float | None, df: DataFrame):
    """Start a metric that closes by the watermark or, with timers, by the clock."""
    if (late is None) == (idle is None):
        raise ValueError("give late (close by the next message) or idle (close by the clock)")
    if idle is None:
        return query()
    with timers(df.sparkSession):
        return query()


def start_throughput(
    spark: SparkSession, source: Topic, sink: Topic, checkpoint: str,
    seconds: int = THROUGHPUT_SECONDS, *, late: str | None = None, idle: float | None = None,
    name: str | None = None, trigger: str | None = None, max_per_trigger: int | None = None,
) -> StreamingQuery:
    """One metric record per closed window of a topic.

    With ``late`` a window closes when a message that much newer comes. With ``idle`` it
    closes when none has come for it for so many seconds; late messages then give it
    again, with the next ``revision``.
    """
    messages = source.read_stream(spark, max_per_trigger=max_per_trigger, group=name)
    metric = encode(
        throughput_stream(messages, "timestamp", seconds, late=late) if late is not None
        else clock_throughput(messages, seconds, "timestamp", idle))
    return _metric(lambda: begin(
        sink.write_stream(metric).outputMode("append"), checkpoint, name, trigger), late, idle, messages)


def start_sentiment_windows(
    spark: SparkSession, source: Topic, sink: Topic, checkpoint: str,
    seconds: int = SENTIMENT_SECONDS, *, late: str | None = None, idle: float | None = None,
    name: str | None = None, trigger: str | None = None, on_malformed: str = "fail",
    max_per_trigger: int | None = None,
) -> StreamingQuery:
    """As ``start_throughput``, sentiment and hate counts."""
    read = source.read_stream(spark, max_per_trigger=max_per_trigger, group=name)
    messages = parsed(read, on_malformed)
    flags = messages.select(
        "timestamp",
        text_field(F.col("record"), "sentimiento").alias("sentimiento"),
        text_field(F.col("record"), "es_odio").try_cast("boolean").alias("es_odio"),
    )
    metric = encode(
        sentiment_stream(flags, "timestamp", seconds, late=late) if late is not None
        else clock_sentiment(flags, seconds, "timestamp", idle))
    return _metric(lambda: begin(
        sink.write_stream(metric).outputMode("append"), checkpoint, name, trigger), late, idle, flags)


def start_parquet_sink(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder: the continuous form of the export."""
    writer = df.writeStream.format("parquet").option("path", path).outputMode("append")
    return begin(writer, checkpoint, name, trigger)


def start_latest_result(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None,
    trigger: str | None = None, keys: Sequence[str] = (), compact_every: int = 20,
) -> StreamingQuery:
    """Keep the current result of an aggregation, windows still open included.

    Each micro-batch writes the rows it changed under its own number, so a
    repeated batch replaces itself, nothing that a reader may hold goes away, and
    the state of closed windows can be dropped. With the ``keys`` of a row the
    batches are compacted, so a reader opens a bounded number of folders however
    long the query runs. Read with ``read_latest_result``.
    """
    put = keep_newest(path, df.schema, keys, compact_every)
    return begin(
        df.writeStream.outputMode("update").foreachBatch(put), checkpoint, name, trigger
    )


def read_latest_result(
    spark: SparkSession, path: str, schema: T.StructType, *keys: str
) -> DataFrame:
    """The newest row of each key that ``start_latest_result`` wrote."""
    return newest_rows(read_batches(spark, path, schema), keys).select(*schema.names)


def start_sinks(
    df: DataFrame, sinks: Mapping[str, tuple[str, Stage]], checkpoint: str,
    name: str | None = None, trigger: str | None = None,
) -> StreamingQuery:
    """One read of a stream to several sinks (name: path, transformation), each exactly
    once. Read a sink with ``read_batches``."""
    return begin(
        df.writeStream.outputMode("append").foreachBatch(to_sinks(sinks)), checkpoint, name, trigger
    )


def start_rolling_shares(
    df: DataFrame, seq: str, path: str, checkpoint: str, name: str | None = None,
    trigger: str | None = None, **how,
) -> StreamingQuery:
    """Hate and sentiment shares over the last messages, after each of a stream.
    Read with ``read_batches``."""
    put = rolling_batches(path, seq, df.schema, **how)
    return begin(df.writeStream.outputMode("append").foreachBatch(put), checkpoint, name, trigger)


def start_clock_windows(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Windows of ``streaming.clock`` to a Parquet folder. Needs an interval or no trigger:
    windows end without new rows, so there is no point at which all is done."""
    if trigger == "available":
        raise ValueError("windows that close by the clock need a trigger that goes on")
    with timers(df.sparkSession):
        return start_parquet_sink(df, path, checkpoint, name, trigger)
