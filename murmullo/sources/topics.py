"""Topics: Kafka in production, a folder of JSON lines in tests, Parquet for archives.

All kinds give the same columns, ``value`` and ``timestamp`` first, so a job
does not know which one it reads. Kafka and Parquet topics have offsets: they are asked
for where they are known (the brokers, the file footers), and then a closed range is
read, so nothing is scanned to find out where to begin or end.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# How far before the end a tail begins that has no positions yet.
TAIL_START = 20

# Topic partition -> next offset; topic partition -> (first offset, offset behind the last).
Positions = Mapping[int, int]
Ranges = Mapping[int, tuple[int, int]]


def decode_value(value: Column) -> Column:
    """Bytes as UTF-8 text; invalid bytes become the replacement character."""
    return F.make_valid_utf8(value.cast("string"))


@dataclass(frozen=True)
class KafkaTopic:
    servers: str
    name: str
    options: Mapping[str, str] = field(default_factory=dict)

    def source_options(
        self, starting: str = "earliest", max_per_trigger: int | None = None,
        group: str | None = None, since_ms: int | None = None,
    ) -> dict[str, str]:
        found = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": starting,
        }
        if max_per_trigger is not None:
            found["maxOffsetsPerTrigger"] = str(max_per_trigger)
        if group is not None:
            found["groupIdPrefix"] = group
        if since_ms is not None:
            found["startingTimestamp"] = str(since_ms)
            # A partition without newer records gives nothing, and does not fail.
            found["startingOffsetsByTimestampStrategy"] = "latest"
        return {**found, **self.options}

    def range_options(self, ranges: Ranges) -> dict[str, str]:
        """Read exactly these offsets: the brokers send nothing else."""

        def offsets(side: int) -> str:
            return json.dumps({self.name: {str(p): r[side] for p, r in sorted(ranges.items())}})

        return {
            **self.source_options(), "startingOffsets": offsets(0), "endingOffsets": offsets(1)
        }

    def positions(self, offset: str) -> dict[int, int]:
        """Positions from an offset text of a progress report or a checkpoint,
        such as ``query.lastProgress.sources[0].endOffset``."""
        return {int(p): int(o) for p, o in json.loads(offset)[self.name].items()}

    def client_options(self) -> dict[str, str]:
        """Settings of a plain client: the ``kafka.`` options, and keys and values as bytes."""
        kept = {k.removeprefix("kafka."): v for k, v in self.options.items() if k.startswith("kafka.")}
        as_bytes = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
        return {"bootstrap.servers": self.servers, "key.deserializer": as_bytes,
                "value.deserializer": as_bytes, **kept}

    def offsets(self, spark: SparkSession, since_ms: int | None = None) -> dict[int, tuple[int, int]]:
        """First offset and offset behind the last of each partition, as the brokers
        tell them; no message is read. With ``since_ms`` the first offset is that of the
        first message of that time or later."""
        jvm = spark._jvm
        settings = jvm.java.util.Properties()
        for key, value in self.client_options().items():
            settings.setProperty(key, value)
        try:
            consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)
        except TypeError as error:  # a package name where the class is missing
            raise RuntimeError("the Kafka connector is not on the class path") from error
        try:
            parts, times = jvm.java.util.ArrayList(), jvm.java.util.HashMap()
            for info in consumer.partitionsFor(self.name):
                part = jvm.org.apache.kafka.common.TopicPartition(self.name, info.partition())
                parts.add(part)
                times.put(part, jvm.java.lang.Long(since_ms or 0))
            first, ends = consumer.beginningOffsets(parts), consumer.endOffsets(parts)
            later = {} if since_ms is None else consumer.offsetsForTimes(times)
            found = {}
            for part in parts:
                start, end = int(first.get(part)), int(ends.get(part))
                if since_ms is not None:
                    start = int(later.get(part).offset()) if later.get(part) is not None else end
                found[part.partition()] = (start, end)
            return found
        finally:
            consumer.close()

    def sink_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers, "topic": self.name, **self.options
        }

    @staticmethod
    def _columns(df: DataFrame) -> DataFrame:
        return df.select(
            decode_value(F.col("value")).alias("value"),
            "timestamp", "topic", "partition", "offset",
        )

    def read_stream(
        self, spark: SparkSession, starting: str = "earliest",
        max_per_trigger: int | None = None, group: str | None = None,
    ) -> DataFrame:
        options = self.source_options(starting, max_per_trigger, group)
        return self._columns(spark.readStream.format("kafka").options(**options).load())

    def read_batch(
        self, spark: SparkSession, max_messages: int | None = None,
        since_ms: int | None = None, starts: Positions | None = None,
        ends: Positions | None = None,
    ) -> DataFrame:
        """What is in the topic now, or at most its first ``max_messages``.

        With ``starts`` and ``ends``, as a progress report gives them, only these
        offsets are read. Without them a bounded read asks the brokers for them
        first. With ``since_ms`` the brokers skip what is older.
        """
        if starts is not None and ends is not None:
            return self.read_range(spark, next_ranges(starts, ends, max_messages))
        if max_messages is not None:
            return self.read_range(spark, first_ranges(self.offsets(spark, since_ms), max_messages))
        options = {**self.source_options(since_ms=since_ms), "endingOffsets": "latest"}
        return self._columns(spark.read.format("kafka").options(**options).load())

    def read_range(self, spark: SparkSession, ranges: Ranges) -> DataFrame:
        """The messages of a closed range; what arrives meanwhile is not in it."""
        options = self.range_options(ranges)
        return self._columns(spark.read.format("kafka").options(**options).load())

    def write_stream(self, df: DataFrame) -> DataStreamWriter:
        return df.select("value").writeStream.format("kafka").options(**self.sink_options())

    def write_batch(self, df: DataFrame) -> None:
        df.select("value").write.format("kafka").options(**self.sink_options()).save()


@dataclass(frozen=True)
class FileTopic:
    """A folder of text files with one JSON record per line.

    With ``compression`` (``"gzip"``) files are written compressed, and end after
    ``records_per_file`` records, as a reader cannot split such a file.
    """

    path: str
    compression: str | None = None
    records_per_file: int = 10_000

    @staticmethod
    def _columns(df: DataFrame) -> DataFrame:
        return df.select(
            decode_value(F.col("value")).alias("value"),
            F.col("_metadata.file_modification_time").alias("timestamp"),
        )

    def _options(self) -> dict[str, str]:
        if self.compression is None:
            return {}
        return {"compression": self.compression, "maxRecordsPerFile": str(self.records_per_file),
                "zlib.compress.level": "BEST_SPEED"}

    def read_stream(
        self, spark: SparkSession, starting: str = "earliest",
        max_per_trigger: int | None = None, group: str | None = None,
    ) -> DataFrame:
        reader = spark.readStream
        if max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return self._columns(reader.text(self.path))

    def read_batch(self, spark: SparkSession, max_messages: int | None = None) -> DataFrame:
        df = spark.read.text(self.path)
        if max_messages is None:
            return self._columns(df)
        # Oldest file first; lines of a file have no number, so they come by text.
        oldest = [F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")]
        return self._columns(df.orderBy(*oldest, "value").limit(max_messages))

    def write_stream(self, df: DataFrame) -> DataStreamWriter:
        return df.select("value").writeStream.format("text").options(**self._options()).option("path", self.path)

    def write_batch(self, df: DataFrame) -> None:
        df.select("value").write.mode("append").options(**self._options()).text(self.path)


@dataclass(frozen=True)
class TableTopic:
    """A topic kept as Parquet, a folder for each partition, for archives and replays.

    The messages of a partition lie in the order of their offsets, so the footers of
    its files tell the first and the last one, and row groups outside a range are
    skipped. Besides ``partition`` and ``offset`` there may be any columns.
    """

    path: str

    def write_batch(self, df: DataFrame) -> None:
        """Append messages that have their partition and offset."""
        by = ["partition", "offset"]
        df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("append").partitionBy(
            "partition").parquet(self.path)

    def bounds_query(self, spark: SparkSession) -> DataFrame:
        """Least and greatest offset of each partition, from the file footers alone."""
        reader = spark.newSession()  # shares all but the settings
        reader.conf.set("spark.sql.sources.useV1SourceList", "")
        reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return reader.read.parquet(self.path).groupBy("partition").agg(
            F.min("offset").alias("first"), F.max("offset").alias("last"))

    def offsets(self, spark: SparkSession) -> dict[int, tuple[int, int]]:
        found = self.bounds_query(spark).collect()
        return {row["partition"]: (row["first"], row["last"] + 1) for row in found}

    def read_range(self, spark: SparkSession, ranges: Ranges) -> DataFrame:
        """The messages of a closed range: a scan of each partition's folder with its own
        limits, so that no row group outside them is read."""
        whole = spark.read.parquet(self.path)
        parts = [in_ranges(whole, {p: r}) for p, r in sorted(ranges.items()) if r[0] < r[1]]
        return functools.reduce(DataFrame.unionAll, parts) if parts else whole.limit(0)

    def read_batch(self, spark: SparkSession, max_messages: int | None = None) -> DataFrame:
        if max_messages is None:
            return spark.read.parquet(self.path)
        return self.read_range(spark, first_ranges(self.offsets(spark), max_messages))


Topic = KafkaTopic | FileTopic
# Topics that know their offsets without being read.
OffsetTopic = KafkaTopic | TableTopic


def bounds(
    df: DataFrame, partition: str = "partition", offset: str = "offset"
) -> dict[int, tuple[int, int]]:
    """First offset and offset behind the last of each topic partition.

    One row per topic partition comes to the driver; the scan reads two columns.
    """
    found = df.groupBy(partition).agg(F.min(offset), F.max(offset) + 1)
    return {row[0]: (row[1], row[2]) for row in found.collect()}


def end_positions(
    df: DataFrame, partition: str = "partition", offset: str = "offset"
) -> dict[int, int]:
    """The next offset of each topic partition, as a consumer would ask for it."""
    return {p: end for p, (_, end) in bounds(df, partition, offset).items()}


def from_positions(
    df: DataFrame, positions: Positions,
    partition: str = "partition", offset: str = "offset",
) -> DataFrame:
    """Rows at or after the given offsets, and all rows of other partitions.

    The limits are literals, so they reach a Parquet scan and skip old row groups.
    """
    wanted = ~F.col(partition).isin(list(positions)) if positions else F.lit(True)
    for number, start in sorted(positions.items()):
        wanted = wanted | ((F.col(partition) == number) & (F.col(offset) >= start))
    return df.filter(wanted)


def in_ranges(
    df: DataFrame, ranges: Ranges, partition: str = "partition", offset: str = "offset"
) -> DataFrame:
    """The rows of closed offset ranges, whatever else has arrived."""
    wanted = F.lit(False)
    for number, (start, end) in sorted(ranges.items()):
        inside = (F.col(offset) >= start) & (F.col(offset) < end)
        wanted = wanted | ((F.col(partition) == number) & inside)
    return df.filter(wanted)


def next_ranges(
    starts: Positions, ends: Positions, max_messages: int | None = None
) -> dict[int, tuple[int, int]]:
    """The next offsets of each partition, at most ``max_messages`` in all.

    Every partition gets an equal share, and what a short one leaves goes to the
    others, so none waits for the rest to catch up.
    """
    waiting = {p: max(0, end - starts.get(p, 0)) for p, end in ends.items()}
    left = sum(waiting.values()) if max_messages is None else max_messages
    found = {}
    shortest = sorted(waiting.items(), key=lambda x: (x[1], x[0]))
    for i, (p, n) in enumerate(shortest):
        share = min(n, left // (len(shortest) - i))
        left -= share
        found[p] = (starts.get(p, 0), starts.get(p, 0) + share)
    return found


def first_ranges(there: Ranges, max_messages: int) -> dict[int, tuple[int, int]]:
    """The oldest messages, an equal share from each partition."""
    return next_ranges(
        {p: b[0] for p, b in there.items()}, {p: b[1] for p, b in there.items()}, max_messages
    )


def tail_ranges(
    there: Ranges, positions: Positions | None, max_new: int, back: int = TAIL_START
) -> tuple[dict[int, tuple[int, int]], dict[int, int]]:
    """What a tail reads next, and the positions it remembers then."""
    ends = {p: end for p, (_, end) in there.items()}
    if positions is None:
        positions = {p: end - back for p, end in ends.items()}
    # Offsets before the first that is still there cannot be read any more.
    starts = {p: max(positions.get(p, first), first) for p, (first, _) in there.items()}
    ranges = next_ranges(starts, ends, max_new)
    return ranges, {**positions, **{p: end for p, (_, end) in ranges.items()}}


def last_ranges(there: Ranges, max_messages: int) -> dict[int, tuple[int, int]]:
    """The newest messages, an equal share from each partition, one at least."""
    share = max(1, max_messages // max(1, len(there)))
    return {p: (max(first, end - share), end) for p, (first, end) in there.items()}


def bounded_read(spark: SparkSession, topic: OffsetTopic, max_messages: int) -> DataFrame:
    """The oldest messages of a topic, an equal share from each partition."""
    return topic.read_range(spark, first_ranges(topic.offsets(spark), max_messages))


def read_tail(
    spark: SparkSession, topic: OffsetTopic, positions: Positions | None = None,
    max_new: int = 10, back: int = TAIL_START,
) -> tuple[DataFrame, dict[int, int]]:
    """As ``incremental_tail``, of a topic that knows its offsets."""
    ranges, then = tail_ranges(topic.offsets(spark), positions, max_new, back)
    return topic.read_range(spark, ranges).orderBy("offset", "partition"), then


def read_last(
    spark: SparkSession, topic: OffsetTopic, max_messages: int = 300, time: str | None = None
) -> DataFrame:
    """As ``last_messages``, of a topic that knows its offsets."""
    ranges = last_ranges(topic.offsets(spark), max_messages)
    newest = topic.read_range(spark, ranges)
    if sum(end - start for start, end in ranges.values()) > max_messages:
        newest = newest.orderBy(F.desc(time or "offset"), "partition").limit(max_messages)
    return newest


def first_messages(
    df: DataFrame, max_messages: int, partition: str = "partition", offset: str = "offset"
) -> DataFrame:
    """The oldest messages, an equal share from each partition."""
    ranges = first_ranges(bounds(df, partition, offset), max_messages)
    return in_ranges(df, ranges, partition, offset)


def incremental_tail(
    df: DataFrame, positions: Positions | None = None, max_new: int = 10,
    partition: str = "partition", offset: str = "offset", back: int = TAIL_START,
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``max_new`` messages after the remembered positions, and the
    positions to remember next.

    The ends are asked for once. Rows and new positions both come from the closed
    range up to them, so a message that arrives meanwhile is read next time and
    none is passed over. Without positions the tail starts ``back`` messages before
    the end of each partition; a partition that was added since is read from its
    beginning.
    """
    ranges, then = tail_ranges(bounds(df, partition, offset), positions, max_new, back)
    return in_ranges(df, ranges, partition, offset).orderBy(offset, partition), then


def last_messages(
    df: DataFrame, max_messages: int = 300,
    partition: str = "partition", offset: str = "offset", time: str | None = None,
) -> DataFrame:
    """The newest messages, an equal share from each partition, at most
    ``max_messages`` in all.

    With more partitions than messages the newest by ``time`` are kept, or by
    offset where there is no time.
    """
    ends = end_positions(df, partition, offset)
    share = max(1, max_messages // max(1, len(ends)))
    newest = from_positions(df, {p: max(0, end - share) for p, end in ends.items()}, partition, offset)
    if share * len(ends) > max_messages:
        newest = newest.orderBy(F.desc(time or offset), partition).limit(max_messages)
    return newest
