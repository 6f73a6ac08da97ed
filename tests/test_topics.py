import pytest
from pyspark.sql import functions as F

from murmullo.sources.tables import (
    TooFewRows, export_table, read_parts, require_rows, write_table,
)
from murmullo.sources.topics import (
    FileTopic, KafkaTopic, decode_value, end_positions, first_messages, from_positions,
    incremental_tail, last_messages, next_ranges,
)


def test_kafka_options():
    topic = KafkaTopic("h1:9092,h2:9092", "comentarios-raw", {"kafka.security.protocol": "SSL"})
    assert topic.source_options("latest", 500, "clean") == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "comentarios-raw",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "500", "groupIdPrefix": "clean",
        "kafka.security.protocol": "SSL",
    }
    assert "maxOffsetsPerTrigger" not in topic.source_options()
    since = topic.source_options(since_ms=5)
    assert since["startingTimestamp"] == "5"
    assert since["startingOffsetsByTimestampStrategy"] == "latest"
    assert "startingOffsetsByTimestampStrategy" not in topic.source_options()
    ranges = topic.range_options({1: (3, 9), 0: (0, 7)})
    assert ranges["startingOffsets"] == '{"comentarios-raw": {"0": 0, "1": 3}}'
    assert ranges["endingOffsets"] == '{"comentarios-raw": {"0": 7, "1": 9}}'
    assert topic.positions('{"comentarios-raw":{"0":7,"12":9}}') == {0: 7, 12: 9}
    assert topic.sink_options()["topic"] == "comentarios-raw"


def test_invalid_utf8_is_replaced(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray("ñ".encode()),)], "value binary")
    assert [r[0] for r in df.select(decode_value(df.value)).collect()] == ["a�b", "ñ"]


def test_file_topic_appends_and_bounds(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "t"))
    for part in range(2):
        topic.write_batch(spark.range(5).select(F.to_json(F.struct("id")).alias("value")))
    assert topic.read_batch(spark).count() == 10
    assert topic.read_batch(spark, 3).count() == 3
    assert topic.read_batch(spark).columns[:2] == ["value", "timestamp"]


@pytest.fixture()
def messages(spark):
    """Partition 0 holds offsets 0-99, 1 holds 0-9, 2 holds 5-24."""
    rows = [(0, i) for i in range(100)] + [(1, i) for i in range(10)] + [(2, i) for i in range(5, 25)]
    return spark.createDataFrame(rows, "partition int, offset long")


def test_positions(messages):
    assert end_positions(messages) == {0: 100, 1: 10, 2: 25}
    found = from_positions(messages, {0: 98, 2: 0}).groupBy("partition").count().collect()
    assert {r.partition: r["count"] for r in found} == {0: 2, 1: 10, 2: 20}
    assert from_positions(messages, {}).count() == 130


def test_shares_are_equal_and_nothing_is_left_over():
    assert next_ranges({}, {0: 100, 1: 2, 2: 100}, 20) == {0: (0, 9), 1: (0, 2), 2: (0, 9)}
    assert next_ranges({0: 95}, {0: 100, 1: 1}) == {0: (95, 100), 1: (0, 1)}
    assert next_ranges({0: 9}, {0: 5}, 3) == {0: (9, 9)}
    assert sum(b - a for a, b in next_ranges({}, {p: 50 for p in range(7)}, 10).values()) == 10


def test_tail_starts_before_the_end(messages):
    rows, positions = incremental_tail(messages, max_new=9)
    found = {(r.partition, r.offset) for r in rows.collect()}
    assert found == {(0, 80), (0, 81), (0, 82), (1, 0), (1, 1), (1, 2), (2, 5), (2, 6), (2, 7)}
    assert positions == {0: 83, 1: 3, 2: 8}
    assert incremental_tail(messages, max_new=90, back=1)[0].count() == 3


def test_tail_reads_everything_once(messages):
    positions, seen = {0: 0, 1: 0, 2: 0}, []
    while True:
        taken, positions = incremental_tail(messages, positions, max_new=33)
        rows = [tuple(r) for r in taken.collect()]
        if not rows:
            break
        assert len(rows) <= 33
        seen += rows
    assert len(seen) == 130 and len(set(seen)) == 130
    assert positions == {0: 100, 1: 10, 2: 25}


def test_no_partition_waits_for_another(spark):
    rows = [(0, i) for i in range(1000)] + [(1, 10**6 + i) for i in range(1000)]
    topic = spark.createDataFrame(rows, "partition int, offset long")
    taken, _ = incremental_tail(topic, {0: 0, 1: 10**6}, max_new=10)
    counts = {r["partition"]: r["count"] for r in taken.groupBy("partition").count().collect()}
    assert counts == {0: 5, 1: 5}


def test_a_growing_topic_loses_nothing(spark, tmp_path):
    """Messages that arrive between the call and the reading come next time."""
    path, sent = str(tmp_path / "grow"), 0

    def send(n):
        nonlocal sent
        rows = [(i % 2, i // 2) for i in range(sent, sent + n)]
        spark.createDataFrame(rows, "partition int, offset long").write.mode("append").parquet(path)
        sent += n

    send(40)
    positions, seen = {0: 0, 1: 0}, []
    for _ in range(6):
        topic = spark.read.parquet(path)
        taken, after = incremental_tail(topic, positions, max_new=1000)
        send(20)  # after the ends were asked for, before the rows are read
        again = incremental_tail(spark.read.parquet(path), positions, max_new=1000)
        seen += [tuple(r) for r in taken.collect()]
        assert again[1] != after
        positions = after
    taken, positions = incremental_tail(spark.read.parquet(path), positions, max_new=1000)
    seen += [tuple(r) for r in taken.collect()]
    assert len(seen) == sent == len(set(seen))


def test_first_messages(messages):
    found = {(r.partition, r.offset) for r in first_messages(messages, 12).collect()}
    assert found == {(p, i + (5 if p == 2 else 0)) for p in range(3) for i in range(4)}
    assert first_messages(messages, 10**6).count() == 130


def test_the_newest_messages_are_kept(spark):
    rows = [(0, 5, 1), (1, 2, 9), (2, 90, 3)]
    topic = spark.createDataFrame(rows, "partition int, offset long, time long")
    assert [r.partition for r in last_messages(topic, 1).collect()] == [2]
    assert [r.partition for r in last_messages(topic, 1, time="time").collect()] == [1]


def test_last_messages_takes_an_equal_share(messages):
    found = {(r.partition, r.offset) for r in last_messages(messages, 30).collect()}
    assert found == {(0, i) for i in range(90, 100)} | {(1, i) for i in range(10)} | {(2, i) for i in range(15, 25)}
    assert last_messages(messages, 2).count() == 2
    assert last_messages(messages.limit(0), 5).count() == 0


def test_tail_limits_reach_the_scan(spark, messages, tmp_path):
    messages.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    plan = last_messages(stored, 30)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,90)" in plan


def test_read_parts(spark, tmp_path):
    path, df = str(tmp_path / "p"), spark.range(3)
    assert read_parts(spark, path, df.schema).count() == 0
    write_table(df, path, "append")
    write_table(df, path, "append")
    assert read_parts(spark, path, df.schema).count() == 6
    write_table(df, path)
    assert read_parts(spark, path, df.schema).count() == 3


def test_row_gate(spark):
    assert require_rows(spark.range(10), 10).count() == 10
    with pytest.raises(TooFewRows, match="9 rows found, 10 needed"):
        require_rows(spark.range(9), 10)


def test_a_failed_copy_does_not_fail_the_export(spark, tmp_path):
    good = str(tmp_path / "a")
    done = export_table(spark.range(4), [good, "nofs://bucket/b", str(tmp_path / "c")])
    assert done == [good, str(tmp_path / "c")]
    assert spark.read.parquet(done[1]).count() == 4
    with pytest.raises(Exception):
        export_table(spark.range(4), ["nofs://bucket/b"])


def test_a_compressed_topic_holds_all_records_in_small_files(spark, tmp_path):
    """Its files are smaller than the text, and bounded, as none of them can be split."""
    rows = spark.range(2500).select(F.concat(F.lit('{"texto":"uno dos tres","n":'), "id", F.lit("}")).alias("value"))
    first, second = [FileTopic(str(tmp_path / n), "gzip", 1000) for n in ("a", "b")]
    first.write_batch(rows.coalesce(1))
    second.write_stream(first.read_stream(spark)).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    size = sum(len(r.value) + 1 for r in rows.collect())
    for topic in (first, second):
        files = list((tmp_path / topic.path).glob("*.gz"))
        assert len(files) >= 3 and sum(f.stat().st_size for f in files) < size / 3
        found = topic.read_batch(spark)
        assert found.select("value").exceptAll(rows).count() == 0 and found.count() == 2500
        most = found.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert most <= 1000
    plain = FileTopic(str(tmp_path / "c"))
    plain.write_batch(rows)
    assert not list((tmp_path / "c").glob("*.gz")) and plain.read_batch(spark).count() == 2500
