"""Offsets that are asked for and not read: brokers, file footers, closed ranges."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from murmullo.sources import store
from murmullo.sources.tables import TooFewRows, export_table, read_table, write_gated
from murmullo.sources.topics import (
    KafkaTopic, TableTopic, bounded_read, first_ranges, incremental_tail, last_messages, last_ranges,
    read_last, read_tail, tail_ranges,
)


@pytest.fixture(scope="module")
def messages(spark):
    return spark.range(30_000).select(
        (F.col("id") % 3).cast("int").alias("partition"), (F.col("id") / 3).cast("bigint").alias("offset"),
        F.concat(F.lit("m"), "id").alias("value"))


@pytest.fixture(scope="module")
def archive(spark, messages, tmp_path_factory):
    topic = TableTopic(str(tmp_path_factory.mktemp("archive") / "topic"))
    for low in range(0, 10_000, 2500):  # four files for each partition
        topic.write_batch(messages.filter(F.col("offset").between(low, low + 2499)))
    return topic


def _scanned(df):
    """Rows that the scans of a plan gave."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        for method in ("executedPlan", "finalPhysicalPlan", "plan"):
            if name.startswith(("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage")) and hasattr(node, method):
                try:
                    nodes.append(getattr(node, method)())
                    break
                except Exception:
                    continue
        if name.startswith(("Scan", "BatchScan")):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_bounds_come_from_the_footers(spark, archive):
    plan = archive.bounds_query(spark)._jdf.queryExecution().toString()
    assert "PushedAggregation: [MIN(offset), MAX(offset)]" in plan and "PushedGroupBy: [partition]" in plan
    assert archive.offsets(spark) == {p: (0, 10_000) for p in range(3)}
    # The session itself keeps its settings.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_only_the_range_is_scanned(spark, archive):
    few = bounded_read(spark, archive, 999)
    assert few.count() == 999
    assert _scanned(bounded_read(spark, archive, 999)) <= 3 * 2500
    last = read_last(spark, archive, 300)
    assert last.count() == 300 and _scanned(read_last(spark, archive, 300)) <= 3 * 2500
    assert archive.read_range(spark, {0: (5, 5)}).count() == 0
    assert _scanned(archive.read_range(spark, {1: (2600, 2700)})) <= 2500


def test_the_same_rows_as_from_a_scan(spark, archive, messages):
    order = lambda df: sorted(map(tuple, df.select("partition", "offset", "value").collect()))
    assert order(read_last(spark, archive, 300)) == order(last_messages(messages, 300))
    positions, other = None, None
    for _ in range(3):
        rows, positions = read_tail(spark, archive, positions, 10)
        same, other = incremental_tail(messages, other, 10)
        assert order(rows) == order(same) and positions == other
    assert order(archive.read_batch(spark, 100)) == order(bounded_read(spark, archive, 100))


def test_ranges():
    there = {0: (100, 200), 1: (0, 5), 2: (7, 7)}
    assert first_ranges(there, 20) == {0: (100, 115), 1: (0, 5), 2: (7, 7)}
    assert last_ranges(there, 30) == {0: (190, 200), 1: (0, 5), 2: (7, 7)}
    ranges, then = tail_ranges(there, {0: 50, 1: 3}, 10)
    assert ranges == {0: (100, 108), 1: (3, 5), 2: (7, 7)} and then == {0: 108, 1: 5, 2: 7}
    assert first_ranges({}, 5) == {} and last_ranges({}, 5) == {}


class Brokers:
    """What a client sees of a topic with two partitions."""

    def __init__(self, settings):
        self.settings, self.closed = settings, False
        Brokers.last = self

    def partitionsFor(self, name):
        return [SimpleNamespace(partition=lambda p=p: p) for p in (0, 1)]

    def beginningOffsets(self, parts):
        return {p: 10 * p.partition() for p in parts}

    def endOffsets(self, parts):
        return {p: 100 + p.partition() for p in parts}

    def offsetsForTimes(self, times):
        return {p: SimpleNamespace(offset=lambda: 40) if p.partition() == 0 else None for p in times}

    def close(self):
        self.closed = True


class _Part:
    def __init__(self, name, number):
        self.partition = lambda: number


class _List(list):
    add = list.append


class _Map(dict):
    def put(self, key, value):
        self[key] = value

    setProperty = put


def _fake(consumer):
    java = SimpleNamespace(
        util=SimpleNamespace(Properties=_Map, ArrayList=_List, HashMap=_Map), lang=SimpleNamespace(Long=int))
    kafka = SimpleNamespace(
        clients=SimpleNamespace(consumer=SimpleNamespace(KafkaConsumer=consumer)),
        common=SimpleNamespace(TopicPartition=_Part))
    org = SimpleNamespace(apache=SimpleNamespace(kafka=kafka))
    return SimpleNamespace(_jvm=SimpleNamespace(java=java, org=org))


def test_brokers_are_asked_and_nothing_is_read():
    topic = KafkaTopic("h:9092", "t", {"kafka.security.protocol": "SSL", "failOnDataLoss": "false"})
    assert topic.offsets(_fake(Brokers)) == {0: (0, 100), 1: (10, 101)}
    assert Brokers.last.closed and Brokers.last.settings["bootstrap.servers"] == "h:9092"
    assert Brokers.last.settings["security.protocol"] == "SSL" and "failOnDataLoss" not in Brokers.last.settings
    assert topic.offsets(_fake(Brokers), since_ms=5) == {0: (40, 100), 1: (101, 101)}


def test_a_missing_connector_is_told():
    with pytest.raises(RuntimeError, match="connector"):
        KafkaTopic("h", "t").offsets(_fake("a package, not a class"))


def test_a_bounded_read_is_one_closed_range(monkeypatch):
    seen = []
    monkeypatch.setattr(KafkaTopic, "read_range", lambda self, spark, ranges: seen.append(ranges))
    KafkaTopic("h", "t").read_batch(_fake(Brokers), max_messages=50)
    assert seen == [{0: (0, 25), 1: (10, 35)}]


def test_the_gate_reads_its_input_once(spark, tmp_path):
    path, rows = str(tmp_path / "out"), spark.range(20)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    counted = rows.mapInArrow(seen, "id bigint")
    assert write_gated(counted, path, 10) == 20
    assert reads.value == 20
    with pytest.raises(TooFewRows, match="20 rows found, 21 needed"):
        write_gated(rows, path, 21)
    assert read_table(spark, path).count() == 20
    write_gated(spark.range(3), path)
    assert read_table(spark, path).count() == 3
    assert store.names(spark, str(tmp_path)) == ["out"]
    with pytest.raises(TooFewRows):
        export_table(spark.range(0), [str(tmp_path / "none")], 1)
    assert store.names(spark, str(tmp_path)) == ["out"]
