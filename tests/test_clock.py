"""Windows that close by the clock, late corrections, numbered batches and their compaction."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from murmullo.operators.recent import rolling_shares
from murmullo.operators.windows import throughput_windows
from murmullo.sources import store
from murmullo.streaming import batches, clock, jobs
from murmullo.streaming.progress import wait_until_idle

SCHEMA = "id bigint, ts timestamp, sentimiento string, es_odio boolean"


def _rows(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint").select(
        "id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"),
        F.when(F.col("id") % 3 == 0, "POS").when(F.col("id") % 3 == 1, "NEG").alias("sentimiento"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5 == 1).alias("es_odio"))


def _run(spark, metric, path, idle):
    query = jobs.start_clock_windows(metric, f"{path}/out", f"{path}/state", trigger="200 milliseconds")
    assert wait_until_idle(query, idle, timeout=120)
    query.stop()
    return spark.read.schema(metric.schema).parquet(f"{path}/out")


def test_an_idle_stream_gives_its_last_window_once(spark, tmp_path):
    path = str(tmp_path)
    _rows(spark, range(50)).write.parquet(f"{path}/in")

    def metric():
        return clock.clock_throughput(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"), 10, "ts", 1)

    found = _run(spark, metric(), path, 4)
    want = sorted(map(tuple, throughput_windows(_rows(spark, range(50)), "ts", 10).collect()))
    assert sorted(map(tuple, found.drop("revision").collect())) == want
    assert {r.revision for r in found.collect()} == {0}
    # A late message and one for a new window, after a restart.
    _rows(spark, [3, 300]).write.mode("append").parquet(f"{path}/in")
    again = _run(spark, metric(), path, 4)
    assert again.count() == len(want) + 2
    both = _rows(spark, [*range(50), 3, 300])
    assert sorted(map(tuple, clock.last_revisions(again).collect())) == sorted(
        map(tuple, throughput_windows(both, "ts", 10).collect()))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in provider  # other queries keep their store


def test_windows_of_the_machine_time_hold_every_message_once(spark, tmp_path):
    path = str(tmp_path)
    for part in (range(20), range(20, 50)):
        _rows(spark, part).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        found = _run(spark, clock.clock_sentiment(arriving, seconds=1), path, 4)
    rows = found.collect()
    assert sum(r.total_comentarios for r in rows) == 50
    assert len({r.ventana_fin for r in rows}) == len(rows)
    truth = _rows(spark, range(50)).collect()
    assert sum(r.positivos for r in rows) == sum(t.sentimiento == "POS" for t in truth)
    assert sum(r.odio for r in rows) == sum(bool(t.es_odio) for t in truth)
    assert all(r.neutrales == r.total_comentarios - r.positivos - r.negativos for r in rows)


def test_a_clock_needs_a_trigger_that_goes_on(spark, tmp_path):
    with pytest.raises(ValueError, match="goes on"):
        jobs.start_clock_windows(None, "x", "y", trigger="available")
    with pytest.raises(ValueError, match="together"):
        clock.clock_windows(spark.range(1), {"n": F.lit(1)}, 10, time="id")


def test_compaction_bounds_what_a_reader_opens(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = spark.createDataFrame([], "k int, v int").schema
    put = batches.keep_newest(path, schema, ["k"], every=20)
    truth = {}
    for number in range(200):
        rows = [(number % 7, number), (100 + number % 3, -number)]
        truth.update(rows)
        put(spark.createDataFrame(rows, schema).coalesce(1), number)
        if number in (59, 123):  # a batch is repeated, once while it was compacted
            put(spark.createDataFrame(rows, schema).coalesce(1), number)
        if number % 45 == 0:
            assert dict(map(tuple, jobs.read_latest_result(spark, path, schema, "k").collect())) == truth
    assert dict(map(tuple, jobs.read_latest_result(spark, path, schema, "k").collect())) == truth
    assert len([n for n in store.names(spark, path) if n.startswith("batch=")]) <= 40
    assert len(batches.snapshots(spark, path)) <= 2
    assert len(batches.read_batches(spark, path, schema).inputFiles()) <= 25


def test_a_half_written_batch_is_not_read(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 1)], "k int, v int")
    batches.put_batch(df, path, 0)
    df.write.parquet(f"{path}/batch=1")  # no mark
    assert batches.read_batches(spark, path, df.schema).count() == 1
    assert batches.read_batches(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_a_reader_that_has_begun_finds_its_files(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = spark.createDataFrame([], "k int, v int").schema
    put = batches.keep_newest(path, schema, ["k"], every=2)
    for number in range(4):
        put(spark.createDataFrame([(number, number)], schema), number)
    begun = jobs.read_latest_result(spark, path, schema, "k")
    for number in range(4, 6):  # one more compaction
        put(spark.createDataFrame([(number, number)], schema), number)
    assert begun.count() == 4


def test_a_crash_between_two_sinks(spark, tmp_path):
    path, failed = str(tmp_path), []
    _rows(spark, range(40)).repartition(4).write.parquet(f"{path}/in")
    arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    reads = spark.sparkContext.accumulator(0)

    def seen(found):
        for batch in found:
            reads.add(batch.num_rows)
            yield batch

    def second(batch):
        if batch.count() and len(failed) < 1:
            failed.append(1)
            raise RuntimeError("down")
        return batch.filter("es_odio")

    sinks = {"all": (f"{path}/a", lambda b: b), "hate": (f"{path}/b", second)}
    rows = arriving.mapInArrow(seen, SCHEMA)
    query = jobs.start_sinks(rows, sinks, f"{path}/state", trigger="available")
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    first = reads.value
    assert 0 < first < 40
    jobs.start_sinks(rows, sinks, f"{path}/state", trigger="available").awaitTermination()
    assert reads.value == 40 + first  # the batch that failed once more, every other once
    everything = batches.read_batches(spark, f"{path}/a", arriving.schema)
    assert sorted(r.id for r in everything.collect()) == list(range(40))
    hate = batches.read_batches(spark, f"{path}/b", arriving.schema)
    assert sorted(r.id for r in hate.collect()) == [i for i in range(40) if i % 5 == 1]


def test_running_shares_over_batches_and_restarts(spark, tmp_path):
    path = str(tmp_path)
    whole = rolling_shares(_rows(spark, range(95)), "id", 20, chunk=32)
    for part in (range(3), range(3, 40), range(40, 41), range(41, 95)):
        _rows(spark, part).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        jobs.start_rolling_shares(arriving, "id", f"{path}/out", f"{path}/state", trigger="available",
                                  size=20, chunk=32).awaitTermination()
    put = batches.rolling_batches(f"{path}/out", "id", arriving.schema, 20, chunk=32)
    put(_rows(spark, range(41, 95)), 3)  # the last batch is repeated
    found = batches.read_batches(spark, f"{path}/out", whole.schema).drop("batch")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert len(store.names(spark, f"{path}/out/tail")) <= 4
