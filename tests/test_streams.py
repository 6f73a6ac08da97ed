import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from murmullo.operators.scorers import lexicon_scorer
from murmullo.operators.stages import enrich, final_columns
from murmullo.operators.windows import sentiment_windows, throughput_windows
from murmullo.schemas import FINAL, NEUTRAL, RAW, SENTIMENT_LABELS
from murmullo.sources.records import decode, encode
from murmullo.sources.topics import FileTopic
from murmullo.streaming import jobs
from murmullo.streaming.buffer import read_buffer, start_buffer
from murmullo.streaming.progress import Progress, ProgressLog, recent_progress

HATE = lexicon_scorer({"CALLS": ["idiota"], "CLASS": ["basura"]})
MOOD = lexicon_scorer({"POS": ["bien"], "NEG": ["mal", "idiota"]}, SENTIMENT_LABELS, rest_label=NEUTRAL)

RECORDS = [
    {"autor": "a", "comentario": "IDIOTA!! basura basura", "likes": 3, "fecha": "", "respuestas": 0, "id": 7},
    {"autor": "b", "comentario": "todo bien 😂", "likes": 1, "fecha": "", "respuestas": 2, "x": {"y": [1]}},
    {"autor": "c", "comentario": "https://a.b", "likes": 0, "fecha": "", "respuestas": 0},
]


@pytest.fixture()
def lines(spark):
    return lambda records: spark.createDataFrame(
        [(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def _finish(query):
    query.awaitTermination()
    return query


def test_stages_linked_by_topics_keep_unknown_fields(spark, tmp_path, lines):
    raw, clean, classified, final = [FileTopic(str(tmp_path / n)) for n in "abcd"]
    raw.write_batch(lines(RECORDS))
    hops = [
        (raw, clean, jobs.clean_stage()), (clean, classified, jobs.hate_stage(HATE)),
        (classified, final, jobs.sentiment_stage(MOOD)),
    ]
    for source, sink, stage in hops:
        _finish(jobs.start_stage(spark, source, sink, stage, sink.path + "-ck", trigger="available"))
    found = {r["autor"]: r for r in map(json.loads, [x.value for x in final.read_batch(spark).collect()])}
    assert found["a"] == {
        **RECORDS[0], "comentario_limpio": "idiota basura basura", "es_odio": True, "prob_odio": 0.5,
        "categoria_odio": "CLASS", "sentimiento": "NEU", "prob_sentimiento": 0.667}
    assert found["b"]["x"] == {"y": [1]}
    assert found["c"]["categoria_odio"] == "sin_texto" and found["c"]["sentimiento"] == "NEU"


def test_one_query_gives_the_same_as_the_batch_form(spark, tmp_path, lines):
    raw, final = FileTopic(str(tmp_path / "raw")), FileTopic(str(tmp_path / "final"))
    raw.write_batch(lines(RECORDS))
    query = _finish(jobs.start_enrichment(
        spark, raw, final, HATE, MOOD, str(tmp_path / "ck"), name="enrich", trigger="available", metrics="comentarios"))
    streamed = decode(final.read_batch(spark).select("value"), FINAL).collect()
    batch = final_columns(enrich(decode(lines(RECORDS), RAW), HATE, MOOD)).collect()
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, batch))
    counts = [p.observedMetrics["comentarios"] for p in query.recentProgress if p.numInputRows]
    assert sum(c.total for c in counts) == 3 and sum(c.n_odio for c in counts) == 1


def test_malformed_records_fail_or_are_skipped(spark, tmp_path, lines):
    raw = FileTopic(str(tmp_path / "raw"))
    raw.write_batch(lines([*RECORDS, "{bad"]))
    bad = jobs.start_stage(
        spark, raw, FileTopic(str(tmp_path / "x")), jobs.clean_stage(), str(tmp_path / "ck1"), trigger="available")
    with pytest.raises(StreamingQueryException, match="malformed record"):
        bad.awaitTermination()
    whole = jobs.start_enrichment(
        spark, raw, FileTopic(str(tmp_path / "z")), HATE, MOOD, str(tmp_path / "ck4"), trigger="available")
    with pytest.raises(StreamingQueryException, match="malformed record"):
        whole.awaitTermination()
    out = FileTopic(str(tmp_path / "y"))
    _finish(jobs.start_stage(
        spark, raw, out, jobs.clean_stage(), str(tmp_path / "ck2"), trigger="available", on_malformed="skip"))
    assert out.read_batch(spark).count() == 3
    with pytest.raises(ValueError):
        jobs.start_stage(spark, raw, out, jobs.clean_stage(), str(tmp_path / "ck3"), on_malformed="?")


def test_restart_goes_on_where_it_stopped(spark, tmp_path, lines):
    raw, out = FileTopic(str(tmp_path / "raw")), FileTopic(str(tmp_path / "out"))
    start = lambda: jobs.start_stage(
        spark, raw, out, jobs.clean_stage(), str(tmp_path / "ck"), trigger="available", max_per_trigger=1)
    raw.write_batch(lines(RECORDS[:2]).repartition(2))
    _finish(start())
    assert out.read_batch(spark).count() == 2
    raw.write_batch(lines(RECORDS[2:]))
    _finish(start())
    _finish(start())
    values = [json.loads(r.value)["autor"] for r in out.read_batch(spark).collect()]
    assert sorted(values) == ["a", "b", "c"]


def test_two_jobs_read_one_topic(spark, tmp_path, lines):
    raw, out, metric = [FileTopic(str(tmp_path / n)) for n in ("raw", "out", "metric")]
    raw.write_batch(lines(RECORDS))
    one = jobs.start_stage(spark, raw, out, jobs.clean_stage(), str(tmp_path / "c1"), trigger="available")
    two = jobs.start_throughput(spark, raw, metric, str(tmp_path / "c2"), late="0 seconds", trigger="available")
    _finish(one), _finish(two)
    assert out.read_batch(spark).count() == 3
    # All records arrived at once, in the window that is still open.
    assert metric.read_batch(spark).count() == 0


EVENTS = "ts timestamp, sentimiento string, es_odio boolean"


def _events(spark, seconds):
    rows = [(s, ["POS", "NEG", "NEU", None][i % 4], i % 3 == 0) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "s long, sentimiento string, es_odio boolean").select(
        F.timestamp_seconds("s").alias("ts"), "sentimiento", "es_odio")


def _read(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def test_windows_of_a_stream_equal_the_batch_form(spark, tmp_path):
    events = _events(spark, [i * 7 for i in range(300)])
    path = str(tmp_path / "in")
    events.repartition(4).write.parquet(path)
    last = 299 * 7
    for stream, batch, seconds in [
        (jobs.throughput_stream, throughput_windows, 10), (jobs.sentiment_stream, sentiment_windows, 60),
    ]:
        out = str(tmp_path / stream.__name__)
        df = stream(_read(spark, path, EVENTS), "ts", seconds, late="0 seconds")
        _finish(jobs.start_parquet_sink(df, out, out + "-ck", trigger="available"))
        closed = batch(events, "ts", seconds).filter(F.col("ventana_fin") <= last)
        assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, closed.collect()))


def test_complete_result_has_the_open_window_too(spark, tmp_path):
    events = _events(spark, range(0, 130, 10))
    events.write.parquet(str(tmp_path / "in"))
    df = jobs.sentiment_stream(_read(spark, str(tmp_path / "in"), EVENTS), "ts", 60, late="10 seconds")
    out = str(tmp_path / "out")
    _finish(jobs.start_latest_result(df, out, out + "-ck", trigger="available"))
    found = jobs.read_latest_result(spark, out, df.schema, "ventana_fin")
    assert sorted(map(tuple, found.collect())) == sorted(
        map(tuple, sentiment_windows(events, "ts", 60).collect()))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        df = jobs.throughput_stream(_read(spark, path, EVENTS), "ts", 10, late="20 seconds")
        return _finish(jobs.start_parquet_sink(df, out, out + "-ck", trigger="available"))

    _events(spark, [0, 5, 100]).write.mode("append").parquet(path)
    run()
    _events(spark, [3, 79, 85, 200]).write.mode("append").parquet(path)
    progress = recent_progress(run())
    assert progress.late_rows >= 2 and progress.rows == 4
    found = {r.ventana_fin: r.cantidad_mensajes for r in spark.read.parquet(out).collect()}
    assert found == {10: 2, 90: 1, 110: 1}


def test_buffer_keeps_the_newest_over_batches(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "partition int, offset long, v string"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        df = _read(spark, path, schema)
        _finish(start_buffer(df, out, out + "-ck", "offset", "partition", size=5, trigger="available"))
        found = read_buffer(spark, out, df.schema).collect()
        return sorted((r.offset, r.partition) for r in found)

    assert run([(0, i, "x") for i in range(3)]) == [(0, 0), (1, 0), (2, 0)]
    assert run([(1, i, "x") for i in range(4)]) == [(1, 0), (1, 1), (2, 0), (2, 1), (3, 1)]
    assert run([(0, 0, "viejo")]) == [(1, 0), (1, 1), (2, 0), (2, 1), (3, 1)]
    assert run([(0, 50 + i, "x") for i in range(9)]) == [(54 + i, 0) for i in range(5)]
    for i in range(6):
        newest = run([(2, 100 + i, "x")])
    assert newest == [(101 + i, 2) for i in range(5)]
    assert len(list((tmp_path / "out").glob("slot=*"))) == 8


def test_a_new_checkpoint_starts_the_buffer_afresh(spark, tmp_path):
    path, out, schema = str(tmp_path / "in"), str(tmp_path / "out"), "offset long"
    for i in range(3):
        spark.createDataFrame([(i,)], schema).write.mode("append").parquet(path)
        df = _read(spark, path, schema)
        _finish(start_buffer(df, out, out + "-a", "offset", size=2, trigger="available"))
    df = _read(spark, path, schema)
    _finish(start_buffer(df, out, out + "-b", "offset", size=1, trigger="available"))
    assert [r.offset for r in read_buffer(spark, out, df.schema).collect()] == [2]
    assert len(list((tmp_path / "out").glob("slot=*"))) == 1


def test_sentiment_metric_topic(spark, tmp_path, lines):
    final, metric = FileTopic(str(tmp_path / "final")), FileTopic(str(tmp_path / "metric"))
    final.write_batch(lines([{"sentimiento": "POS", "es_odio": True}, {"sentimiento": "NEG"}, {}]))
    query = jobs.start_sentiment_windows(spark, final, metric, str(tmp_path / "ck"), late="10 seconds",
        trigger="available")
    assert recent_progress(_finish(query)).rows == 3


def test_progress_log_counts_rows(spark, tmp_path, lines):
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        raw, out = FileTopic(str(tmp_path / "raw")), FileTopic(str(tmp_path / "out"))
        raw.write_batch(lines(RECORDS))
        query = _finish(jobs.start_stage(
            spark, raw, out, jobs.clean_stage(), str(tmp_path / "ck"), trigger="available"))
        import time

        for _ in range(50):
            if log.total(query).rows:
                break
            time.sleep(0.1)
        assert log.total(query).rows == 3
    finally:
        spark.streams.removeListener(log)
    assert Progress() == Progress(0, 0, 0.0, 0)


def test_triggers():
    assert jobs.trigger_options(None) == {}
    assert jobs.trigger_options("available") == {"availableNow": True}
    assert jobs.trigger_options("20 seconds") == {"processingTime": "20 seconds"}


def test_encode_of_a_metric(spark):
    df = throughput_windows(_events(spark, [0, 1]), "ts")
    assert json.loads(encode(df).first().value) == {
        "ventana_fin": 10, "cantidad_mensajes": 2, "throughput_msg_seg": 0.2}
