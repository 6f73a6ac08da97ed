import json

import pytest
from pyspark.sql import functions as F

from murmullo.schemas import FINAL, RAW
from murmullo.sources.records import (
    decode, encode, good_records, malformed_lines, parse_record, set_fields, text_field,
)
from murmullo.streaming.jobs import parsed

LINES = [
    '{"autor":"a","comentario":"x","likes":7,"fecha":"","respuestas":1}',
    '{"autor":"b","comentario":"y","likes":"7.9","fecha":"","respuestas":3.7}',
    '{"autor":5,"comentario":"z","likes":"x","extra":{"n":[1,2]}}',
    "", "   \t", "{bad", "[1,2]", '{"autor":"c","likes":NaN}', '{"autor":"d","autor":"e"}', "7",
]


@pytest.fixture()
def lines(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "i int, value string")


def test_decode_types_and_defaults(lines):
    found = {r.i: tuple(r)[1:] for r in decode(lines, RAW).collect()}
    assert found == {
        0: ("a", "x", 7, "", 1), 1: ("b", "y", 7, "", 3), 2: ("5", "z", 0, None, 0),
    }


def test_quarantine_holds_malformed_lines_only(lines):
    assert sorted(r.value for r in malformed_lines(lines, RAW).collect()) == sorted(
        ["7", "[1,2]", "{bad", *LINES[7:9]])
    assert good_records(lines, RAW).count() == 3


def test_streams_and_exports_agree_on_what_a_record_is(lines):
    skipped = parsed(lines.filter("trim(value) <> ''"), "skip").select("i").collect()
    assert sorted(skipped) == sorted(good_records(lines, RAW).select("i").collect())


def test_each_line_is_parsed_once(lines):
    plan = decode(lines, RAW)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1


def test_truthiness_is_not_copied(spark):
    df = spark.createDataFrame([('{"es_odio":"false","prob_odio":"0.5"}',), ('{"es_odio":true}',)], "value string")
    assert [(r.es_odio, r.prob_odio) for r in decode(df, FINAL).collect()] == [(False, 0.5), (True, 0.0)]


def test_encode_is_json_of_all_columns(spark):
    df = spark.createDataFrame([("ñ\n\"", 1, True)], "a string, b long, c boolean")
    assert json.loads(encode(df).first().value) == {"a": "ñ\n\"", "b": 1, "c": True}
    assert json.loads(encode(df, "b").first().value) == {"b": 1}


def test_merge_keeps_unknown_fields(spark):
    text = '{"a":1,"n":{"x":[1,null,"ñ"]},"es_odio":"viejo","z":null}'
    df = spark.createDataFrame([(text,), ("{bad",), ("[1]",)], "value string")
    fields = {"es_odio": F.lit(True), "prob_odio": F.lit(0.5), "t": F.lit("a\"b")}
    updated = F.to_json(set_fields(parse_record(F.col("value")), fields))
    found = [r[0] for r in df.select(updated).collect()]
    assert json.loads(found[0]) == {
        "a": 1, "n": {"x": [1, None, "ñ"]}, "z": None, "es_odio": True, "prob_odio": 0.5, "t": "a\"b"}
    assert found[1:] == [None, None]


def test_text_field(spark):
    df = spark.createDataFrame([('{"a":"x","b":2}',), ("{}",)], "value string")
    record = parse_record(F.col("value"))
    found = df.select(text_field(record, "a").alias("a"), text_field(record, "b").alias("b"))
    assert [tuple(r) for r in found.collect()] == [("x", "2"), (None, None)]
