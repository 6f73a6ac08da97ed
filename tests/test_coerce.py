import math

from murmullo.functions.coerce import (
    author_or_unknown, safe_bool, safe_double, safe_int, text_or_empty,
)
from murmullo.sources.tables import coerce_export, normalize_comments


def test_safe_int(values):
    inputs = ["7", "7.9", "-3.9", "NaN", "inf", "-inf", "x", "", None, " 12 ", "1e3", "1e30"]
    assert values(safe_int, inputs) == [7, 7, -3, 0, 0, 0, 0, 0, 0, 12, 1000, 0]
    assert values(safe_int, ["1d", "2f", "3D ", "4.F", "0x1F", "5"]) == [0, 0, 0, 0, 0, 5]
    assert values(safe_int, [2.9, float("nan"), None], "double") == [2, 0, 0]
    assert values(safe_int, [2**60 + 1, None], "bigint") in ([2**60, 0], [2**60 + 1, 0])


def test_safe_double(values):
    assert values(safe_double, ["1d", "2.5f", "2.5"]) == [0.0, 0.0, 2.5]
    found = values(safe_double, ["0.25", "nan", "x", None, "inf"])
    assert found[:4] == [0.25, 0.0, 0.0, 0.0] and math.isinf(found[4])


def test_safe_bool(values):
    found = values(safe_bool, ["true", "FALSE", "1", "0", "quizás", None, "yes"])
    assert found == [True, False, True, False, False, False, True]


def test_defaults(values):
    assert values(author_or_unknown, ["ana", None]) == ["ana", "desconocido"]
    assert values(text_or_empty, ["x", None]) == ["x", ""]


def test_normalize_fills_nulls_but_not_blanks(spark):
    rows = [
        ("a", "hola ", None, "3", "2024-01-01", "1"),
        ("b", None, "  del chat\n", "7.9", None, "x"),
        ("c", " \t", "no se usa", "1", "", "1"),
        ("d", None, None, "1", "", "1"),
        (None, " x ", "y", None, "", None),
    ]
    names = "autor string, comentario string, mensaje string, likes string, fecha string, respuestas string"
    found = normalize_comments(spark.createDataFrame(rows, names)).collect()
    assert sorted(tuple(r) for r in found) == [
        ("a", "hola", 3, "2024-01-01", 1),
        ("b", "del chat", 7, "", 0),
        ("desconocido", "x", 0, "", 0),
    ]


def test_normalize_without_optional_columns(spark):
    df = spark.createDataFrame([("hola",), ("",)], "comentario string")
    assert [tuple(r) for r in normalize_comments(df).collect()] == [
        ("desconocido", "hola", 0, "", 0)]


def test_coerce_export_leaves_other_columns(spark):
    df = spark.createDataFrame(
        [("1.7", "x", "true", "nada"), (None, "0.5", "huh", None)],
        "likes string, prob_odio string, es_odio string, extra string",
    )
    assert [tuple(r) for r in coerce_export(df).collect()] == [
        (1, 0.0, True, "nada"), (0, 0.5, False, None)]
