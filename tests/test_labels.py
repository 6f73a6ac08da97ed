from murmullo.functions import labels as lb


def test_correlation_texts(values):
    texts = values(lb.correlation_text, [0.1, 0.11, -0.1, -0.11, None], "double")
    assert texts == [lb.NO_RELATION, lb.MORE_LIKES, lb.NO_RELATION, lb.FEWER_LIKES, lb.NO_RELATION]
    short = values(lb.correlation_label, [0.05, 0.1, -0.1, None], "double")
    assert short == ["Sin correlación", "Positiva", "Negativa", "Sin correlación"]


def test_names(values):
    assert values(lb.category_name, ["CLASS", "ninguna", "otra", None]) == ["Clasismo", "Sin odio", "otra", None]


def test_clock(values):
    assert values(lb.clock, ["0", "86399.9", "x", None]) == ["00:00:00", "23:59:59", None, None]


def test_bands(values):
    assert values(lb.hate_band, [0.0, 24.99, 25.0, 50.0, 100.0, 101.0], "double") == [
        "bajo", "bajo", "medio", "alto", "alto", None]


def test_severity(spark):
    rows = [(True, "POS"), (False, "NEG"), (None, "POS"), (False, "NEU"), (False, None)]
    df = spark.createDataFrame(rows, "f boolean, s string")
    assert [r[0] for r in df.select(lb.severity(df.f, df.s)).collect()] == [
        "odio", "negativo", "positivo", "neutral", "neutral"]
