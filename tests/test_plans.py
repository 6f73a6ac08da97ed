"""The physical plans are the ones meant to run at scale."""

import pytest

from checks import views
from murmullo.operators.correlation import likes_correlation
from murmullo.operators.recent import rolling_shares
from murmullo.operators.risk import user_risk_score
from murmullo.operators.stages import clean, enrich
from murmullo.operators.terms import top_hate_terms
from murmullo.operators.trend import hourly_trend
from murmullo.schemas import FINAL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "final")
    rows = [("a", "x", 1, "2024-01-01", 0, "uno dos", i % 2 == 0, 0.5, "CALLS", "POS", 0.5) for i in range(20)]
    spark.createDataFrame(rows, FINAL).write.parquet(path)
    return spark.read.schema(FINAL).parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _read_columns(plan):
    part = plan.split("ReadSchema: struct<")[1].split(">")[0]
    return sorted(c.split(":")[0] for c in part.split(","))


def test_top_terms_push_the_flag_and_read_two_columns(stored):
    plan = _plan(top_hate_terms(stored))
    assert "EqualTo(es_odio,true)" in plan and "TakeOrderedAndProject" in plan
    assert _read_columns(plan) == ["comentario_limpio", "es_odio"]
    assert "partial_count" in plan


def test_reports_read_only_their_columns(stored):
    assert _read_columns(_plan(user_risk_score(stored))) == ["autor", "es_odio", "likes"]
    assert _read_columns(_plan(hourly_trend(stored))) == ["es_odio", "fecha"]


def test_correlation_scans_once(stored):
    plan = _plan(likes_correlation(stored))
    assert plan.count("FileScan") == 1
    assert _read_columns(plan) == ["es_odio", "likes", "prob_odio"]
    assert "partial_var" in plan or "partial_" in plan


def test_trend_scans_once_and_has_one_shuffle_of_the_data(stored):
    plan = _plan(hourly_trend(stored))
    assert plan.count("FileScan") == 1 and plan.count("hashpartitioning") == 1


def test_record_stages_stay_out_of_python_and_do_not_shuffle(stored):
    raw = stored.select("autor", "comentario", "likes", "fecha", "respuestas")
    plan = _plan(enrich(raw, *views.scorers()))
    assert "Python" not in plan and "Exchange" not in plan
    assert "Python" not in _plan(clean(raw))


def test_a_filter_on_a_score_does_not_repeat_the_cleaning(stored):
    raw = stored.select("autor", "comentario", "likes", "fecha", "respuestas")
    def costly(df):
        plan = _plan(df).lower()
        return [plan.count(x) for x in ("regexp_replace", "split(", "regexp_extract_all")]

    once = costly(enrich(raw, *views.scorers()))
    kept = enrich(raw, *views.scorers()).filter("es_odio AND sentimiento = 'NEG'")
    assert costly(kept) == once


def test_a_filter_on_a_raw_column_reaches_the_scan(stored):
    raw = stored.select("autor", "comentario", "likes", "fecha", "respuestas")
    plan = _plan(enrich(raw, *views.scorers()).filter("autor = 'a' AND fecha > '2023'"))
    assert "EqualTo(autor,a)" in plan and "GreaterThan(fecha,2023)" in plan


def test_two_enriched_tables_combine(stored):
    raw = stored.select("autor", "comentario", "likes", "fecha", "respuestas")
    one, two = enrich(raw, *views.scorers()), enrich(raw, *views.scorers())
    assert one.unionByName(two).count() == 40
    assert one.join(two, "autor").count() == 400
    assert "CollectMetrics" not in _plan(one)
    assert "CollectMetrics" in _plan(enrich(raw, *views.scorers(), metrics="m"))


def test_the_text_is_split_once_for_all_word_lists(stored):
    raw = stored.select("autor", "comentario", "likes", "fecha", "respuestas")
    assert _plan(enrich(raw, *views.scorers())).count("split(") == _plan(clean(raw)).count("split(") + 1


def test_rolling_shares_have_no_window_over_all_rows(stored):
    plan = _plan(rolling_shares(stored.select("likes", "es_odio", "sentimiento"), "likes", 5))
    assert "SinglePartition" not in plan


def test_nothing_is_broadcast_or_crossed(stored):
    for df in (user_risk_score(stored), hourly_trend(stored), likes_correlation(stored)):
        plan = _plan(df)
        assert "Broadcast" not in plan and "Cartesian" not in plan
