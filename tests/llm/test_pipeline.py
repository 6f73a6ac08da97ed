import os

import pytest

import corpus_pipeline
from murmullo.llm import queries
from murmullo.llm.decontaminate import contamination
from murmullo.llm.simhash import near_duplicates

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage and what comes out, every one written."""
    docs, seen = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        function(spark, docs, SF_DIR).write.parquet(path)
        out = spark.read.parquet(path)
        seen.append((name, docs, out))
        docs = out
    return {name: (a, b) for name, a, b in seen}


def _ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_stay(spark, stages):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    for name, (_, out) in list(stages.items())[:-1]:
        assert out.columns == columns, name
    assert stages["token_output"][1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_language_keeps_what_it_knows(stages):
    given, out = stages["language_id"]
    gone = _ids(given) - _ids(out)
    assert len(gone) <= 0.02 * given.count()
    assert not {r.doc_id for r in given.filter("text IS NULL").collect()} - gone


def test_near_dedup_keeps_one_of_each_group(stages):
    given, out = stages["near_dedup"]
    groups = {r.component_id for r in near_duplicates(given).collect()}
    assert _ids(out) == groups and out.count() == len(groups)


def test_contaminated_documents_go(spark, stages):
    given, out = stages["decontaminate"]
    verdict = contamination(given, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    assert _ids(out) == {r.doc_id for r in verdict.filter("NOT contaminated").collect()}


def test_the_mix_is_whole_documents(stages):
    given, out = stages["mix_sources"]
    assert _ids(out) <= _ids(given)
    assert max(r["count"] for r in out.groupBy("doc_id").count().collect()) <= 3


def test_every_row_of_the_mix_is_written(stages):
    given, out = stages["token_output"]
    rows = sorted((r.start, r.n_tokens, r.doc_id) for r in out.collect())
    assert sorted(r[2] for r in rows) == sorted(r.doc_id for r in given.collect())
    assert [r[0] for r in rows] == [0, *(a + n for a, n, _ in rows[:-1])]
    assert [r[2] for r in rows] == sorted(r[2] for r in rows)


def test_run_is_the_stages_in_a_row(spark, stages):
    found = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert found == sorted(map(tuple, stages["token_output"][1].collect()))


def _through(spark, docs, path):
    """All stages over a table, every one written."""
    seen = [docs]
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, SF_DIR).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen.append(docs)
    return seen


def test_odd_rows_go_through_all_stages(spark, edges, tmp_path):
    """Nulls in every column, blank and very long texts, repeated rows, clashing names."""
    given, known, unique, clean, mix, tokens = _through(spark, edges, str(tmp_path))
    assert known.columns == unique.columns == clean.columns == mix.columns == edges.columns
    # Null, empty, blank and letterless texts are in no language.
    assert not _ids(known) & {1, 2, 5, 7}
    assert _ids(unique) <= _ids(known) and unique.groupBy("doc_id", "text").count().filter("count > 1").count() == 0
    assert _ids(mix) <= _ids(clean) <= _ids(unique)
    rows = sorted((r.start, r.n_tokens) for r in tokens.collect())
    assert len(rows) == mix.count() and [r[0] for r in rows] == [0, *(a + n for a, n in rows[:-1])][:len(rows)]


def test_an_empty_table_goes_through_all_stages(spark, nothing, tmp_path):
    assert [df.count() for df in _through(spark, nothing, str(tmp_path))] == [0] * 6


def test_queries_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(queries.ORACLES) <= set(queries.QUERIES)
