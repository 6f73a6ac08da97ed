import json

import pytest

from murmullo import __main__ as cli
from murmullo.operators.scorers import lexicon_scorer
from murmullo.plans import batch
from murmullo.schemas import (
    CORRELATION, FINAL, HOURLY_TREND, NEUTRAL, SENTIMENT_LABELS, SYNONYMS, TOP_TERMS, USER_RISK,
)
from murmullo.session import work_dir
from murmullo.sources.tables import TooFewRows
from murmullo.sources.topics import FileTopic


@pytest.fixture()
def mixed(spark, tmp_path):
    rows = [(f"u{i % 4}", f"texto {'idiota' if i % 3 == 0 else 'amable'} voto", None, i,
             "2024-01-01T12:00:00Z", 0) for i in range(30)]
    rows.append(("u1", None, " del chat ", 5, None, None))
    path = str(tmp_path / "mixed")
    spark.createDataFrame(
        rows, "autor string, comentario string, mensaje string, likes long, fecha string, respuestas long"
    ).write.parquet(path)
    return path


HATE = lexicon_scorer({"CALLS": ["idiota"]})
MOOD = lexicon_scorer({"NEG": ["idiota"], "POS": ["amable"]}, SENTIMENT_LABELS, rest_label=NEUTRAL)


def _kinds(schema):
    return [(f.name, f.dataType) for f in schema]


def test_from_mixed_table_to_reports(spark, tmp_path, mixed):
    final = str(tmp_path / "final")
    batch.run_enrichment(spark, mixed, final, HATE, MOOD)
    assert spark.read.parquet(final).count() == 31
    schemas = {
        "top_hate_terms": TOP_TERMS, "user_risk_score": USER_RISK,
        "hourly_trend": HOURLY_TREND, "likes_correlation": CORRELATION,
    }
    assert set(schemas) == set(batch.REPORTS)
    for name, schema in schemas.items():
        out = str(tmp_path / name)
        cli.main(["report", name, final, out])
        found = spark.read.parquet(out)
        assert _kinds(found.schema) == _kinds(schema) and found.count() > 0
    cli.main(["synonyms", final, str(tmp_path / "syn"), str(tmp_path / "model"), "--terms", "voto", "nada"])
    found = spark.read.parquet(str(tmp_path / "syn"))
    assert _kinds(found.schema) == _kinds(SYNONYMS)
    assert {r.palabra_clave for r in found.collect()} == {"voto"}


def test_synonyms_of_unknown_terms_leave_no_old_result(spark, tmp_path, mixed):
    final, target = str(tmp_path / "final"), tmp_path / "syn"
    batch.run_enrichment(spark, mixed, final, HATE, MOOD)
    word = spark.read.parquet(final).filter("comentario_limpio <> ''").first().comentario_limpio.split()[0]
    batch.run_synonyms(spark, final, str(target), str(tmp_path / "m"), [word])
    assert spark.read.parquet(str(target)).count() > 0
    batch.run_synonyms(spark, final, str(target), str(tmp_path / "m"), ["ausente"])
    assert spark.read.parquet(str(target)).count() == 0 and (tmp_path / "m").exists()


def test_too_few_rows_stop_a_report(spark, tmp_path):
    path = str(tmp_path / "few")
    spark.createDataFrame([], FINAL).write.parquet(path)
    with pytest.raises(TooFewRows):
        batch.run_report(spark, "user_risk_score", path, str(tmp_path / "out"))
    with pytest.raises(TooFewRows):
        batch.run_export(spark, _empty_topic(spark, tmp_path), [str(tmp_path / "x")])
    assert not (tmp_path / "x").exists()


def _empty_topic(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "empty"))
    topic.write_batch(spark.createDataFrame([("",), ("{bad",)], "value string"))
    return topic


def test_whole_chain_through_topics_by_command_line(spark, tmp_path, mixed):
    folder, words = str(tmp_path / "topics"), tmp_path / "words.json"
    words.write_text(json.dumps({
        "hate": {"CALLS": ["idiota"]}, "sentiment": {"NEG": ["idiota"], "POS": ["amable"]}}))
    cli.main(["publish", mixed, "--folder", folder])
    for command in ("clean", "hate", "sentiment"):
        args = [command, "--folder", folder, "--checkpoint", f"{folder}/ck-{command}", "--trigger", "available"]
        cli.main(args if command == "clean" else [*args, "--lexicons", str(words)])
    cli.main(["export", f"{tmp_path}/p1", f"{tmp_path}/p2", "--folder", folder])
    chained = spark.read.parquet(f"{tmp_path}/p2").select(*FINAL.names)
    batch.run_enrichment(spark, mixed, str(tmp_path / "direct"), HATE, MOOD)
    direct = spark.read.parquet(str(tmp_path / "direct")).select(*FINAL.names)
    assert sorted(map(tuple, chained.collect())) == sorted(map(tuple, direct.collect()))
    for command in ("throughput", "sentiment-windows"):
        cli.main([
            command, "--folder", folder, "--checkpoint", f"{folder}/ck-{command}",
            "--trigger", "available", "--late", "1 minute", "--max-per-trigger", "1"])
    with pytest.raises(SystemExit):
        cli.main(["throughput", "--folder", folder, "--checkpoint", f"{folder}/ck"])


def test_work_dir_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one.startswith(root) and one != two


class _Unset:
    """A session without the shared folder."""

    def __init__(self, master):
        self.sparkContext = type("C", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})


def test_only_a_local_session_may_lack_the_shared_folder():
    assert work_dir(_Unset("local[2]"), "x") != work_dir(_Unset("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(_Unset("yarn"), "x")
