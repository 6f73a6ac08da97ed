"""Every checked query: a Spark function and, where SQL can say it, the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sql, views
from murmullo.functions import text as tx
from murmullo.functions.labels import category_name, correlation_label, severity
from murmullo.operators import cooccurrence as co
from murmullo.operators import recent, summaries, trained
from murmullo.operators.ordered import stage as tables_stage
from murmullo.operators.ordered import with_running_sums
from murmullo.operators.correlation import likes_correlation
from murmullo.operators.risk import top_users, user_risk, user_risk_score
from murmullo.operators.scorers import (
    classifier_scorer, fit_classifier, model_scorer, score_together,
)
from murmullo.operators.similarity import (
    fit_word2vec, load_model, nearest_terms, save_model, saved_vectors, word_lists,
)
from murmullo.operators.stages import clean, decide_hate, decide_sentiment
from murmullo.operators.terms import top_hate_terms, top_negative_terms
from murmullo.operators.trend import hourly_mean, hourly_trend, peak_hour
from murmullo.operators.windows import sentiment_windows, throughput_windows
from murmullo.schemas import (
    FINAL, HATE_LABELS, HATE_THRESHOLD, RAW, SENTIMENT, SENTIMENT_LABELS, THROUGHPUT, extend, struct,
)
from murmullo.session import work_dir
from murmullo.sources import tables
from murmullo.sources.records import decode, encode, malformed_lines, parse_record, text_field
from murmullo.sources.topics import (
    FileTopic, TableTopic, bounded_read, decode_value, first_messages, incremental_tail, last_messages,
    read_last, read_tail,
)
from murmullo.streaming import clock, jobs
from murmullo.streaming.batches import read_batches
from murmullo.streaming.buffer import read_buffer, start_buffer
from murmullo.streaming.progress import wait_until_idle
from murmullo.wordlists import (
    CATEGORY_NAMES, NEGATIVE_STOPWORDS, SENTIMENT_NAMES, TERM_STOPWORDS,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(name: str, oracle: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def over_marked(name: str, function: Callable[[DataFrame], DataFrame], oracle: str) -> None:
    checked(name, oracle)(lambda spark, sf: function(views.marked(views.tables(spark, sf))))


def over_final(name: str, function: Callable[[DataFrame], DataFrame], oracle: str) -> None:
    checked(name, oracle)(lambda spark, sf: function(views.final(views.tables(spark, sf))))


def over_texts(name: str, function, oracle: str) -> None:
    query = sql.over("texts", f"SELECT rid, {oracle} AS texto FROM texts")
    checked(name, query)(
        lambda spark, sf: views.texts(views.tables(spark, sf)).select(
            "rid", function(F.col("texto")).alias("texto")
        )
    )


# --- Batch reports ---------------------------------------------------------

over_marked("user_risk_score", user_risk_score, sql.over("marked", "SELECT * FROM riesgo", sql.RISK))

_WORDS = "unnest(regexp_split_to_array(trim(lower(comentario_limpio)), '\\s+'))"
over_final("top_hate_terms", top_hate_terms, sql.over("final", f"""
    SELECT palabra, count(*) AS "count"
    FROM (SELECT {_WORDS} AS palabra FROM final WHERE es_odio)
    WHERE length(palabra) > 2 AND palabra NOT IN ({sql.quoted(TERM_STOPWORDS)})
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30"""))

_LETTERS = "unnest(string_split(trim(regexp_replace(lower(comentario_limpio), '[^a-záéíóúñü]+', ' ', 'g')), ' '))"
over_final("negative_terms", top_negative_terms, sql.over("final", f"""
    SELECT palabra, count(*) AS frecuencia
    FROM (SELECT {_LETTERS} AS palabra FROM final WHERE sentimiento = 'NEG')
    WHERE length(palabra) > 3 AND palabra NOT IN ({sql.quoted(NEGATIVE_STOPWORDS)})
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""))

_TREND = sql.trend(sql.hour("fecha"), f"{sql.hour('fecha')} IS NOT NULL")
over_marked("hourly_trend", hourly_trend, sql.over("marked", _TREND))
over_marked(
    "hourly_trend_no_valid_dates",
    lambda df: hourly_trend(df, date="event_type"),
    sql.over("marked", sql.trend("0")),
)
over_marked("peak_hour", lambda df: peak_hour(hourly_trend(df)), sql.over("marked", f"""
    SELECT hora_dia, porcentaje_odio FROM ({_TREND}) ORDER BY porcentaje_odio DESC, hora_dia LIMIT 1"""))

_R = """(SELECT CASE WHEN isnan(r) THEN NULL ELSE r END FROM
    (SELECT corr(CAST(es_odio AS INTEGER), likes) AS r FROM marked))"""
_CONCLUSION = f"""CASE WHEN {_R} > 0.1 THEN 'Los comentarios discriminatorios tienden a recibir MAS likes'
    WHEN {_R} < -0.1 THEN 'Los comentarios discriminatorios tienden a recibir MENOS likes'
    ELSE 'No hay correlacion significativa entre likes y discurso discriminatorio' END"""
_CORRELATION = f"""SELECT es_odio, count(*) AS cantidad,
    {sql.rounded('avg(likes)', 2)} AS promedio_likes,
    {sql.rounded('avg(prob_odio)', 3)} AS prob_odio_promedio,
    {sql.rounded(_R, 4)} AS correlacion_pearson, {_CONCLUSION} AS interpretacion
    FROM marked GROUP BY es_odio"""
over_marked("likes_correlation", likes_correlation, sql.over("marked", _CORRELATION))
over_marked(
    "correlation_label",
    lambda df: likes_correlation(df).select(
        "es_odio",
        F.when(F.col("es_odio"), "Discriminatorio").otherwise("Normal").alias("tipo"),
        "promedio_likes",
        correlation_label(F.col("correlacion_pearson")).alias("relacion"),
    ),
    sql.over("marked", f"""SELECT es_odio, CASE WHEN es_odio THEN 'Discriminatorio' ELSE 'Normal' END AS tipo,
        promedio_likes, CASE WHEN coalesce(abs(correlacion_pearson), 0) < 0.1 THEN 'Sin correlación'
        WHEN correlacion_pearson > 0 THEN 'Positiva' ELSE 'Negativa' END AS relacion
        FROM ({_CORRELATION})"""),
)
over_marked("hate_share", summaries.hate_share, sql.over("marked", f"""
    SELECT count(*) AS total, count(*) FILTER (WHERE es_odio) AS n_odio,
    {sql.percent('count(*) FILTER (WHERE es_odio)', 'count(*)', 1)} AS pct_odio FROM marked"""))


# --- Normalising and cleaning ------------------------------------------------

checked("normalize_comments", sql.over("raw", "SELECT * FROM raw"))(
    lambda spark, sf: views.raw(views.tables(spark, sf))
)

over_texts("clean_lower", F.lower, "lower(texto)")
over_texts("clean_urls", tx.strip_urls, sql.urls("texto"))
over_texts("clean_mentions", tx.strip_mentions, sql.mentions("texto"))
over_texts("clean_emoji", tx.name_emoji, sql.emoji("texto"))
over_texts("clean_separators", tx.separators_to_space, "translate(texto, ':_', '  ')")
over_texts("clean_repeats", tx.collapse_repeats, sql.repeats("texto"))
over_texts("clean_charset", tx.keep_charset, sql.charset("texto"))
over_texts("clean_spaces", tx.squeeze_spaces, sql.spaces("texto"))


@checked("clean_text", sql.over("limpio", "SELECT rid, comentario_limpio FROM limpio"))
def _clean_text(spark, sf):
    return clean(views.raw(views.tables(spark, sf))).select("rid", "comentario_limpio")


_EXPORT_FLAG = "CASE event_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN 'quizás' ELSE NULL END"
_EXPORT_PROB = "CASE event_id % 5 WHEN 0 THEN CAST(value AS {0}) WHEN 1 THEN 'NaN' WHEN 2 THEN 'x' WHEN 3 THEN '2f' ELSE NULL END"
_EXPORT_LIKES = "CASE event_id % 5 WHEN 0 THEN CAST(value AS {0}) WHEN 1 THEN 'nan' WHEN 2 THEN concat('-', CAST(value AS {0})) WHEN 3 THEN '1d' ELSE NULL END"


@checked("coerce_export", f"""
    SELECT event_id, {sql.safe_int('likes')} AS likes, {sql.safe_double('prob_odio')} AS prob_odio,
           coalesce(TRY_CAST(es_odio AS BOOLEAN), false) AS es_odio
    FROM (SELECT event_id, {_EXPORT_LIKES.format('VARCHAR')} AS likes,
                 {_EXPORT_PROB.format('VARCHAR')} AS prob_odio, {_EXPORT_FLAG} AS es_odio FROM events)""")
def _coerce_export(spark, sf):
    untyped = views.tables(spark, sf)("events").selectExpr(
        "event_id", f"{_EXPORT_LIKES.format('STRING')} AS likes",
        f"{_EXPORT_PROB.format('STRING')} AS prob_odio", f"{_EXPORT_FLAG} AS es_odio",
    )
    return tables.coerce_export(untyped)


# --- JSON, files and topics --------------------------------------------------

_RAW_WITH_ID = extend(RAW, rid=T.StringType())


@checked("publish_json", sql.over("raw", """
    SELECT CAST(to_json({rid: rid, autor: autor, comentario: comentario, likes: likes,
                         fecha: fecha, respuestas: respuestas}) AS VARCHAR) AS value FROM raw"""))
def _publish_json(spark, sf):
    return encode(views.raw(views.tables(spark, sf)))


@checked("json_roundtrip", sql.over("raw", "SELECT * FROM raw"))
def _json_roundtrip(spark, sf):
    return decode(encode(views.raw(views.tables(spark, sf))), _RAW_WITH_ID)


def _damaged(spark, sf) -> DataFrame:
    """The records as JSON lines: chat lines broken, page lines blank, some events
    with a key twice or a number that is none."""
    records = views.raw(views.tables(spark, sf))
    line = F.to_json(F.struct("rid", "autor", "likes", "comentario"))
    return records.select(
        F.when(F.col("rid").startswith("c"), F.concat(F.lit("{bad "), "rid"))
        .when(F.col("rid").startswith("p"), F.lit(" \t "))
        .when(F.col("rid").rlike("^e.*3$"), F.concat(F.lit('{"likes":NaN,"rid":"'), "rid", F.lit('"}')))
        .when(F.col("rid").rlike("^e.*4$"), F.concat(F.lit('{"rid":"x","rid":"'), "rid", F.lit('"}')))
        .otherwise(line)
        .alias("value")
    )


_LINE = struct(
    rid=T.StringType(), autor=T.StringType(), likes=T.LongType(), comentario=T.StringType()
)


@checked("json_good_rows", sql.over("raw", """
    SELECT rid, autor, likes, comentario FROM raw WHERE rid[1] NOT IN ('c', 'p') AND NOT regexp_matches(rid, '^e.*[34]$')"""))
def _json_good_rows(spark, sf):
    return decode(_damaged(spark, sf), _LINE)


@checked("json_quarantine", sql.over("raw", """
    SELECT CASE WHEN rid[1] = 'c' THEN concat('{bad ', rid)
        WHEN rid LIKE '%3' THEN concat('{"likes":NaN,"rid":"', rid, '"}')
        ELSE concat('{"rid":"x","rid":"', rid, '"}') END AS value
    FROM raw WHERE rid[1] = 'c' OR regexp_matches(rid, '^e.*[34]$')"""))
def _json_quarantine(spark, sf):
    return malformed_lines(_damaged(spark, sf), _LINE)


_ALL_MARKED = sql.over("marked", """
    SELECT event_id, autor, likes, es_odio, prob_odio, categoria_odio, sentimiento,
           prob_sentimiento FROM marked""")
_MARKED_COLUMNS = [
    "event_id", "autor", "likes", "es_odio", "prob_odio", "categoria_odio", "sentimiento",
    "prob_sentimiento",
]


def _marked(spark, sf) -> DataFrame:
    return views.marked(views.tables(spark, sf)).select(*_MARKED_COLUMNS)


@checked("parquet_roundtrip", _ALL_MARKED)
def _parquet_roundtrip(spark, sf):
    path = work_dir(spark, "parquet")
    tables.write_table(_marked(spark, sf), path)
    return tables.read_table(spark, path)


@checked("read_parts", _ALL_MARKED)
def _read_parts(spark, sf):
    path, rows = work_dir(spark, "parts"), _marked(spark, sf)
    tables.write_table(rows.filter("es_odio"), path, "append")
    tables.write_table(rows.filter("NOT es_odio"), path, "append")
    missing = tables.read_parts(spark, path + "-none", rows.schema)
    return tables.read_parts(spark, path, rows.schema).unionByName(missing)


@checked("export_two_paths", _ALL_MARKED)
def _export_two_paths(spark, sf):
    path = work_dir(spark, "export")
    done = tables.export_table(_marked(spark, sf), [f"{path}/a", f"{path}/b"])
    return tables.read_table(spark, done[1])


@checked("row_gate", sql.over("marked", "SELECT count(*) AS filas FROM marked"))
def _row_gate(spark, sf):
    rows = tables.require_rows(views.marked(views.tables(spark, sf)), 10)
    return rows.agg(F.count("*").alias("filas"))


@checked("bounded_read", sql.over("topic", """
    SELECT "partition", "offset", event_id FROM topic
    WHERE "offset" < 333"""))
def _bounded_read(spark, sf):
    """The first 999 messages, a third from each of the three partitions."""
    messages = views.topic(views.tables(spark, sf)).select("partition", "offset", "event_id")
    return first_messages(messages, 999)


@checked("export_topic", _ALL_MARKED)
def _export_topic(spark, sf):
    rows, folder = _marked(spark, sf), FileTopic(work_dir(spark, "topic"))
    folder.write_batch(encode(rows))
    return decode(folder.read_batch(spark).select("value"), rows.schema)


# Of 20 waiting messages per partition the first read takes 3, 3 and 4; then the
# last partition is the shortest, and the shares go to 2, 0 and 1 in this order.
_TAIL = """
    SELECT CASE WHEN n <= CASE "partition" WHEN 2 THEN 4 ELSE 3 END THEN 1 ELSE 2 END AS lectura,
           "partition", "offset", event_id
    FROM (SELECT *, "offset" - (fin - 20) + 1 AS n
          FROM (SELECT *, max("offset") OVER (PARTITION BY "partition") + 1 AS fin FROM topic))
    WHERE n BETWEEN 1 AND CASE "partition" WHEN 0 THEN 6 ELSE 7 END"""


@checked("invalid_utf8", """
    SELECT event_id, concat(event_type, chr(65533), ' ñ', CASE WHEN event_id % 2 = 0 THEN chr(65533) ELSE '' END)
        AS value FROM events""")
def _invalid_utf8(spark, sf):
    """Event types as bytes with one that never occurs in UTF-8, and a cut letter."""
    odd = F.when(F.col("event_id") % 2 == 0, F.unhex(F.lit("C3"))).otherwise(F.unhex(F.lit("")))
    raw = F.concat(F.encode("event_type", "UTF-8"), F.unhex(F.lit("FF")), F.encode(F.lit(" ñ"), "UTF-8"), odd)
    return views.tables(spark, sf)("events").select("event_id", decode_value(raw).alias("value"))


@checked("incremental_tail", sql.over("topic", _TAIL))
def _incremental_tail(spark, sf):
    messages = views.topic(views.tables(spark, sf)).select("partition", "offset", "event_id")
    first, positions = incremental_tail(messages)
    second, _ = incremental_tail(messages, positions)
    mark = lambda df, n: df.select(F.lit(n).alias("lectura"), *messages.columns)
    return mark(first, 1).unionByName(mark(second, 2))


@checked("uneven_tail", sql.over("topic", """
    SELECT "partition", "offset", event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS n
        FROM topic WHERE "partition" = 0 OR "offset" >= 100)
    WHERE n <= 10 + CASE WHEN "partition" = 0 THEN 1 ELSE 0 END"""))
def _uneven_tail(spark, sf):
    """Two partitions whose offsets lie far apart are served alike."""
    messages = views.topic(views.tables(spark, sf)).select("partition", "offset", "event_id")
    return incremental_tail(messages, {0: 0, 1: 100, 2: 100}, max_new=31)[0]


@checked("last_n_per_partition", sql.over("topic", """
    SELECT "partition", "offset", event_id, es_odio
    FROM (SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY "offset" DESC) AS n FROM topic)
    WHERE n <= 100"""))
def _last_n(spark, sf):
    messages = views.topic(views.tables(spark, sf))
    return last_messages(messages.select("partition", "offset", "event_id", "es_odio"), 300)


def _archive(spark, sf) -> TableTopic:
    """The topic as Parquet with offsets in the file footers."""
    archive = TableTopic(work_dir(spark, "archive"))
    archive.write_batch(views.topic(views.tables(spark, sf)).select(
        "partition", "offset", "event_id", "es_odio"))
    return archive


@checked("topic_bounded_read", ORACLES["bounded_read"])
def _topic_bounded_read(spark, sf):
    """The offsets come from the footers, and only the range is scanned."""
    return bounded_read(spark, _archive(spark, sf), 999).select("partition", "offset", "event_id")


@checked("topic_tail", ORACLES["incremental_tail"])
def _topic_tail(spark, sf):
    archive = _archive(spark, sf)
    first, positions = read_tail(spark, archive)
    second, _ = read_tail(spark, archive, positions)
    mark = lambda df, n: df.select(F.lit(n).alias("lectura"), "partition", "offset", "event_id")
    return mark(first, 1).unionByName(mark(second, 2))


@checked("topic_last_n", ORACLES["last_n_per_partition"])
def _topic_last_n(spark, sf):
    return read_last(spark, _archive(spark, sf), 300).select("partition", "offset", "event_id", "es_odio")


@checked("export_gated", sql.over("marked", """
    SELECT count(*) AS filas, count(*) FILTER (WHERE es_odio) AS con_odio, count(*) AS guardadas, count(*) AS antes FROM marked"""))
def _export_gated(spark, sf):
    """One read of the input; too few rows leave the earlier table."""
    path, rows = f"{work_dir(spark, 'gated')}/out", _marked(spark, sf)
    found = tables.write_gated(rows, path, 10)
    try:
        tables.write_gated(rows.limit(3), path, 10)
        left = 0
    except tables.TooFewRows:
        left = tables.read_table(spark, path).count()
    return tables.read_table(spark, path).agg(
        F.lit(found).cast("bigint").alias("filas"), F.count_if("es_odio").alias("con_odio"),
        F.count("*").alias("guardadas"), F.lit(left).cast("bigint").alias("antes"))


# --- Scoring and decisions ---------------------------------------------------

_DECIDED = sql.decided("props")

@checked("classify_hate", sql.over("dado", f"""
    SELECT event_id, es_odio, prob_odio, categoria_odio FROM (SELECT event_id, {_DECIDED} FROM dado)"""))
def _classify_hate(spark, sf):
    given = views.given_probabilities(views.tables(spark, sf))
    return decide_hate(given, text="props").select("event_id", "es_odio", "prob_odio", "categoria_odio")


@checked("classify_hate_blank", sql.over("dado", f"""
    SELECT event_id, es_odio, prob_odio, categoria_odio
    FROM (SELECT event_id, {sql.decided('texto_parcial')} FROM dado)"""))
def _classify_hate_blank(spark, sf):
    given = views.given_probabilities(views.tables(spark, sf))
    return decide_hate(given, text="texto_parcial").select(
        "event_id", "es_odio", "prob_odio", "categoria_odio"
    )


@checked("classify_sentiment", sql.over("dado", f"""
    SELECT event_id, sentimiento, prob_sentimiento FROM (SELECT event_id, {_DECIDED} FROM dado)"""))
def _classify_sentiment(spark, sf):
    given = views.given_probabilities(views.tables(spark, sf))
    return decide_sentiment(given, text="props").select("event_id", "sentimiento", "prob_sentimiento")


@checked("classify_sentiment_blank", sql.over("dado", f"""
    SELECT event_id, sentimiento, prob_sentimiento
    FROM (SELECT event_id, {sql.decided('texto_parcial')} FROM dado)"""))
def _classify_sentiment_blank(spark, sf):
    given = views.given_probabilities(views.tables(spark, sf))
    return decide_sentiment(given, text="texto_parcial").select(
        "event_id", "sentimiento", "prob_sentimiento"
    )


_SCORE_COLUMNS = ", ".join(f"p_{x}" for x in [*HATE_LABELS, "POS", "NEG", "NEU"])


@checked("lexicon_scores", sql.over("puntos", f"SELECT rid, {_SCORE_COLUMNS} FROM puntos"))
def _lexicon_scores(spark, sf):
    hate, mood = views.scorers()
    cleaned = clean(views.raw(views.tables(spark, sf))).select("rid", "comentario_limpio")
    scored = score_together(cleaned, "comentario_limpio", {"h": hate, "s": mood})
    return scored.select(
        "rid",
        *[F.get("h", F.lit(i)).alias(f"p_{x}") for i, x in enumerate(HATE_LABELS)],
        *[F.get("s", F.lit(i)).alias(f"p_{x}") for i, x in enumerate(SENTIMENT_LABELS)],
    )


@checked("udf_scores", sql.over("puntos", f"""
    SELECT rid, {', '.join(f'CASE WHEN {sql.has_text("comentario_limpio")} THEN p_{x} END AS p_{x}' for x in HATE_LABELS)}
    FROM puntos"""))
def _udf_scores(spark, sf):
    lists = {k: list(v) for k, v in views.HATE_LEXICON.items()}
    half = views.HALF_POINT

    def load():
        sets = [frozenset(words) for words in lists.values()]

        def predict(batch):
            out = []
            for one in batch:
                words = one.split(" ")
                hits = [float(sum(w in s for w in words)) for s in sets]
                out.append([h / (h + half) for h in hits])
            return out

        return predict

    scorer = model_scorer(spark, "word-lists", load, list(lists))
    cleaned = clean(views.raw(views.tables(spark, sf))).select("rid", "comentario_limpio")
    scored = scorer(cleaned, "comentario_limpio", "h")
    return scored.select(
        "rid", *[F.get("h", F.lit(i)).alias(f"p_{x}") for i, x in enumerate(HATE_LABELS)]
    )


def _listed(terms):
    return F.array(*[F.lit(t) for t in terms])


def _says(lexicon):
    """Per label, whether a text has one of its words. Each word is looked up once, in the
    words of all labels; what is found is compared with those of each."""
    every = _listed(sorted({t for terms in lexicon.values() for t in terms}))
    found = F.array_intersect(F.split("comentario_limpio", " "), every)
    return {label: F.arrays_overlap(found, _listed(terms)) for label, terms in lexicon.items()}


def _sums_oracle(lexicon, case) -> str:
    words = {label: f"list_has_any(string_split(comentario_limpio, ' '), {list(terms)})"
             for label, terms in lexicon.items()}
    parts = " UNION ALL ".join(
        f"SELECT '{label}' AS etiqueta, count(*) AS textos, count(*) FILTER (WHERE {c}) AS casos, "
        f"CAST(count(*) FILTER (WHERE {c}) AS DOUBLE) AS esperados FROM calibran"
        for label, c in case(words).items())
    return sql.over("limpio", parts, f"""calibran AS (
        SELECT * FROM limpio WHERE {sql.has_text('comentario_limpio')}
        AND CAST('0x' || substr(md5(comentario_limpio), 1, 4) AS INTEGER) % 10 IN (0, 1))""")


def _sums(spark, sf, labels, exclusive: bool) -> DataFrame:
    cleaned = tables_stage(
        clean(views.raw(views.tables(spark, sf))).select("comentario_limpio"), "trained-clean")
    scorer = trained.fit_labels(cleaned, labels, exclusive=exclusive)
    return trained.calibration_sums(scorer, cleaned, labels, "comentario_limpio").select(
        F.col("label").alias("etiqueta"), F.col("texts").alias("textos"), F.col("cases").alias("casos"),
        F.round("expected", 6).alias("esperados"))


@checked("trained_hate_sums", _sums_oracle(views.HATE_LEXICON, lambda words: words))
def _trained_hate_sums(spark, sf):
    """Eight labels: what the calibrated probabilities add up to is what was labelled."""
    says = _says(views.HATE_LEXICON)
    return _sums(spark, sf, {x: says[x] for x in HATE_LABELS}, False)


def _classes(says, negate, both):
    pos, neg = says["POS"], says["NEG"]
    return {"POS": pos, "NEG": both(negate(pos), neg), "NEU": both(negate(pos), negate(neg))}


@checked("trained_sentiment_sums", _sums_oracle(views.SENTIMENT_LEXICON, lambda words: _classes(
    words, lambda a: f"NOT {a}", lambda a, b: f"{a} AND {b}")))
def _trained_sentiment_sums(spark, sf):
    says = _says(views.SENTIMENT_LEXICON)
    return _sums(spark, sf, _classes(says, lambda a: ~a, lambda a, b: a & b), True)


def _trained(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Cleaned documents, and the same with scores learned from their labels."""
    read = views.tables(spark, sf)
    cleaned = read("documents").select(
        "doc_id", tx.clean_text(F.col("text")).alias("comentario_limpio")
    )
    labelled = cleaned.join(read("labels").withColumnRenamed("toxic", "label"), "doc_id")
    # Training reads its input several times, so the cleaned texts are stored.
    path = work_dir(spark, "labelled")
    tables.write_table(labelled.select("doc_id", "comentario_limpio", "label"), path)
    stored = tables.read_table(spark, path)
    model = fit_classifier(stored)
    return stored, classifier_scorer(model, "CALLS")(cleaned, "comentario_limpio", "probas_odio")


@checked("ml_hate_scores")
def _ml_hate_scores(spark, sf):
    return decide_hate(_trained(spark, sf)[1]).select(
        "doc_id", "es_odio", "prob_odio", "categoria_odio"
    )


@checked("ml_hate_checks", f"""
    SELECT count(*) AS filas, count(*) FILTER (WHERE NOT {sql.has_text("coalesce(text, '')")}) AS sin_texto,
           true AS por_umbral, true AS por_etiqueta, true AS acierta FROM documents""")
def _ml_hate_checks(spark, sf):
    """Decisions of the trained scorer against its probabilities and its labels."""
    labelled, scored = _trained(spark, sf)
    rows = decide_hate(scored).join(labelled.select("doc_id", "label"), "doc_id", "left")
    top, blank = F.array_max("probas_odio"), F.col("categoria_odio") == "sin_texto"
    flag = F.col("es_odio")
    of_label = F.get("probas_odio", F.lit(HATE_LABELS.index("CALLS")))
    right = F.avg(F.when(F.col("label").isNotNull(), (flag == (F.col("label") == 1)).cast("int")))
    usual = F.avg(F.when(F.col("label").isNotNull(), (F.col("label") == 0).cast("int")))
    return rows.agg(
        F.count("*").alias("filas"), F.count_if(blank).alias("sin_texto"),
        F.every(blank | (flag == (top > HATE_THRESHOLD))).alias("por_umbral"),
        F.every((of_label == top) & (blank | (flag == (F.col("categoria_odio") == "CALLS"))))
        .alias("por_etiqueta"),
        (right > usual).alias("acierta"),
    )


_FINAL_ORACLE = sql.over("final", "SELECT * FROM final")


@checked("final_records", _FINAL_ORACLE)
def _final_records(spark, sf):
    return views.final(views.tables(spark, sf))


# --- Windows -----------------------------------------------------------------

over_marked(
    "throughput_windows", lambda df: throughput_windows(df, "ts"),
    sql.over("marked", "SELECT * FROM throughput", sql.throughput()),
)
over_marked(
    "sentiment_windows", lambda df: sentiment_windows(df, "ts"),
    sql.over("marked", "SELECT * FROM ventanas", sql.sentiment_windows()),
)
over_marked(
    "throughput_summary",
    lambda df: summaries.series_summary(
        throughput_windows(df, "ts"), "throughput_msg_seg", "cantidad_mensajes"
    ),
    sql.over("marked", f"""
        SELECT arg_max(throughput_msg_seg, ventana_fin) AS actual, max(throughput_msg_seg) AS maximo,
               {sql.rounded('avg(throughput_msg_seg)', 2)} AS promedio,
               CAST(sum(cantidad_mensajes) AS BIGINT) AS total FROM throughput""", sql.throughput()),
)
over_marked(
    "window_clock",
    lambda df: summaries.with_clock(throughput_windows(df, "ts")).select("ventana_fin", "hora"),
    sql.over("marked", """
        SELECT ventana_fin, strftime(make_timestamp(ventana_fin * 1000000), '%H:%M:%S') AS hora
        FROM throughput""", sql.throughput()),
)
_LONG = " UNION ALL ".join(
    f"SELECT ventana_fin, '{name}' AS tipo, {column} AS cantidad FROM ventanas"
    for column, name in [("positivos", "Positivo"), ("negativos", "Negativo"), ("neutrales", "Neutral")]
)
over_marked(
    "window_long", lambda df: summaries.window_long(sentiment_windows(df, "ts")),
    sql.over("marked", _LONG, sql.sentiment_windows()),
)
over_marked(
    "dominant_sentiment", lambda df: summaries.dominant_sentiment(sentiment_windows(df, "ts")),
    sql.over("marked", """
        SELECT ventana_fin, CASE greatest(positivos, negativos, neutrales)
            WHEN positivos THEN 'Positivo' WHEN negativos THEN 'Negativo' ELSE 'Neutral' END AS dominante
        FROM ventanas ORDER BY ventana_fin DESC LIMIT 1""", sql.sentiment_windows()),
)
over_marked(
    "hate_band",
    lambda df: summaries.with_hate_band(sentiment_windows(df, "ts")).select(
        "ventana_fin", "porcentaje_odio", "banda"
    ),
    sql.over("marked", """
        SELECT ventana_fin, porcentaje_odio, CASE WHEN porcentaje_odio < 25 THEN 'bajo'
            WHEN porcentaje_odio < 50 THEN 'medio' ELSE 'alto' END AS banda
        FROM ventanas""", sql.sentiment_windows()),
)
over_marked(
    "hate_delta", lambda df: summaries.hate_delta(sentiment_windows(df, "ts")),
    sql.over("marked", f"""
        SELECT arg_max(porcentaje_odio, ventana_fin) AS ultimo,
               {sql.rounded('avg(porcentaje_odio)', 2)} AS promedio,
               {sql.rounded('(arg_max(porcentaje_odio, ventana_fin) - avg(porcentaje_odio))', 2)} AS delta
        FROM ventanas""", sql.sentiment_windows()),
)

over_marked(
    "last_window", lambda df: summaries.last_window(sentiment_windows(df, "ts")),
    sql.over("marked", f"""
        SELECT ventana_fin, total_comentarios, positivos, negativos, neutrales, odio,
               {sql.rounded('porcentaje_odio', 1)} AS porcentaje_odio,
               strftime(make_timestamp(ventana_fin * 1000000), '%H:%M:%S') AS hora
        FROM ventanas ORDER BY ventana_fin DESC LIMIT 1""", sql.sentiment_windows()),
)
over_marked(
    "window_table", lambda df: summaries.window_table(sentiment_windows(df, "ts")),
    sql.over("marked", """
        SELECT strftime(make_timestamp(ventana_fin * 1000000), '%H:%M:%S') AS "Hora",
               total_comentarios AS "Total", odio AS "Discriminatorio", porcentaje_odio AS "% Discrim."
        FROM ventanas""", sql.sentiment_windows()),
)
over_marked("hourly_mean", lambda df: hourly_mean(hourly_trend(df)), sql.over("marked", f"""
    SELECT {sql.rounded('avg(porcentaje_odio)', 1)} AS promedio FROM ({_TREND})"""))


def _metric_topic(windows: DataFrame) -> DataFrame:
    """Windows as the messages of a metric topic with one partition."""
    placed = with_running_sums(
        windows.withColumn("_one", F.lit(1)), [F.col("ventana_fin")], {"_place": "_one"}, "metric-topic")
    return placed.select(
        F.lit(0).alias("partition"), F.col("_place").alias("offset"),
        F.to_json(F.struct(*windows.columns)).alias("value"),
    )


over_marked(
    "recent_throughput",
    lambda df: summaries.series_summary(
        summaries.metric_records(_metric_topic(throughput_windows(df, "ts")), THROUGHPUT, 60),
        "throughput_msg_seg", "cantidad_mensajes",
    ),
    sql.over("marked", f"""
        SELECT arg_max(throughput_msg_seg, ventana_fin) AS actual, max(throughput_msg_seg) AS maximo,
               {sql.rounded('avg(throughput_msg_seg)', 2)} AS promedio,
               CAST(sum(cantidad_mensajes) AS BIGINT) AS total
        FROM (SELECT * FROM throughput ORDER BY ventana_fin DESC LIMIT 60)""", sql.throughput()),
)
over_marked(
    "recent_hate_delta",
    lambda df: summaries.hate_delta(
        summaries.metric_records(_metric_topic(sentiment_windows(df, "ts")), SENTIMENT, 30)),
    sql.over("marked", f"""
        SELECT arg_max(porcentaje_odio, ventana_fin) AS ultimo,
               {sql.rounded('avg(porcentaje_odio)', 2)} AS promedio,
               {sql.rounded('(arg_max(porcentaje_odio, ventana_fin) - avg(porcentaje_odio))', 2)} AS delta
        FROM (SELECT * FROM ventanas ORDER BY ventana_fin DESC LIMIT 30)""", sql.sentiment_windows()),
)


# --- Reports over records ----------------------------------------------------

over_marked("flag_counts", summaries.flag_counts, sql.over("marked", """
    SELECT es_odio, count(*) AS cantidad, CASE WHEN es_odio THEN 'Discriminatorio'
        ELSE 'Sin discriminación' END AS etiqueta FROM marked GROUP BY es_odio"""))
over_marked("category_counts", summaries.category_counts, sql.over("marked", f"""
    SELECT categoria_odio, count(*) AS cantidad, {sql.category('categoria_odio')} AS categoria
    FROM marked WHERE es_odio GROUP BY categoria_odio"""))
over_marked("sentiment_counts", summaries.sentiment_counts, sql.over("marked", f"""
    SELECT sentimiento, count(*) AS cantidad, {sql.sentiment('sentimiento')} AS label
    FROM marked GROUP BY sentimiento"""))
over_marked(
    "category_labels",
    lambda df: df.select(
        "event_id", category_name(F.col("categoria_odio")).alias("categoria"),
        severity(F.col("es_odio"), F.col("sentimiento")).alias("nivel"),
    ),
    sql.over("marked", f"""
        SELECT event_id, {sql.category('categoria_odio')} AS categoria,
            CASE WHEN es_odio THEN 'odio' WHEN sentimiento = 'NEG' THEN 'negativo'
                 WHEN sentimiento = 'POS' THEN 'positivo' ELSE 'neutral' END AS nivel FROM marked"""),
)
over_marked("distinct_categories", lambda df: summaries.distinct_sorted(df, "categoria_odio"),
            sql.over("marked", "SELECT DISTINCT categoria_odio FROM marked"))
over_marked("top_users", lambda df: top_users(user_risk(df)).withColumnsRenamed({
    "autor": "Usuario", "total_comentarios": "Total", "comentarios_odio": "Discriminatorios",
    "porcentaje_odio": "Porcentaje", "score_riesgo": "Score",
}).select("Usuario", "Total", "Discriminatorios", "Porcentaje", "Score"), sql.over("marked", """
    SELECT autor AS "Usuario", total_comentarios AS "Total", comentarios_odio AS "Discriminatorios",
           porcentaje_odio AS "Porcentaje", score_riesgo AS "Score"
    FROM riesgo ORDER BY score_riesgo DESC, autor LIMIT 20""", sql.RISK))
over_marked(
    "top_users_chart",
    lambda df: top_users(top_users(user_risk(df)), 15).select("autor", "score_riesgo", "porcentaje_odio"),
    sql.over("marked", """SELECT autor, score_riesgo, porcentaje_odio
        FROM riesgo ORDER BY score_riesgo DESC, autor LIMIT 15""", sql.RISK),
)
over_final("clean_rate", summaries.clean_rate, sql.over("final", f"""
    SELECT count(*) AS recibidos, count(comentario_limpio) AS limpios,
           {sql.percent('count(comentario_limpio)', 'count(*)', 1)} AS tasa FROM final"""))
over_final(
    "clean_sample",
    lambda df: summaries.first_complete(df, ["comentario", "comentario_limpio"], "rid"),
    sql.over("final", "SELECT comentario, comentario_limpio FROM final ORDER BY rid LIMIT 6"),
)
over_final("top_hate_rows", lambda df: summaries.top_hate_rows(df, tie="rid"), sql.over("final", f"""
    SELECT autor AS "Autor", comentario_limpio AS "Comentario", {sql.category('categoria_odio')} AS "Tipo",
           prob_odio AS "Prob" FROM final WHERE es_odio ORDER BY prob_odio DESC, rid LIMIT 10"""))
over_final("scatter_points", summaries.scatter_points, sql.over("final", f"""
    SELECT comentario_limpio, prob_sentimiento, prob_odio, sentimiento, es_odio,
           {sql.names('sentimiento', SENTIMENT_NAMES, 'NULL')} AS "Sentimiento_nombre" FROM final"""))

_LAST_SHARES = ", ".join(
    f"{sql.percent(part, 'count(*)', 1)} AS {name}"
    for name, part in [
        ("pct_odio", "count(*) FILTER (WHERE es_odio)"),
        ("pct_pos", "count(*) FILTER (WHERE sentimiento = 'POS')"),
        ("pct_neg", "count(*) FILTER (WHERE sentimiento = 'NEG')"),
        ("pct_neu", "count(*) FILTER (WHERE sentimiento = 'NEU')"),
    ]
)
over_marked("recent_shares", lambda df: recent.recent_shares(df, "event_id"), sql.over("marked", f"""
    SELECT count(*) AS total, {_LAST_SHARES}
    FROM (SELECT * FROM marked ORDER BY event_id DESC LIMIT 60)"""))
_ROLLING = ", ".join(
    f"{sql.percent(part, 'total', 1)} AS {name}"
    for name, part in [("pct_odio", "o"), ("pct_pos", "p"), ("pct_neg", "n"), ("pct_neu", "u")]
)
over_marked("rolling_shares", lambda df: recent.rolling_shares(df, "event_id"), sql.over("marked", f"""
    SELECT event_id, total, {_ROLLING} FROM (
      SELECT event_id, count(*) OVER w AS total, count(*) FILTER (WHERE es_odio) OVER w AS o,
             count(*) FILTER (WHERE sentimiento = 'POS') OVER w AS p,
             count(*) FILTER (WHERE sentimiento = 'NEG') OVER w AS n,
             count(*) FILTER (WHERE sentimiento = 'NEU') OVER w AS u
      FROM marked WINDOW w AS (ORDER BY event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))"""))
over_marked(
    "rolling_shares_sparse",
    lambda df: recent.rolling_shares(
        df.withColumn("sparse", F.col("event_id") * (1 << 40)), "sparse"),
    sql.over("marked", f"""
    SELECT event_id * 1099511627776 AS sparse, total, {_ROLLING} FROM (
      SELECT event_id, count(*) OVER w AS total, count(*) FILTER (WHERE es_odio) OVER w AS o,
             count(*) FILTER (WHERE sentimiento = 'POS') OVER w AS p,
             count(*) FILTER (WHERE sentimiento = 'NEG') OVER w AS n,
             count(*) FILTER (WHERE sentimiento = 'NEU') OVER w AS u
      FROM marked WINDOW w AS (ORDER BY event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))"""))
over_final("recent_messages", lambda df: recent.recent_messages(df, "rid"), sql.over("final", f"""
    SELECT rid, autor, substr(comentario, 1, 130) AS texto, {sql.category('categoria_odio')} AS categoria,
        CASE WHEN es_odio THEN 'odio' WHEN sentimiento = 'NEG' THEN 'negativo'
             WHEN sentimiento = 'POS' THEN 'positivo' ELSE 'neutral' END AS nivel
    FROM final ORDER BY rid DESC LIMIT 30"""))


over_final("processed_messages", lambda df: recent.processed_messages(df, "rid"), sql.over("final", f"""
    SELECT rid, autor, substr(coalesce(nullif(comentario_limpio, ''), comentario), 1, 120) AS texto,
        {sql.names('categoria_odio', CATEGORY_NAMES, "'Sin odio'")} AS categoria, prob_odio, sentimiento,
        CASE WHEN es_odio THEN 'odio' WHEN sentimiento = 'NEG' THEN 'negativo'
             WHEN sentimiento = 'POS' THEN 'positivo' ELSE 'neutral' END AS nivel
    FROM final ORDER BY rid DESC LIMIT 6"""))


# --- Streams -----------------------------------------------------------------

def _to_parquet(spark, df: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over all there is, into a Parquet folder, and read that."""
    path = work_dir(spark, purpose)
    jobs.start_parquet_sink(df, f"{path}/out", f"{path}/state", trigger="available").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


_CLOSED = "ventana_fin <= (SELECT epoch(max(ts)) FROM events) - 10"


def _latest(spark, df: DataFrame, purpose: str) -> DataFrame:
    """Run a window metric over all there is; the last window is part of the result."""
    path = work_dir(spark, purpose)
    jobs.start_latest_result(
        df, f"{path}/out", f"{path}/state", trigger="available", keys=["ventana_fin"], compact_every=2
    ).awaitTermination()
    return jobs.read_latest_result(spark, f"{path}/out", df.schema, "ventana_fin")


@checked("stream_throughput", sql.over("marked", "SELECT * FROM throughput", sql.throughput()))
def _stream_throughput(spark, sf):
    events = views.streams(spark, sf)("events")
    return _latest(spark, jobs.throughput_stream(events, "ts", late="10 seconds"), "throughput")


@checked("stream_sentiment", sql.over("marked", "SELECT * FROM ventanas", sql.sentiment_windows()))
def _stream_sentiment(spark, sf):
    events = views.marked(views.streams(spark, sf))
    return _latest(spark, jobs.sentiment_stream(events, "ts", late="10 seconds"), "sentiment")


@checked("stream_sentiment_complete", sql.over(
    "marked", "SELECT * FROM ventanas", sql.sentiment_windows()))
def _stream_sentiment_complete(spark, sf):
    """In several micro-batches, so that windows are updated."""
    path, read = work_dir(spark, "complete"), views.tables(spark, sf)
    read("events").repartition(3).write.parquet(f"{path}/in")
    arriving = spark.readStream.schema(read("events").schema).option(
        "maxFilesPerTrigger", 1).parquet(f"{path}/in")
    result = jobs.sentiment_stream(
        views.marked(lambda name: arriving if name == "events" else read(name)), "ts",
        late="60 days")
    return _latest(spark, result, "complete-out")


@checked("stream_late_data", sql.over("marked", f"""
    SELECT ventana_fin, count(*) AS cantidad_mensajes,
           {sql.rounded("(count(*) / 10.0e0)", 2)} AS throughput_msg_seg
    FROM (SELECT CAST(floor(epoch(ts) / 10) AS BIGINT) * 10 + 10 AS ventana_fin
          FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00')
    WHERE {_CLOSED} GROUP BY 1"""))
def _stream_late_data(spark, sf):
    """The second half of the month arrives first; the first half is then late."""
    path, events = work_dir(spark, "late"), views.tables(spark, sf)("events")
    second_half = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (second_half, ~second_half):
        events.filter(part).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        metric = jobs.throughput_stream(arriving, "ts", late="10 seconds")
        jobs.start_parquet_sink(
            metric, f"{path}/out", f"{path}/state", trigger="available"
        ).awaitTermination()
    return spark.read.schema(metric.schema).parquet(f"{path}/out")


def _by_clock(spark, path: str, metric: DataFrame, idle: float) -> DataFrame:
    """Run windows that close by the clock until the stream has been silent for a while."""
    query = jobs.start_clock_windows(metric, f"{path}/out", f"{path}/state", trigger="500 milliseconds")
    try:
        if not wait_until_idle(query, idle, timeout=300):
            raise TimeoutError("the stream never fell silent")
    finally:
        query.stop()
    return spark.read.schema(metric.schema).parquet(f"{path}/out")


@checked("stream_idle_window", sql.over("marked", "SELECT *, 0 AS revision FROM ventanas", sql.sentiment_windows()))
def _stream_idle_window(spark, sf):
    """No newer message follows the last window, and it is there, once."""
    metric = clock.clock_sentiment(views.marked(views.streams(spark, sf)), time="ts", idle=3)
    found = _by_clock(spark, work_dir(spark, "idle"), metric, 8)
    return found.withColumn("revision", F.col("revision").cast("int"))


def _in_two_halves(spark, sf, path: str):
    """The events arrive in two halves; the stream after each of them."""
    events = views.tables(spark, sf)("events")
    for half in (0, 1):
        events.filter(F.pmod("event_id", F.lit(2)) == half).write.mode("append").parquet(f"{path}/in")
        yield views.marked(lambda name: spark.readStream.schema(events.schema).parquet(f"{path}/in"))


@checked("stream_clock_windows", sql.over("marked", """
    SELECT count(*) AS mensajes, count(*) FILTER (WHERE sentimiento = 'POS') AS positivos,
           count(*) FILTER (WHERE es_odio) AS odio, 0 AS repetidas FROM marked"""))
def _stream_clock_windows(spark, sf):
    """Windows of the machine's time, over a restart: every message is in one of them,
    and no window is given twice."""
    path = work_dir(spark, "clock")
    for arriving in _in_two_halves(spark, sf, path):
        found = _by_clock(spark, path, clock.clock_sentiment(arriving, seconds=2), 6)
    return found.agg(
        F.sum("total_comentarios").alias("mensajes"), F.sum("positivos").alias("positivos"),
        F.sum("odio").alias("odio"),
        (F.count("*") - F.count_distinct("ventana_fin")).cast("int").alias("repetidas"))


@checked("stream_late_corrected", sql.over("marked", """
    SELECT t.*, veces FROM throughput t JOIN (
        SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) * 86400 + 86400 AS ventana_fin,
               count(DISTINCT event_id % 2) AS veces FROM events GROUP BY 1) USING (ventana_fin)""",
    sql.throughput(86400)))
def _stream_late_corrected(spark, sf):
    """Half of every day comes when its window is closed: the window is given again."""
    path = work_dir(spark, "corrected")
    for arriving in _in_two_halves(spark, sf, path):
        found = _by_clock(spark, path, clock.clock_throughput(arriving, 86400, "ts", 3), 8)
    times = found.groupBy("ventana_fin").agg(F.count("*").alias("veces"))
    return clock.last_revisions(found).join(times, "ventana_fin")


@checked("stream_running_shares", ORACLES["rolling_shares"])
def _stream_running_shares(spark, sf):
    """The shares after every message of a stream, which is stopped and started again."""
    path, read = work_dir(spark, "running"), views.tables(spark, sf)
    events = read("events")
    half = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        events.filter(part).write.mode("append").parquet(f"{path}/in")
        rows = views.marked(lambda name: spark.readStream.schema(events.schema).parquet(f"{path}/in")).select(
            "event_id", "es_odio", "sentimiento")
        jobs.start_rolling_shares(
            rows, "event_id", f"{path}/out", f"{path}/state", trigger="available").awaitTermination()
    schema = recent.rolling_shares(views.marked(read).limit(0), "event_id").schema
    return read_batches(spark, f"{path}/out", schema).drop("batch")


@checked("stream_one_read", sql.over("marked", """
    SELECT count(*) AS todos, count(*) FILTER (WHERE es_odio) AS odio, count(*) AS leidos FROM marked"""))
def _stream_one_read(spark, sf):
    """Two sinks of one query; between them it fails once, and is started again."""
    path, failed = work_dir(spark, "one-read"), []
    rows = views.marked(views.streams(spark, sf)).select("event_id", "es_odio")

    def hate(batch: DataFrame) -> DataFrame:
        if not failed:
            failed.append(True)
            raise RuntimeError("the second sink is not there")
        return batch.filter("es_odio")

    sinks = {"todos": (f"{path}/a", lambda batch: batch), "odio": (f"{path}/b", hate)}
    try:
        jobs.start_sinks(rows, sinks, f"{path}/state", trigger="available").awaitTermination()
    except StreamingQueryException:
        pass
    query = jobs.start_sinks(rows, sinks, f"{path}/state", trigger="available")
    query.awaitTermination()
    read = sum(p.numInputRows for p in query.recentProgress)
    count = lambda name, folder: read_batches(spark, folder, rows.schema).agg(
        F.count("*").alias(name), F.lit(1).alias("_"))
    return count("todos", f"{path}/a").join(count("odio", f"{path}/b"), "_").select(
        "todos", "odio", F.lit(read).cast("bigint").alias("leidos"))


@checked("stream_interval", sql.over("marked", "SELECT * FROM throughput", sql.throughput()))
def _stream_interval(spark, sf):
    """An interval trigger, a file for each batch; stopped when nothing more comes."""
    path, events = work_dir(spark, "interval"), views.tables(spark, sf)("events")
    events.repartition(3).write.parquet(f"{path}/in")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    df = jobs.throughput_stream(arriving, "ts", late="60 days")
    query = jobs.start_latest_result(
        df, f"{path}/out", f"{path}/state", trigger="300 milliseconds", keys=["ventana_fin"], compact_every=2)
    query.processAllAvailable()
    query.stop()
    return jobs.read_latest_result(spark, f"{path}/out", df.schema, "ventana_fin")


@checked("stream_stages", _FINAL_ORACLE)
def _stream_stages(spark, sf):
    """All stages as one query on file streams."""
    return _to_parquet(spark, views.final(views.streams(spark, sf)), "stages")


@checked("stream_topics", _FINAL_ORACLE)
def _stream_topics(spark, sf):
    """Each stage as its own query, linked by topics; ``rid`` passes through."""
    path = work_dir(spark, "topics")
    names = ["raw", "clean", "classified", "final"]
    raw, cleaned, classified, final = [FileTopic(f"{path}/{n}", "gzip") for n in names]
    raw.write_batch(encode(views.raw(views.tables(spark, sf))))
    hate, mood = views.scorers()
    hops = [
        (raw, cleaned, jobs.clean_stage()),
        (cleaned, classified, jobs.hate_stage(hate)),
        (classified, final, jobs.sentiment_stage(mood)),
    ]
    for source, sink, stage in hops:
        jobs.start_stage(
            spark, source, sink, stage, f"{sink.path}-state", trigger="available"
        ).awaitTermination()
    return decode(final.read_batch(spark).select("value"), extend(FINAL, rid=T.StringType()))


@checked("stream_two_sinks", sql.over("raw", """
    SELECT count(*) AS registros, count(*) AS limpios, count(*) AS contados, count(*) AS progreso FROM raw"""))
def _stream_two_sinks(spark, sf):
    """Two jobs read one topic at their own positions; the first is stopped after
    half of the files and started again. No record is lost or written twice."""
    path = work_dir(spark, "sinks")
    raw, cleaned = FileTopic(f"{path}/raw"), FileTopic(f"{path}/clean")
    records = views.raw(views.tables(spark, sf))
    half = F.pmod(F.xxhash64("rid"), F.lit(2)) == 0

    def run(queries):
        for query in queries:
            query.awaitTermination()
        return queries

    def cleaning():
        return jobs.start_stage(
            spark, raw, cleaned, jobs.clean_stage(), f"{path}/state", trigger="available",
            max_per_trigger=1,
        )

    raw.write_batch(encode(records.filter(half)))
    first = run([cleaning()])[0]
    raw.write_batch(encode(records.filter(~half)))
    copies = raw.read_stream(spark).select("value")
    second, _ = run([cleaning(), jobs.start_parquet_sink(
        copies, f"{path}/copy", f"{path}/state2", trigger="available")])
    told = sum(p.numInputRows for q in (first, second) for p in q.recentProgress)
    one = lambda df, name: df.agg(
        F.count("*").alias(name), F.lit(1).alias("_"))
    rid = text_field(parse_record(F.col("value")), "rid").alias("rid")
    lines = cleaned.read_batch(spark).select(rid)
    found = one(records, "registros").join(one(lines.distinct(), "limpios"), "_").join(
        one(spark.read.schema("value string").parquet(f"{path}/copy"), "contados"), "_")
    return found.select("registros", "limpios", "contados", F.lit(told).cast("bigint").alias("progreso"))


@checked("stream_recent_messages", sql.over("marked", """
    SELECT event_id, autor, likes, es_odio, sentimiento FROM marked ORDER BY event_id DESC LIMIT 60"""))
def _stream_recent_messages(spark, sf):
    path = work_dir(spark, "buffer")
    messages = views.marked(views.streams(spark, sf)).select(
        "event_id", "autor", "likes", "es_odio", "sentimiento"
    )
    start_buffer(
        messages, f"{path}/out", f"{path}/state", "event_id", trigger="available"
    ).awaitTermination()
    return read_buffer(spark, f"{path}/out", messages.schema)


# --- Word vectors --------------------------------------------------------------

def _words(spark, sf, path: str) -> DataFrame:
    """Word lists of stored texts: training reads its input several times. Parquet takes
    one text in a fraction of the time it takes for a list of its words."""
    cleaned = clean(views.raw(views.tables(spark, sf))).select("comentario_limpio")
    tables.write_table(cleaned, f"{path}/texts")
    return word_lists(tables.read_table(spark, f"{path}/texts"))


def _read_once(spark, sf) -> DataFrame:
    """Word lists for Word2Vec, which cuts them into pieces of its own first."""
    return word_lists(clean(views.raw(views.tables(spark, sf))).select("comentario_limpio"))


def _synonyms(spark, sf, terms):
    path = work_dir(spark, "word2vec")
    save_model(fit_word2vec(_read_once(spark, sf)), f"{path}/model")
    return nearest_terms(saved_vectors(spark, f"{path}/model"), terms)


@checked("word2vec_synonyms")
def _word2vec_synonyms(spark, sf):
    return _synonyms(spark, sf, ["idiot", "stupid", "que", "nicht", "purchase", "terruco"])


_WORD_LIST = "list_filter(regexp_split_to_array(comentario_limpio, ' '), lambda w: w <> '')"


@checked("word_lists", sql.over("limpio", f"""
    SELECT rid, len({_WORD_LIST}) AS palabras, list_distinct({_WORD_LIST})[1] IS NOT NULL AS alguna
    FROM limpio WHERE len({_WORD_LIST}) > 0"""))
def _word_lists(spark, sf):
    cleaned = clean(views.raw(views.tables(spark, sf)))
    lists = word_lists(cleaned, keep=["rid"])
    return lists.select(
        "rid", F.size("tokens").cast("bigint").alias("palabras"), (F.get("tokens", F.lit(0)) != "").alias("alguna")
    )


@checked("word2vec_checks", sql.over("limpio", f"""
    SELECT count(DISTINCT w) AS vocabulario, 50 AS medidas, true AS rangos, true AS valores, true AS leido
    FROM (SELECT unnest({_WORD_LIST}) AS w FROM limpio)"""))
def _word2vec_checks(spark, sf):
    """Size of the vocabulary and of the vectors, ranks and range of the neighbours,
    and whether the saved model is the trained one."""
    path = work_dir(spark, "word2vec")
    model = fit_word2vec(_read_once(spark, sf))
    save_model(model, f"{path}/model")
    vectors = saved_vectors(spark, f"{path}/model")
    sizes = vectors.agg(
        F.count("*").alias("vocabulario"), F.max(F.size("vector")).alias("medidas")
    )
    near = nearest_terms(vectors, ["que", "the", "nicht"], 4).groupBy("palabra_clave").agg(
        F.count("*").alias("n"), F.every(F.col("similitud").between(-1, 1)).alias("ok")
    ).agg(F.every(F.col("n") == 4).alias("rangos"), F.every("ok").alias("valores"))
    # A hash of the vector is moved in its place.
    read, own = (m.getVectors().select("word", F.xxhash64("vector").alias("vector"))
                 for m in (load_model(f"{path}/model"), model))
    kept = read.join(own, ["word", "vector"], "left_anti").limit(1)
    same = kept.agg((F.count("*") == 0).alias("leido"))
    one = F.lit(1).alias("_")
    return (
        sizes.withColumn("_", one).join(near.withColumn("_", one), "_")
        .join(same.withColumn("_", one), "_").drop("_")
    )


@checked("synonyms_missing_terms")
def _synonyms_missing_terms(spark, sf):
    return _synonyms(spark, sf, ["terruco", "comunista"])


# Every pair of words at most five apart, both ways, and its positive information.
_PAIRS = f"""palabras AS (
    SELECT rid, unnest({_WORD_LIST}) AS w, generate_subscripts({_WORD_LIST}, 1) AS i FROM limpio
), cercanas AS (
    SELECT w, unnest([lead(w, 1) OVER v, lead(w, 2) OVER v, lead(w, 3) OVER v, lead(w, 4) OVER v,
        lead(w, 5) OVER v]) AS x FROM palabras WINDOW v AS (PARTITION BY rid ORDER BY i)
), pares AS (
    SELECT a, b, count(*) AS n FROM (
        SELECT w AS a, x AS b FROM cercanas WHERE x IS NOT NULL
        UNION ALL SELECT x, w FROM cercanas WHERE x IS NOT NULL) GROUP BY ALL
), sumas AS (SELECT a, sum(n) AS na FROM pares GROUP BY a),
ppmi AS (
    SELECT p.a, p.b, ln(p.n * CAST(t.n AS DOUBLE) / (CAST(x.na AS DOUBLE) * y.na)) AS valor
    FROM pares p JOIN sumas x ON x.a = p.a JOIN sumas y ON y.a = p.b, (SELECT sum(n) AS n FROM pares) t
    WHERE ln(p.n * CAST(t.n AS DOUBLE) / (CAST(x.na AS DOUBLE) * y.na)) > 0
)"""


def _information(spark, sf):
    words = _words(spark, sf, work_dir(spark, "cooccurrence"))
    return words, co.positive_information(co.pair_counts(words))


@checked("cooccurrence_by_word", sql.over("limpio", f"""
    SELECT a AS palabra, count(*) AS parejas, round(sum(valor), 3) AS informacion
    FROM ppmi GROUP BY a""", _PAIRS))
def _cooccurrence_by_word(spark, sf):
    words, matrix = _information(spark, sf)
    sums = matrix.groupBy(F.col("a").alias("id")).agg(
        F.count("*").alias("parejas"), F.round(F.sum("value"), 3).alias("informacion"))
    return sums.join(co.word_ids(words), "id").select(F.col("word").alias("palabra"), "parejas", "informacion")


_NEAR_KEYS = ("que", "the", "nicht", "stupid", "terruco")


@checked("nearest_by_information", sql.over("limpio", f"""
    SELECT palabra_clave, palabra_similar, similitud FROM (
        SELECT *, row_number() OVER (PARTITION BY palabra_clave ORDER BY similitud DESC, palabra_similar) AS n
        FROM (
            SELECT k.a AS palabra_clave, m.a AS palabra_similar,
                round(sum(k.valor * m.valor) / (any_value(nk.norma) * any_value(nm.norma)), 6) AS similitud
            FROM ppmi k JOIN ppmi m ON m.b = k.b AND m.a <> k.a
            JOIN normas nk ON nk.a = k.a JOIN normas nm ON nm.a = m.a
            WHERE k.a IN {_NEAR_KEYS} GROUP BY ALL))
    WHERE n <= 4""", _PAIRS, "normas AS (SELECT a, sqrt(sum(valor * valor)) AS norma FROM ppmi GROUP BY a)"))
def _nearest_by_information(spark, sf):
    words, matrix = _information(spark, sf)
    return co.nearest_rows(matrix, co.word_ids(words), _NEAR_KEYS, 4)


@checked("factor_synonyms")
def _factor_synonyms(spark, sf):
    """As ``word2vec_synonyms``, from counts, with nothing per word on the driver."""
    words = _words(spark, sf, work_dir(spark, "factors"))
    vectors = tables_stage(co.word_vectors(words), "factor-vectors")
    return nearest_terms(vectors, ["idiot", "stupid", "que", "nicht", "purchase", "terruco"])


def _vectors(spark, sf) -> DataFrame:
    return views.tables(spark, sf)("embeddings").select(
        F.col("vec_id").cast("string").alias("word"), F.col("embedding").alias("vector")
    )


def _nearest(*terms: str) -> str:
    wanted = ", ".join(f"'{t}'" for t in terms)
    return f"""
    WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS word, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    p AS (SELECT k.word AS palabra_clave, v.word AS palabra_similar, list_cosine_similarity(k.x, v.x) AS c
          FROM v JOIN v AS k ON k.word <> v.word WHERE k.word IN ({wanted})),
    r AS (SELECT *, row_number() OVER (PARTITION BY palabra_clave ORDER BY c DESC, palabra_similar) AS n FROM p)
    SELECT palabra_clave, palabra_similar, {sql.rounded('c', 4)} AS similitud FROM r WHERE n <= 5"""


@checked("nearest_vectors", _nearest("0", "7", "42", "123"))
def _nearest_vectors(spark, sf):
    return nearest_terms(_vectors(spark, sf), ["0", "7", "42", "123"])


@checked("nearest_vectors_some_absent", _nearest("3", "-1"))
def _nearest_vectors_some_absent(spark, sf):
    """A key word without a vector gives no rows; the others give theirs."""
    return nearest_terms(_vectors(spark, sf), ["3", "-1", "nada"])


@checked("nearest_vectors_absent", f"SELECT count(*) AS filas FROM ({_nearest('nada')})")
def _nearest_vectors_absent(spark, sf):
    return nearest_terms(_vectors(spark, sf), ["nada", "-1"]).agg(F.count("*").alias("filas"))
