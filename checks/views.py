"""Comment views over the given tables.

``mixed``  one row per document, chat turn, web page and event, in the shape of
           the mixed input table (two text columns, untyped numbers);
``marked`` one row per event with class probabilities, decided by the library;
``topic``  the marked events with a topic partition and a gap-free offset.

The views take a reader, so a table and a stream go through the same code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmullo.operators.scorers import lexicon_scorer
from murmullo.operators.stages import decide_hate, decide_sentiment, enrich
from murmullo.schemas import HATE_LABELS, NEUTRAL, SENTIMENT_LABELS
from murmullo.sources.tables import normalize_comments

Reader = Callable[[str], DataFrame]

# Word lists for the given texts. The hate words are the insults that occur in
# them; the sentiment words are common ones, so that every class occurs.
HATE_LEXICON = {
    "CALLS": ["trash", "scum"],
    "CRIMINAL": ["clown"],
    "RACISM": ["disgusting"],
    "CLASS": ["loser", "worthless"],
    "APPEARANCE": ["pathetic"],
    "POLITICS": ["idiot"],
    "WOMEN": ["stupid"],
    "LGBTI": ["moron"],
}
SENTIMENT_LEXICON = {
    "POS": ["con", "with", "mit", "avec", "para", "for", "pour"],
    "NEG": ["no", "not", "nicht", "pas", "idiot", "stupid", "de", "that"],
}
HALF_POINT = 2.0

PROBABILITY_STEPS = {
    "CALLS": 7919, "CRIMINAL": 6101, "RACISM": 5003, "CLASS": 4211,
    "APPEARANCE": 3307, "POLITICS": 2503, "WOMEN": 1709, "LGBTI": 911,
}
SENTIMENT_STEPS = {"POS": 613, "NEG": 409, "NEU": 271}


def tables(spark: SparkSession, sf_dir: str) -> Reader:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def streams(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> Reader:
    """The same tables as file streams, whether a table is a file or a folder."""

    def read(name: str) -> DataFrame:
        reader = spark.readStream.schema(tables(spark, sf_dir)(name).schema)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(f"{sf_dir}/{name}.parquet*")

    return read


def _dated(number: str) -> str:
    """A date in one of the accepted formats, an empty or an unreadable one."""
    t = f"timestamp_seconds(1704067200 + {number} * 2237)"
    return f"""CASE {number} % 6
        WHEN 0 THEN date_format({t}, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        WHEN 1 THEN date_format({t}, 'yyyy-MM-dd HH:mm:ss')
        WHEN 2 THEN date_format({t}, "yyyy-MM-dd'T'HH:mm:ss")
        WHEN 3 THEN date_format({t}, 'yyyy-MM-dd')
        WHEN 4 THEN '' ELSE 'ayer' END"""


def mixed(read: Reader) -> DataFrame:
    """Video comments, chat messages, pages and short event notes in one table."""
    documents = read("documents").selectExpr(
        "concat('d', doc_id) AS rid",
        "source AS autor",
        """concat(text, CASE doc_id % 5
               WHEN 0 THEN concat(' https://ejemplo.pe/Ñ?d=', doc_id, ' fin')
               WHEN 1 THEN ' @user_7!!! :a_b: ¿Qué?.. @ñandú'
               WHEN 2 THEN ' 😂🔥 vaya ❤️❤ 👍'
               ELSE '' END) AS comentario""",
        "CAST(NULL AS STRING) AS mensaje",
        """CASE doc_id % 8
               WHEN 0 THEN CAST(n_chars AS STRING) WHEN 1 THEN '7.9' WHEN 2 THEN '-3.9'
               WHEN 3 THEN 'NaN' WHEN 4 THEN 'inf' WHEN 5 THEN 'x' WHEN 6 THEN NULL
               ELSE concat(' ', n_chars, ' ') END AS likes""",
        f"{_dated('doc_id')} AS fecha",
        """CASE doc_id % 3 WHEN 0 THEN CAST(doc_id AS STRING)
               WHEN 1 THEN concat(doc_id, '.5') ELSE NULL END AS respuestas""",
    )
    chat = read("conversations").selectExpr(
        "concat('c', conv_id, '-', turn) AS rid",
        "role AS autor",
        "CAST(NULL AS STRING) AS comentario",
        "text AS mensaje",
        "CAST(turn AS STRING) AS likes",
        "CAST(NULL AS STRING) AS fecha",
        "CAST(NULL AS STRING) AS respuestas",
    )
    pages = read("pages").selectExpr(
        "concat('p', page_id) AS rid",
        "CAST(NULL AS STRING) AS autor",
        "html AS comentario",
        "url AS mensaje",
        "CAST(page_id AS STRING) AS likes",
        f"{_dated('page_id')} AS fecha",
        "'1e2' AS respuestas",
    )
    notes = read("events").selectExpr(
        "concat('e', event_id) AS rid",
        "concat('user_', user_id) AS autor",
        "CASE event_type WHEN 'view' THEN ' \t\n' ELSE NULL END AS comentario",
        "CASE event_type WHEN 'error' THEN NULL ELSE concat(event_type, ' ', props) END AS mensaje",
        "CAST(value AS STRING) AS likes",
        f"{_dated('event_id')} AS fecha",
        "get_json_object(props, '$.k') AS respuestas",
    )
    return documents.unionByName(chat).unionByName(pages).unionByName(notes)


def texts(read: Reader) -> DataFrame:
    """Row id and text of every mixed row that has one."""
    text = F.coalesce("comentario", "mensaje")
    return mixed(read).select("rid", text.alias("texto")).filter(F.col("texto").isNotNull())


def raw(read: Reader) -> DataFrame:
    return normalize_comments(mixed(read))


def scorers():
    return (
        lexicon_scorer(HATE_LEXICON, HATE_LABELS, HALF_POINT),
        lexicon_scorer(SENTIMENT_LEXICON, SENTIMENT_LABELS, HALF_POINT, NEUTRAL),
    )


def final(read: Reader) -> DataFrame:
    """The mixed rows after all three stages, scored with the word lists."""
    return enrich(raw(read), *scorers())


def given_probabilities(read: Reader, as_map: bool = True) -> DataFrame:
    """One comment per event with its label probabilities, as maps or as arrays."""
    e = read("events")

    def table(steps: dict[str, int], modulus: int, scale: float):
        found = {
            label: (F.col("event_id") * step) % modulus / F.lit(scale)
            for label, step in steps.items()
        }
        if as_map:
            return F.create_map(*[x for k, p in found.items() for x in (F.lit(k), p)])
        return F.array(*found.values())

    return e.select(
        "event_id", "ts", "event_type", "props",
        F.concat(F.lit("user_"), F.col("user_id")).alias("autor"),
        F.floor("value").alias("likes"),
        F.expr(_dated("event_id")).alias("fecha"),
        table({k: PROBABILITY_STEPS[k] for k in HATE_LABELS}, 1000, 3200.0).alias("probas_odio"),
        table(SENTIMENT_STEPS, 997, 997.0).alias("probas_sentimiento"),
        F.expr("CASE event_type WHEN 'view' THEN ' \t' WHEN 'error' THEN NULL ELSE props END")
        .alias("texto_parcial"),
    )


def marked(read: Reader) -> DataFrame:
    """The events with hate and sentiment decided from the given probabilities."""
    given = given_probabilities(read, as_map=False)
    return decide_sentiment(decide_hate(given, text="props"), text="props").drop(
        "probas_odio", "probas_sentimiento", "texto_parcial"
    )


def topic(read: Reader) -> DataFrame:
    return marked(read).withColumns({
        "partition": (F.col("event_id") % 3).cast("int"),
        "offset": F.floor(F.col("event_id") / 3),
        "timestamp": F.col("ts").cast("timestamp"),
    })
