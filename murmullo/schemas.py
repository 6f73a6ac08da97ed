"""Record schemas of the wire contract and of the stored results."""

from __future__ import annotations

from pyspark.sql import types as T

# Class labels in declared order (the order breaks ties).
HATE_LABELS = (
    "CALLS", "CRIMINAL", "RACISM", "CLASS",
    "APPEARANCE", "POLITICS", "WOMEN", "LGBTI",
)
SENTIMENT_LABELS = ("POS", "NEG", "NEU")
NO_HATE = "ninguna"
NO_TEXT = "sin_texto"
NEUTRAL = "NEU"
UNKNOWN_AUTHOR = "desconocido"

# Default decision threshold, window lengths and topic names.
HATE_THRESHOLD = 0.3
THROUGHPUT_SECONDS = 10
SENTIMENT_SECONDS = 60
TOPIC_RAW = "comentarios-raw"
TOPIC_CLEAN = "comentarios-limpios"
TOPIC_CLASSIFIED = "comentarios-clasificados"
TOPIC_FINAL = "comentarios-finales"
TOPIC_THROUGHPUT = "metricas-throughput"
TOPIC_SENTIMENT = "metricas-ventana-sentimiento"


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def extend(schema: T.StructType, **fields: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *struct(**fields).fields])


_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DOUBLE, _FLAG = T.DoubleType(), T.BooleanType()

RAW = struct(autor=_TEXT, comentario=_TEXT, likes=_LONG, fecha=_TEXT, respuestas=_LONG)
CLEAN = extend(RAW, comentario_limpio=_TEXT)
CLASSIFIED = extend(CLEAN, es_odio=_FLAG, prob_odio=_DOUBLE, categoria_odio=_TEXT)
FINAL = extend(CLASSIFIED, sentimiento=_TEXT, prob_sentimiento=_DOUBLE)

THROUGHPUT = struct(ventana_fin=_LONG, cantidad_mensajes=_LONG, throughput_msg_seg=_DOUBLE)
SENTIMENT = struct(
    ventana_fin=_LONG, total_comentarios=_LONG, positivos=_LONG, negativos=_LONG,
    neutrales=_LONG, odio=_LONG, porcentaje_odio=_DOUBLE,
)
TOP_TERMS = struct(palabra=_TEXT, count=_LONG)
USER_RISK = struct(
    autor=_TEXT, total_comentarios=_LONG, comentarios_odio=_LONG, likes_en_odio=_LONG,
    likes_totales=_LONG, porcentaje_odio=_DOUBLE, score_riesgo=_DOUBLE,
)
SYNONYMS = struct(palabra_clave=_TEXT, palabra_similar=_TEXT, similitud=_DOUBLE)
HOURLY_TREND = struct(
    hora_dia=_INT, total_comentarios=_LONG, comentarios_odio=_LONG, porcentaje_odio=_DOUBLE
)
CORRELATION = struct(
    es_odio=_FLAG, cantidad=_LONG, promedio_likes=_DOUBLE, prob_odio_promedio=_DOUBLE,
    correlacion_pearson=_DOUBLE, interpretacion=_TEXT,
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same fields, all as strings: JSON is read this way, then coerced."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
