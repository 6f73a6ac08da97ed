"""The same views in SQL, for the value check."""

from __future__ import annotations

from checks.views import (
    HALF_POINT, HATE_LEXICON, PROBABILITY_STEPS, SENTIMENT_LEXICON, SENTIMENT_STEPS,
)
from murmullo.schemas import HATE_LABELS, SENTIMENT_LABELS
from murmullo.wordlists import CATEGORY_NAMES, EMOJI_NAMES, SENTIMENT_NAMES

SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x85"
KEPT = "a-zA-Z0-9ñáéíóúü"
# The emoji that the views add to the texts.
USED_EMOJI = ["❤️", "😂", "🔥", "👍"]


def rounded(x: str, digits: int) -> str:
    """Half-up rounding on the decimal text of a double."""
    return (
        f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"
    )


def percent(part: str, total: str, digits: int = 2) -> str:
    share = rounded(f"(CAST({part} AS DOUBLE) / {total} * 100)", digits)
    return f"CASE WHEN {total} = 0 THEN 0.0 ELSE {share} END"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def names(column: str, table: dict[str, str], default: str | None = None) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} {cases} ELSE {default or column} END"


def category(column: str) -> str:
    return names(column, CATEGORY_NAMES)


def sentiment(column: str) -> str:
    return names(column, SENTIMENT_NAMES, "NULL")


def sub(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"


def urls(x: str) -> str:
    return sub(x, f"http[^{SPACE}]+", "")


def mentions(x: str) -> str:
    return sub(x, r"@[\p{L}\p{N}_]+", "")


def emoji(x: str) -> str:
    for seq in USED_EMOJI:
        x = f"replace({x}, '{seq}', ':{EMOJI_NAMES[seq]}:')"
    return f"replace({x}, '❤', ':{EMOJI_NAMES['❤️']}:')"


def repeats(x: str) -> str:
    for mark, pattern in [("!", "!{2,}"), ("?", r"\?{2,}"), (".", r"\.{2,}")]:
        x = sub(x, pattern, mark)
    return x


def charset(x: str) -> str:
    return sub(x, f"[^{KEPT}{SPACE}]", " ")


def spaces(x: str) -> str:
    return f"trim({sub(x, f'[{SPACE}]+', ' ')})"


def cleaned(x: str) -> str:
    step = emoji(mentions(urls(f"lower({x})")))
    return spaces(charset(repeats(f"translate({step}, ':_', '  ')")))


def has_text(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '[^{SPACE}]'), false)"


def strip(x: str) -> str:
    return sub(x, f"^[{SPACE}]+|[{SPACE}]+$", "")


def safe_int(x: str) -> str:
    number = f"TRY_CAST({x} AS DOUBLE)"
    return (
        f"CASE WHEN isnan({number}) OR isinf({number}) THEN 0 "
        f"ELSE coalesce(TRY_CAST(trunc({number}) AS BIGINT), 0) END"
    )


def safe_double(x: str) -> str:
    number = f"TRY_CAST({x} AS DOUBLE)"
    return f"CASE WHEN isnan({number}) THEN 0.0 ELSE coalesce({number}, 0.0) END"


def _dated(number: str) -> str:
    t = f"make_timestamp((1704067200 + {number} * 2237) * 1000000)"
    return f"""CASE {number} % 6
        WHEN 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%SZ')
        WHEN 1 THEN strftime({t}, '%Y-%m-%d %H:%M:%S')
        WHEN 2 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S')
        WHEN 3 THEN strftime({t}, '%Y-%m-%d')
        WHEN 4 THEN '' ELSE 'ayer' END"""


MIXED = f"""mixed AS (
  SELECT concat('d', doc_id) AS rid, source AS autor,
         concat(text, CASE doc_id % 5
           WHEN 0 THEN concat(' https://ejemplo.pe/Ñ?d=', doc_id, ' fin')
           WHEN 1 THEN ' @user_7!!! :a_b: ¿Qué?.. @ñandú'
           WHEN 2 THEN ' 😂🔥 vaya ❤️❤ 👍'
           ELSE '' END) AS comentario,
         CAST(NULL AS VARCHAR) AS mensaje,
         CASE doc_id % 8
           WHEN 0 THEN CAST(n_chars AS VARCHAR) WHEN 1 THEN '7.9' WHEN 2 THEN '-3.9'
           WHEN 3 THEN 'NaN' WHEN 4 THEN 'inf' WHEN 5 THEN 'x' WHEN 6 THEN NULL
           ELSE concat(' ', n_chars, ' ') END AS likes,
         {_dated('doc_id')} AS fecha,
         CASE doc_id % 3 WHEN 0 THEN CAST(doc_id AS VARCHAR)
           WHEN 1 THEN concat(doc_id, '.5') ELSE NULL END AS respuestas
  FROM documents
  UNION ALL
  SELECT concat('c', conv_id, '-', turn), role, NULL, text, CAST(turn AS VARCHAR), NULL, NULL
  FROM conversations
  UNION ALL
  SELECT concat('p', page_id), NULL, html, url, CAST(page_id AS VARCHAR), {_dated('page_id')}, '1e2'
  FROM pages
  UNION ALL
  SELECT concat('e', event_id), concat('user_', user_id),
         CASE event_type WHEN 'view' THEN concat(' ', chr(9), chr(10)) ELSE NULL END,
         CASE event_type WHEN 'error' THEN NULL ELSE concat(event_type, ' ', props) END,
         CAST(value AS VARCHAR), {_dated('event_id')}, json_extract_string(props, '$.k')
  FROM events
)"""

TEXTS = """texts AS (
  SELECT rid, coalesce(comentario, mensaje) AS texto FROM mixed
  WHERE coalesce(comentario, mensaje) IS NOT NULL
)"""

RAW = f"""raw AS (
  SELECT rid, coalesce(autor, 'desconocido') AS autor,
         {strip('coalesce(comentario, mensaje)')} AS comentario,
         {safe_int('likes')} AS likes, coalesce(fecha, '') AS fecha,
         {safe_int('respuestas')} AS respuestas
  FROM mixed WHERE {has_text('coalesce(comentario, mensaje)')}
)"""

CLEAN = f"""limpio AS (
  SELECT *, {cleaned('comentario')} AS comentario_limpio FROM raw
)"""


def _hits(words) -> str:
    return (
        "CAST(len(list_filter(string_split(comentario_limpio, ' '), "
        f"lambda w: w IN ({quoted(words)}))) AS DOUBLE)"
    )


_COUNTED = ", ".join(
    f"{_hits(words)} AS h_{label}"
    for label, words in {**HATE_LEXICON, **SENTIMENT_LEXICON}.items()
)
_HATE_P = ", ".join(f"h_{x} / (h_{x} + {HALF_POINT}) AS p_{x}" for x in HATE_LEXICON)
_ALL = f"(h_POS + h_NEG + {HALF_POINT})"
SCORES = f"""puntos AS (
  SELECT *, {_HATE_P}, h_POS / {_ALL} AS p_POS, h_NEG / {_ALL} AS p_NEG,
         {HALF_POINT} / {_ALL} AS p_NEU
  FROM (SELECT *, {_COUNTED} FROM limpio)
)"""


def best(labels) -> str:
    top = "greatest(" + ", ".join(f"p_{x}" for x in labels) + ")"
    return "CASE " + " ".join(f"WHEN p_{x} = {top} THEN '{x}'" for x in labels) + " END"


def decided(text: str) -> str:
    """Hate and sentiment columns from the ``p_*`` columns."""
    top = "greatest(" + ", ".join(f"p_{x}" for x in HATE_LABELS) + ")"
    mood = "greatest(" + ", ".join(f"p_{x}" for x in SENTIMENT_LABELS) + ")"
    some = has_text(text)
    return f"""{some} AND {top} > 0.3 AS es_odio,
        CASE WHEN {some} THEN {rounded(top, 3)} ELSE 0.0 END AS prob_odio,
        CASE WHEN NOT {some} THEN 'sin_texto' WHEN {top} > 0.3 THEN {best(HATE_LABELS)}
             ELSE 'ninguna' END AS categoria_odio,
        CASE WHEN {some} THEN {best(SENTIMENT_LABELS)} ELSE 'NEU' END AS sentimiento,
        CASE WHEN {some} THEN {rounded(mood, 3)} ELSE 0.0 END AS prob_sentimiento"""


FINAL = f"""final AS (
  SELECT rid, autor, comentario, likes, fecha, respuestas, comentario_limpio,
         {decided('comentario_limpio')}
  FROM puntos
)"""

_GIVEN_P = ", ".join(
    [f"((event_id * {s}) % 1000) / 3200.0e0 AS p_{x}" for x, s in PROBABILITY_STEPS.items()]
    + [f"((event_id * {s}) % 997) / 997.0e0 AS p_{x}" for x, s in SENTIMENT_STEPS.items()]
)
GIVEN = f"""dado AS (
  SELECT event_id, ts, event_type, props, concat('user_', user_id) AS autor,
         CAST(floor(value) AS BIGINT) AS likes, {_dated('event_id')} AS fecha,
         CASE event_type WHEN 'view' THEN concat(' ', chr(9)) WHEN 'error' THEN NULL
              ELSE props END AS texto_parcial,
         {_GIVEN_P}
  FROM events
)"""
MARKED = f"""marked AS (
  SELECT event_id, ts, event_type, props, autor, likes, fecha, {decided('props')} FROM dado
)"""
TOPIC = """topic AS (
  SELECT *, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset" FROM marked
)"""


def windows(seconds: int, *columns: str) -> str:
    end = f"CAST(floor(epoch(ts) / {seconds}) AS BIGINT) * {seconds} + {seconds}"
    return f"SELECT {end} AS ventana_fin, {', '.join(columns)} FROM marked GROUP BY 1"


def throughput(seconds: int = 10) -> str:
    return "throughput AS (" + windows(
        seconds, "count(*) AS cantidad_mensajes",
        f"{rounded(f'(count(*) / {float(seconds)}e0)', 2)} AS throughput_msg_seg",
    ) + ")"


def sentiment_windows(seconds: int = 60) -> str:
    return "ventanas AS (" + windows(
        seconds, "count(*) AS total_comentarios",
        "count(*) FILTER (WHERE sentimiento = 'POS') AS positivos",
        "count(*) FILTER (WHERE sentimiento = 'NEG') AS negativos",
        "count(*) FILTER (WHERE sentimiento NOT IN ('POS', 'NEG')) AS neutrales",
        "count(*) FILTER (WHERE es_odio) AS odio",
        f"{percent('count(*) FILTER (WHERE es_odio)', 'count(*)')} AS porcentaje_odio",
    ) + ")"


_MIXED_CHAIN = {
    "mixed": [MIXED], "texts": [MIXED, TEXTS], "raw": [MIXED, RAW],
    "limpio": [MIXED, RAW, CLEAN], "puntos": [MIXED, RAW, CLEAN, SCORES],
    "final": [MIXED, RAW, CLEAN, SCORES, FINAL],
}
_EVENT_CHAIN = {"dado": [GIVEN], "marked": [GIVEN, MARKED], "topic": [GIVEN, MARKED, TOPIC]}


def over(view: str, query: str, *more: str) -> str:
    """``query`` with the view it reads, and the views that one reads, in front."""
    chain = {**_MIXED_CHAIN, **_EVENT_CHAIN}[view]
    return "WITH " + ",\n".join([*chain, *more]) + "\n" + query


RISK = f"""riesgo AS (
  SELECT *, {rounded('(porcentaje_odio * (1 + likes_en_odio * 0.01e0))', 2)} AS score_riesgo
  FROM (
    SELECT autor, count(*) AS total_comentarios,
           count(*) FILTER (WHERE es_odio) AS comentarios_odio,
           CAST(coalesce(sum(likes) FILTER (WHERE es_odio), 0) AS BIGINT) AS likes_en_odio,
           CAST(sum(likes) AS BIGINT) AS likes_totales,
           {percent('count(*) FILTER (WHERE es_odio)', 'count(*)')} AS porcentaje_odio
    FROM marked GROUP BY autor HAVING count(*) >= 2
  )
)"""


def hour(date: str) -> str:
    parsed = ", ".join(
        f"try_strptime({date}, '{f}')"
        for f in ("%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d")
    )
    return f"CAST(hour(coalesce({parsed}) - INTERVAL 5 HOUR) AS INTEGER)"


def trend(hour_of_day: str, condition: str = "true") -> str:
    flagged = "count(*) FILTER (WHERE es_odio)"
    return f"""SELECT {hour_of_day} AS hora_dia, count(*) AS total_comentarios,
        {flagged} AS comentarios_odio, {percent(flagged, 'count(*)')} AS porcentaje_odio
        FROM marked WHERE {condition} GROUP BY 1"""
