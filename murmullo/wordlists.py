"""Word lists and label maps."""

from __future__ import annotations

# Words left out of the top-terms report.
TERM_STOPWORDS = tuple("""
el la de que y a en un ser se no haber por con su para como estar tener le lo todo pero mas
hacer o poder decir este ir otro ese si me ya ver porque dar cuando muy sin vez mucho saber los
las del al una unos unas es son fue ha te mi tu nos hay les han era eso aqui ni más también
bien solo sino hasta sobre entre durante tras antes después aunque mientras donde quien cuál cual
cuándo así tan tanto cada esta estas estos
tiene puede van voy vamos están siendo hizo hará haría dijo dice dijeron
quiero quiere queremos sabe saben sé deben debe
cara risa llorando sonriendo gente señora señor persona personas todos todas nada algo alguien
nadie veces año años día días parte lado tipo caso forma manera lugar país perú ciudad mundo
tiempo momento hora horas sola solos solas nuevo nueva gran grande mismo misma igual menos poco
mucha sus nunca siempre ahora luego aquí allí qué quién cómo cuánto
""".split())

# Words left out of the negative-terms report.
NEGATIVE_STOPWORDS = tuple("""
de la el en y a los del se las por un para con una su al lo como más pero sus le ya o este porque
esta entre cuando muy sin sobre también me hasta hay han desde todo nos todos uno les ni otros ese
eso ante ellos e esto antes yo otro otras otra mucho nada cual poco ella estas si te que es son no
ha he mi tu ser bien puede vez hoy va q
""".split())

# Terms whose nearest neighbours are reported.
KEY_TERMS = ("terruco", "comunista", "candidato", "corrupto", "voto", "presidente")

# Display names of the categories.
CATEGORY_NAMES = {
    "CALLS": "Incitación",
    "CRIMINAL": "Criminalización",
    "RACISM": "Racismo",
    "CLASS": "Clasismo",
    "APPEARANCE": "Apariencia",
    "POLITICS": "Política",
    "WOMEN": "Misoginia",
    "LGBTI": "LGBTI+",
    "ninguna": "Sin odio",
}
SENTIMENT_NAMES = {"POS": "Positivo", "NEG": "Negativo", "NEU": "Neutral"}

# Spanish short names of common emoji (Unicode CLDR). A caller
# with a fuller table passes it as data: every emoji function takes a dict.
EMOJI_NAMES = {
    "😀": "cara_sonriendo",
    "😃": "cara_sonriendo_con_ojos_grandes",
    "😄": "cara_sonriendo_con_ojos_sonrientes",
    "😁": "cara_radiante_con_ojos_sonrientes",
    "😆": "cara_sonriendo_con_los_ojos_cerrados",
    "😅": "cara_sonriendo_con_sudor_frío",
    "🤣": "cara_revolviéndose_de_la_risa",
    "😂": "cara_llorando_de_risa",
    "🙂": "cara_sonriendo_ligeramente",
    "🙃": "cara_al_revés",
    "😉": "cara_guiñando_el_ojo",
    "😊": "cara_feliz_con_ojos_sonrientes",
    "😇": "cara_sonriendo_con_aureola",
    "🥰": "cara_sonriendo_con_corazones",
    "😍": "cara_sonriendo_con_ojos_de_corazón",
    "😘": "cara_lanzando_un_beso",
    "😎": "cara_sonriendo_con_gafas_de_sol",
    "🤔": "cara_pensativa",
    "😐": "cara_neutral",
    "😒": "cara_de_desaprobación",
    "🙄": "cara_con_ojos_en_blanco",
    "😢": "cara_llorando",
    "😭": "cara_llorando_fuerte",
    "😡": "cara_cabreada",
    "😠": "cara_enfadada",
    "🤬": "cara_con_símbolos_en_la_boca",
    "🤮": "cara_vomitando",
    "🤡": "cara_de_payaso",
    "👏": "manos_aplaudiendo",
    "👍": "pulgar_hacia_arriba",
    "👎": "pulgar_hacia_abajo",
    "🙏": "manos_en_oración",
    "💪": "bíceps_flexionado",
    "❤️": "corazón_rojo",
    "💔": "corazón_roto",
    "🔥": "fuego",
    "🎉": "cañón_de_confeti",
    "🇵🇪": "bandera_perú",
}
