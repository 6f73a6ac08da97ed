"""Fixed tables, pinned: the SQL oracles read the same tables as the library."""

import hashlib

import murmullo.wordlists as lists
from murmullo.functions.text import clean_text, emoji_names
from pyspark.sql import functions as F


def _digest(table):
    items = sorted(table.items()) if isinstance(table, dict) else sorted(table)
    return hashlib.sha256(repr(items).encode()).hexdigest()[:16]


PINNED = {
    "TERM_STOPWORDS": "c6e4352a5ad74516",
    "NEGATIVE_STOPWORDS": "9953e110ee70d2e3",
    "KEY_TERMS": "8af777acac96c55f",
    "CATEGORY_NAMES": "9d7eef79c1b04c80",
    "SENTIMENT_NAMES": "3a6aab3e81203edd",
}


def test_tables_are_the_ones_that_were_checked():
    found = {name: _digest(getattr(lists, name)) for name in PINNED}
    assert found == PINNED


def test_an_emoji_table_with_joined_and_toned_sequences(spark):
    rows = [("👍", ":thumbs_up:"), ("👍🏽", "thumbs_up_medium_skin_tone"), ("👩‍👩‍👧", "family"),
            ("👩", "woman"), ("🇵🇪", "Peru"), ("❤️", "red_heart"), (None, "x"), ("", "y")]
    names = emoji_names(spark.createDataFrame(rows, "emoji string, nombre string"))
    assert names["👍"] == "thumbs_up" and len(names) == 6
    text = spark.createDataFrame([("a 👍🏽 b👩‍👩‍👧 c 👩 d 🇵🇪 e ❤ f 👍",)], "t string")
    found = text.select(clean_text(F.col("t"), names)).first()[0]
    assert found == "a thumbs up medium skin tone b family c woman d peru e red heart f thumbs up" \
        or found == "a thumbs up medium skin tone b family c woman d Peru e red heart f thumbs up"
