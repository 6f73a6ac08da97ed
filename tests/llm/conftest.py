import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, target string, _key int"

# Null in every column, empty and very long texts, ties, repeated rows, clashing names.
EDGES = [
    (0, "Uno dos TRES cuatro cinco seis siete ocho", "es", "a", 1, "x", "y", 1),
    (1, None, None, None, None, None, None, None),
    (2, "", "es", "b", 0, "", "", 0),
    (3, "largo " * 40_000 + "fin", "es", "b", 5, "x", "y", 2),
    (4, "uno dos tres cuatro cinco seis siete ocho", "es", "a", 1, "x", "y", 3),
    (4, "uno dos tres cuatro cinco seis siete ocho", "es", "a", 1, "x", "y", 3),
    (None, "sin número pero con palabras suficientes para todo", "es", None, 9, None, "y", 4),
    (5, " \t\n ", "en", "c", 4, "x", "y", 5),
    (6, "É Ünï 日本語 😀 it's <|endoftext|> 12,5%", "en", "c", 3, "x", "y", 6),
    (7, "...!!! ### $$$", None, "a", 3, "x", "y", 7),
]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGES


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    """Random texts with copies, near copies and shared passages."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(words).title() if rng.random() < 0.1 else rng.choice(words) for _ in range(n))

    passage = text(60)
    texts = [text(rng.randint(0, 120)) for _ in range(120)]
    for i in range(10):
        texts.append(texts[i])
        at = rng.randint(0, 40)
        texts.append(texts[20 + i][:at] + " x " + texts[20 + i][at:])
        texts.append(text(30) + " " + passage + " " + text(rng.randint(0, 30)))
    rng.shuffle(texts)
    rows = [
        (i * 7 + 3, t, "es", rng.choice("pqrst"), len(t), "s", "t", i) for i, t in enumerate(texts)
    ]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)
