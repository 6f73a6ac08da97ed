import random
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmullo.functions import text as tx


def test_urls_end_at_any_whitespace(values):
    found = values(tx.strip_urls, [
        "a http://x.y/z?q=1 b", "https://a b", "http://a b", "http", "HTTP://x",
        "ahttp://q\nfin", "http://a\x1cb", None,
    ])
    assert found == ["a  b", " b", " b", "http", "HTTP://x", "a\nfin", "\x1cb", None]


def test_mentions_take_unicode_letters_digits_and_underscore(values):
    found = values(tx.strip_mentions, ["hola @josé_1!", "@ñandú-x", "a@b.c", "@ solo", "@@x"])
    assert found == ["hola !", "-x", "a.c", "@ solo", "@"]


def test_emoji_longest_sequence_first(values):
    names = {"👍": "pulgar", "👍🏽": "pulgar_medio", "❤️": "corazón_rojo", "🇵🇪": "bandera_perú"}
    found = values(lambda c: tx.name_emoji(c, names), [
        "👍👍🏽", "a❤️b❤c", "🇵🇪", "sin nada", "", None, "😂 fuera", "👍",
    ])
    assert found == [
        ":pulgar::pulgar_medio:", "a:corazón_rojo:b:corazón_rojo:c", ":bandera_perú:",
        "sin nada", "", None, "😂 fuera", ":pulgar:",
    ]


def test_emoji_whose_characters_are_regex_signs(values):
    names = {"*️⃣": "asterisco", "#️⃣": "almohadilla", ":)": "sonrisa"}
    found = values(lambda c: tx.name_emoji(c, names), ["*️⃣ y #️⃣", "a * b # c", ":) ok :("])
    assert found == [":asterisco: y :almohadilla:", "a * b # c", ":sonrisa: ok :("]


def test_no_emoji_table_changes_nothing(values):
    assert values(lambda c: tx.name_emoji(c, {}), ["😂"]) == ["😂"]


def test_single_steps(values):
    assert values(tx.separators_to_space, [":a_b:"]) == [" a b "]
    assert values(tx.collapse_repeats, ["ah!!!! ¿¿qué??? ... a.b", "!?!?"]) == [
        "ah! ¿¿qué? . a.b", "!?!?"]
    assert values(tx.keep_charset, ["Ñandú-ç#1\xa0x\n"]) == [" andú   1\xa0x\n"]
    assert values(tx.squeeze_spaces, ["  a \t \n b "]) == ["a b"]
    assert values(tx.strip, [" \x1c a b \n", " \t"]) == ["a b", ""]
    assert values(tx.has_text, [" \x1f\n", "", None, " x "]) == [False, False, False, True]


def test_clean_text_composed(values):
    found = values(tx.clean_text, [
        "¡HOLA!!! @juan mira https://a.b/c?d=1 😂",
        "Ñandú_y:Cía... ÁÉÍÓÚÜ",
        "@a https://b",
        "   ",
        None,
        "uno dos\x0btres",
        "1 2  3",
    ])
    assert found == [
        "hola mira cara llorando de risa", "ñandú y cía áéíóúü", "", "", None,
        "uno dos tres", "1 2 3",
    ]


def test_long_text_is_cleaned_to_its_end(values):
    text = "palabra " * 60_000 + "FIN!!!"
    assert values(tx.clean_text, [text])[0].endswith("palabra fin")
    assert len(values(tx.clean_text, [text])[0]) == 8 * 60_000 + 3


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=60), min_size=1, max_size=60))
def test_clean_text_properties(values, texts):
    cleaned = values(tx.clean_text, texts)
    allowed = set("abcdefghijklmnopqrstuvwxyz0123456789ñáéíóúü ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    for one in cleaned:
        assert set(one) <= allowed
        assert one == " ".join(one.split(" ")) and one == one.strip()
        assert "  " not in one
    # An address or a name can appear once marks are gone, but no new characters.
    again = values(lambda c: tx._finish(F.lower(c)), cleaned)
    assert again == [c.lower() for c in cleaned]


def test_tokens(values):
    assert values(tx.tokens, ["  Hola  MUNDO \t x ", ""]) == [["hola", "mundo", "x"], [""]]
    assert values(tx.letter_tokens, ["Año 2024: día-1"]) == [["año", "día"]]


def test_is_term(values):
    keep = lambda c: tx.is_term(c, 2, ["que", "los"])
    assert values(keep, ["ab", "abc", "que", "ñañ"]) == [False, True, False, True]
    assert values(lambda c: tx.is_term(c, 3, []), ["abc", "abcd"]) == [False, True]


def test_loose_tokens_are_tokens_and_empty_words(values):
    texts = ["Uno  dos\ttres\n", " a ", "", None, "x\x0by\fz\rw", "ÑANDÚ él", "a\u00a0b"]
    loose, exact = values(tx.loose_tokens, texts), values(tx.tokens, texts)
    for a, b in zip(loose, exact):
        assert (a is None) == (b is None) and [w for w in a or [] if w] == [w for w in b or [] if w]


def _many_sequences(rng, n):
    """Sequences of one to six characters, with joiners, selectors, flags and signs."""
    base = [chr(c) for c in range(0x1F300, 0x1F300 + 900)] + list("#*0123456789©®") + [chr(c) for c in range(0x1F1E6, 0x1F200)]
    tail = ["\u200d", "\ufe0f", "\u20e3", *map(chr, range(0x1F3FB, 0x1F400)), *base[:200]]
    found = {}
    while len(found) < n:
        seq = rng.choice(base) + "".join(rng.choice(tail) for _ in range(rng.choice([0, 0, 1, 2, 3, 5])))
        if seq not in "0123456789#*":
            found[seq] = f"n{len(found)}"
    return found, base, tail


def test_a_long_emoji_table_gives_the_text_of_the_alternation(values, monkeypatch):
    rng = random.Random(1)
    names, base, tail = _many_sequences(rng, 1200)
    known = list(names)
    texts = ["".join(rng.choice([rng.choice(known), rng.choice(base), rng.choice(tail), "a ñ", "12", " ", "."])
                     for _ in range(rng.randint(0, 25))) for _ in range(300)] + [None, ""]
    by_table = values(lambda c: tx.name_emoji(c, names), texts)
    monkeypatch.setattr(tx, "_ALTERNATIVES", 10**9)
    assert by_table == values(lambda c: tx.name_emoji(c, names), texts)
    assert sum(":n" in (t or "") for t in by_table) > 200


def test_a_full_emoji_table_costs_little_more_than_a_short_one(spark):
    rng = random.Random(2)
    names, _, _ = _many_sequences(rng, 5000)
    short = dict(list(names.items())[:50])
    prose = "unas palabras de un comentario cualquiera "
    rows = [("".join(prose + (rng.choice(list(short)) if rng.random() < 0.2 else "") for _ in range(8)),) for _ in range(4000)]
    df = spark.createDataFrame(rows, "t string").repartition(4).cache()
    df.count()

    def seconds(table):
        best = []
        for _ in range(4):
            start = time.perf_counter()
            df.select(F.sum(F.length(tx.name_emoji(F.col("t"), table)))).collect()
            best.append(time.perf_counter() - start)
        return min(best)

    few, all_of_them = seconds(short), seconds(names)
    assert all_of_them <= 2 * few + 0.5, (few, all_of_them)


def test_ordinary_text_is_told_without_a_pattern(spark, monkeypatch):
    """The bytes that sequences begin with are searched; what is replaced stays the same."""
    texts = ["sin nada", "ñandú ≠ ❤ ❤️x", "a👍🏽👍", "✔ 🦄 😂🔥", "", None, "\ud7ff\uffff\U00010000"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")

    def named(names):
        found = df.select("x", tx.name_emoji(F.col("x"), names).alias("y"))
        return [tuple(r) for r in found.collect()], "RLIKE" in found._jdf.queryExecution().analyzed().toString()

    many = {chr(0x100 + 0x800 * i): f"n{i}" for i in range(9)}
    quick = [named(names) for names in (tx.EMOJI_NAMES, {"#": "n"}, many)]
    assert [pattern for _, pattern in quick] == [False, True, True]
    monkeypatch.setattr(tx, "_SEARCHES", 0)
    plain = [named(names) for names in (tx.EMOJI_NAMES, {"#": "n"}, many)]
    assert [rows for rows, _ in plain] == [rows for rows, _ in quick]
