"""Text cleaning and tokenising, all as native column expressions.

Java's ``\\s`` and ``\\w`` know ASCII only, so the classes below spell out the
Unicode whitespace and word characters.
"""

from __future__ import annotations

import functools
import operator
import re
import string
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.functions.binding import bind
from murmullo.wordlists import EMOJI_NAMES

_SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x85"
_LETTERS = "a-záéíóúñü"
# Single characters, not ranges: Java turns them into one bit set, and a negated
# class of this many ranges takes more than twice as long.
_KEPT = string.ascii_letters + string.digits + "ñáéíóúü"

# Every character that counts as whitespace, for trimming.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove whitespace of any kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def has_text(text: Column) -> Column:
    """True where there is at least one non-whitespace character."""
    return F.coalesce(text.rlike(f"[^{_SPACE}]"), F.lit(False))


def _where(text: Column, sign: str, change: Callable[[Column], Column]) -> Column:
    """``change`` only for texts that contain ``sign``; a plain search is much
    cheaper than a pattern, and most comments have neither link nor name."""
    return bind(text, lambda t: F.when(t.contains(sign), change(t)).otherwise(t))


def strip_urls(text: Column) -> Column:
    pattern = f"http[^{_SPACE}]+"
    return _where(text, "http", lambda t: F.regexp_replace(t, pattern, ""))


def strip_mentions(text: Column) -> Column:
    return _where(text, "@", lambda t: F.regexp_replace(t, r"@[\p{L}\p{N}_]+", ""))


def _first_characters(names: Mapping[str, str], gap: int = 0x800) -> str:
    """A character class, of few ranges, that covers every first character.

    It may cover more: it only has to tell ordinary text apart quickly.
    """
    ranges: list[list[int]] = []
    for point in sorted({ord(seq[0]) for seq in names}):
        if ranges and point - ranges[-1][1] <= gap:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


# So many searches for bytes take less time than one pattern over the text.
_SEARCHES = 4


def _may_hold(text: Column, names: Mapping[str, str]) -> Column:
    """True where a sequence may begin, and false in ordinary text.

    Searched are the first two bytes of the first characters, which takes no decoding. A table
    with too many of these, or with plain characters, is told by a pattern.
    """
    starts = sorted({seq[0].encode("utf-8", "surrogatepass")[:2] for seq in names})
    if len(starts) > _SEARCHES or any(len(start) < 2 for start in starts):
        return text.rlike(_first_characters(names))
    found = [F.contains(text.cast("binary"), F.lit(start)) for start in starts]
    return functools.reduce(operator.or_, found)


def emoji_pattern(names: Mapping[str, str]) -> str:
    """One alternation over all sequences, longest first.

    The look-ahead on the first character lets the matcher skip ordinary text
    without trying the alternatives one by one.
    """
    ordered = sorted(names, key=lambda s: (-len(s), s))
    return f"(?={_first_characters(names)})(?:" + "|".join(map(re.escape, ordered)) + ")"


def emoji_names(table: DataFrame, sequence: str = "emoji", name: str = "nombre") -> dict[str, str]:
    """An emoji table as the mapping that the cleaner takes.

    Sequences of any length: joined ones, flags, skin tones. The table is as
    large as the standard's list, some thousand rows, and comes to the driver.
    """
    rows = table.select(sequence, name).na.drop().distinct().collect()
    return {row[0]: row[1].strip(":") for row in rows if row[0]}


def _with_plain_forms(names: Mapping[str, str]) -> dict[str, str]:
    """Add each sequence without its variation selector, as people type both."""
    plain = {s.replace("\ufe0f", ""): n for s, n in names.items() if "\ufe0f" in s}
    return {**plain, **names}


# Up to so many sequences one alternation finds them; a longer table is looked up.
_ALTERNATIVES = 100


def _character_class(points: set[int]) -> str:
    """A class of exactly these characters, as ranges."""
    ranges: list[list[int]] = []
    for point in sorted(points):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _buckets(table: Mapping[str, str]) -> tuple[int, Column]:
    """The table in buckets by checksum, so that a look-up searches a few sequences,
    however many there are: their number, and one literal."""
    n = 1 << max(4, len(table).bit_length())
    buckets = [""] * n
    for sequence, name in sorted(table.items()):
        buckets[zlib.crc32(sequence.encode()) % n] += f"\x01{sequence}\x02:{name}:\x03"
    # Split of a literal: done once, when the plan is made.
    return n, F.split(F.lit("\x04".join(buckets)), "\x04", -1)


def _looked_up(sequence: Column, n: int, buckets: Column) -> Column:
    """The name of a sequence, or null."""
    key = F.concat(F.lit("\x01"), sequence, F.lit("\x02"))
    return bind(
        F.get(buckets, F.pmod(F.crc32(sequence), F.lit(n)).cast("int")),
        lambda bucket: F.when(bucket.contains(key), F.substring_index(
            F.call_function("substring_index", bucket, key, F.lit(-1)), "\x03", 1)),
    )


def name_emoji_by_table(text: Column, table: Mapping[str, str]) -> Column:
    """As ``name_emoji``, for tables of any length.

    Runs of characters that occur in sequences are cut out. In a run every place
    takes the longest sequence that begins there, and goes on behind it.
    """
    sizes = sorted({len(sequence) for sequence in table}, reverse=True)
    run = _character_class({ord(c) for sequence in table for c in sequence}) + "+"
    n, listed = _buckets(table)

    def walked(found: Column, buckets: Column) -> Column:
        def step(state: Column, place: Column) -> Column:
            def if_known(size: int) -> Column:
                sequence = F.substring(found, place, F.lit(size))
                return bind(_looked_up(sequence, n, buckets), lambda name: F.when(
                    name.isNotNull(), F.struct(name.alias("name"), F.lit(size).alias("n"))))

            itself = F.struct(F.substring(found, place, F.lit(1)).alias("name"), F.lit(1).alias("n"))
            longest = F.coalesce(*map(if_known, sizes), itself)
            return F.when(place < state["next"], state).otherwise(bind(longest, lambda x: F.struct(
                (place + x["n"]).alias("next"), F.concat(state["out"], x["name"]).alias("out"))))

        start = F.struct(F.lit(1).alias("next"), F.lit("").alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.char_length(found)), start, step, lambda state: state["out"])

    runs = bind(listed, lambda buckets: F.transform(
        F.regexp_extract_all(text, F.lit(run), F.lit(0)), lambda found: walked(found, buckets)))
    woven = F.zip_with(
        F.split(text, run, -1), F.concat(runs, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    maybe = text.rlike(_character_class({ord(sequence[0]) for sequence in table}))
    return F.when(maybe, F.array_join(woven, "")).otherwise(text)


def name_emoji(text: Column, names: Mapping[str, str] = EMOJI_NAMES) -> Column:
    """Replace each known emoji by ``:its_name:``."""
    if not names:
        return text
    table = _with_plain_forms(names)
    if len(table) > _ALTERNATIVES:
        return name_emoji_by_table(text, table)
    pattern = emoji_pattern(table)
    lookup = F.create_map(
        *[F.lit(x) for seq, name in table.items() for x in (seq, f":{name}:")]
    )
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    named = F.transform(found, lambda seq: F.element_at(lookup, seq))
    woven = F.zip_with(
        pieces, F.concat(named, F.array(F.lit(""))), lambda a, b: F.concat(a, b)
    )
    return F.when(_may_hold(text, table), F.array_join(woven, "")).otherwise(text)


def separators_to_space(text: Column) -> Column:
    return F.translate(text, ":_", "  ")


def collapse_repeats(text: Column) -> Column:
    """``!!!`` -> ``!``, and the same for ``?`` and ``.``."""
    return F.regexp_replace(text, r"([!?.])\1+", "$1")


def keep_charset(text: Column) -> Column:
    """Blank every character outside the kept letters, digits and whitespace."""
    return F.regexp_replace(text, f"[^{_KEPT}{_SPACE}]", " ")


def squeeze_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{_SPACE}]++", " "))


def _without_links(text: Column) -> Column:
    return strip_mentions(strip_urls(F.lower(text)))


def _finish(text: Column) -> Column:
    # Separators, repeated marks, the character set and the spaces in one pass:
    # every run of characters that are not kept becomes one space.
    return F.trim(F.regexp_replace(text, f"[^{_KEPT}]++", " "))


def clean_text(text: Column, emoji: Mapping[str, str] = EMOJI_NAMES) -> Column:
    """The whole cleaner as one expression that reads the text once."""
    return bind(_without_links(text), lambda t: _finish(name_emoji(t, emoji)))


def tokens(text: Column) -> Column:
    """Lower-cased words split on whitespace; blank text gives ``['']``."""
    return F.split(F.trim(F.lower(text)), r"\s+")


def loose_tokens(text: Column) -> Column:
    """As ``tokens``, with an empty word wherever two separators meet, for counts that leave
    these out anyway. Cleaned text has single spaces, and a plain split of these takes a
    fraction of the time of a pattern."""
    return bind(F.lower(text), lambda t: F.when(
        t.rlike(r"[\t\n\x0b\f\r]"), F.split(t, r"\s")).otherwise(F.split(t, " ")))


def letter_tokens(text: Column) -> Column:
    """Words of letters only: digits and marks are separators."""
    letters = F.regexp_replace(F.lower(text), f"[^{_LETTERS}]++", " ")
    return F.split(F.trim(letters), " ")


def is_term(word: Column, longer_than: int, stopwords: Sequence[str]) -> Column:
    keep = F.length(word) > longer_than
    return keep & ~word.isin(list(stopwords)) if stopwords else keep


def shorten(text: Column, length: int) -> Column:
    """The first characters, for display only."""
    return F.substring(text, 1, length)
