"""Document fingerprints from closed syncmers, and their likeness.

The k-mers are runs of five words and the inner substrings are pairs of words.
A k-mer is an anchor where the smallest hash of its four pairs is that of its
first or its last pair. This depends on the k-mer alone, so the same passage gives
the same anchors in any surroundings, and about half of all k-mers are anchors.
The fingerprint is made of the distinct hashes of all anchors of a document, eight
hexadecimal digits each, in ascending order; ``anchor_table`` has every anchor with
its place, for positional matching. The likeness of two fingerprints is the
Jaccard similarity of the two sets. Only where ``sketch`` is given do the ``sketch``
smallest hashes stand for all, and the likeness is an estimate.

A text without an anchor (fewer than five words, mostly) has the hash of its
words as its only value; a null or empty text, or one without a word, has an
empty fingerprint. Two empty fingerprints are alike (1), an empty and another
are not (0). Everything runs as SQL expressions within a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmullo.llm.common import PLAIN_WORD, row_struct, stage

K = 5
S = 2
# All anchors; a number keeps as many of the smallest hashes.
SKETCH = None
_DIGITS = 8
_HALF = 1 << 31


def _with_anchors(df: DataFrame, text: str, name: str, k: int, s: int) -> DataFrame:
    """Add the anchors of ``text`` in order; helper columns start with ``_``.

    Each has its ``position``, the number of its first word from 0, and a ``value``,
    the first half of its hash less 2^31, so that signed order is that of the digits.
    """
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(PLAIN_WORD), F.lit(0))
    inner = k - s + 1
    others = [c for c in df.columns]
    hashed = df.withColumn("_w", words).withColumn(
        "_h", F.transform("_w", lambda w: F.xxhash64(w))
    ).withColumn("_n", F.size("_w"))

    def shifted(array: str, by: int, many: Column) -> Column:
        return F.slice(array, by + 1, many)

    pairs = F.greatest(F.col("_n") - (s - 1), F.lit(0))
    small = hashed.withColumn("_s", F.transform(
        F.arrays_zip(*[shifted("_h", i, pairs).alias(f"p{i}") for i in range(s)]),
        lambda p: F.xxhash64(*[p[f"p{i}"] for i in range(s)]),
    ))
    runs = F.greatest(F.col("_n") - (k - 1), F.lit(0))
    zipped = F.arrays_zip(
        *[shifted("_s", i, runs).alias(f"s{i}") for i in range(inner)]
    )

    def is_anchor(run: Column) -> Column:
        least = F.least(*[run[f"s{i}"] for i in range(inner)])
        return (least == run["s0"]) | (least == run[f"s{inner - 1}"])

    def anchor(value: Column, position: Column) -> Column:
        short = F.shiftrightunsigned(value, 64 - 4 * _DIGITS) - F.lit(_HALF)
        return F.struct(short.cast("int").alias("value"), position.alias("position"))

    # Pairs that follow each other hold all words of the k-mer.
    found = small.withColumn("_a", F.filter(
        F.transform(zipped, lambda run, i: F.when(
            is_anchor(run), anchor(F.xxhash64(*[run[f"s{j}"] for j in range(inner)]), i)
        )),
        lambda a: a.isNotNull(),
    ))
    whole = F.array(anchor(F.xxhash64(F.array_join("_w", " ")), F.lit(0)))
    return found.select(*others, F.when(
        (F.size("_a") > 0) | (F.col("_n") == 0), F.col("_a")
    ).otherwise(whole).alias(name))


def _with_values(
    df: DataFrame, text: str, name: str, k: int = K, s: int = S, sketch: int | None = SKETCH
) -> DataFrame:
    """Add the distinct values of the anchors of ``text`` in ascending order."""
    others = df.columns
    found = _with_anchors(df, text, "_anchors", k, s)
    values = F.sort_array(F.array_distinct(F.col("_anchors")["value"]))
    return found.select(*others, _smallest(values, sketch).alias(name))


def _smallest(values: Column, sketch: int | None) -> Column:
    return values if sketch is None else F.slice(values, 1, sketch)


def _digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value.cast("bigint") + F.lit(_HALF))), _DIGITS, "0")


def _text_of(values: Column) -> Column:
    return F.array_join(F.transform(values, _digits), "")


def with_fingerprint(
    df: DataFrame, text: str = "text", name: str = "fingerprint",
    k: int = K, s: int = S, sketch: int | None = SKETCH,
) -> DataFrame:
    """Add the fingerprint of a text column."""
    others = df.columns
    return _with_values(df, text, "_values", k, s, sketch).select(
        *others, _text_of(F.col("_values")).alias(name)
    )


def anchor_table(docs: DataFrame, text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """A row for every anchor of every row: the row as ``_doc``, ``anchor``, ``position``."""
    rows = docs.select(row_struct(docs).alias("_doc"), F.col(text).alias("_text"))
    return _with_anchors(rows, "_text", "_anchors", k, s).select(
        "_doc", F.explode("_anchors").alias("_anchor")
    ).select(
        "_doc", _digits(F.col("_anchor.value")).alias("anchor"),
        F.col("_anchor.position").cast("bigint").alias("position"),
    )


def values_of(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(f"[0-9a-f]{{{_DIGITS}}}"), F.lit(0))


def _alike(a: Column, b: Column, sketch: int | None) -> Column:
    """Share of common values among all of two sets, or the smallest of both."""
    if sketch is None:
        both = F.size(F.array_intersect(a, b))
        union = F.size(a) + F.size(b) - both
    else:
        least = _smallest(F.sort_array(F.array_union(a, b)), sketch)
        both = F.size(F.array_intersect(F.array_intersect(a, b), least))
        union = F.size(least)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / F.greatest(union, F.lit(1))
    )


def likeness(a: Column, b: Column, sketch: int | None = SKETCH) -> Column:
    """Share of common hashes among all of two fingerprints, or their smallest, 0 to 1."""
    return _alike(values_of(a), values_of(b), sketch)


def _neighbours(ids: DataFrame) -> DataFrame:
    """For every document the one that comes before it, in a ring.

    Order: ``doc_id`` descending, null last, then hash. The ids are range-
    partitioned and written; only the first and last of each range meet in one
    window, a row per range.
    """
    order = [F.col("_no_id"), F.col("_id").desc(), F.col("_hash")]
    ranged = stage(
        ids.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()),
        "syncmer-ids",
    )
    me = F.struct("_id", "_no_id", "_hash", "_chars")
    inside = Window.partitionBy("_range").orderBy(*order)
    near = ranged.withColumn("_near", F.lag(me).over(inside))
    place = F.struct("_no_id", -F.col("_id").cast("decimal(20,0)"), "_hash")
    last = ranged.groupBy("_range").agg(F.max_by(me, place).alias("_last"))
    line, ring = Window.orderBy("_range"), Window.partitionBy()
    edges = last.select("_range", F.coalesce(
        F.lag("_last").over(line), F.max_by("_last", "_range").over(ring)
    ).alias("_edge"))
    return near.join(edges, "_range").select(
        "_id", "_no_id", "_hash", F.coalesce("_near", "_edge").alias("_before")
    )


def compare_edited(docs: DataFrame, sketch: int | None = SKETCH, **how) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    Edited: the last third of the code points (rounded down) gives way to as many
    from the beginning of the next document, in descending ``doc_id``; the first
    follows on the last. Rows that are equal in ``doc_id`` and text hold one
    place in that order; a single document follows on itself. Each document
    sends its predecessor the part it needs and its values, so a text is shuffled
    once, a third of it a second time, and four bytes for each anchor. Its own
    values are made again behind that shuffle.
    """
    body = F.coalesce("text", F.lit(""))
    key = [
        F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("_id"),
        F.col("doc_id").isNull().alias("_no_id"), F.xxhash64(body).alias("_hash"),
    ]
    names = ["_id", "_no_id", "_hash"]
    marked = docs.select(*key, body.alias("_text"))
    ids = docs.select(*key, F.char_length(body).alias("_chars")).distinct()
    # Both joins below need the same columns in the same partitions, so the texts
    # are shuffled once.
    before = stage(_neighbours(ids), "syncmer-order")
    third = F.floor(F.col("_before._chars") / 3).cast("int")
    sent = _with_values(
        marked.join(before, names).select(
            *[F.col(f"_before.{c}").alias(c) for c in names],
            F.substring("_text", F.lit(1), third).alias("_part"), "_text",
        ),
        "_text", "_next", sketch=sketch, **how,
    ).drop("_text").dropDuplicates(names)
    n = F.char_length("_text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), n - cut), "_part")
    both = marked.join(sent, names, "left").select(
        F.when(~F.col("_no_id"), F.col("_id")).alias("doc_id"),
        n.cast("bigint").alias("n_chars"), "_text", "_next", edited.alias("_edited"),
    )
    for text, name in (("_text", "_own"), ("_edited", "_other")):
        both = _with_values(both, text, name, sketch=sketch, **how)
    return both.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        _text_of(F.col("_own")).alias("fingerprint"),
        _text_of(F.col("_other")).alias("edited_fingerprint"),
        _alike(F.col("_own"), F.col("_other"), sketch).alias("near_edited"),
        _alike(F.col("_own"), F.col("_next"), sketch).alias("near_next"),
    )
