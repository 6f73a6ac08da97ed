"""Benchmark decontamination as a prefix-filtered set join.

A window is 13 consecutive words of an item, or a whole item of fewer words. A
document is hit where such a window occurs in it word by word. The join takes
four steps, all of them native:

1. every window and every document is a set of five-word shingles (fewer words
   in a window: the window is its only shingle), each with its position;
   document shingles that are in some window are kept, with their counts;
2. a window's shingles are ordered by rarity over all documents. Containment is
   wanted in full, so a prefix of one shingle, the rarest, is enough; a window
   with a shingle that no document has cannot occur at all;
3. the prefix is joined, and a match gives the only place where the window
   could begin; places before the start or past the end are dropped;
4. the words at the remaining places are compared with the window's.

Documents are matched by a hash of their text up to step 4, so copies do the work
once; as step 4 compares words, a collision of hashes changes nothing. Equal
windows of several items are one window. A null text has no words, a null
item id is not listed (its windows still hit), and rows with one ``doc_id`` are
judged row by row. Without items nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.llm.common import lower_ascii, row_struct, stage

# Words of the contract, on text whose A-Z are in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 5
# Contaminated: at least one word in this many is hit.
ONE_IN = 20


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(
        lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)
    )


def _placed_shingles(df: DataFrame, k: int, *keep: str) -> DataFrame:
    """A row per run of ``k`` of the ``_words``: ``_at`` and the hash ``_shingle``."""
    runs = F.greatest(F.size("_words") - (k - 1), F.lit(0))
    shifted = [F.slice("_words", i + 1, runs).alias(f"w{i}") for i in range(k)]
    return df.select(
        *keep, F.posexplode(F.arrays_zip(*shifted)).alias("_at", "_run")
    ).select(
        *keep, "_at",
        F.xxhash64(F.lit(k), *[F.col(f"_run.w{i}") for i in range(k)]).alias("_shingle"),
    )


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``_window`` (an id), ``_len``, ``_text``, ``_items``."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("_item"), words_of(F.col("text")).alias("_all")
    ).filter(F.size("_all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_all") - (window - 1), F.lit(1)))
    cut = words.select("_item", "_all", F.explode(starts).alias("_start")).select(
        "_item", F.slice("_all", F.col("_start"), F.lit(window)).alias("_words")
    )
    return cut.groupBy("_words").agg(F.collect_set("_item").alias("_items")).select(
        F.monotonically_increasing_id().alias("_window"), "_words",
        F.size("_words").alias("_len"), F.array_join("_words", " ").alias("_text"), "_items",
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _candidates(texts: DataFrame, windows: DataFrame, shingle: int) -> DataFrame:
    """Per text hash, the places where some window could begin.

    ``texts`` has ``_key`` and ``_words``.
    """
    size = F.least("_len", F.lit(shingle))
    # At most ``shingle`` different numbers.
    lengths = sorted(r[0] for r in windows.select(size).distinct().collect()) or [shingle]
    parts = stage(_union([
        _placed_shingles(windows.filter(size == k), k, "_window", "_len") for k in lengths
    ]), "decon-shingles")
    wanted = stage(parts.select("_shingle").distinct(), "decon-wanted")
    numbered = texts.withColumn("_n", F.size("_words"))
    matches = stage(_union([
        _placed_shingles(numbered, k, "_key", "_n") for k in lengths
    ]).join(wanted, "_shingle"), "decon-matches")
    rarity = matches.groupBy("_shingle").agg(F.count("*").alias("_found"))
    rarest = F.min(F.struct(F.coalesce("_found", F.lit(0)).alias("_found"), "_shingle", "_at"))
    prefix = stage(
        parts.join(rarity, "_shingle", "left").groupBy("_window", "_len")
        .agg(rarest.alias("_first")).filter("_first._found > 0")
        .select("_window", "_len", "_first._shingle", F.col("_first._at").alias("_offset")),
        "decon-prefix",
    )
    begin = F.col("_at") - F.col("_offset")
    places = (
        matches.join(prefix, "_shingle").withColumn("_begin", begin)
        .filter((F.col("_begin") >= 0) & (F.col("_begin") + F.col("_len") <= F.col("_n")))
        .select("_key", "_begin", "_window").distinct()
    )
    return stage(
        # A window and its items once for a text, however often it may stand there.
        places.groupBy("_key", "_window").agg(F.collect_list("_begin").alias("_begins"))
        .join(windows.select("_window", "_len", "_text", "_items"), "_window")
        .groupBy("_key")
        .agg(F.collect_list(F.struct("_begins", "_len", "_text", "_items")).alias("_places")),
        "decon-places",
    )


def judged(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
    one_in: int = ONE_IN,
) -> DataFrame:
    """Every row of ``docs`` as ``_doc`` with the verdict of the contract beside it."""
    windows = stage(windows_of(benchmark, window), "decon-windows")
    keyed = docs.select(row_struct(docs).alias("_doc"), "text", F.xxhash64("text").alias("_key"))
    places = _candidates(
        keyed.select("_key", words_of(F.col("text")).alias("_words")), windows, shingle
    ).withColumnRenamed("_key", "_k")

    def occurring(window: Column) -> Column:
        def there(begin: Column) -> Column:
            return F.array_join(F.slice("_words", begin + 1, window["_len"]), " ") == window["_text"]

        return F.struct(
            window["_len"].alias("_len"), window["_items"].alias("_items"),
            F.filter(window["_begins"], there).alias("_begins"))

    def covered(window: Column) -> Column:
        return F.flatten(F.transform(
            window["_begins"], lambda begin: F.sequence(begin, begin + window["_len"] - 1)))

    # The texts are shuffled at every size: whether the places would fit a broadcast
    # depends on the corpus.
    found = (
        keyed.join(places.hint("merge"), keyed["_key"] == places["_k"], "left")
        .select("_doc", "_places", words_of(F.col("text")).alias("_words"))
        .select(
            "_doc", F.size("_words").cast("bigint").alias("n_words"),
            F.coalesce(F.filter(F.transform("_places", occurring), lambda w: F.size(w["_begins"]) > 0),
                       F.array()).alias("_hits"),
        )
        .select(
            "_doc", "n_words",
            F.size(F.array_distinct(F.flatten(F.transform("_hits", covered))))
            .cast("bigint").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["_items"]))))
            .alias("_items"),
        )
    )
    return found.select(
        "_doc", "n_words", "n_hit", F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))
        .alias("contaminated"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The verdict on every document."""
    return judged(docs, benchmark, **how).select(
        F.col("_doc.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256",
        "contaminated",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows that are not contaminated, as they came."""
    return judged(docs, benchmark, **how).filter(~F.col("contaminated")).select("_doc.*")
