"""How far the sources of a language differ in their words.

A count vectorizer keeps the terms that stand in enough documents of a language and
turns every document into a sparse vector of exact counts. All languages share one
vectorizer: a term carries its language in front, so that its document frequency is
that of the language, and one fit serves however many languages there are. The
vectors are summed by source, and every source gives each kept term a smoothed
probability in billionths, a whole number.

Two sources are as far apart as the sum of the differences of these numbers. Terms
that neither has differ by the same amount each, so only terms that one of them has
are looked at. That work is cut into blocks: terms by terms, sources by sources; a
block is a bounded matrix whatever the vocabulary and the number of sources.

Null text, language and source count as ''. A group without terms has only the
smoothing, and takes part. A language without kept terms has distances of 0. Rows may
repeat and count each time. An empty table gives no rows. All sums are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmullo.llm.common import sliced, stage
from murmullo.session import ship_package

MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
# Whatever the vocabulary: the limit is a 32-bit number, so this keeps every term.
_ALL_TERMS = 2**31 - 1
# No term holds a space, so it parts the language from the term.
_PARTED = " "
# A term is a run of A-Z, which become a-z, of a-z and of bytes above 127: UTF-8 puts no
# others into a character that is not ASCII. All other bytes become spaces.
_BYTES = bytes(b | 0x20 if chr(b).isascii() and chr(b).isalpha() else b if b > 127 else 0x20
               for b in range(256))
# Terms and sources of a block, on average.
_TERMS, _SOURCES = 4096, 256


def _known(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")])


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts, one after another, and how many each has."""
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    plain = pa.StringArray.from_buffers(
        len(texts), offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(_BYTES)),
        None, 0, texts.offset)
    cut = pc.ascii_split_whitespace(plain)
    found = cut.flatten()
    some = pc.not_equal(found, "")
    text_of = np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy(zero_copy_only=False))
    counts = np.bincount(text_of[some.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return found.filter(some), counts


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``source`` and the terms of each text, with the language in front."""
    for whole in batches:
        for batch in sliced(whole, 2):
            terms, counts = terms_of(batch.column(2))
            langs = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), counts)))
            named = pc.binary_join_element_wise(langs, terms.cast(langs.type), _PARTED)
            ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.ListArray.from_arrays(ends, named)], names=["source", "_terms"])


def count_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """The kept terms (``_id``, ``lang``, ``term``) and the counts of each source
    (``_id``, ``source``, ``n`` above 0)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = _known(docs).mapInArrow(_cut, "source string, _terms array<string>")
    # A vectorizer refuses an empty vocabulary: rows with a term that no text has.
    floor = spark.range(min_docs).select(F.array(F.lit(_PARTED)).alias("_terms"))
    model = CountVectorizer(
        inputCol="_terms", outputCol="_vector", minDF=float(min_docs), vocabSize=_ALL_TERMS,
    ).fit(rows.select("_terms").unionAll(floor))
    named = pd.DataFrame({"_name": model.vocabulary})
    named.insert(0, "_id", np.arange(len(named), dtype=np.int32))
    term = F.substring_index("_name", _PARTED, -1)
    kept = spark.createDataFrame(named, "_id int, _name string").select(
        "_id", F.expr("substr(_name, 1, char_length(_name) - char_length("
                      "substring_index(_name, ' ', -1)) - 1)").alias("lang"), term.alias("term"),
    ).filter(F.col("term") != "")
    vector = F.unwrap_udt("_vector")
    cells = (
        model.transform(rows)
        .select("source", F.inline(F.arrays_zip(
            vector["indices"].alias("_id"), vector["values"].alias("_n"))))
        .groupBy("source", "_id").agg(F.sum(F.col("_n").cast("bigint")).alias("n"))
    )
    return stage(kept, "divergence-terms"), stage(cells, "divergence-counts")


def _share(n: Column, whole: Column, smooth: int, scale: int) -> Column:
    """A smoothed probability in units of ``1 / scale``, exact in decimals."""
    top = F.lit(scale).cast("decimal(10,0)") * (n + F.lit(smooth))
    below = F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return (F.lit(1) + F.call_function("div", top, below)).cast("bigint")


def shares(
    docs: DataFrame, min_docs: int = MIN_DOCS, smooth: int = SMOOTH, scale: int = SCALE,
) -> tuple[DataFrame, DataFrame]:
    """Groups (``lang``, ``source``, ``v`` kept terms of the language, ``floor``: the
    share of a term it lacks) and cells (``lang``, ``source``, ``_id``, ``term``, its
    share ``p`` and the whole language's ``q``)."""
    kept, counted = count_terms(docs, min_docs)
    cells = counted.join(kept, "_id")
    n_terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = stage(
        _known(docs).select("lang", "source").distinct()
        .join(n_terms, "lang", "left").join(sizes, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
                F.coalesce("size", F.lit(0)).alias("size"))
        .withColumn("_whole", F.col("size") + F.col("v") * smooth)
        .withColumn("floor", F.coalesce(_share(F.lit(0), F.col("_whole"), smooth, scale), F.lit(0))),
        "divergence-groups",
    )
    of_lang = groups.groupBy("lang").agg(
        (F.sum("size") + F.max("v") * smooth).alias("_all"))
    in_lang = counted.groupBy("_id").agg(F.sum("n").alias("_m"))
    found = (
        cells.join(in_lang, "_id").join(of_lang, "lang")
        .join(groups.select("lang", "source", "_whole"), ["lang", "source"])
        .select("lang", "source", "_id", "term",
                _share(F.col("n"), F.col("_whole"), smooth, scale).alias("p"),
                _share(F.col("_m"), F.col("_all"), smooth, scale).alias("q"))
    )
    return groups, stage(found, "divergence-shares")


_BLOCK = ["lang", "_terms", "_a", "_b"]


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """Distances of the pairs of two blocks of sources over one block of terms.

    Rows with ``_id`` -1 name all sources of both blocks and their floors.
    """
    named = rows[rows["_id"] < 0].sort_values("source", kind="stable")
    names = named["source"].to_numpy()
    side, floor = named["_side"].to_numpy(), named["p"].to_numpy(np.int64)
    found = rows[rows["_id"] >= 0]
    ids, line = np.unique(found["_id"].to_numpy(), return_inverse=True)
    share = np.broadcast_to(floor, (len(ids), len(names))).copy()
    share[line, pd.Index(names).get_indexer(found["source"])] = found["p"].to_numpy(np.int64)
    key = {c: rows[c].iat[0] for c in _BLOCK}
    left, right, values = [], [], []
    for i in np.flatnonzero(side == key["_a"]):
        others = np.flatnonzero(side == key["_b"])
        if key["_a"] == key["_b"]:
            others = others[others > i]
        apart = np.abs(floor[i] - floor[others])
        value = np.abs(share[:, [i]] - share[:, others]).sum(axis=0) - len(ids) * apart
        if key["_terms"] == 0:  # once: as if neither had any term
            value += int(named["v"].iat[0]) * apart
        left += [names[i]] * len(others)
        right += names[others].tolist()
        values.append(value)
    texts = {"lang": [key["lang"]] * len(left), "_x": left, "_y": right}
    return pd.DataFrame({
        **{c: pd.Series(found, dtype=object) for c, found in texts.items()},
        "value": np.concatenate(values) if values else np.zeros(0, np.int64),
    })


def pair_distances(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """``lang``, ``_x``, ``_y``, ``value`` for every two sources of a language, once."""
    ship_package(groups.sparkSession)
    blocks = groups.groupBy("lang").agg(
        F.greatest(F.ceil(F.count("*") / _SOURCES), F.lit(1)).alias("_n_sources"),
        F.greatest(F.ceil(F.max("v") / _TERMS), F.lit(1)).alias("_n_terms"),
    )
    side = F.pmod(F.xxhash64("source"), F.col("_n_sources")).cast("int").alias("_side")
    named = groups.join(blocks, "lang").select(
        "lang", "source", side, "_n_sources", F.lit(-1).alias("_id"), F.col("floor").alias("p"),
        "v", F.explode(F.sequence(F.lit(0), (F.col("_n_terms") - 1).cast("int"))).alias("_terms"),
    )
    filled = cells.join(blocks, "lang").select(
        "lang", "source", side, "_n_sources", "_id", "p", F.lit(0).cast("bigint").alias("v"),
        F.pmod(F.col("_id"), F.col("_n_terms")).cast("int").alias("_terms"),
    )
    met = F.explode(F.sequence(F.lit(0), (F.col("_n_sources") - 1).cast("int"))).alias("_met")
    dealt = named.unionByName(filled).select("*", met).select(
        "lang", "_terms", F.least("_side", "_met").alias("_a"),
        F.greatest("_side", "_met").alias("_b"), "_side", "source", "_id", "p", "v",
    )
    return (
        dealt.groupBy(*_BLOCK).applyInPandas(_block, "lang string, _x string, _y string, value bigint")
        .groupBy("lang", "_x", "_y").agg(F.sum("value").alias("value"))
    )


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, smooth: int = SMOOTH, scale: int = SCALE, top: int = TOP,
) -> DataFrame:
    """Per source of a language: its distance to each other one (part ``pair``), and the
    terms it has most above the whole language (part ``term``, up to rank ``top``)."""
    groups, cells = shares(docs, min_docs, smooth, scale)
    pairs = stage(pair_distances(groups, cells), "divergence-pairs")
    both = pairs.select("lang", F.inline(F.array(
        F.struct(F.col("_x").alias("source"), F.col("_y").alias("item")),
        F.struct(F.col("_y").alias("source"), F.col("_x").alias("item")),
    )), "value")
    terms = cells.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order)

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value",
                           rank.alias("rank"))

    return part(both, "pair").unionAll(part(terms, "term").filter(F.col("rank") <= top))
