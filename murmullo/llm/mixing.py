"""Mix sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words of its source up to and
with it, in a shuffled order, divided by the words the source should give. All
sources reach time 1 when they have given their target, so one global sort by
finish time interleaves them at their weights, and the mix is cut where the
total budget of words is spent. A source whose target is above its size is read
again, in the same order, up to ``repeats`` times.

Null texts and texts without a word have size 0 and are never taken. A null
source is a source of its own and comes last. Rows without ``doc_id`` are shuffled by
their text, so copies among them stand together. Rows with one ``doc_id`` are ordered
by size; equal rows are told apart by nothing, so it does not matter which of them
is taken. Without any word all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmullo.llm.common import PLAIN_WORD, row_struct, stage, with_running_sums

WEIGHTS = (1, 2, 3)
REPEATS = 3
SEED = "17"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS
) -> DataFrame:
    """One row per source: size, what the sources before it hold, target.

    Weights go round the sources in code point order. The words of all sources
    are shared out by weight; a target stops at ``repeats`` times the size and
    the excess is shared by the others. Sorted by size over weight, the stopped
    sources come first, so running sums give the share of the rest directly.
    """
    by_name = [F.col("source").asc_nulls_last()]
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.max("size").alias("_longest"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    ranked = with_running_sums(
        totals, by_name, {"_place": "_one", "_until": "source_size"}, "mix-sources"
    )
    turn = F.pmod(F.col("_place") - 1, F.lit(len(weights)))
    weighted = ranked.withColumns({
        "_weight": F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
        .cast("bigint"),
        "_before": F.col("_until") - F.col("source_size"),
        "_most": F.col("source_size") * repeats,
    }).withColumn("_ratio", F.col("_most") / F.col("_weight"))
    filled = stage(with_running_sums(
        weighted, [F.col("_ratio").asc(), *by_name],
        {"_most_until": "_most", "_weight_until": "_weight"}, "mix-levels",
    ), "mix-filled")
    # A few numbers over all sources come to the driver, one row each.
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    total, weights_sum = F.lit(whole["size"]).cast("bigint"), F.lit(whole["weight"]).cast("bigint")
    level = (total - (F.col("_most_until") - F.col("_most"))) / (
        weights_sum - (F.col("_weight_until") - F.col("_weight"))
    )
    levelled = filled.withColumn("_level", level).withColumn("_stopped", F.col("_ratio") < F.col("_level"))
    # The level of the first source that is not stopped holds for all the rest.
    first = levelled.filter(~F.col("_stopped")).agg(F.min_by("_level", "_weight_until")).first()[0]
    aimed = levelled.withColumn("target", F.when(F.col("_stopped"), F.col("_most").cast("double"))
                                .otherwise(F.lit(first).cast("double") * F.col("_weight")))
    # No finish time beyond this one can be inside the budget.
    last = aimed.agg(F.max(
        (F.col("target") + F.col("_longest")) / F.nullif(F.col("target"), F.lit(0.0)))).first()[0]
    return aimed.select(
        "source", "source_size", "target", "_before", total.alias("_total"),
        F.lit(last).cast("double").alias("_last_time"))


def plan_mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS,
    seed: str = SEED,
) -> tuple[DataFrame, DataFrame]:
    """All documents with size and target, and the copies that the mix takes.

    The copies carry ``_row`` (which document), ``epoch`` and ``finish``.
    """
    sizes = stage(
        docs.select(
            F.monotonically_increasing_id().alias("_row"), "doc_id", "source",
            word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_hash"),
        ),
        "mix-sizes",
    )
    targets = stage(source_targets(sizes, weights, repeats), "mix-targets")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.col("_hash")), F.lit(""))
    shuffled = F.md5(F.concat(name, F.lit(f":{seed}")))
    in_source = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("size"), F.col("_hash")]
    summed = with_running_sums(
        sizes.withColumn("_key", shuffled), in_source, {"_until": "size"}, "mix-order"
    )
    known = targets.withColumnRenamed("source", "_source")
    planned = summed.join(known, summed["source"].eqNullSafe(known["_source"]), "left")
    epochs = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    begun = F.col("epoch") * F.col("source_size")
    copies = (
        planned.filter("size > 0")
        .select("_row", "doc_id", "size", "_hash", "_key", "_until", "_before", "source_size",
                "target", "_total", "_last_time", epochs.alias("epoch"))
        .withColumn("finish", (begun + F.col("_until") - F.col("_before")) / F.col("target"))
        .filter(F.col("finish") <= F.col("_last_time"))
        .select("_row", "doc_id", "size", "_hash", "_key", "epoch", "finish", "_total")
    )
    by_time = [F.col(c) for c in ("finish", "_key", "doc_id", "size", "_hash", "epoch")]
    taken = with_running_sums(copies, by_time, {"_spent": "size"}, "mix-queue").filter(
        F.col("_spent") <= F.col("_total")
    )
    return planned, taken


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """Per document: its size, its source's size and target, the words taken."""
    planned, taken = plan_mix(docs, **how)
    words = taken.groupBy("_row").agg(F.sum("size").alias("taken"))
    return planned.join(words, "_row", "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the input's rows, each as often as it is taken.

    A row is found again by id, source, size and a hash of its text. Copies of
    rows that are equal in all of these are dealt out among them.
    """
    planned, taken = plan_mix(docs, **how)
    counts = taken.groupBy("_row").agg(F.count("*").alias("_times"))
    same = ["doc_id", "source", "size", "_hash"]
    wanted = (
        planned.select("_row", *same).join(counts, "_row", "left").groupBy(*same)
        .agg(F.count("*").alias("_rows"), F.sum("_times").alias("_times"))
        .filter("_times > 0")
        .select(*[F.col(c).alias(f"_w_{c}") for c in same], "_rows", "_times")
    )
    rows = docs.select(
        row_struct(docs).alias("_doc"), F.col("doc_id").alias("_id"),
        F.col("source").alias("_src"), word_count(F.col("text")).alias("_n"),
        F.xxhash64("text").alias("_h"),
    )
    found = rows.join(
        wanted,
        rows["_id"].eqNullSafe(wanted["_w_doc_id"])
        & rows["_src"].eqNullSafe(wanted["_w_source"])
        & (rows["_n"] == wanted["_w_size"]) & (rows["_h"] == wanted["_w__hash"]),
    )
    equal = Window.partitionBy("_id", "_src", "_n", "_h").orderBy("_times")
    share = F.floor(F.col("_times") / F.col("_rows")) + (
        F.row_number().over(equal) <= F.pmod(F.col("_times"), F.col("_rows"))
    ).cast("bigint")
    return (
        found.withColumn("_share", share).filter("_share > 0")
        .select("_doc", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_share"))))
        .select("_doc.*")
    )
