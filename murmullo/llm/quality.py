"""Quality scores from weak labels.

Six heuristics look at a document and vote good (1), bad (0) or nothing (-1).
They overlap and err, so expectation-maximisation estimates how often each is right
for good and for bad documents, and the share of good ones, from the number of
documents with each pattern of votes: at most 3^6 numbers, whatever the
corpus. The posterior of its pattern is a document's soft label. A linear model
over hashed words, word shapes and pairs of shapes learns from the soft labels of a
bounded sample of rows, and scores every document; it sees what the heuristics do not
count. Votes and hashed counts are made in one reading of the texts and written.

A null text counts as an empty one. Texts without words get no votes; their score is
that of the model without features. Rows may repeat; the sample takes rows, not
texts, so copies are in it as often as in the table. Where the sample has soft labels
of one kind only, or no row, nothing can be learned and the score is the posterior. An
empty table has no rows to score.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.llm.common import PLAIN_WORD, row_struct, stage

# Documents that the linear model learns from.
SAMPLE = 20_000
# Buckets for words, and for word shapes and pairs of them.
FEATURES = (1 << 15, 1 << 12)
KEEP = 0.5
VOTERS = ("symbols", "capitals", "tables", "endings", "variety", "plain")


def _shape(text: Column) -> Column:
    """The text with its runs of letters and digits reduced to their kind."""
    lower = F.regexp_replace(text, r"\p{Lu}?[\p{L}&&[^\p{Lu}]]+", "x")
    capitals = F.regexp_replace(lower, r"\p{Lu}{2,}", "X")
    return F.regexp_replace(capitals, r"\p{N}+", "0")


def _vote(value: Column, bad: Column, good: Column) -> Column:
    return F.when(value.isNull(), -1).when(bad, 0).when(good, 1).otherwise(-1)


def with_votes(docs: DataFrame) -> DataFrame:
    """``_doc`` (the row), ``_words``, ``_shapes`` (of words, and pairs of them), and a
    column for each voter."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        row_struct(docs).alias("_doc"),
        F.regexp_extract_all(text, F.lit(PLAIN_WORD), F.lit(0)).alias("_words"),
        F.regexp_extract_all(_shape(text), F.lit(PLAIN_WORD), F.lit(0)).alias("_own"),
    )
    n_words = F.size("_words")
    follows = F.zip_with(
        F.slice("_words", 1, F.greatest(n_words - 1, F.lit(0))),
        F.slice("_words", 2, F.greatest(n_words - 1, F.lit(0))), lambda a, b: a == b,
    )
    pairs = F.zip_with(
        F.slice("_own", 1, F.greatest(F.size("_own") - 1, F.lit(0))),
        F.slice("_own", 2, F.greatest(F.size("_own") - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    shaped = split.select(
        "_doc", "_words", "_own", F.size(F.array_distinct("_words")).alias("_distinct"),
        # A word that is the one before it again counts as one more shape.
        F.concat("_own", pairs, F.array_repeat(F.lit("="), F.size(F.filter(follows, lambda x: x))))
        .alias("_shapes"),
    )
    measured = shaped.select(
        "_doc", "_distinct", "_words", "_shapes", F.size("_own").alias("_n"),
        F.array_join("_own", " ").alias("_joined"),
    )

    def rate(pattern: str) -> Column:
        return F.regexp_count("_joined", F.lit(pattern)) / F.nullif(F.col("_n"), F.lit(0))

    rates = measured.select(
        "_doc", "_words", "_shapes", "_n", (F.col("_distinct") / F.nullif("_n", F.lit(0))).alias("_variety"),
        rate(r"[#$%&*=~^<>@]").alias("_symbols"), rate(r"X").alias("_capitals"),
        rate(r"\|").alias("_bars"), rate(r"x[.!?]( |$)").alias("_ends"),
        rate(r"(?<=^| )x[.,;:]?(?= |$)").alias("_plain"),
    )
    n = F.col("_n")
    return rates.select(
        "_doc", "_words", "_shapes",
        _vote(F.col("_symbols"), F.col("_symbols") > 0.3, F.col("_symbols") < 0.05).alias("symbols"),
        _vote(F.col("_capitals"), F.col("_capitals") > 0.3, F.col("_capitals") < 0.05).alias("capitals"),
        _vote(F.col("_bars"), F.col("_bars") > 0.2, F.col("_bars") < 0.02).alias("tables"),
        _vote(F.when(n >= 10, F.col("_ends")), ~F.col("_ends").between(0.025, 0.4),
              F.col("_ends").between(0.04, 0.3)).alias("endings"),
        _vote(F.when(n >= 20, F.col("_variety")), F.col("_variety") < 0.2,
              F.col("_variety") > 0.35).alias("variety"),
        _vote(F.col("_plain"), F.col("_plain") < 0.7, F.col("_plain") > 0.9).alias("plain"),
    )


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200):
    """Share of good documents and, per voter, class and vote, its probability.

    Two-class latent model; votes are independent given the class, and saying
    nothing is a vote like any other. It starts from voters that are right more
    often than not, which settles which class is the good one.
    """
    voters = patterns.shape[1]
    chosen = patterns + 1  # nothing, bad, good
    good = 0.7
    rates = np.tile(np.array([[0.3, 0.45, 0.25], [0.3, 0.15, 0.55]]), (voters, 1, 1))
    for _ in range(rounds):
        p = posterior(patterns, good, rates)
        weight = np.stack([(1 - p) * counts, p * counts])
        new = np.full((voters, 2, 3), 0.1)
        for v in range(voters):
            for vote in range(3):
                new[v, :, vote] += weight[:, chosen[:, v] == vote].sum(axis=1)
        new /= new.sum(axis=2, keepdims=True)
        share = float(weight[1].sum() / max(weight.sum(), 1e-9))
        done = np.abs(new - rates).max() < 1e-7
        good, rates = min(max(share, 1e-3), 1 - 1e-3), new
        if done:
            break
    return good, rates


def posterior(patterns: np.ndarray, good: float, rates: np.ndarray) -> np.ndarray:
    """Probability that documents with these votes are good."""
    voters = np.arange(patterns.shape[1])
    logs = np.log(rates)
    bad_log = logs[voters, 0, patterns + 1].sum(axis=1) + np.log(1 - good)
    good_log = logs[voters, 1, patterns + 1].sum(axis=1) + np.log(good)
    return 1.0 / (1.0 + np.exp(np.clip(bad_log - good_log, -500, 500)))


def hashers(features: tuple[int, int] = FEATURES) -> list[HashingTF]:
    """Words and shapes as counts of buckets."""
    return [HashingTF(inputCol=c, outputCol=f"{c}_tf", numFeatures=n)
            for c, n in zip(("_words", "_shapes"), features)]


def measured(
    docs: DataFrame, features: tuple[int, int] = FEATURES, whole: bool = True
) -> DataFrame:
    """Every row as ``_doc`` with its number ``_row``, its votes and its hashed counts,
    written: one reading of the texts serves the counts, the sample and the scores."""
    voted = with_votes(docs)
    if not whole:
        voted = voted.withColumn("_doc", F.col("_doc").dropFields("text"))
    for hasher in hashers(features):
        voted = hasher.transform(voted)
    return stage(voted.drop("_words", "_shapes").withColumn(
        "_row", F.monotonically_increasing_id()), "quality")


def trained(labelled: DataFrame, total: int, sample: int = SAMPLE) -> PipelineModel | None:
    """The linear model from the soft labels (``posterior``) of about ``sample`` rows,
    or None where they are all of one kind."""
    share = min(1.0, sample / max(1, total))
    chosen = labelled.filter(
        F.pmod(F.xxhash64("_row"), F.lit(1 << 30)) < int(share * (1 << 30))
    )
    # A soft label is a good and a bad row with weights that add up to one.
    both = F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")),
    ))
    training = stage(
        chosen.select("_words_tf", "_shapes_tf", both.alias("_y"))
        .select("_words_tf", "_shapes_tf", "_y.*").filter("weight > 0.01"), "quality-sample",
    )
    if training.select("label").distinct().count() < 2:
        return None
    # Each part has length one, so that neither outweighs the other.
    return Pipeline(stages=[
        Normalizer(inputCol="_words_tf", outputCol="_words_unit", p=2.0),
        Normalizer(inputCol="_shapes_tf", outputCol="_shapes_unit", p=2.0),
        VectorAssembler(inputCols=["_words_unit", "_shapes_unit"], outputCol="_unit"),
        LogisticRegression(
            featuresCol="_unit", labelCol="label", weightCol="weight", maxIter=25, regParam=1e-4,
            probabilityCol="_prob", rawPredictionCol="_raw", predictionCol="_pred"),
    ]).fit(training)


def scored(
    docs: DataFrame, sample: int = SAMPLE, features: tuple[int, int] = FEATURES,
    whole: bool = True,
) -> DataFrame:
    """Every row as ``_doc`` with the votes, the posterior and the score (0 to 1).

    ``_doc`` has all columns, or all but ``text``.
    """
    spark = docs.sparkSession
    rows = measured(docs, features, whole)
    counted = rows.groupBy(*VOTERS).agg(F.count("*").alias("n")).toPandas()
    patterns = counted[list(VOTERS)].to_numpy(np.int64).reshape(-1, len(VOTERS))
    counts = counted["n"].to_numpy(np.float64)
    good, rates = estimate(patterns, counts)
    labels = spark.createDataFrame(
        [(*map(int, p), float(q)) for p, q in zip(patterns, posterior(patterns, good, rates))],
        ", ".join(f"{v} int" for v in VOTERS) + ", posterior double",
    )
    labelled = rows.join(F.broadcast(labels), list(VOTERS))  # at most 3^6 rows
    model = trained(labelled, int(counts.sum()), sample)
    if model is None:
        return labelled.withColumn("score", F.col("posterior"))
    return model.transform(labelled).withColumn("score", vector_to_array("_prob")[1])


def quality_table(docs: DataFrame, keep: float = KEEP, **how) -> DataFrame:
    """Per row: the votes, the posterior of the heuristics, the score, the decision."""
    return scored(docs.select("doc_id", "text"), whole=False, **how).select(
        F.col("_doc.doc_id").alias("doc_id"), *VOTERS, "posterior", "score",
        (F.col("score") >= keep).alias("keep"),
    )


def good_documents(docs: DataFrame, keep: float = KEEP, **how) -> DataFrame:
    """The rows that score ``keep`` or more."""
    return scored(docs, **how).filter(F.col("score") >= keep).select("_doc.*")
