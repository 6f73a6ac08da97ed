"""Likes against the hate flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmullo.functions.labels import correlation_text


def likes_correlation(
    df: DataFrame, flag: str = "es_odio", likes: str = "likes", prob: str = "prob_odio"
) -> DataFrame:
    """Averages per flag value and the Pearson correlation of flag and likes.

    One pass over the data. The flag is 0 or 1, so the correlation follows from
    the size, mean and variance of the two groups, which the same aggregation
    delivers; the window that combines them sees three rows at most. Pairs with
    a null are left out. Without variance the correlation is null.
    """
    per_flag = df.groupBy(F.col(flag).alias("es_odio")).agg(
        F.count("*").alias("cantidad"),
        F.avg(likes).alias("_mean"),
        F.avg(prob).alias("_prob"),
        F.when(F.col("es_odio").isNotNull(), F.count(likes)).otherwise(0)
        .cast("double").alias("_n"),
        F.var_pop(likes).alias("_var"),
    )
    every = Window.partitionBy()

    def total(value):
        return F.coalesce(F.sum(value).over(every), F.lit(0.0))

    flagged = F.col("es_odio") & (F.col("_n") > 0)
    plain = ~F.col("es_odio") & (F.col("_n") > 0)
    combined = per_flag.withColumns({
        "_n1": total(F.when(flagged, F.col("_n"))),
        "_n0": total(F.when(plain, F.col("_n"))),
        "_m1": total(F.when(flagged, F.col("_mean"))),
        "_m0": total(F.when(plain, F.col("_mean"))),
        "_within": total(F.when(F.col("_n") > 0, F.col("_n") * F.col("_var"))),
    })
    n = F.col("_n1") + F.col("_n0")
    spread = F.try_divide(F.col("_n1") * F.col("_n0"), n * n)
    gap = F.col("_m1") - F.col("_m0")
    likes_var = F.try_divide(F.col("_within"), n) + spread * gap * gap
    r = F.try_divide(spread * gap, F.sqrt(spread * likes_var))
    return (
        combined.withColumn("_r", r)
        .select(
            "es_odio", "cantidad",
            F.round("_mean", 2).alias("promedio_likes"),
            F.round("_prob", 3).alias("prob_odio_promedio"),
            F.round("_r", 4).alias("correlacion_pearson"),
            correlation_text(F.col("_r")).alias("interpretacion"),
        )
        .orderBy("es_odio")
    )
