"""Risk score per author."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmullo.functions.measures import percent, risk_score


def user_activity(df: DataFrame, author: str = "autor") -> DataFrame:
    """Comments, hate comments and likes of each author, in one pass.

    All four are partial sums, so an author with a third of all comments sends
    one row per task to the shuffle.
    """
    hate = F.col("es_odio")
    zero = F.lit(0).cast("bigint")
    return df.groupBy(author).agg(
        F.count("*").alias("total_comentarios"),
        F.count_if(hate).alias("comentarios_odio"),
        F.sum(F.when(hate, F.col("likes")).otherwise(zero)).alias("likes_en_odio"),
        F.sum("likes").alias("likes_totales"),
    )


def user_risk(df: DataFrame, min_comments: int = 2, author: str = "autor") -> DataFrame:
    """Authors with enough comments, scored on the rounded hate percentage."""
    return (
        user_activity(df, author)
        .filter(F.col("total_comentarios") >= min_comments)
        .withColumn(
            "porcentaje_odio", percent(F.col("comentarios_odio"), F.col("total_comentarios"))
        )
        .withColumn(
            "score_riesgo", risk_score(F.col("porcentaje_odio"), F.col("likes_en_odio"))
        )
    )


def user_risk_score(df: DataFrame, min_comments: int = 2, author: str = "autor") -> DataFrame:
    """All scored authors, highest risk first; equal scores in author order."""
    return user_risk(df, min_comments, author).orderBy(F.desc("score_riesgo"), F.asc(author))


def top_users(scores: DataFrame, k: int = 20, author: str = "autor") -> DataFrame:
    return scores.orderBy(F.desc("score_riesgo"), F.asc(author)).limit(k)
