"""Parquet tables: read, write, gate and export."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmullo.functions.coerce import (
    author_or_unknown, safe_bool, safe_double, safe_int, text_or_empty, unified_text,
)
from murmullo.functions.text import has_text, strip
from murmullo.sources import store

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All part files below ``path``; an empty table if nothing is there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


class TooFewRows(RuntimeError):
    """The input holds fewer rows than the job needs."""


def require_rows(df: DataFrame, min_rows: int) -> DataFrame:
    """``df`` itself if it has the rows a job needs; reads no further than that."""
    found = df.limit(min_rows).count()
    if found < min_rows:
        raise TooFewRows(f"{found} rows found, {min_rows} needed")
    return df


def write_gated(df: DataFrame, path: str, min_rows: int = 0) -> int:
    """Write a table and keep it only if it has ``min_rows``; returns how many it has.

    The input is read once: rows go to a draft beside ``path``, and the footers of its
    files tell their number. Too few, and the draft is removed and an earlier table
    stays; else the draft takes its place.
    """
    spark = df.sparkSession
    draft = f"{path.rstrip('/')}.draft-{uuid.uuid4().hex}"
    try:
        df.write.parquet(draft)
        found = spark.read.schema(df.schema).parquet(draft).count()
        if found < min_rows:
            raise TooFewRows(f"{found} rows found, {min_rows} needed")
        store.replace(spark, draft, path)
    finally:
        store.remove(spark, draft)
    return found


def normalize_comments(df: DataFrame) -> DataFrame:
    """Mixed input rows as raw records: one text column, no blank text, whole
    numbers, no nulls. Columns that the input lacks get their defaults."""

    def given(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    text = unified_text(given("comentario"), given("mensaje")).cast("string")
    raw = {
        "autor": author_or_unknown(given("autor")),
        "comentario": strip(text),
        "likes": safe_int(given("likes")),
        "fecha": text_or_empty(given("fecha")),
        "respuestas": safe_int(given("respuestas")),
    }
    other = [c for c in df.columns if c not in raw and c != "mensaje"]
    return df.filter(has_text(text)).select(
        *other, *[value.alias(name) for name, value in raw.items()]
    )


def coerce_export(df: DataFrame) -> DataFrame:
    """Give the scored columns their export types; other columns pass."""
    rules = {
        "likes": safe_int, "respuestas": safe_int, "es_odio": safe_bool,
        "prob_odio": safe_double, "prob_sentimiento": safe_double,
    }
    return df.withColumns(
        {name: rule(F.col(name)) for name, rule in rules.items() if name in df.columns}
    )


def export_table(df: DataFrame, paths: Sequence[str], min_rows: int = 0) -> list[str]:
    """Write to the first path, then copy to the others; returns those written.

    The copies read what was written first, so the input is computed once; too few
    rows leave nothing. A copy that fails is logged and left out.
    """
    first, *others = paths
    write_gated(df, first, min_rows)
    done = [first]
    if others:
        written = df.sparkSession.read.schema(df.schema).parquet(first)
        for path in others:
            try:
                write_table(written, path)
                done.append(path)
            except Exception as error:  # the second destination is optional
                log.warning("could not copy the export to %s: %s", path, error)
    return done

