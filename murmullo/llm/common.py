"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmullo.operators.ordered import stage, with_running_sums  # noqa: F401  (used by the operators)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What a word is made of where white space alone separates words.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def row_struct(df: DataFrame) -> Column:
    """The whole row under one name, so that no column of the input can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def sliced(
    batch: pa.RecordBatch, column: int | pa.Array, most: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text, one row at least.

    ``column`` is the number of the texts' column, or the texts. What a task keeps
    besides its batch is then bounded by the longest text.
    """
    texts = batch.column(column) if isinstance(column, int) else column
    start = size = 0
    for i in range(batch.num_rows):
        value = texts[i]
        n = len(value.as_buffer()) if value.is_valid else 0
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)
