"""The corpus pipeline: from raw documents to token files, in five stages.

Each stage takes the documents that the one before it kept, makes its decision on
them, and returns those that stay, with the same columns; the last returns what the
token files hold. Every stage is written as Parquet and read again.

Texts without a letter, null ones too, are in no language and go in the first stage. Of
repeated rows one stays. A null id or source is a value like any other; other columns,
whatever their names, stay as they are. An empty table, or one that a stage leaves empty,
gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from murmullo.llm.common import stage, table
from murmullo.llm.decontaminate import decontaminated
from murmullo.llm.language import in_a_language
from murmullo.llm.mixing import mixed
from murmullo.llm.simhash import deduplicated
from murmullo.llm.token_files import token_table

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay."""
    return in_a_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken by weight; a document is there as often as it is taken."""
    return mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back."""
    return token_table(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

# Language models and token files cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
