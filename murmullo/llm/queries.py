"""The registered queries of the corpus operators and, where SQL can say them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from murmullo.llm.common import table
from murmullo.llm.conversations import repair_damaged
from murmullo.llm.decontaminate import contamination
from murmullo.llm.divergence import source_divergence
from murmullo.llm.language import language_table
from murmullo.llm.mixing import mix_report
from murmullo.llm.quality import quality_table
from murmullo.llm.secrets import secret_table
from murmullo.llm.simhash import near_duplicates
from murmullo.llm.sql import CONVERSATIONS, DECONTAMINATION, DIVERGENCE, MIX, WARC
from murmullo.llm.substrings import repeated_spans
from murmullo.llm.syncmers import compare_edited
from murmullo.llm.token_counts import token_counts
from murmullo.llm.token_files import token_table
from murmullo.llm.warc_zip import archive_pages

Query = Callable[[SparkSession, str], DataFrame]
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_table(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_table(table(spark, sf_dir, "documents"))


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_table(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_substring_dedup, op2_source_mix, op3_token_files, op4_simhash, op5_decontamination,
    op6_quality, op7_token_counts, op8_warc, op9_language, op10_syncmers,
    op11_source_divergence, op12_conversation_repair, op13_secret_scan, pipeline,
)}

ORACLES = {
    "op2_source_mix": MIX, "op5_decontamination": DECONTAMINATION, "op8_warc": WARC,
    "op11_source_divergence": DIVERGENCE, "op12_conversation_repair": CONVERSATIONS,
}
