"""Token counts through a cache of digests.

The cache is a Parquet folder with a folder for each tokenizer version (SHA-256 of its
file): digest of the content (SHA-256 in UTF-8), number of tokens. Contents that are in it are
not encoded again; of the others each is encoded once, however many documents
have it, and appended. The content is normalised by making null an empty text,
the only change that cannot alter a count. Equal digests are pre-aggregated
in the tasks, so a group of copies sends one text per task.

Rows may repeat; every row gets its count. Two jobs that fill one cache at a
time may append a digest twice, which does no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmullo.llm.common import sliced, stage
from murmullo.llm.tokens import encoder
from murmullo.session import ship_package, work_dir

LIMIT = 1024
_CACHE = "digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _counting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for whole in batches:
            for batch in sliced(whole, 1, 8 << 20):
                _, counts = known.encode(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts.astype(np.int64))],
                    names=["digest", "n_tokens"],
                )

    return run


def _cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    own = f"{cache.rstrip('/')}/version={version}"
    where = spark._jvm.org.apache.hadoop.fs.Path(own)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(where):
        return spark.createDataFrame([], _CACHE)
    return spark.read.schema(_CACHE).parquet(own)


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``cache`` is a folder that all executors share; without one a fresh folder
    is used, which then holds this table's counts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    cache = cache or work_dir(spark, "token-counts")
    version = tokenizer_version(tokenizer)
    text = F.coalesce("text", F.lit(""))
    digested = docs.select(
        "doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    # Copies are dropped inside the tasks, before anything is shuffled.
    misses = (
        digested.select("digest", "text").dropDuplicates(["digest"])
        .join(_cached(spark, cache, version), "digest", "left_anti")
    )
    (
        misses.mapInArrow(_counting(tokenizer), "digest binary, n_tokens bigint")
        .write.mode("append").parquet(f"{cache.rstrip('/')}/version={version}")
    )
    # Only what this table needs is kept of the cache, however large it is.
    wanted = digested.select("digest").distinct()
    counts = stage(
        _cached(spark, cache, version).join(wanted, "digest", "left_semi")
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts-read",
    )
    return digested.select("doc_id", "digest", "n_bytes").join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
