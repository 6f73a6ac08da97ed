"""A live buffer: the last N messages of a stream, kept as a small table."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from murmullo.operators.recent import BUFFER_SIZE, last_rows
from murmullo.streaming.jobs import begin


# Versions go round a few folders, so a buffer does not grow with its batches.
_SLOTS = 8


def _slot(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/slot={number % _SLOTS}"


def start_buffer(
    df: DataFrame, path: str, checkpoint: str, *order: str, size: int = BUFFER_SIZE,
    name: str | None = None, trigger: str | None = None,
) -> StreamingQuery:
    """Keep the ``size`` newest messages by the given order columns.

    Each micro-batch merges its own newest rows with the previous version and
    writes a new one. A batch that is repeated reads the same previous version
    and writes the same result. A first batch on a path of an earlier buffer, that
    is with a new checkpoint, starts it afresh.
    """
    schema = _with_version(df.schema)

    def keep_newest(batch: DataFrame, number: int) -> None:
        if number == 0:
            _clear(batch.sparkSession, path)
        newest = last_rows(batch, size, *order)
        if number > 0:
            reader = batch.sparkSession.read.schema(schema)
            before = reader.parquet(_slot(path, number - 1)).drop("version")
            newest = last_rows(newest.unionByName(before), size, *order)
        stamped = newest.withColumn("version", F.lit(number).cast("bigint"))
        stamped.coalesce(1).write.mode("overwrite").parquet(_slot(path, number))

    writer = df.writeStream.outputMode("append").foreachBatch(keep_newest)
    return begin(writer, checkpoint, name, trigger)


def _clear(spark: SparkSession, path: str) -> None:
    """Remove the slots of an earlier buffer, and nothing else."""
    for number in range(_SLOTS):
        slot = spark._jvm.org.apache.hadoop.fs.Path(_slot(path, number))
        slot.getFileSystem(spark._jsc.hadoopConfiguration()).delete(slot, True)


def read_buffer(
    spark: SparkSession, path: str, schema: T.StructType, tries: int = 5
) -> DataFrame:
    """The newest version of a buffer.

    Its few rows (``size`` of the buffer) are read at once. Where a folder is
    replaced meanwhile, the reader was overtaken by all slots, and reads again.
    """
    for left in reversed(range(tries)):
        versions = spark.read.schema(_with_version(schema)).parquet(path)
        try:
            newest = versions.agg(F.max("version")).first()[0]
            rows = versions.filter(F.col("version") == F.lit(newest)).drop("version", "slot").collect()
            # The version may have been replaced between the two reads.
            if newest is None or rows:
                return spark.createDataFrame(rows, schema)
        except (PySparkException, Py4JJavaError):
            if not left:
                raise
    raise RuntimeError(f"{path}: every version was replaced while it was read")


def _with_version(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("version", T.LongType())])
