"""Running sums over a whole table in order, without one window over all rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmullo.session import work_dir
from murmullo.sources.store import remove


def stage(df: DataFrame, purpose: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder, in folders ``by`` its columns, and read it back.

    Later steps start from the files: lost executors cost no recomputation, a
    random order or partition number is fixed once, and the planner knows the
    size when it decides on a broadcast.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    return found.select(*df.columns) if by else found  # columns of folders come last


def discard(staged: DataFrame, name: str = "") -> None:
    """Remove a table of ``stage``, or its folders of one ``name``, which no later step reads."""
    for folder in {path.rsplit("/", 1)[0] for path in staged.inputFiles()}:
        if folder.endswith(name):
            remove(staged.sparkSession, folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their job is done, not when the driver collects its garbage:
    for jobs that each write their result to a table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_running_sums(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, str], purpose: str
) -> DataFrame:
    """Add, for each ``total: value``, the sum of ``value`` up to and with each row.

    The rows are range-partitioned by ``order`` and written, and each range is
    summed on its own. The sums of the ranges come to the driver, one row per
    shuffle partition, and what lies before a range is added to its rows.
    Values are whole numbers; a null adds nothing.
    """
    ranged = stage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), purpose
    )
    found = ranged.groupBy("_range").agg(
        *[F.coalesce(F.sum(value), F.lit(0)).cast("bigint") for value in sums.values()]
    ).collect()
    by_range = {row[0]: row[1:] for row in found}
    bases, before = [], [0] * len(sums)
    for number in range(max(by_range, default=-1) + 1):
        bases.append(before)
        before = [a + b for a, b in zip(before, by_range.get(number, [0] * len(sums)))]
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )

    def total(i: int, value: str) -> Column:
        listed = ", ".join(f"{base[i]}L" for base in bases) or "0L"
        base = F.element_at(F.expr(f"array({listed})"), F.col("_range") + 1)
        return base + F.coalesce(F.sum(value).over(inside), F.lit(0))

    return ranged.withColumns({
        name: total(i, value) for i, (name, value) in enumerate(sums.items())
    }).select(*df.columns, *sums)
