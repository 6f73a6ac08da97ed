"""Folders of whatever store a path names: list, mark, move and remove."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    store, target = _at(spark, path)
    if not store.exists(target):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(target))


def mark(spark: SparkSession, path: str) -> None:
    """An empty file: it is there or it is not, and nothing in between."""
    store, target = _at(spark, path)
    store.mkdirs(target.getParent())
    store.create(target, True).close()


def remove(spark: SparkSession, path: str) -> None:
    store, target = _at(spark, path)
    store.delete(target, True)


def replace(spark: SparkSession, source: str, path: str) -> None:
    """Put a folder in the place of another. The old one is moved aside first, and comes
    back if the new one cannot be moved."""
    store, target = _at(spark, path)
    new, old = _at(spark, source)[1], _at(spark, f"{source}-old")[1]
    there = store.exists(target)
    if there:
        store.rename(target, old)
    if not store.rename(new, target):
        if there:
            store.rename(old, target)
        raise OSError(f"could not move {source} to {path}")
    if there:
        store.delete(old, True)
