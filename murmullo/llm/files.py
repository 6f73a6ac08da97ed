"""Files of formats that Spark does not know, written and read by tasks."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder in the shared folder, and the path in it."""
    return pafs.FileSystem.from_uri(uri)


def part_name(folder: str, suffix: str) -> tuple[pafs.FileSystem, str, str, int]:
    """A name that no other attempt of this task uses: store, path, address, part.

    Only what a task returns is listed in the manifest, so the files of a lost
    attempt are never read.
    """
    store, path = filesystem(folder)
    store.create_dir(path, recursive=True)
    part = TaskContext.get().partitionId()
    name = f"part-{part:06d}-{uuid.uuid4().hex}{suffix}"
    return store, f"{path}/{name}", f"{folder}/{name}", part
