"""Session defaults and the shared working folder."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_session(app_name: str, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    The zone is pinned because the date formats carry no offset. Keys may use
    ``__`` for ``.`` so they can be given as keywords.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = {**_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    It lies in the folder every executor shares, named by
    ``spark.checkpoint.dir``. Only a local session may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_root(spark)
    return f"{root.rstrip('/')}/murmullo/{purpose}-{uuid.uuid4().hex}"


def _local_root(spark: SparkSession) -> str:
    """Driver and executors are one process here, so its own folder will do."""
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster is not local
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="murmullo-")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed only where a Python model runs inside tasks and the package is not
    installed on the executors. The archive is made on the driver; Spark copies
    it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="murmullo-"), "murmullo.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent).as_posix())
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
