"""Where intermediate tables go, and how they are removed."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_base(setting: str | None, master: str) -> str:
    """The folder that driver and executors share. Only where both are one process (local mode)
    may it be a temporary folder of the machine."""
    if setting:
        return setting.rstrip("/")
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="meterloom-")
    raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table whose reader decides when it is done with."""
    base = scratch_base(spark.conf.get(SETTING, None), spark.sparkContext.master)
    return f"{base}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A path whose content is removed at the end, also after an error."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        discard(spark, path)
