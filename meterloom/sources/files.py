"""Small control files in the folders that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def locate(spark: SparkSession, path: str):
    """File system and path object of a path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def exists(spark: SparkSession, path: str) -> bool:
    fs, root = locate(spark, path)
    return fs.exists(root)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    fs, root = locate(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, root = locate(spark, path)
    fs.mkdirs(root)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, which shows the target whole or not at all."""
    fs, root = locate(spark, source)
    _, to = locate(spark, target)
    if not fs.rename(root, to):
        raise OSError(f"{source} could not be renamed to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears with its whole content."""
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, root = locate(spark, aside)
    out = fs.create(root)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, aside, path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]
