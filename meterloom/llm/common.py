"""Helpers shared by the operators: tables, Arrow columns as bytes, files in the shared folder."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application. A cluster job would do the
    same with --py-files; workers that start elsewhere than the driver cannot import it otherwise."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="meterloom-")) / "meterloom-llm.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column; a null text counts as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def str_texts(column: pa.Array) -> Iterator[str]:
    """The texts of a string column; a null text counts as empty."""
    for value in column:
        yield value.as_py() or ""


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, so that equal rows can be found without moving texts."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, so that tasks find the file system that Spark would use."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder URI, from a task or the driver."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), unquote("/" + uri[len("file:") :].lstrip("/"))
    return pyarrow.fs.FileSystem.from_uri(uri)
