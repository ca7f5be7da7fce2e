"""Embedding whitening: the leading principal components, scaled to variance one.

The fit list is each distinct integer vector once. Its count, sums and second moments are added up
as exact integers, per task first, then per pair of dimensions; the driver gets one number per pair
of dimensions (at most MAX_SIZE dimensions) and forms the centred covariance without rounding
before its last division. The eigenpairs come from `feast`. Rows are projected where they are
read; the covariance of the whitened fit list is measured by a second pass over it.

Defined results: rows whose vector is null or has a null or non-finite component go; a null id is
passed through; repeated rows get a result each and count once in the fit; components without
variance (fewer distinct vectors than components) are left out, so an empty table, or one with one
distinct vector, gives no rows; vectors of different lengths raise an error; only the named columns
are read, so others may have any name."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.feast import largest_pairs
from meterloom.llm.vectors import integer_vector, largest, matrix, one_size, usable
from meterloom.sources.scratch import scratch_path

#: The driver holds a matrix of so many rows and columns at most.
MAX_SIZE = 4096
MOMENT = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """n vectors with integer sums; eigenvalues (falling) and unit eigenvectors (columns) of their
    covariance, and its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, as exact integers."""
        limit = self.n * largest(x) + max(map(abs, self.sums), default=0)
        if limit < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One row per vector, one column per component."""
        return (self.centred(x) / self.n).astype(float) @ (self.vectors / np.sqrt(self.values))


def distinct_vectors(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Each x once, written to the shared folder. Copies collapse before the shuffle."""
    path = scratch_path(spark, "fit-list")
    rows.select("x").distinct().write.parquet(path)
    return spark.read.schema("x array<bigint>").parquet(path)


def moments(fit: DataFrame, size: int) -> tuple[int, list[int], np.ndarray]:
    """Count, sums and second moments (upper triangle) of x, exact."""
    upper = np.triu_indices(size)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(size, object), np.zeros(len(upper[0]), object)
        for batch in batches:
            x = matrix(batch.column("x"), size)
            n += len(x)
            if len(x) * largest(x) ** 2 < 1 << 53:  # every partial sum is an exact double
                x = x.astype(float)
            elif len(x) * largest(x) ** 2 >= 1 << 63:
                x = x.astype(object)
            sums += np.array([int(v) for v in x.sum(axis=0)], object)
            products += np.array([int(v) for v in (x.T @ x)[upper]], object)
        if n:
            first = np.r_[-1, np.full(size, -1), upper[0]].astype(np.int32)
            second = np.r_[-1, np.arange(size), upper[1]].astype(np.int32)
            totals = pa.array([Decimal(v) for v in (n, *sums, *products)], MOMENT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first), pa.array(second), totals], names=["i", "j", "total"]
            )

    rows = fit.mapInArrow(partial, "i int, j int, total decimal(38,0)")
    found = {(r[0], r[1]): int(r[2]) for r in rows.groupBy("i", "j").agg(F.sum("total")).collect()}
    products = np.zeros((size, size), object)
    for i, j in zip(*upper):
        products[i, j] = products[j, i] = found.get((i, j), 0)
    return found.get((-1, -1), 0), [found.get((-1, j), 0) for j in range(size)], products


def fit_components(fit: DataFrame, size: int, k: int) -> Whitening:
    """The k leading components of the fit list; those without variance are left out."""
    if size > MAX_SIZE:
        raise ValueError(f"{size} dimensions; the driver factors at most {MAX_SIZE}")
    n, sums, products = moments(fit, size)
    outer = np.array(sums, object)[:, None] * np.array(sums, object)[None, :]
    centred = n * products - outer  # n^2 times the covariance, an exact integer
    scale = n * n
    covariance = np.array([[int(v) / scale for v in row] for row in centred], float).reshape(size, size)
    trace = sum(int(centred[i, i]) for i in range(size)) / scale
    values, vectors = largest_pairs(covariance, k)
    real = values > max(trace, 0.0) * size * np.finfo(float).eps
    return Whitening(n, sums, values[real], vectors[:, real], trace)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest difference between the covariance of the whitened fit list and the identity."""
    k, size = len(model.values), len(model.sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.whitened(matrix(batch.column("x"), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, c]) for c in range(k)], names=[f"w{c}" for c in range(k)]
            )

    whitened = fit.mapInArrow(project, ", ".join(f"w{c} double" for c in range(k)))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    row = whitened.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(row, pairs))


def whiten(
    spark: SparkSession, rows: DataFrame, k: int = 4, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, component (from 1), n (fit list), deviation (decimal), whitened, explained,
    identity_error: for each usable row its first k whitened components."""
    kept = rows.filter(usable(vector)).select(
        F.col(vec_id).alias("vec_id"), integer_vector(vector).alias("x")
    )
    kind = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, deviation decimal(38,0), whitened double, explained double"
    fit = distinct_vectors(spark, kept)
    size = one_size(fit)
    model = fit_components(fit, size, k) if size else None
    if model is None or not len(model.values):
        empty = spark.createDataFrame([], schema)
        return empty.withColumns({"n": F.lit(0).cast("long"), "identity_error": F.lit(0.0)})
    error = identity_error(fit, model)
    explained = model.values / model.trace
    found_k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), size)
            centred = model.centred(x)
            if largest(centred) ** 2 * size >= 1 << 63:
                centred = centred.astype(object)
            deviation = [Decimal(int(v)) for v in (centred * centred).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), found_k))),
                    pa.array(np.tile(np.arange(1, found_k + 1, dtype=np.int32), len(x))),
                    pa.array([v for v in deviation for _ in range(found_k)], MOMENT),
                    pa.array(model.whitened(x).reshape(-1)),
                    pa.array(np.tile(explained, len(x))),
                ],
                names=["vec_id", "component", "deviation", "whitened", "explained"],
            )

    found = kept.mapInArrow(project, schema)
    return found.withColumns({"n": F.lit(model.n).cast("long"), "identity_error": F.lit(error)})
