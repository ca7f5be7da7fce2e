"""Hand-written micro-frames."""

from __future__ import annotations

from pyspark.sql import types as T

from meterloom.schemas import FIELDS, POINT, STATISTICS_META

READING = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("metadata_id", T.LongType()),
        T.StructField("start_ts", T.TimestampNTZType()),
        T.StructField("table_rank", T.IntegerType()),
    ]
    + [T.StructField(f, T.DoubleType()) for f in FIELDS]
)


def meta(spark, rows):
    """Rows of (id, statistic_id, source, unit)."""
    full = [(i, sid, src, unit, True, False, sid, 1, None) for i, sid, src, unit in rows]
    return spark.createDataFrame(full, STATISTICS_META)


def readings(spark, rows):
    """Rows of (id, metadata_id, start_ts, table_rank, field values...), short rows padded."""
    return spark.createDataFrame(
        [tuple(r) + (None,) * (len(READING) - len(r)) for r in rows], READING
    )


def points(spark, rows):
    """Rows of dicts; absent tags are null."""
    return spark.createDataFrame([tuple(r.get(n) for n in POINT.names) for r in rows], POINT)
