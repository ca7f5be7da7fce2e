"""Schemas of the relational inputs, the point stores and the progress table."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STATISTICS_META = _struct(
    ("id", T.LongType()),
    ("statistic_id", T.StringType()),
    ("source", T.StringType()),
    ("unit_of_measurement", T.StringType()),
    ("has_mean", T.BooleanType()),
    ("has_sum", T.BooleanType()),
    ("name", T.StringType()),
    ("mean_type", T.IntegerType()),
    ("unit_class", T.StringType()),
)

# Both readings tables share this shape; times are float epoch seconds at the source.
STATISTICS = _struct(
    ("id", T.LongType()),
    ("created_ts", T.DoubleType()),
    ("metadata_id", T.LongType()),
    ("start_ts", T.DoubleType()),
    ("mean", T.DoubleType()),
    ("mean_weight", T.DoubleType()),
    ("min", T.DoubleType()),
    ("max", T.DoubleType()),
    ("last_reset_ts", T.DoubleType()),
    ("state", T.DoubleType()),
    ("sum", T.DoubleType()),
)

STATES_META = _struct(("metadata_id", T.LongType()), ("entity_id", T.StringType()))

STATES = _struct(
    ("metadata_id", T.LongType()),
    ("attributes_id", T.LongType()),
    ("last_updated_ts", T.DoubleType()),
)

STATE_ATTRIBUTES = _struct(("attributes_id", T.LongType()), ("shared_attrs", T.StringType()))

POINT = _struct(
    ("measurement", T.StringType()),
    ("entity_id", T.StringType()),
    ("domain", T.StringType()),
    ("category", T.StringType()),
    ("unit", T.StringType()),
    ("source", T.StringType()),
    ("friendly_name", T.StringType()),
    ("device_class", T.StringType()),
    ("value", T.DoubleType()),
    ("ts", T.TimestampNTZType()),
)

# A series is the measurement plus every tag; (series, ts) identifies a point.
SERIES = tuple(POINT.names[:8])

PROGRESS = _struct(
    ("metadata_id", T.LongType()),
    ("source_table", T.StringType()),
    ("status", T.StringType()),
    ("last_start_ts", T.TimestampNTZType()),
    ("recorded_at", T.TimestampNTZType()),
    # The export that wrote the row, and the range of readings that it covers.
    ("export_id", T.StringType()),
    ("covered_from", T.TimestampNTZType()),
    ("covered_until", T.TimestampNTZType()),
)

SHORT_TERM = "statistics_short_term"
LONG_TERM = "statistics"

# The five numeric fields of a reading that quality rules look at, in report order.
FIELDS = ("value", "mean", "min_value", "max_value", "sum_value")
