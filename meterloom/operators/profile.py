"""Statistics, previews and samples of a point store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.time import days_before, in_range, seconds_between
from meterloom.operators.rollup import aged, where_tags
from meterloom.rules import BYTES_PER_POINT
from meterloom.schemas import SERIES


def store_profile(points: DataFrame, now: str, by: str = "store") -> DataFrame:
    """Counts, entity count and time range per store, in one aggregate.

    The entity count is exact; the only distinct is on one column, so it is two-level and its
    map side already sends each entity once."""
    last_month = in_range("ts", days_before(now, 30), now)
    return points.groupBy(by).agg(
        F.count("value").alias("total_points"),
        F.expr(f"count_if({last_month})").alias("points_30d"),
        F.count_distinct("entity_id").alias("n_entities"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def store_size(profile: DataFrame, by: str = "store") -> DataFrame:
    """Size estimate, whole days spanned and points per day, from a profile row."""
    sized = profile.selectExpr(
        by,
        "total_points",
        f"total_points * {BYTES_PER_POINT} AS size_bytes",
        f"CAST(({seconds_between('first_ts', 'last_ts')}) DIV 86400 AS BIGINT) AS days_span",
    )
    return sized.selectExpr(
        "*",
        "size_bytes / 1048576D AS size_mb",
        "CASE WHEN size_bytes / 1048576D > 1024 THEN size_bytes / 1073741824D END AS size_gb",
        "CASE WHEN total_points > 0 AND days_span > 0"
        " THEN try_divide(CAST(total_points AS DOUBLE), CAST(days_span AS DOUBLE)) END"
        " AS points_per_day",
    )


def measurements(points: DataFrame, by: str = "store") -> DataFrame:
    return points.select(by, "measurement").distinct()


def field_names(points: DataFrame, by: str = "store") -> DataFrame:
    """Distinct fields that hold a value, over the long form of the store."""
    long_form = points.unpivot([by], ["value"], "field", "field_value")
    return long_form.filter("field_value IS NOT NULL").select(by, "field").distinct()


def times(points: DataFrame) -> DataFrame:
    """The time column alone."""
    return points.select("ts")


def series_ends(points: DataFrame) -> DataFrame:
    """First and last point of every series."""
    return points.groupBy(*SERIES).agg(
        F.min("ts").alias("first_ts"),
        F.min_by("value", "ts").alias("first_value"),
        F.max("ts").alias("last_ts"),
        F.max_by("value", "ts").alias("last_value"),
    )


def first_per_series(points: DataFrame, n: int) -> DataFrame:
    """The first n points of every series by time; each map task keeps n per series before the
    shuffle (window group limit)."""
    position = f"row_number() OVER (PARTITION BY {', '.join(SERIES)} ORDER BY ts) AS position"
    return points.selectExpr("*", position).filter(f"position <= {n}").drop("position")


def sample_size(points: DataFrame, now: str, days: int = 7, per_series: int = 1000) -> DataFrame:
    """How many points the last days hold, and how many of them a sample of at most per_series
    points per series would take. Counting needs no ordering, so no window."""
    counts = aged(points, now, days).groupBy(*SERIES).agg(F.count("*").alias("n"))
    return counts.selectExpr(
        "coalesce(sum(n), 0) AS all_points",
        f"coalesce(sum(least(n, {per_series})), 0) AS sample_points",
    )


def preview(
    points: DataFrame, now: str, days: int = 7, entity_id: str | None = None, n: int = 10
) -> DataFrame:
    """The first n points of the last days in (series, time) order, optionally of one entity.

    Each series may contribute up to n points, so the first n overall need no per-series limit."""
    recent = aged(points, now, days)
    if entity_id is not None:
        recent = where_tags(recent, entity_id=entity_id)
    return (
        recent.orderBy("entity_id", "measurement", "domain", "ts")
        .limit(n)
        .select("entity_id", "measurement", "value", "ts")
    )
