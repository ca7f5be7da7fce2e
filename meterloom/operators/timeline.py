"""Store maintenance as DataFrame operators: retention, deletion, duplicates, one timeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.sql import holds, lit
from meterloom.functions.time import days_before, in_range, ntz
from meterloom.rules import MIGRATION_SOURCE
from meterloom.schemas import SERIES

# The time range a deletion covers, first inclusive, last inclusive.
DELETE_FROM = "1970-01-01 00:00:00"
DELETE_UNTIL = "2030-12-31 23:59:59"

_TAGGED = holds(f"source = {lit(MIGRATION_SOURCE)}")

# The deletion predicate; a point without source tag does not match.
MIGRATED = f"({_TAGGED} AND ts BETWEEN {ntz(DELETE_FROM)} AND {ntz(DELETE_UNTIL)})"


def retained(points: DataFrame, now: str, days: int) -> DataFrame:
    """Points younger than the retention; zero days keeps everything."""
    return points if days == 0 else points.filter(in_range("ts", days_before(now, days), None))


def without_migrated(points: DataFrame) -> DataFrame:
    return points.filter(f"NOT {holds(MIGRATED)}")


def delete_counts(points: DataFrame) -> DataFrame:
    """Tagged points before the deletion, those it removes, and tagged points after it."""
    return points.selectExpr(
        f"count_if({_TAGGED}) AS n_before",
        f"count_if({MIGRATED}) AS n_deleted",
        f"count_if({_TAGGED} AND NOT {MIGRATED}) AS n_after",
    )


def newest_per_point(points: DataFrame, version: str) -> DataFrame:
    """One value per (series, ts): the one with the highest version.

    With a numeric version this is a hash aggregate that collapses copies before the shuffle."""
    return points.groupBy(*SERIES, "ts").agg(F.max_by("value", version).alias("value"))


def unified(*stores: DataFrame) -> DataFrame:
    """Stores as one timeline; where several have a point, the first of them wins. One aggregate
    over all of them."""
    ranked = [s.selectExpr("*", f"{-place} AS priority") for place, s in enumerate(stores)]
    return newest_per_point(reduce(DataFrame.unionByName, ranked), "priority")
