"""Readings to tagged points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.numeric import finite_or_null
from meterloom.functions.sql import lit
from meterloom.functions.text import domain_of, non_empty, object_id_of
from meterloom.functions.time import floor_second
from meterloom.rules import MIGRATION_SOURCE
from meterloom.schemas import POINT

RECENT, HISTORICAL = "recent", "historical"

# Short-term readings go to the recent store, long-term ones to the historical.
_STORE = f"CASE WHEN table_rank = 0 THEN {lit(RECENT)} ELSE {lit(HISTORICAL)} END"

# The state of a raw reading if it is a finite number, else the mean if that is, else null.
_RAW_VALUE = f"coalesce({finite_or_null('value')}, {finite_or_null('mean')})"

_TAGS = {
    "entity_id": object_id_of("statistic_id"),
    "domain": domain_of("statistic_id"),
    "unit": non_empty("unit_of_measurement"),
    "friendly_name": non_empty("friendly_name"),
    "device_class": non_empty("device_class"),
}


def with_tags(entities: DataFrame, measurement: str | None = None) -> DataFrame:
    """Attach the point tags to the entity side: text is worked on once per entity, and a
    reading only picks the tags up. Null means the tag is absent. An id without a dot has no
    entity tag and gives no points."""
    given = [f"CAST(NULL AS STRING) AS {c}" for c in _TAGS if c in ("friendly_name", "device_class")
             and c not in entities.columns]
    rest = [c for c in entities.columns if c not in _TAGS]
    known = entities.selectExpr("*", *given)
    tagged = known.selectExpr(*rest, *[f"{sql} AS {tag}" for tag, sql in _TAGS.items()])
    name = lit(measurement) if measurement else "coalesce(unit, concat(domain, '_data'))"
    return tagged.selectExpr("*", f"{name} AS measurement")


def build_points(judged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One point per reading of a tagged entity that has a valid time and a usable value: the
    state if there is one, else the mean.

    `store` says where the point belongs; `keep` carries further columns along.

    Neither the decision nor the value needs min, max or sum, so those are not even read."""
    points = judged.filter("time_ok").selectExpr(
        "measurement",
        "entity_id",
        "domain",
        "category",
        "unit",
        f"{lit(MIGRATION_SOURCE)} AS source",
        "friendly_name",
        "device_class",
        "coalesce(value, mean) AS value",
        f"{floor_second('start_ts')} AS ts",
        f"{_STORE} AS store",
        *keep,
    )
    return points.filter("value IS NOT NULL AND entity_id IS NOT NULL")


def for_store(points: DataFrame, store: str) -> DataFrame:
    return points.filter(F.col("store") == store).select(*POINT.names)


def point_counts(matched_raw: DataFrame) -> DataFrame:
    """Points produced and readings skipped per store when raw readings are written without
    validation; unmatched readings and those without a usable value are skipped."""
    usable = f"coalesce(matched AND {_RAW_VALUE} IS NOT NULL AND contains(statistic_id, '.'), false)"
    flagged = matched_raw.selectExpr(f"{_STORE} AS store", f"{usable} AS usable")
    return flagged.groupBy("store").agg(
        F.count("*").alias("n_readings"),
        F.expr("count_if(usable)").alias("n_points"),
        F.expr("count_if(NOT usable)").alias("n_skipped"),
    )
