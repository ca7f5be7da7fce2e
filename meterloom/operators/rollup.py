"""Hourly rollup of a point store, and range, tag and name filters on points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.entity import aggregation_method
from meterloom.functions.sql import lit, one_of
from meterloom.functions.time import days_before, in_range
from meterloom.rules import RollupRules
from meterloom.schemas import SERIES

RULES = RollupRules()


def aged(points: DataFrame, now: str, from_days: int, until_days: int = 0) -> DataFrame:
    """Points aged between from_days (inclusive) and until_days (exclusive) before now."""
    return points.filter(in_range("ts", days_before(now, from_days), days_before(now, until_days)))


def where_tags(points: DataFrame, **tags: str | tuple[str, ...]) -> DataFrame:
    """Equality, or one-of, on measurement and tag columns."""
    for name, wanted in tags.items():
        points = points.filter(one_of(name, (wanted,) if isinstance(wanted, str) else wanted))
    return points


def measurement_like(points: DataFrame, pattern: str) -> DataFrame:
    return points.filter(F.col("measurement").rlike(pattern))


def series_method(rules: RollupRules = RULES) -> str:
    """How a series is rolled up, null for none. A counter takes max whatever its unit."""
    return (
        f"CASE WHEN {one_of('domain', rules.max_domains)} THEN 'max'"
        f" WHEN {one_of('measurement', rules.last)} THEN 'last'"
        f" WHEN {one_of('measurement', rules.mean)} THEN 'mean' END"
    )


def _aggregate(tagged: DataFrame, rules: RollupRules, stamp: str) -> DataFrame:
    """The one aggregate: buffers are fixed-width, so it stays a hash aggregate with map-side
    combine, and a hot series or hour ships one row per map task."""
    if stamp not in ("start", "end"):
        raise ValueError(f"unknown stamp: {stamp}")
    hours = tagged.groupBy(*SERIES, "method", F.window("ts", rules.window).alias("hour")).agg(
        F.max_by("value", "ts").alias("last"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
    )
    return hours.selectExpr(
        *SERIES,
        "CASE method WHEN 'last' THEN last WHEN 'max' THEN max ELSE mean END AS value",
        f"hour.{stamp} AS ts",
    )


def rollup(points: DataFrame, rules: RollupRules = RULES, stamp: str = "end") -> DataFrame:
    """All rules in a single pass over the points; also usable on a stream.

    A point can count twice: for its series, and, when its measurement is unit-less data, for
    the mean of its domain. Domain rows carry the measurement <domain>_data and no other tag.
    Empty hours do not appear; rows are stamped at the end of the hour by default."""
    fallback = f"measurement RLIKE {lit(rules.fallback_pattern)}"
    # Targets: false for the series itself, true for its domain.
    routed = points.selectExpr("*", f"{series_method(rules)} AS own").selectExpr(
        "*",
        f"""explode(CASE WHEN own IS NOT NULL AND {fallback} THEN array(false, true)
                         WHEN own IS NOT NULL THEN array(false)
                         WHEN {fallback} THEN array(true) END) AS for_domain""",
    )
    tags = [f"CASE WHEN NOT for_domain THEN {t} END AS {t}" for t in SERIES[3:]]
    tagged = routed.selectExpr(
        "CASE WHEN for_domain THEN concat(domain, '_data') ELSE measurement END AS measurement",
        "CASE WHEN NOT for_domain THEN entity_id END AS entity_id",
        "domain",
        *tags,
        "CASE WHEN for_domain THEN 'mean' ELSE own END AS method",
        "value",
        "ts",
    )
    return _aggregate(tagged, rules, stamp)


def rollup_by_category(points: DataFrame, rules: RollupRules = RULES, stamp: str = "end") -> DataFrame:
    """The alternative rule set: the method follows the category tag."""
    tagged = points.selectExpr("*", f"{aggregation_method()} AS method")
    return _aggregate(tagged.filter("method IS NOT NULL"), rules, stamp)


def without_rule(points: DataFrame, rules: RollupRules = RULES) -> DataFrame:
    """Measurements that no rollup rule covers; their points end with the recent store."""
    uncovered = (
        f"{series_method(rules)} IS NULL"
        f" AND NOT measurement RLIKE {lit(rules.fallback_pattern)}"
    )
    return points.filter(uncovered).groupBy("measurement").agg(F.count("*").alias("n_points"))
