"""Classifying, filtering and summarising entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.entity import (
    aggregation_method,
    aggregation_window,
    category,
    is_kept,
    rejection,
)
from meterloom.functions.numeric import percent
from meterloom.functions.sql import lit, one_of
from meterloom.functions.text import name_contains, non_empty
from meterloom.rules import CATEGORIES, EXCLUDED, EntityRules

RULES = EntityRules()


def categorise(meta: DataFrame, rules: EntityRules = RULES) -> DataFrame:
    """Add category and the aggregation that goes with it."""
    return meta.selectExpr("*", f"{category(rules)} AS category").selectExpr(
        "*",
        f"{aggregation_method()} AS aggregation_method",
        f"{aggregation_window()} AS aggregation_window",
    )


def decide(meta: DataFrame, rules: EntityRules = RULES) -> DataFrame:
    """Every entity with its inclusion decision and the reason for it."""
    judged = categorise(meta, rules)
    named = judged.selectExpr("*", f"{rejection(rules)} AS why_not")
    return named.selectExpr(
        *judged.columns,
        "why_not IS NULL AS included",
        "coalesce(why_not, concat('Included as ', category)) AS reason",
    )


def filter_entities(meta: DataFrame, rules: EntityRules = RULES) -> DataFrame:
    """The entities that `decide` includes."""
    kept = meta.selectExpr("*", f"{category(rules)} AS category").filter(is_kept(rules))
    return kept.selectExpr(
        "*",
        f"{aggregation_method()} AS aggregation_method",
        f"{aggregation_window()} AS aggregation_window",
        "concat('Included as ', category) AS reason",
    )


def entity_ids(entities: DataFrame) -> DataFrame:
    return entities.select("id")


def named_like(entities: DataFrame, part: str) -> DataFrame:
    """Case-insensitive substring on the statistic id."""
    return entities.filter(name_contains("statistic_id", part))


def of_categories(entities: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    return entities.filter(one_of("category", wanted))


def filter_summary(decided: DataFrame) -> DataFrame:
    """One row: totals, inclusion rate (null without entities) and a count per category.

    The category list is fixed, so empty categories are zero columns of the same aggregate."""
    return decided.selectExpr(
        "count(*) AS total_entities",
        "count_if(included) AS included_entities",
        "count_if(NOT included) AS excluded_entities",
        *[f"count_if(included AND category = {lit(c)}) AS {c}" for c in CATEGORIES],
        f"{percent('count_if(included)', 'count(*)')} AS inclusion_rate",
    )


def category_breakdown(decided: DataFrame) -> DataFrame:
    """The category counts of the summary as rows, zeros included."""
    wide = filter_summary(decided).select(*CATEGORIES)
    return wide.unpivot([], list(CATEGORIES), "category", "n_entities")


def by_category(entities: DataFrame) -> DataFrame:
    """Members of every category, one row each; an empty category has one row without member.

    Groups stay rows: a list per category would put a third of all entities in one task."""
    members = entities.select("category", "id", "statistic_id", "unit_of_measurement")
    listed = ", ".join(lit(c) for c in CATEGORIES)
    names = entities.sparkSession.range(1).selectExpr(f"explode(array({listed})) AS category")
    empty = names.join(entities.select("category").distinct(), "category", "left_anti")
    return members.unionByName(empty, allowMissingColumns=True)


def category_samples(entities: DataFrame, n: int = 3) -> DataFrame:
    """The first n entities per category by statistic id, and how many more there are.

    The row number under its limit keeps n rows per category in each map task, so no category
    is sorted in one place."""
    position = "row_number() OVER (PARTITION BY category ORDER BY statistic_id, id) AS position"
    first = entities.selectExpr(
        "category", "id", "statistic_id", "unit_of_measurement", position
    ).filter(f"position <= {n}")
    # One row per category: bounded by the fixed category list.
    counts = entities.groupBy("category").agg(F.count("*").alias("members"))
    return first.join(F.broadcast(counts), "category").selectExpr(
        "category",
        "position",
        "statistic_id",
        "coalesce(unit_of_measurement, 'no unit') AS unit",
        f"greatest(members - {n}, 0) AS n_more",
    )


def unit_breakdown(meta: DataFrame, top_excluded: int = 10, rules: EntityRules = RULES) -> DataFrame:
    """Entities per unit, split by category alone (not by the full inclusion decision): every
    included unit, and the most frequent excluded ones."""
    counts = (
        meta.selectExpr(
            f"{category(rules)} = {lit(EXCLUDED)} AS is_excluded",
            f"coalesce({non_empty('unit_of_measurement')}, 'no unit') AS unit",
        )
        .groupBy("is_excluded", "unit")
        .agg(F.count("*").alias("n_entities"))
    )
    excluded = (
        counts.filter("is_excluded").orderBy(F.desc("n_entities"), "unit").limit(top_excluded)
    )
    return counts.filter("NOT is_excluded").unionByName(excluded)


def count_by(meta: DataFrame, column: str) -> DataFrame:
    """Entities per value of one column; null is a group."""
    return meta.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))


def entity_summary(meta: DataFrame, short_term: DataFrame, long_term: DataFrame) -> DataFrame:
    """Table totals and the unit and source distributions as (section, label, n) rows."""

    def total(df: DataFrame, label: str) -> DataFrame:
        return df.selectExpr("'total' AS section", f"{lit(label)} AS label", "count(*) AS n")

    def section(column: str) -> DataFrame:
        return count_by(meta, column).selectExpr(f"{lit(column)} AS section", "label", "n")

    summary = total(meta, "entities")
    for part in (
        total(long_term, "long_term_records"),
        total(short_term, "short_term_records"),
        section("unit_of_measurement"),
        section("source"),
    ):
        summary = summary.unionByName(part)
    return summary
