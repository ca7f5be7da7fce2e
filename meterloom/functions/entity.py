"""Classification of an entity from its metadata columns."""

from __future__ import annotations

from meterloom.functions.sql import grouped, lit, one_of, pick
from meterloom.functions.text import contains_any, domain_of, first_contained
from meterloom.rules import CATEGORY_AGGREGATION, EXCLUDED, UNIT_CATEGORY, EntityRules


def category(rules: EntityRules) -> str:
    """First match wins: special source, excluded name, unit, other listed unit, excluded."""
    unit = "unit_of_measurement"
    banned = [p.replace("%", "").strip() for p in rules.exclude_patterns]
    by_unit = " ".join(
        f"WHEN {one_of(unit, units)} THEN {lit(c)}" for c, units in grouped(UNIT_CATEGORY).items()
    )
    return (
        f"CASE WHEN {one_of('source', rules.special_sources)} THEN 'special'"
        f" WHEN {contains_any('lower(statistic_id)', banned)} THEN {lit(EXCLUDED)}"
        f" {by_unit}"
        f" WHEN {one_of(unit, rules.include_units)} THEN 'special'"
        f" ELSE {lit(EXCLUDED)} END"
    )


def _rejections(rules: EntityRules) -> list[tuple[str, str]]:
    """(condition, reason) pairs over an entity with a category, in order of precedence."""
    domain = domain_of("statistic_id")
    name = "lower(statistic_id)"
    word = first_contained(name, rules.status_words)
    return [
        ("NOT coalesce(contains(statistic_id, '.'), false)", "'Invalid entity ID format'"),
        (
            f"NOT ({one_of(domain, rules.include_domains)})",
            f"concat('Domain \\'', {domain}, '\\' not in include list')",
        ),
        (
            f"category = {lit(EXCLUDED)}",
            "'Excluded by filter patterns or unsupported unit'",
        ),
        (contains_any(name, rules.status_words), f"concat('Status indicator: ', {word})"),
    ]


def rejection(rules: EntityRules) -> str:
    """Why an entity is left out; null when it is kept."""
    return "CASE " + " ".join(f"WHEN {c} THEN {r}" for c, r in _rejections(rules)) + " END"


def is_kept(rules: EntityRules) -> str:
    """The same decision without the text, short enough to be pushed into a scan."""
    return " AND ".join(f"NOT ({c})" for c, _ in _rejections(rules))


def aggregation_method() -> str:
    return pick("category", {c: rule[0] for c, rule in CATEGORY_AGGREGATION.items()})


def aggregation_window() -> str:
    return pick("category", {c: rule[1] for c, rule in CATEGORY_AGGREGATION.items()})
