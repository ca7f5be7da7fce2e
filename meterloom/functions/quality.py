"""Value rules. Limits depend only on unit and category, so they are looked up once per
entity (`limits`) and each reading only compares numbers.

An absent limit is the largest finite double, so no comparison meets a null, and because
Spark orders NaN above every number, NaN and the infinities lie outside of every range."""

from __future__ import annotations

from meterloom.functions.numeric import is_infinite
from meterloom.functions.sql import holds, lit, pick, pick_number, total
from meterloom.functions.time import ntz
from meterloom.rules import ISSUES, QualityRules

_LARGEST = "1.7976931348623157E308D"
_SMALLEST = f"-{_LARGEST}"


def limits(rules: QualityRules) -> dict[str, str]:
    """The limit columns of an entity, as expressions over its unit and category."""

    def repair(side: int, absent: str) -> str:
        branches = " ".join(
            f"WHEN category = {lit(c)}"
            + (f" AND unit_of_measurement = {lit(u)}" if u is not None else "")
            + f" THEN {lit(r[side])}"
            for (c, u), r in rules.repair.items()
            if r[side] is not None
        )
        return f"CASE {branches} ELSE {absent} END" if branches else absent

    def bound(column: str, values: dict, absent: str) -> str:
        return f"coalesce({pick_number(column, values)}, {absent})"

    unit, kinds = rules.unit_range, rules.category_range
    return {
        "unit_low": bound("unit_of_measurement", {u: r[0] for u, r in unit.items()}, _SMALLEST),
        "unit_high": bound("unit_of_measurement", {u: r[1] for u, r in unit.items()}, _LARGEST),
        "category_low": bound("category", {c: r[0] for c, r in kinds.items()}, _SMALLEST),
        "category_high": bound("category", {c: r[1] for c, r in kinds.items()}, _LARGEST),
        "repair_low": repair(0, _SMALLEST),
        "repair_high": repair(1, _LARGEST),
    }


# Both kinds of limit taken together, over the limit columns.
TIGHTEST = {"low": "greatest(unit_low, category_low)", "high": "least(unit_high, category_high)"}


def usable_or_null(x: str, rules: QualityRules) -> str:
    """The value unless it is NaN, infinite or an error sentinel, for which no repair is tried."""
    sentinel = f"{x} IN ({lit(rules.sentinel_low)}, {lit(rules.sentinel_high)})"
    return f"CASE WHEN {x} >= {_SMALLEST} AND {x} <= {_LARGEST} AND NOT {sentinel} THEN {x} END"


def repaired(usable: str) -> str:
    """A usable value after the limits: kept, moved to the repair limit, or null."""
    return (
        f"CASE WHEN {usable} >= low AND {usable} <= high THEN {usable}"
        f" WHEN {usable} < repair_low THEN repair_low"
        f" WHEN {usable} > repair_high THEN repair_high END"
    )


def _beyond(x: str) -> list[str]:
    return [
        f"({x} < unit_low)",
        f"({x} > unit_high)",
        f"({x} < category_low)",
        f"({x} > category_high)",
    ]


def issue_count(raw: str, usable: str) -> str:
    """How many issues one value raises: one when it is unusable, else one per rule broken, of
    which there can be a unit and a category rule."""
    return (
        f"CASE WHEN {raw} IS NULL THEN 0 WHEN {usable} IS NULL THEN 1"
        f" ELSE {total(_beyond(usable))} END"
    )


def issue_codes(x: str, rules: QualityRules) -> str:
    """The issues of one value as an array of codes, in rule order."""
    below = pick("category", {c: r[2] for c, r in rules.category_range.items()})
    above = pick("category", {c: r[3] for c, r in rules.category_range.items()})
    codes = ("'below_minimum'", "'above_maximum'", below, above)
    soft = ", ".join(f"CASE WHEN {hit} THEN {code} END" for hit, code in zip(_beyond(x), codes))
    return (
        f"CASE WHEN {x} IS NULL THEN CAST(array() AS ARRAY<STRING>)"
        f" WHEN isnan({x}) THEN array('nan')"
        f" WHEN {is_infinite(x)} THEN array('infinite')"
        f" WHEN {x} = {lit(rules.sentinel_low)} THEN array('sentinel_low')"
        f" WHEN {x} = {lit(rules.sentinel_high)} THEN array('sentinel_high')"
        f" ELSE array_compact(array({soft})) END"
    )


def category_counts(fields: list[str], rules: QualityRules) -> dict[str, str]:
    """Issue category -> how many issues of it the fields raise together. The same decisions as
    issue_codes, as sums of conditions."""
    groups: dict[str, list[str]] = {}

    def add(code: str, condition: str) -> None:
        groups.setdefault(ISSUES[code][0], []).append(condition)

    for x in fields:
        hard = f"(isnan({x}) OR {is_infinite(x)} OR {x} IN ({lit(rules.sentinel_low)}, {lit(rules.sentinel_high)}))"
        add("nan", holds(f"isnan({x})"))
        add("infinite", holds(is_infinite(x)))
        add("sentinel_low", holds(f"{x} = {lit(rules.sentinel_low)}"))
        add("sentinel_high", holds(f"{x} = {lit(rules.sentinel_high)}"))
        unit_low, unit_high, kind_low, kind_high = _beyond(x)
        add("below_minimum", holds(f"NOT {hard} AND {unit_low}"))
        add("above_maximum", holds(f"NOT {hard} AND {unit_high}"))
        for category, (_, _, below, above) in rules.category_range.items():
            of_kind = f"NOT {hard} AND category = {lit(category)}"
            if below:
                add(below, holds(f"{of_kind} AND {kind_low}"))
            if above:
                add(above, holds(f"{of_kind} AND {kind_high}"))
    return {group: total(conditions) for group, conditions in groups.items()}


def is_valid_time(ts: str, rules: QualityRules) -> str:
    """Both ends inclusive; a null time is not valid."""
    return holds(f"{ts} BETWEEN {ntz(rules.earliest)} AND {ntz(rules.latest)}")


def issue_category(code: str) -> str:
    return pick(code, {c: group for c, (group, _) in ISSUES.items()})


def issue_message(code: str, value: str, limit: str, unit: str) -> str:
    """Readable text of an issue."""
    text = pick(code, {c: message for c, (_, message) in ISSUES.items()})
    for slot, column in (("{value}", value), ("{limit}", limit), ("{unit}", unit)):
        text = f"replace({text}, {lit(slot)}, coalesce(CAST({column} AS STRING), ''))"
    return text
