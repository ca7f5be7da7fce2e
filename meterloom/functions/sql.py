"""Literals and small expression shapes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping


def lit(value: str | float | int | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def one_of(column: str, values: Iterable) -> str:
    inside = ", ".join(lit(v) for v in values)
    return f"{column} IN ({inside})" if inside else "false"


def grouped(pairs: Mapping[str, str]) -> dict[str, list[str]]:
    """Invert key -> value into value -> keys, order kept."""
    groups: dict[str, list[str]] = {}
    for key, value in pairs.items():
        groups.setdefault(value, []).append(key)
    return groups


def pick(column: str, pairs: Mapping[str, str]) -> str:
    """A text map as an expression: one branch per value; null for an unknown key."""
    branches = (f"WHEN {one_of(column, keys)} THEN {lit(v)}" for v, keys in grouped(pairs).items())
    return f"CASE {' '.join(branches)} END"


def pick_number(column: str, pairs: Mapping[str, float | None]) -> str:
    """A numeric map as an expression; null for an unknown key or an unbounded value."""
    known = [f"WHEN {lit(k)} THEN {lit(float(v))}" for k, v in pairs.items() if v is not None]
    return f"CASE {column} {' '.join(known)} END" if known else "CAST(NULL AS DOUBLE)"


def total(conditions: Iterable[str]) -> str:
    """How many of the conditions hold."""
    return " + ".join(f"CAST({c} AS INT)" for c in conditions)


def holds(condition: str) -> str:
    """A condition with null read as false."""
    return f"coalesce({condition}, false)"
