"""Numeric expressions. Spark orders NaN above every number, so NaN is always tested first."""

from __future__ import annotations

INFINITY = "double('Infinity')"


def is_infinite(x: str) -> str:
    return f"abs({x}) = {INFINITY}"


def finite_or_null(x: str) -> str:
    """An ordinary number, else null."""
    return f"CASE WHEN NOT isnan({x}) AND abs({x}) < {INFINITY} THEN {x} END"


def percent(part: str, whole: str) -> str:
    """100 * part / whole; null when the whole is zero."""
    return f"try_divide(100.0D * {part}, CAST({whole} AS DOUBLE))"
