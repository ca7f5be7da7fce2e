"""String expressions."""

from __future__ import annotations

from collections.abc import Iterable

from meterloom.functions.sql import lit


def display_name(statistic_id: str) -> str:
    """Readable name from an id: every 'sensor.' removed, underscores to spaces."""
    return f"replace(replace({statistic_id}, 'sensor.', ''), '_', ' ')"


def domain_of(statistic_id: str) -> str:
    """Text before the first dot."""
    return f"split({statistic_id}, '[.]', 2)[0]"


def object_id_of(statistic_id: str) -> str:
    """Text after the first dot; null without a dot."""
    return f"get(split({statistic_id}, '[.]', 2), 1)"


def attributes_in(json: str, keys: Iterable[str]) -> str:
    """Top-level JSON attributes as columns of their names, from one parse of the text; null when
    missing or when the text is malformed."""
    keys = tuple(keys)
    return f"json_tuple({json}, {', '.join(map(lit, keys))}) AS ({', '.join(keys)})"


def contains_any(text: str, words: Iterable[str]) -> str:
    hits = [f"contains({text}, {lit(w)})" for w in words]
    return f"({' OR '.join(hits)})" if hits else "false"


def first_contained(text: str, words: Iterable[str]) -> str:
    """The first of the words that occurs in the text, null when none does."""
    hits = [f"WHEN contains({text}, {lit(w)}) THEN {lit(w)}" for w in words]
    return f"CASE {' '.join(hits)} END" if hits else "CAST(NULL AS STRING)"


def non_empty(text: str) -> str:
    """The text, with an empty string turned into null."""
    return f"nullif({text}, '')"


def name_contains(statistic_id: str, part: str) -> str:
    """Case-insensitive substring test."""
    return f"contains(lower({statistic_id}), {lit(part.lower())})"
