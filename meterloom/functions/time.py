"""Time expressions. The batch type is timestamp_ntz holding UTC, so no result depends on the
session time zone, and "now" is always a parameter."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone


def ntz(text: str) -> str:
    return f"TIMESTAMP_NTZ '{text}'"


def days_before(now: str, days: int) -> str:
    """Literal text of a time so many days before now."""
    return str(datetime.fromisoformat(now) - timedelta(days=days))


def epoch_of(text: str) -> float:
    """The epoch seconds of a UTC time, for comparing against a raw epoch column."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp()


def epoch_to_ntz(seconds: str) -> str:
    """Float epoch seconds to UTC. NaN and infinite input give null."""
    exact = f"try_cast({seconds} AS DECIMAL(18, 6))"
    return f"{ntz('1970-01-01 00:00:00')} + make_dt_interval(0, 0, 0, {exact})"


def floor_second(ts: str) -> str:
    """Drop the fraction of a second, which is the same in every time zone."""
    fraction = f"pmod(unix_micros(CAST({ts} AS TIMESTAMP)), 1000000L)"
    return f"timestampadd(MICROSECOND, CAST(-{fraction} AS INT), {ts})"


def in_range(ts: str, start: str | None, end: str | None) -> str:
    """Half-open range of literal times: start inclusive, end exclusive, both optional."""
    parts = []
    if start is not None:
        parts.append(f"{ts} >= {ntz(start)}")
    if end is not None:
        parts.append(f"{ts} < {ntz(end)}")
    return " AND ".join(parts) or "true"


def seconds_between(earlier: str, later: str) -> str:
    """Whole seconds between two timestamp_ntz columns."""
    gap = f"({later} - {earlier})"
    return (
        f"CAST(extract(DAY FROM {gap}) AS BIGINT) * 86400"
        f" + CAST(extract(HOUR FROM {gap}) AS BIGINT) * 3600"
        f" + CAST(extract(MINUTE FROM {gap}) AS BIGINT) * 60"
        f" + CAST(floor(extract(SECOND FROM {gap})) AS BIGINT)"
    )
