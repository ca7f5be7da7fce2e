"""Scheduled maintenance of the stores: roll up what ages out, then expire it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from meterloom.functions.time import days_before, ntz
from meterloom.operators.rollup import RULES, rollup
from meterloom.operators.sizing import is_small, maybe_broadcast
from meterloom.rules import Lifecycle, RollupRules
from meterloom.sources.scratch import scratch
from meterloom.sources.store import CHANGE, HOUR, PointStore


def _hours_before(now: str, days: int) -> str:
    until = datetime.fromisoformat(days_before(now, days))
    return str(until.replace(minute=0, second=0, microsecond=0))


def roll_up_changes(
    recent: PointStore, historical: PointStore, end: str, rules: RollupRules = RULES
) -> None:
    """Hourly points of the hours that writes have changed and that end by `end`. What is rolled up
    together has one measurement, domain and hour, so the other points of these are read along.
    Nothing is read if nothing has changed."""
    spark, parts = recent.spark, recent.change_parts()
    if not parts:
        return
    with scratch(spark, "due") as path:
        due = recent.changes(parts).filter(f"hour + INTERVAL 1 HOUR <= {ntz(end)}")
        due.write.parquet(path)
        due = spark.read.schema(CHANGE).parquet(path)
        first, last = due.agg(F.min("hour"), F.max("hour")).first()
        if first is not None:
            hours = due.selectExpr(*(f"{c} AS due_{c}" for c in CHANGE.names))
            points = recent.read(str(first), str(last + timedelta(hours=1))).selectExpr("*", HOUR)
            same = [F.col(c) == F.col(f"due_{c}") for c in CHANGE.names]
            changed = points.join(maybe_broadcast(hours, is_small(due)), same, "left_semi")
            historical.add(rollup(changed.drop("hour"), rules))
    recent.settle_changes(parts, end)


def roll_up_slice(
    recent: PointStore,
    historical: PointStore,
    now: str,
    lifecycle: Lifecycle = Lifecycle(),
    rules: RollupRules = RULES,
) -> str:
    """Hourly points of what aged past 30 days, replaced by key in the historical store, so a
    repeated run changes nothing. Returns the end of the last hour rolled up.

    A store that logs its changes is rolled up by them: a point that arrives late, at whatever age,
    changes its hour until it expires. Otherwise a run covers the slice aged 30 to 31 days, and
    everything from the end of the last run on, or from the start of the store for the first one: no
    stop of the scheduler leaves an hour out, but a point that arrives after its hour has left the
    slice is ignored."""
    end = _hours_before(now, lifecycle.rollup_until_days)
    mark = historical.mark()
    if recent.log_changes:
        roll_up_changes(recent, historical, end, rules)
    else:
        slice_start = _hours_before(now, lifecycle.rollup_from_days)
        start = None if mark is None else min(mark, slice_start)
        historical.add(rollup(recent.read(start, end), rules))
    reached = end if mark is None else max(mark, end)
    historical.set_mark(reached)
    return reached


def maintain(
    recent: PointStore,
    historical: PointStore,
    now: str,
    lifecycle: Lifecycle = Lifecycle(),
    rules: RollupRules = RULES,
) -> None:
    """One scheduled run. Recent points expire only up to where they have been rolled up."""
    reached = roll_up_slice(recent, historical, now, lifecycle, rules)
    recent.expire(now, not_after=reached)
    historical.expire(now)
