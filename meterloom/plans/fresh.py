"""What an incremental export has to read: the readings after the mark of their entity and table.

Entities are grouped by table and by how far their mark lies behind the newest one. Each group has a
scan of its own, bounded by its oldest mark, so that one sensor that went silent years ago does not
open the history of all. Small groups go into the scan as a list of ids, which prunes row groups or
uses an index of the source; entities without a mark are a group too, and where there are none no
scan without a bound is planned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.time import epoch_of, seconds_between
from meterloom.operators.sizing import BROADCAST_ROWS, maybe_broadcast
from meterloom.schemas import LONG_TERM, SHORT_TERM
from meterloom.sources.tables import Inputs

#: Days behind the newest mark at which a group ends; what is further behind is the last group.
GROUP_DAYS = (1, 7, 30, 365)
#: Groups of so many entities at most are listed in the scan.
LISTED = 1000


def mark_groups(marks: DataFrame) -> DataFrame:
    """marks (id, table_rank, last_start_ts) with the group of each: -1 without a mark, else by its
    distance from the newest mark of the table. The newest ones are at most two numbers."""
    newest = {
        r["table_rank"]: r["t"]
        for r in marks.groupBy("table_rank").agg(F.max("last_start_ts").alias("t")).collect()
    }
    group = "CASE WHEN last_start_ts IS NULL THEN -1"
    for rank, time in newest.items():
        if time is None:
            continue
        behind = seconds_between("last_start_ts", f"TIMESTAMP_NTZ '{time}'")
        for place, days in enumerate(GROUP_DAYS):
            group += f" WHEN table_rank = {rank} AND {behind} <= {days * 86400} THEN {place}"
    return marks.selectExpr("*", f"{group} ELSE {len(GROUP_DAYS)} END AS mark_group")


def fresh_readings(
    inputs: Inputs, marks: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Readings of the listed entities after their marks, within a half-open range. marks has one
    row per entity and table (progress.marks_of) and should be a written table: it is read once
    for the groups and once per group."""
    grouped = mark_groups(marks)
    groups = grouped.groupBy("table_rank", "mark_group").agg(
        F.count("*").alias("n"), F.min("last_start_ts").alias("since")
    )
    scans = []
    for g in sorted(groups.collect(), key=lambda r: (r["table_rank"], r["mark_group"])):
        table = SHORT_TERM if g["table_rank"] == 0 else LONG_TERM
        since = None if g["since"] is None else str(g["since"])
        bound = max((t for t in (start, since) if t is not None), key=epoch_of, default=None)
        scan = inputs.table_readings(table, bound, end)
        here = (F.col("table_rank") == g["table_rank"]) & (F.col("mark_group") == g["mark_group"])
        own = grouped.filter(here).selectExpr("id AS metadata_id", "last_start_ts")
        if g["n"] <= LISTED:
            scan = scan.filter(F.col("metadata_id").isin([r[0] for r in own.collect()]))
        if since is not None or g["n"] > LISTED:
            joined = scan.join(maybe_broadcast(own, g["n"] <= BROADCAST_ROWS), "metadata_id")
            scan = joined.filter("last_start_ts IS NULL OR start_ts > last_start_ts").select(*scan.columns)
        scans.append(scan)
    return reduce(DataFrame.unionByName, scans) if scans else inputs.readings(start, end).filter("false")
