"""Readings: range and id filters, de-duplication, entity matching, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.time import in_range, seconds_between
from meterloom.operators.sizing import maybe_broadcast, tasks_for
from meterloom.schemas import FIELDS

_RANK_BIT = 62
_NO_ID = f"{(1 << _RANK_BIT) - 1}L"


def between(readings: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Half-open time range."""
    return readings.filter(in_range("start_ts", start, end))


def of_entities(
    readings: DataFrame, ids: DataFrame | None, small: bool = False
) -> DataFrame:
    """Readings of the listed entities; None stands for the empty list, which filters nothing."""
    if ids is None:
        return readings
    wanted = maybe_broadcast(ids.selectExpr("id AS metadata_id"), small)
    return readings.join(wanted, "metadata_id", "left_semi")


def in_order(readings: DataFrame) -> DataFrame:
    """By entity, then time. The id closes ties, so a range partition can split a hot entity
    and even a hot (entity, time) pair."""
    return readings.orderBy("metadata_id", "start_ts", "table_rank", "id")


def both_tables(short_term: DataFrame, long_term: DataFrame) -> DataFrame:
    """The two tables as one run; table_rank keeps short-term first."""
    return short_term.unionByName(long_term)


def count_by_table(readings: DataFrame) -> DataFrame:
    return readings.groupBy("table_rank").agg(F.count("*").alias("n_readings"))


def time_range(readings: DataFrame) -> DataFrame:
    return readings.groupBy("table_rank").agg(
        F.min("start_ts").alias("first_ts"), F.max("start_ts").alias("last_ts")
    )


def first_readings(readings: DataFrame, scope: str = "run") -> DataFrame:
    """The first reading per (metadata_id, start_ts): short-term before long-term, then the
    lowest id. Scope "run" spans both tables, "table" treats each table on its own.

    Dropped copies are counted, not kept: n_short and n_long tell how many readings of each
    table the key had. Every aggregate has a fixed-width buffer, so this is a hash aggregate
    whose map side collapses copies before the shuffle; one key with a third of all rows
    ships one row per map task."""
    if scope not in ("run", "table"):
        raise ValueError(f"unknown scope: {scope}")
    keys = ["metadata_id", "start_ts"] + (["table_rank"] if scope == "table" else [])
    # (table_rank, id) as one number: ids are row ids from 0 below 2**62 - 1; none sorts last.
    position = (
        f"CASE WHEN id IS NULL THEN {_NO_ID} WHEN id >= 0 AND id < {_NO_ID} THEN id"
        " ELSE raise_error(concat('reading id out of range: ', id)) END"
    )
    order = f"shiftleft(CAST(table_rank AS BIGINT), {_RANK_BIT}) | {position} AS place"
    groups = (
        readings.selectExpr("metadata_id", "start_ts", "table_rank", *FIELDS, order)
        .groupBy(*keys)
        .agg(
            F.min("place").alias("first_place"),
            *[F.min_by(f, "place").alias(f) for f in FIELDS],
            F.expr("count_if(table_rank = 0)").alias("n_short"),
            F.expr("count_if(table_rank = 1)").alias("n_long"),
        )
    )
    return groups.selectExpr(
        "metadata_id",
        "start_ts",
        f"CAST(shiftright(first_place, {_RANK_BIT}) AS INT) AS table_rank",
        f"nullif(first_place & {_NO_ID}, {_NO_ID}) AS id",
        *FIELDS,
        "n_short",
        "n_long",
    )


def match_entities(
    readings: DataFrame,
    entities: DataFrame,
    small: bool = False,
    candidates: DataFrame | None = None,
    scope: str = "run",
) -> DataFrame:
    """First readings of the filtered entities with the entity columns attached.

    All readings of a key share the entity, so keys can be de-duplicated before matching.
    When the entity side was measured as small, candidates (any superset of the entity ids)
    thins the readings by a broadcast before the one shuffle, and the match itself is a
    broadcast too. Otherwise the match is a plain equi-join: its readings side starts at its
    own exchange and nothing behind it needs that partitioning, so AQE can split the
    partition of a hot entity."""
    if small and candidates is not None:
        readings = of_entities(readings, candidates, small)
    return attach_entities(first_readings(readings, scope), entities, small)


def attach_entities(first: DataFrame, entities: DataFrame, small: bool = False) -> DataFrame:
    """The entity columns next to the readings; readings of other entities fall away."""
    return first.join(maybe_broadcast(_entity_side(entities), small), "metadata_id")


def _entity_side(entities: DataFrame) -> DataFrame:
    return entities.withColumnRenamed("id", "metadata_id").drop("source")


def match_raw(readings: DataFrame, entities: DataFrame, small: bool = False) -> DataFrame:
    """Every reading with its entity; `matched` is false where no entity survived."""
    side = _entity_side(entities).selectExpr("*", "true AS found")
    joined = readings.join(maybe_broadcast(side, small), "metadata_id", "left")
    return joined.selectExpr("*", "found IS NOT NULL AS matched").drop("found")


def gaps(readings: DataFrame, expected_seconds: int = 3600) -> DataFrame:
    """Per entity: how often and for how long the distance between neighbours exceeds the
    expected interval.

    Neighbours are compared in two levels, so that no task needs a whole entity: inside each
    (entity, day), then between the days of an entity, of which there are few. Copies of a time
    are neighbours without distance, so they need no aggregate of their own. The readings are
    counted first: both exchanges deal them to as many tasks as keeps each small."""
    timed = readings.filter("start_ts IS NOT NULL").select("metadata_id", "start_ts")
    tasks = tasks_for(timed)
    keys = timed.selectExpr("*", "to_date(start_ts) AS day").repartition(tasks, "metadata_id", "day")
    in_day = "lag(start_ts) OVER (PARTITION BY metadata_id, day ORDER BY start_ts)"
    steps = (
        keys.selectExpr("*", f"{in_day} AS earlier")
        .filter("earlier IS NULL OR earlier <> start_ts")
        .selectExpr(
            "metadata_id", "day", "start_ts", f"{seconds_between('earlier', 'start_ts')} AS step"
        )
    )
    wide = f"step > {expected_seconds}"
    days = steps.groupBy("metadata_id", "day").agg(
        F.count("*").alias("n"),
        F.expr(f"count_if({wide})").alias("n_gaps"),
        F.expr(f"max(step) FILTER (WHERE {wide})").alias("longest"),
        F.min("start_ts").alias("first_ts"),
        F.max("start_ts").alias("last_ts"),
    )
    across = "lag(last_ts) OVER (PARTITION BY metadata_id ORDER BY day)"
    bridged = (
        days.repartition(tasks, "metadata_id")
        .selectExpr("*", f"{across} AS earlier")
        .selectExpr("*", f"{seconds_between('earlier', 'first_ts')} AS step")
    )
    return bridged.groupBy("metadata_id").agg(
        F.sum("n").alias("n_readings"),
        F.expr(f"sum(n_gaps) + count_if({wide})").alias("n_gaps"),
        F.expr(f"greatest(max(longest), max(step) FILTER (WHERE {wide}))").alias("longest_gap_s"),
    )
