"""Export progress: a log of rows per (entity, table), read as the latest row of each, beside a
snapshot that takes the log up, so that it does not grow with the number of runs.

A run writes `running` rows when it starts, `failed` and `completed` rows when it ends early (an
entity is completed in a table once all of its periods are written), and `exported` rows when both
stores are complete. Only the rows of an export that has not ended count for resuming: a finished
export hides nothing from later runs. Marks never pass what is written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.sql import lit
from meterloom.functions.time import ntz
from meterloom.operators.sizing import maybe_broadcast
from meterloom.schemas import LONG_TERM, PROGRESS, SHORT_TERM
from meterloom.sources import files
from meterloom.sources.scratch import discard

RUNNING, COMPLETED, FAILED, EXPORTED = "running", "completed", "failed", "exported"
_LOG, _SNAPSHOT = "log", "snapshot-"
_RANK_OF = f"CASE source_table WHEN {lit(SHORT_TERM)} THEN 0 WHEN {lit(LONG_TERM)} THEN 1 END"
_REST = ("status", "last_start_ts", "export_id", "covered_from", "covered_until")


def record_progress(
    rows: DataFrame,
    path: str,
    recorded_at: str,
    export_id: str | None = None,
    covered_from: str | None = None,
    covered_until: str | None = None,
) -> None:
    """Append rows of (metadata_id, source_table, status, last_start_ts)."""

    def time(value: str | None) -> str:
        return "CAST(NULL AS TIMESTAMP_NTZ)" if value is None else ntz(value)

    stamped = rows.selectExpr(
        "metadata_id",
        "source_table",
        "status",
        "last_start_ts",
        f"{ntz(recorded_at)} AS recorded_at",
        f"CAST({lit(export_id)} AS STRING) AS export_id",
        f"{time(covered_from)} AS covered_from",
        f"{time(covered_until)} AS covered_until",
    )
    stamped.select(*PROGRESS.names).write.mode("append").parquet(f"{path}/{_LOG}")


def _parts(spark: SparkSession, path: str) -> list[str]:
    """The newest snapshot, if any, and the log."""
    names = files.children(spark, path)
    newest = [n for n in names if n.startswith(_SNAPSHOT)][-1:]
    return [f"{path}/{n}" for n in (*newest, *(n for n in names if n == _LOG))]


def has_progress(spark: SparkSession, path: str) -> bool:
    return bool(_parts(spark, path))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return latest_progress(spark.read.schema(PROGRESS).parquet(*_parts(spark, path)))


def compact(spark: SparkSession, path: str) -> None:
    """Take the log up into a new snapshot. The snapshot appears whole; rows that are still in the
    log after a failure in between are read twice, which changes nothing."""
    log = [n for n in files.children(spark, f"{path}/{_LOG}") if n.startswith("part-")]
    old = [n for n in files.children(spark, path) if n.startswith(_SNAPSHOT)]
    number = int(old[-1].removeprefix(_SNAPSHOT)) + 1 if old else 0
    aside = f"{path}/new-{uuid.uuid4().hex}"
    read_progress(spark, path).select(*PROGRESS.names).write.parquet(aside)
    files.move(spark, aside, f"{path}/{_SNAPSHOT}{number:09d}")
    for name in log:
        discard(spark, f"{path}/{_LOG}/{name}")
    for name in old:
        discard(spark, f"{path}/{name}")


def _stage(status: str) -> str:
    """Order of the rows that one run writes at one instant."""
    order = (RUNNING, FAILED, COMPLETED, EXPORTED)
    return f"array_position(array({', '.join(map(lit, order))}), {status})"


def latest_progress(progress: DataFrame) -> DataFrame:
    """The newest row per entity and table; of two rows of one instant, the later stage, then the
    further one."""
    row = f"struct({', '.join((*_REST, 'recorded_at'))})"
    order = f"struct(recorded_at, {_stage('status')} AS stage, last_start_ts)"
    newest = F.expr(f"max_by({row}, {order})").alias("row")
    return (
        progress.groupBy("metadata_id", "source_table")
        .agg(newest)
        .selectExpr("metadata_id", "source_table", "row.status", "row.last_start_ts",
                    "row.recorded_at", "row.export_id", "row.covered_from", "row.covered_until")
    )


def unfinished(progress: DataFrame, export_id: str) -> DataFrame:
    """The rows of one export that has started and not ended."""
    return progress.filter((F.col("export_id") == export_id) & (F.col("status") != EXPORTED))


def completed(progress: DataFrame, tables: tuple[str, ...]) -> DataFrame:
    """Entities finished in all the tables."""
    done = progress.filter((F.col("status") == COMPLETED) & F.col("source_table").isin(*tables))
    return (
        done.groupBy("metadata_id")
        .agg(F.count_distinct("source_table").alias("n"))
        .filter(F.col("n") == len(tables))
        .selectExpr("metadata_id AS id")
    )


def remaining(entities: DataFrame, done: DataFrame) -> DataFrame:
    """Resume: the entities not finished yet."""
    return entities.join(done, "id", "left_anti")


def marks(progress: DataFrame) -> DataFrame:
    """Where incremental exports go on, per entity and table. A time later than its recording
    came from the future and must not hide what arrives until then."""
    return progress.filter("last_start_ts IS NOT NULL").selectExpr(
        "metadata_id",
        "source_table",
        "least(last_start_ts, recorded_at) AS last_start_ts",
    )


def marks_of(entities: DataFrame, progress: DataFrame | None) -> DataFrame:
    """id, source_table, table_rank and last_start_ts, the mark (null without one), for every one
    of the entities and both tables."""
    tables = f"explode(array({lit(SHORT_TERM)}, {lit(LONG_TERM)})) AS source_table"
    both = entities.selectExpr("id", tables).selectExpr("*", f"{_RANK_OF} AS table_rank")
    if progress is None:
        return both.selectExpr("*", "CAST(NULL AS TIMESTAMP_NTZ) AS last_start_ts")
    known = marks(progress).withColumnRenamed("metadata_id", "id")
    return both.join(known, ["id", "source_table"], "left")


def newer_than_progress(
    readings: DataFrame, progress: DataFrame, small: bool = False
) -> DataFrame:
    """Incremental export: readings after the last exported time of their entity and table;
    an entity without progress contributes all of its readings."""
    last = marks(progress).selectExpr("metadata_id", f"{_RANK_OF} AS table_rank", "last_start_ts")
    joined = readings.join(maybe_broadcast(last, small), ["metadata_id", "table_rank"], "left")
    return joined.filter("last_start_ts IS NULL OR start_ts > last_start_ts").drop("last_start_ts")
