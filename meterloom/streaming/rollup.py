"""The rollup and the de-duplication as Structured Streaming jobs.

The batch form is the reference: it ages points by the clock. A watermark ages them by the
largest event time seen, so the streaming form agrees on every hour (or key) the watermark has
closed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.operators.readings import first_readings
from meterloom.operators.rollup import RULES, rollup
from meterloom.rules import RollupRules
from meterloom.sources.store import PointStore


def _event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need a session-zoned timestamp; with the session in UTC it holds the same
    instant as the timestamp_ntz."""
    if stream.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        raise ValueError("set spark.sql.session.timeZone to UTC for streaming")
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def first_readings_stream(readings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The first reading per (metadata_id, start_ts) of a stream of both tables, by the rule of the
    batch form: short-term before long-term, then the lowest id, whatever the order of arrival.

    The state holds one row per open key, the lowest so far; a key is emitted once the watermark
    has closed it (its time lies the delay behind the latest one), and readings that come later are
    dropped. Readings without a time belong to no key and are left out."""
    timed = _event_time(readings.filter("start_ts IS NOT NULL"), "start_ts", delay)
    first = first_readings(timed)
    return first.withColumn("start_ts", F.col("start_ts").cast("timestamp_ntz"))


def rollup_stream(points: DataFrame, delay: str = "30 days", rules: RollupRules = RULES) -> DataFrame:
    """The batch rollup over a stream of points; an hour is emitted once the watermark passes
    it, and points older than the watermark are dropped."""
    hours = rollup(_event_time(points, "ts", delay), rules)
    return hours.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything available, append closed hours as files, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_to_store(stream: DataFrame, store: PointStore, checkpoint: str) -> None:
    """Process everything available into a point store. Each batch replaces by key, so a batch
    that is run again after a failure leaves the store unchanged."""

    def put(batch: DataFrame, batch_id: int) -> None:
        store.replace(batch)

    query = (
        stream.writeStream.foreachBatch(put)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
