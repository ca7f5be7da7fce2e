"""A point store: Parquet partitioned by period (day or month of the point time), each file
sorted by series and time, so that ranges prune directories and tags prune row groups.

Writes replace points by (series, ts). New content is written once, by dynamic partition
overwrite: Spark reads the old files of the touched periods, writes beside them, and puts the new
directories in place when all tasks have finished. That last step is not transactional; every
operation can be repeated after a failure, because replacing by key and deleting by predicate give
the same store again.

Beside the points a store may keep two small folders. `changes` queues the hours that writes have
touched, for a rollup that takes up exactly those. `deltas` holds small writes that are not
yet part of the period files: reading merges them by key, the newest write first, and folding puts
them into their periods. Both survive a failure at any point: a change is queued before its points are
written and leaves the queue after they are rolled up, and a delta is removed after it was folded."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions.sql import holds
from meterloom.functions.time import days_before, in_range, ntz
from meterloom.operators.sizing import ROWS_PER_TASK, is_small, maybe_broadcast
from meterloom.operators.timeline import MIGRATED
from meterloom.schemas import POINT, SERIES
from meterloom.sources import files
from meterloom.sources.scratch import discard, scratch

_STORED = T.StructType(POINT.fields + [T.StructField("period", T.DateType(), True)])
_MARK = "until STRING"
_COUNTS = "period DATE, n BIGINT"
_DELTA = T.StructType(_STORED.fields + [T.StructField("seq", T.IntegerType(), True)])
#: A period is not cut into files of fewer points.
ROWS_PER_FILE = 100_000
#: Points of one measurement, domain and hour are rolled up together.
CHANGE = T.StructType(
    [
        T.StructField("measurement", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("hour", T.TimestampNTZType()),
    ]
)
HOUR = "window(ts, '1 hour').start AS hour"
_PERIODS = {"day": "to_date({})", "month": "to_date({}) - (day({}) - 1)"}


def _same_point(left: DataFrame, right: DataFrame) -> Column:
    """Series and time equality where an absent tag equals an absent tag."""
    same = (left["ts"] == right["ts"]) & (left["period"] == right["period"])
    for tag in SERIES:
        same = same & left[tag].eqNullSafe(right[tag])
    return same


@dataclass(frozen=True)
class PointStore:
    """Day periods suit a store that is rolled up and expired by the day; month periods keep
    the directories of a sparse, long history few. With `log_changes`, writes queue the hours they
    touch. With `max_deltas`, `add` writes beside the periods until so many writes are there."""

    spark: SparkSession
    path: str
    period: str = "day"
    retention_days: int = 0
    log_changes: bool = False
    max_deltas: int = 0

    def exists(self) -> bool:
        return files.exists(self.spark, self.path)

    def period_of(self, ts: str) -> str:
        return _PERIODS[self.period].format(ts, ts)

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(_STORED).parquet(self.path)

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Points of a half-open time range; the range also prunes periods."""
        if not self.exists():
            return self.spark.createDataFrame([], POINT)

        def within(rows: DataFrame) -> DataFrame:
            if start is not None:
                rows = rows.filter(f"period >= {self.period_of(ntz(start))}")
            if end is not None:
                rows = rows.filter(f"period <= {self.period_of(ntz(end))}")
            return rows.filter(in_range("ts", start, end))

        rows = within(self._stored())
        if self.delta_parts():
            added = within(self._newest_deltas())
            side = maybe_broadcast(added, is_small(added))
            rows = rows.join(side, _same_point(rows, side), "left_anti").unionByName(added)
        return rows.select(*POINT.names)

    def read_stream(self, max_files: int = 1000) -> DataFrame:
        """The points as a stream: files that appear later are picked up, at most max_files per
        micro-batch. Files are sorted by series, not by time, so a watermark over a store needs a
        delay of at least one period, or points of a file that comes later in the batch order
        fall behind it."""
        files = self.spark.readStream.schema(_STORED).option("maxFilesPerTrigger", max_files)
        return files.parquet(self.path).select(*POINT.names)

    def _write(self, rows: DataFrame, path: str) -> None:
        """Rebalance by period: AQE joins small periods into one task and splits a hot one
        over many."""
        self._write_dealt(rows.hint("rebalance", "period"), path)

    def _write_dealt(self, rows: DataFrame, path: str) -> None:
        (
            rows.sortWithinPartitions("period", *SERIES, "ts")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("period")
            .parquet(path)
        )

    def _changes(self) -> str:
        return f"{self.path.rstrip('/')}.changes"

    def change_parts(self) -> list[str]:
        """The writes in the queue of changed hours."""
        return files.children(self.spark, self._changes())

    def changes(self, parts: list[str]) -> DataFrame:
        """The distinct changed hours of some writes."""
        paths = [f"{self._changes()}/{p}" for p in parts]
        if not paths:
            return self.spark.createDataFrame([], CHANGE)
        return self.spark.read.schema(CHANGE).parquet(*paths).distinct()

    def _queue(self, changed: DataFrame) -> None:
        with scratch(self.spark, "changed") as path:
            changed.write.parquet(path)
            files.make_folder(self.spark, self._changes())
            files.move(self.spark, path, f"{self._changes()}/{uuid.uuid4().hex}")

    def settle_changes(self, parts: list[str], until: str) -> None:
        """Take the hours that end by `until` out of the queue, of the writes that were looked at."""
        later = self.changes(parts).filter(f"hour + INTERVAL 1 HOUR > {ntz(until)}")
        if not later.isEmpty():
            self._queue(later)
        for part in parts:
            discard(self.spark, f"{self._changes()}/{part}")

    def _deltas(self) -> str:
        return f"{self.path.rstrip('/')}.deltas"

    def delta_parts(self) -> list[str]:
        return files.children(self.spark, self._deltas())

    def _newest_deltas(self) -> DataFrame:
        """The points of all deltas, of several writes of a point the last."""
        rows = self.spark.read.schema(_DELTA).parquet(self._deltas())
        newest = rows.groupBy(*SERIES, "ts", "period").agg(F.max_by("value", "seq").alias("value"))
        return newest.select(*_STORED.names)

    def add(self, points: DataFrame) -> None:
        """Upsert by (series, ts), beside the period files as long as deltas are few: the work is in
        proportion to the points, not to the periods that they fall into."""
        if not self.max_deltas or not self.exists():
            self.replace(points)
            return
        if self.log_changes:
            self._log(points)
        parts = self.delta_parts()
        number = int(parts[-1].removeprefix("seq=")) + 1 if parts else 0
        with scratch(self.spark, "delta") as path:
            incoming = points.selectExpr(*POINT.names, f"{self.period_of('ts')} AS period")
            incoming.write.parquet(path)
            files.make_folder(self.spark, self._deltas())
            files.move(self.spark, path, f"{self._deltas()}/seq={number:09d}")
        if len(parts) + 1 > self.max_deltas:
            self.fold()

    def fold(self) -> None:
        """Put the deltas into their periods, each period once. Until they are removed they say the
        same as the periods."""
        parts = self.delta_parts()
        if not parts:
            return
        with scratch(self.spark, "folded") as path:
            self._newest_deltas().write.parquet(path)
            self._merge(self.spark.read.schema(_STORED).parquet(path))
        for part in parts:
            discard(self.spark, f"{self._deltas()}/{part}")

    def _log(self, points: DataFrame) -> None:
        self._queue(points.selectExpr("measurement", "domain", HOUR).distinct())

    def replace(self, points: DataFrame, staged: bool = False) -> None:
        """Upsert by (series, ts). The points must be unique by that key, as exports and rollups
        are. Only periods that receive points are read and rewritten; the first write of a store
        and periods that are new to it meet no stored point. `staged` says that the points are
        read from files already; otherwise they are written aside first, because they are looked
        at twice and may come from this very store."""
        self.fold()
        incoming = points.selectExpr(*POINT.names, f"{self.period_of('ts')} AS period")
        if staged or not self.exists():
            if self.log_changes:
                self._log(points)
            if self.exists():
                self._merge(incoming)
            else:
                self._write(incoming, self.path)
        else:
            with scratch(self.spark, "incoming") as path:
                incoming.write.parquet(path)
                written = self.spark.read.schema(_STORED).parquet(path)
                if self.log_changes:
                    self._log(written)
                self._merge(written)

    def _merge(self, incoming: DataFrame) -> None:
        """One exchange, by period and, where a period has many points, by a hash of the key within
        it. In it stored points meet the incoming ones of their key and give way, and the order that
        this takes is the one of the files."""
        with scratch(self.spark, "touched") as path:
            counts = incoming.groupBy("period").agg(F.count("*").alias("n"))
            counts.write.parquet(path)
            touched = self.spark.read.schema(_COUNTS).parquet(path)
            stored = self._in_periods(self._stored(), touched.select("period"))
            sizes = stored.groupBy("period").agg(F.count("*").alias("n")).unionByName(touched)
            busy = self.spark.sparkContext.defaultParallelism
            rows = sizes.agg(F.sum("n")).first()[0] or 0
            # Small enough for one task, and for all cores to have some.
            most = min(ROWS_PER_TASK, max(ROWS_PER_FILE, rows // busy))
            sizes = sizes.groupBy("period").agg(F.expr(f"CAST(ceil(sum(n) / {most}) AS BIGINT) AS spread"))
            pieces = sizes.agg(F.sum("spread")).first()[0] or 1
            tasks = min(pieces, max(busy, 2 * rows // ROWS_PER_TASK))
            sizes = sizes.select(F.col("period").alias("sized"), "spread").filter("spread > 1")
            # Only periods that are cut have a row there.
            both = stored.withColumn("fresh", F.lit(False)).unionByName(incoming.withColumn("fresh", F.lit(True)))
            sizes = maybe_broadcast(sizes, is_small(touched))
            both = both.join(sizes, F.col("period") == F.col("sized"), "left")
            piece = F.expr(f"pmod(xxhash64({', '.join(SERIES)}, ts), coalesce(spread, 1))")
            dealt = both.withColumn("piece", piece).repartition(tasks, "period", "piece")
            same = Window.partitionBy("period", *SERIES, "ts", "piece")
            newest = dealt.withColumn("replaced", F.max("fresh").over(same)).filter("fresh = replaced")
            self._write_dealt(newest.select(*_STORED.names), self.path)

    def _in_periods(self, rows: DataFrame, periods: DataFrame) -> DataFrame:
        """Periods are few next to points, which is checked; the join then prunes directories."""
        return rows.join(maybe_broadcast(periods, is_small(periods)), "period", "left_semi").select(
            *_STORED.names
        )

    def delete(self, predicate: str = MIGRATED, within: str = "true") -> None:
        """Remove the points that match both conditions; a null outcome keeps the point. All other
        points of a touched period stay. `within` is meant for conditions on the period, which
        narrow the directories looked at."""
        self.fold()
        hit = f"({holds(predicate)} AND {holds(within)})"
        with scratch(self.spark, "touched") as path:
            self._stored().filter(within).filter(hit).select("period").distinct().write.parquet(path)
            touched = self.spark.read.parquet(path)
            self._write(self._in_periods(self._stored(), touched).filter(f"NOT {hit}"), self.path)
            # Periods with nothing left were not overwritten, so they still hold what matched.
            left = self._in_periods(self._stored(), touched).filter(hit)
            self._drop_periods(left.select("period").distinct())

    def expire(self, now: str, not_after: str | None = None) -> None:
        """Apply the retention: whole periods are dropped as directories without being read,
        the period of the limit is rewritten. Zero days keeps everything, and so does a limit
        later than not_after for the points from there on."""
        if self.retention_days == 0 or not self.exists():
            return
        until = days_before(now, self.retention_days)
        if not_after is not None:
            until = str(min(datetime.fromisoformat(until), datetime.fromisoformat(not_after)))
        self.fold()
        limit = ntz(until)
        edge = self.period_of(limit)
        self._drop_periods(self._stored().filter(f"period < {edge}").select("period").distinct())
        self.delete(f"ts < {limit}", within=f"period = {edge}")

    def mark(self) -> str | None:
        """The time noted beside the store, if any: up to where it has been rolled up."""
        if not files.exists(self.spark, self._mark_path):
            return None
        return self.spark.read.schema(_MARK).parquet(self._mark_path).first()["until"]

    def set_mark(self, until: str) -> None:
        row = self.spark.range(1).selectExpr(f"'{until}' AS until").coalesce(1)
        row.write.mode("overwrite").parquet(self._mark_path)

    @property
    def _mark_path(self) -> str:
        return f"{self.path.rstrip('/')}.mark"

    def _drop_periods(self, periods: DataFrame) -> None:
        """Delete period directories, walking a list of directories (not points)."""
        for row in periods.toLocalIterator():
            discard(self.spark, f"{self.path}/period={row.period}")
