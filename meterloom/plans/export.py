"""The export job: metadata to points in the two stores."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.sql import lit
from meterloom.functions.time import floor_second, in_range, ntz
from meterloom.operators import entities as ent
from meterloom.operators import metadata as md
from meterloom.operators import points as pt
from meterloom.operators import quality as qa
from meterloom.operators import readings as rd
from meterloom.operators.sizing import is_small
from meterloom.operators.timeline import newest_per_point
from meterloom.plans.fresh import fresh_readings
from meterloom.rules import EntityRules, QualityRules
from meterloom.schemas import LONG_TERM, SHORT_TERM
from meterloom.sources import progress as pg
from meterloom.sources.run_journal import RunJournal, Step, steps_of
from meterloom.sources.scratch import scratch
from meterloom.sources.store import PointStore
from meterloom.sources.tables import Inputs


@dataclass(frozen=True)
class ExportOptions:
    latest_metadata_only: bool = True
    name_filter: str | None = None
    categories: tuple[str, ...] = ()
    validate: bool = True
    dry_run: bool = False
    # Only readings after the recorded progress, instead of skipping finished entities.
    incremental: bool = False
    measurement: str | None = None
    dedup_scope: str = "run"
    start: str | None = None
    end: str | None = None
    # Store periods are written in steps of so many readings; each is noted once it is written.
    rows_per_step: int = 200_000_000
    entity_rules: EntityRules = EntityRules()
    quality_rules: QualityRules = QualityRules()


def select_entities(inputs: Inputs, options: ExportOptions) -> DataFrame:
    """The entities to export, with point tags and value limits attached."""
    load = md.enriched_latest if options.latest_metadata_only else md.enriched
    few = inputs.attributes is not None and is_small(inputs.attributes[0])
    chosen = ent.filter_entities(
        load(inputs.statistics_meta, inputs.attributes, few), options.entity_rules
    )
    if options.categories:
        chosen = ent.of_categories(chosen, options.categories)
    if options.name_filter:
        chosen = ent.named_like(chosen, options.name_filter)
    return qa.with_limits(pt.with_tags(chosen, options.measurement), options.quality_rules)


def judged_readings(
    readings: DataFrame,
    entities: DataFrame,
    options: ExportOptions = ExportOptions(),
    small: bool = False,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """Readings in range, first per key, matched to their entities and validated. (A range given
    to tables.open_inputs reaches the scan as well; the one here works on any frame.) Candidates
    and small are those of readings.match_entities."""
    wanted = rd.between(readings, options.start, options.end)
    if small and candidates is not None:
        wanted = rd.of_entities(wanted, candidates, small)
    first = rd.first_readings(wanted, options.dedup_scope)
    if not options.validate:
        return qa.unvalidated(rd.attach_entities(first, entities, small))
    screened = qa.screen(first, options.quality_rules)
    return qa.judge(rd.attach_entities(screened, entities, small))


def export_key(options: ExportOptions) -> str:
    """What tells exports apart: a run resumes only an unfinished run with equal options."""
    return hashlib.sha256(repr(options).encode()).hexdigest()[:16]


# What is staged of a judged reading: its point, and what the marks need.
_STAGED = (
    "metadata_id", "start_ts", "time_ok", "n_short", "n_long", "table_rank", "value", "mean",
    "measurement", "entity_id", "domain", "category", "unit", "friendly_name", "device_class",
)


#: More microseconds than lie between any two times.
_RANK_SPAN = f"{1 << 60}L"


@dataclass(frozen=True)
class _Run:
    """One export: what it reads, where it writes, what it notes."""

    spark: SparkSession
    inputs: Inputs
    recent: PointStore
    historical: PointStore
    options: ExportOptions
    journal: RunJournal
    progress_path: str | None
    recorded_at: str | None
    key: str

    def targets(self) -> tuple[tuple[PointStore, str, int], ...]:
        return (self.recent, SHORT_TERM, 0), (self.historical, LONG_TERM, 1)

    def progress(self) -> DataFrame | None:
        """Recorded progress, or None before the first run."""
        path = self.progress_path
        if path is None or not pg.has_progress(self.spark, path):
            return None
        return pg.read_progress(self.spark, path)

    def judged(self) -> DataFrame:
        """The judged readings of the run. The entity table is written once and read back: it is
        used twice, and its row count decides whether it may be broadcast."""
        options, progress = self.options, self.progress()
        select_entities(self.inputs, options).write.parquet(self.journal.entities_at)
        entities = self.spark.read.parquet(self.journal.entities_at)
        small = is_small(entities)
        if progress is not None and options.incremental:
            marks_at = f"{self.journal.path}/marks"
            pg.marks_of(entities.select("id"), progress).write.parquet(marks_at)
            marks = self.spark.read.parquet(marks_at)
            readings = fresh_readings(self.inputs, marks, options.start, options.end)
        else:
            readings = self.inputs.readings(options.start, options.end)
        return qa.with_point_flag(
            judged_readings(readings, entities, options, small, entities if small else None)
        )

    def stage(self) -> None:
        """Write the judged readings of both tables in one pass, in time order within each file, so
        that a step reads little but its own; then the plan, with the counters of the run. These
        are observed in the last stage, whose finished tasks are counted once even when executors
        are lost."""
        self.journal.clear()
        seen = Observation()
        staged = _counted(self.judged(), seen).select(*_STAGED)
        # Table and time in one number, which is sorted without comparing rows; no time comes first.
        place = f"try_add({_RANK_SPAN} * table_rank, unix_micros(CAST(start_ts AS TIMESTAMP)))"
        staged.sortWithinPartitions(F.expr(place)).write.parquet(self.journal.staged_at)
        counters = {name: int(value) for name, value in seen.get.items()}
        counters["entities_processed"] = self.spark.read.parquet(self.journal.entities_at).count()
        written = self.spark.read.schema(staged.schema).parquet(self.journal.staged_at)
        steps = []
        for store, table, rank in self.targets():
            period = f"CAST({store.period_of('start_ts')} AS STRING) AS first"
            sizes = written.filter(f"table_rank = {rank} AND time_ok").selectExpr(period)
            found = sizes.groupBy("first").count().collect()  # one row per period
            sizes = [(r["first"], r["count"]) for r in found]
            steps += steps_of(table, sizes, self.options.rows_per_step)
        self.journal.plan(steps, counters, staged.schema)

    def write(self) -> dict[str, int]:
        """Write the steps of the plan that are not written yet, and note how far the run came."""
        journal = self.journal
        staged, steps, counters = journal.staged(), journal.steps(), journal.counters()
        done = journal.written()
        self.note_running()
        try:
            for number, step in enumerate(steps):
                if number in done:
                    continue
                store, _, rank = next(t for t in self.targets() if t[1] == step.table)
                own = staged.filter(f"table_rank = {rank} AND {in_range('start_ts', step.start, step.end)}")
                points = pt.build_points(own, keep=("start_ts",))
                if counters["between_seconds"]:
                    # Only readings between whole seconds can meet in one point; the later one stays.
                    points = newest_per_point(points, "start_ts")
                store.replace(points, staged=True)
                journal.note_written(number)
        finally:
            self.settle(staged, steps, journal.written())
        return counters

    def _record(self, rows: DataFrame) -> None:
        options = self.options
        pg.record_progress(
            rows, self.progress_path, self.recorded_at, self.key, options.start, options.end
        )

    def note_running(self) -> None:
        if self.progress_path is not None:
            entities = self.spark.read.parquet(self.journal.entities_at).select("id")
            known = pg.marks_of(entities, self.progress()).withColumnRenamed("id", "metadata_id")
            self._record(known.withColumn("status", F.lit(pg.RUNNING)))

    def settle(self, staged: DataFrame, steps: list[Step], written: set[int]) -> None:
        """Note the state of every entity and table. An entity whose readings are all written is
        completed in the table, others failed; marks move as far as readings are written, and only
        where nothing before them was cut off by the start of the run."""
        if self.progress_path is None:
            return
        ended = len(written) == len(steps)
        entities = self.spark.read.parquet(self.journal.entities_at).select("id")
        known = pg.marks_of(entities, self.progress()).withColumnRenamed("id", "metadata_id")
        found = None
        for _, table, _ in self.targets():
            left = [s for n, s in enumerate(steps) if s.table == table and n not in written]
            until = in_range("start_ts", None, left[0].start) if left else "true"
            if left and left[0].start is None:
                until = "false"
            copies = "n_short" if table == SHORT_TERM else "n_long"
            counts = f"time_ok AND {copies} > 0"
            rows = staged.groupBy("metadata_id").agg(
                F.expr(f"max(start_ts) FILTER (WHERE {counts} AND {until})").alias("reached"),
                F.expr(f"count_if({counts} AND NOT ({until}))").alias("n_left"),
            )
            rows = rows.withColumn("source_table", F.lit(table))
            found = rows if found is None else found.unionByName(rows)
        start = self.options.start
        whole = "true" if start is None else f"last_start_ts >= {ntz(start)}"
        open_state = f"CASE WHEN coalesce(n_left, 0) = 0 THEN {lit(pg.COMPLETED)} ELSE {lit(pg.FAILED)} END"
        rows = known.join(found, ["metadata_id", "source_table"], "left").selectExpr(
            "metadata_id",
            "source_table",
            f"{lit(pg.EXPORTED) if ended else open_state} AS status",
            f"CASE WHEN {whole} THEN greatest(last_start_ts, reached) ELSE last_start_ts END AS last_start_ts",
        )
        self._record(rows)
        if ended:
            pg.compact(self.spark, self.progress_path)

    def run(self) -> dict[str, int]:
        if not self.journal.is_planned():
            self.stage()
        counters = self.write()
        self.journal.clear()
        return counters


def _counted(judged: DataFrame, seen: Observation) -> DataFrame:
    return judged.observe(
        seen,
        F.coalesce(F.sum("n_short"), F.lit(0)).alias("short_term_records"),
        F.coalesce(F.sum("n_long"), F.lit(0)).alias("long_term_records"),
        F.expr("count_if(status <> 'invalid')").alias("valid_records"),
        F.expr("count_if(status = 'corrected')").alias("data_corrections"),
        F.expr("count_if(has_point)").alias("total_points"),
        F.expr(f"count_if(start_ts <> {floor_second('start_ts')})").alias("between_seconds"),
    )


def run_export(
    spark: SparkSession,
    inputs: Inputs,
    recent: PointStore,
    historical: PointStore,
    options: ExportOptions = ExportOptions(),
    progress_path: str | None = None,
    recorded_at: str | None = None,
    export_id: str | None = None,
) -> dict[str, int]:
    """Export both tables and return the counters of the run.

    Judged readings of both tables are staged in one pass and written in steps of whole store
    periods, each noted when it is written. With a progress path (and the time of recording), a run
    that died is taken up by a run with equal options: it writes the steps that are left, from the
    readings that were staged, and returns the counters of that staging. What has arrived since is
    not part of it; an incremental run goes on with that, other runs leave it to the next. Once a run
    ends, later runs see everything again; an incremental one goes on at the marks. Marks never pass
    what is written, and stay where a run is cut off at the start."""
    if progress_path is not None and recorded_at is None:
        raise ValueError("progress needs the time of recording")
    key = export_id or export_key(options)
    with scratch(spark, "export") as own:
        kept = progress_path is not None and not options.dry_run
        journal = RunJournal(spark, f"{progress_path}/runs/{key}" if kept else own)
        run = _Run(
            spark, inputs, recent, historical, options, journal, progress_path, recorded_at, key
        )
        if options.dry_run:
            seen = Observation()
            _counted(run.judged(), seen).write.format("noop").mode("overwrite").save()
            counters = {name: int(value) for name, value in seen.get.items()}
            counters["entities_processed"] = spark.read.parquet(journal.entities_at).count()
        else:
            resumed = journal.is_planned()
            counters = run.run()
            if resumed and options.incremental:
                more = run.run()
                counters = {c: n + more[c] for c, n in counters.items()}
                counters["entities_processed"] = more["entities_processed"]
    del counters["between_seconds"]
    counters["total_records"] = counters["short_term_records"] + counters["long_term_records"]
    counters["data_quality_issues"] = counters["total_records"] - counters["valid_records"]
    return counters
