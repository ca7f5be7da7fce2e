"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.numeric import finite_or_null, is_infinite
from meterloom.functions.sql import lit
from meterloom.functions.time import seconds_between
from meterloom.operators import entities as ent
from meterloom.operators import metadata as md
from meterloom.operators import points as pt
from meterloom.operators import profile as pf
from meterloom.operators import quality as qa
from meterloom.operators import readings as rd
from meterloom.operators import rollup as ro
from meterloom.operators import timeline as tl
from meterloom.operators.sizing import is_small
from meterloom.plans.export import ExportOptions, judged_readings, run_export
from meterloom.plans.fresh import fresh_readings
from meterloom.plans.lifecycle import maintain, roll_up_slice
from meterloom.schemas import FIELDS, LONG_TERM, SERIES, SHORT_TERM
from meterloom.sources import driver_tables as dt
from meterloom.sources import progress as pg
from meterloom.sources.scratch import scratch_path
from meterloom.sources.store import PointStore
from meterloom.sources.tables import Inputs, basic_metadata, open_inputs
from meterloom.streaming import rollup as st

# Fixed "now" of relative ranges, so that every run gives the same rows.
NOW_PREVIEW = "2024-01-31 00:00:00"
NOW_ROLLUP = "2024-02-15 00:00:00"
NOW_RETENTION = "2024-04-10 00:00:00"


class Sensors:
    """The driver tables as sensor frames; nothing is computed until a query needs it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def statistics_meta(self) -> DataFrame:
        return dt.statistics_meta(self.spark, self.sf_dir)

    @cached_property
    def attributes(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return dt.attribute_tables(self.spark, self.sf_dir)

    @cached_property
    def small(self) -> bool:
        """Filtering only removes entities and each is listed once, so the metadata row count
        bounds the entity side."""
        return is_small(self.statistics_meta)

    @cached_property
    def meta(self) -> DataFrame:
        return basic_metadata(self.statistics_meta)

    @cached_property
    def short_term(self) -> DataFrame:
        return dt.short_term(self.spark, self.sf_dir)

    @cached_property
    def long_term(self) -> DataFrame:
        return dt.long_term(self.spark, self.sf_dir)

    @cached_property
    def readings(self) -> DataFrame:
        return rd.both_tables(self.short_term, self.long_term)

    def readings_in(self, start: str, end: str) -> DataFrame:
        """Both tables within a range that reaches their scans."""
        return dt.inputs(self.spark, self.sf_dir).readings(start, end)

    @cached_property
    def candidates(self) -> DataFrame:
        """Entities by name, unit and source alone: a superset of the enriched ones."""
        return ent.filter_entities(self.meta)

    @cached_property
    def entities(self) -> DataFrame:
        return qa.with_limits(self.candidates)

    @cached_property
    def enriched_entities(self) -> DataFrame:
        rich = md.enriched(self.statistics_meta, self.attributes, self.small)
        return qa.with_limits(pt.with_tags(ent.filter_entities(rich)))

    def judged(self, readings: DataFrame, options: ExportOptions = ExportOptions()) -> DataFrame:
        return judged_readings(readings, self.entities, options, self.small, self.candidates)

    def points(
        self,
        readings: DataFrame | None = None,
        options: ExportOptions = ExportOptions(),
        entities: DataFrame | None = None,
    ) -> DataFrame:
        judged = judged_readings(
            self.readings if readings is None else readings,
            self.enriched_entities if entities is None else entities,
            options,
            self.small,
            self.candidates,
        )
        return pt.build_points(judged)

    def recent(self) -> DataFrame:
        """Short-term readings win every key they take part in, so their points need no look
        at the long-term table."""
        return pt.for_store(self.points(self.short_term), pt.RECENT)

    def historical(self) -> DataFrame:
        return pt.for_store(self.points(), pt.HISTORICAL)

    def progress(self) -> DataFrame:
        """Progress rows derived from the events: the state of a run ten days in."""
        seen = dt.table(self.spark, self.sf_dir, "events").groupBy("user_id").agg(
            F.min("ts").alias("first_ts")
        )
        return seen.selectExpr(
            "user_id AS metadata_id",
            f"explode(array({lit(SHORT_TERM)}, {lit(LONG_TERM)})) AS source_table",
            """CASE WHEN user_id % 3 = 0 THEN 'completed'
                    WHEN user_id % 3 = 1 AND user_id % 7 = 0 THEN 'failed'
                    ELSE 'running' END AS status""",
            "first_ts + INTERVAL 10 DAYS AS last_start_ts",
            "TIMESTAMP_NTZ '2024-01-20 00:00:00' AS recorded_at",
        )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums and means depend on the order of addition; reports round them."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


QUERIES: dict[str, Callable[[Sensors], DataFrame]] = {}


def _query(fn: Callable[[Sensors], DataFrame]) -> Callable[[Sensors], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# --- metadata -------------------------------------------------------------------------------


@_query
def entity_metadata_basic(s: Sensors) -> DataFrame:
    return md.without_attributes(s.statistics_meta)


@_query
def entity_metadata_enriched(s: Sensors) -> DataFrame:
    return md.enriched(s.statistics_meta, s.attributes, s.small)


@_query
def entity_metadata_latest(s: Sensors) -> DataFrame:
    rows = md.enriched_latest(s.statistics_meta, s.attributes, s.small)
    return rows.orderBy("statistic_id")


@_query
def latest_attribute_ids(s: Sensors) -> DataFrame:
    return md.latest_attributes(s.attributes[1])


@_query
def attribute_lookup(s: Sensors) -> DataFrame:
    return md.attributes_of(s.candidates, s.attributes, s.small)


@_query
def metadata_by_ids(s: Sensors) -> DataFrame:
    return md.by_ids(s.statistics_meta, s.short_term.select("metadata_id"), "metadata_id")


@_query
def attribute_health(s: Sensors) -> DataFrame:
    return md.malformed_attributes(s.attributes[2])


# --- entities -------------------------------------------------------------------------------


@_query
def entity_categories(s: Sensors) -> DataFrame:
    return ent.categorise(s.meta).select(
        "id", "statistic_id", "category", "aggregation_method", "aggregation_window"
    )


@_query
def entity_inclusion(s: Sensors) -> DataFrame:
    return ent.decide(s.meta).select("id", "statistic_id", "category", "included", "reason")


@_query
def entity_ids(s: Sensors) -> DataFrame:
    return ent.entity_ids(s.candidates)


@_query
def entity_filter_summary(s: Sensors) -> DataFrame:
    return _rounded(ent.filter_summary(ent.decide(s.meta)), "inclusion_rate")


@_query
def entity_category_breakdown(s: Sensors) -> DataFrame:
    return ent.category_breakdown(ent.decide(s.meta))


@_query
def entity_category_groups(s: Sensors) -> DataFrame:
    return ent.by_category(s.candidates)


@_query
def entity_category_samples(s: Sensors) -> DataFrame:
    return ent.category_samples(s.candidates)


@_query
def entity_name_filter(s: Sensors) -> DataFrame:
    return ent.named_like(s.candidates, "RING").select("id", "statistic_id", "category")


@_query
def unit_breakdown(s: Sensors) -> DataFrame:
    return ent.unit_breakdown(s.meta)


@_query
def entity_summary(s: Sensors) -> DataFrame:
    return ent.entity_summary(s.meta, s.short_term, s.long_term)


# --- readings -------------------------------------------------------------------------------

_READING = ("id", "metadata_id", "start_ts", "table_rank", *FIELDS)


def _finite(df: DataFrame) -> DataFrame:
    """NaN and infinities as text-free codes: a value column, and a note next to it."""
    return df.selectExpr(
        *[c for c in df.columns if c != "value"],
        f"{finite_or_null('value')} AS value",
        f"CASE WHEN isnan(value) THEN 'nan' WHEN {is_infinite('value')} THEN 'inf' END AS value_note",
    )


@_query
def readings_short_term(s: Sensors) -> DataFrame:
    return _finite(s.short_term.select(*_READING))


@_query
def readings_range(s: Sensors) -> DataFrame:
    rows = s.readings_in("2024-01-10 00:00:00", "2024-01-20 00:00:00")
    chosen = rd.of_entities(rows, s.candidates, s.small)
    return rd.in_order(_finite(chosen.select(*_READING)))


@_query
def readings_epoch_scan(s: Sensors) -> DataFrame:
    """The same readings as a source stores them, with float epoch seconds, through the input
    contract and a range that is pushed to the raw column."""

    def stored(table: DataFrame) -> DataFrame:
        epoch = seconds_between("TIMESTAMP_NTZ '1970-01-01 00:00:00'", "start_ts")
        return table.selectExpr(
            "id", "created_ts", "metadata_id", f"CAST({epoch} AS DOUBLE) AS start_ts", "mean",
            "mean_weight", "min_value AS min", "max_value AS max", "last_reset_ts",
            "value AS state", "sum_value AS sum",
        )

    available = {
        "statistics_meta": lambda: s.statistics_meta,
        SHORT_TERM: lambda: stored(s.short_term),
        LONG_TERM: lambda: stored(s.long_term),
    }
    inputs = open_inputs(available, start="2024-01-05 00:00:00")
    return _finite(inputs.readings(end="2024-01-25 00:00:00").select(*_READING))


@_query
def readings_count(s: Sensors) -> DataFrame:
    everything = rd.count_by_table(s.readings).withColumn("scope", F.lit("all"))
    chosen = rd.of_entities(s.readings, s.candidates, s.small)
    return everything.unionByName(
        rd.count_by_table(chosen).withColumn("scope", F.lit("filtered entities"))
    )


@_query
def readings_time_range(s: Sensors) -> DataFrame:
    return rd.time_range(s.readings)


@_query
def readings_dedup(s: Sensors) -> DataFrame:
    matched = rd.match_entities(s.readings, s.entities, s.small, s.candidates)
    return matched.select("metadata_id", "start_ts", "table_rank", "id", "n_short", "n_long")


@_query
def readings_dedup_per_table(s: Sensors) -> DataFrame:
    matched = rd.match_entities(s.readings, s.entities, s.small, s.candidates, scope="table")
    return matched.select("metadata_id", "start_ts", "table_rank", "id", "n_short", "n_long")


@_query
def gap_report(s: Sensors) -> DataFrame:
    return rd.gaps(s.readings, expected_seconds=86400)


# --- quality --------------------------------------------------------------------------------


@_query
def readings_validated(s: Sensors) -> DataFrame:
    return s.judged(s.readings).select(
        "metadata_id", "start_ts", "table_rank", "id", *FIELDS,
        "status", "invalid_reason", "n_issues", "n_corrected", "n_nulled",
    )


@_query
def processing_metrics(s: Sensors) -> DataFrame:
    judged = qa.judge_all(rd.first_readings(s.readings), s.entities, s.small)
    return _rounded(qa.processing_metrics(judged), "success_rate")


@_query
def issue_details(s: Sensors) -> DataFrame:
    """Numbers inside the message are masked: engines write floats differently."""
    rows = qa.issues(s.judged(s.readings))
    value = F.regexp_replace("message", r"^Value \S+ (below|above)", "Value # $1")
    message = F.regexp_replace(value, r"(minimum|maximum) \S+ for", "$1 # for")
    return rows.select(
        "metadata_id", "start_ts", "field", "code", "issue_category", "limit_value",
        message.alias("message"),
    )


@_query
def issue_breakdown(s: Sensors) -> DataFrame:
    return qa.issue_totals(s.judged(s.readings))


@_query
def issue_entity_samples(s: Sensors) -> DataFrame:
    return qa.issue_entity_samples(qa.issues(s.judged(s.readings)))


def _raw_issues(s: Sensors, readings: DataFrame) -> DataFrame:
    return qa.raw_issues(rd.match_raw(readings, s.candidates, s.small))


def _sample_report(s: Sensors, n: int | None, chosen_first: bool) -> DataFrame:
    """The issue report per table over all readings, or over the first n, cut after or before the
    readings of the chosen entities are picked."""
    tables = [s.short_term, s.long_term]
    if chosen_first:
        tables = [rd.of_entities(t, s.candidates, s.small) for t in tables]
    short, long = (qa.reading_sample(t, n) for t in tables)
    issues = _raw_issues(s, short.unionByName(long))
    return qa.issue_breakdown(issues, "table_rank", "issue_type")


@_query
def issue_sample(s: Sensors) -> DataFrame:
    """Over all readings of the chosen entities."""
    return _sample_report(s, None, chosen_first=True)


@_query
def issue_sample_unfiltered(s: Sensors) -> DataFrame:
    """Over all readings; the chosen entities are picked with the issues."""
    return _sample_report(s, None, chosen_first=False)


@_query
def issue_sample_first_5000(s: Sensors) -> DataFrame:
    """Sampled per table as the source's report does: the first readings of chosen entities."""
    return _sample_report(s, 5000, chosen_first=True)


@_query
def issue_sample_unfiltered_first_5000(s: Sensors) -> DataFrame:
    """The same report for a long id list, where the sample is cut before the filter."""
    return _sample_report(s, 5000, chosen_first=False)


@_query
def validation_report(s: Sensors) -> DataFrame:
    return qa.issue_breakdown(_raw_issues(s, s.readings), "table_rank", "issue_type")


@_query
def validation_overview(s: Sensors) -> DataFrame:
    return qa.scan_overview(rd.match_raw(s.readings, s.candidates, s.small))


@_query
def validation_samples(s: Sensors) -> DataFrame:
    return qa.issue_entity_samples(_raw_issues(s, s.readings), category="issue_type")


@_query
def worst_offenders(s: Sensors) -> DataFrame:
    return qa.worst_entities(_raw_issues(s, s.readings))


@_query
def worst_offender_examples(s: Sensors) -> DataFrame:
    rows = qa.worst_examples(_raw_issues(s, s.readings))
    return rows.selectExpr(
        "table_rank", "statistic_id", "position", "start_ts", "field", "issue_type",
        f"{finite_or_null('raw_value')} AS raw_value",
    )


@_query
def unusual_values(s: Sensors) -> DataFrame:
    rows = qa.unusual_values(rd.match_raw(s.readings, s.candidates, s.small))
    return rows.selectExpr(
        "table_rank", "metadata_id", "start_ts", "id", "field",
        f"{finite_or_null('raw_value')} AS raw_value",
        f"{is_infinite('raw_value')} AS is_infinite",
    )


# --- points and export ----------------------------------------------------------------------


@_query
def points_recent(s: Sensors) -> DataFrame:
    return s.recent()


@_query
def points_historical(s: Sensors) -> DataFrame:
    return s.historical()


@_query
def points_skipped(s: Sensors) -> DataFrame:
    return pt.point_counts(rd.match_raw(s.readings, s.candidates, s.small))


@_query
def points_named(s: Sensors) -> DataFrame:
    """The measurement override."""
    rich = ent.filter_entities(md.enriched(s.statistics_meta, s.attributes, s.small))
    entities = qa.with_limits(pt.with_tags(rich, measurement="sensor_data"))
    named = s.points(s.short_term, entities=entities)
    return named.groupBy("measurement", "unit").agg(F.count("*").alias("n_points"))


@_query
def category_export(s: Sensors) -> DataFrame:
    chosen = ent.of_categories(s.enriched_entities, ("energy", "power"))
    return pt.for_store(s.points(entities=chosen), pt.HISTORICAL)


@_query
def export_unvalidated(s: Sensors) -> DataFrame:
    points = s.points(options=ExportOptions(validate=False))
    return points.select("store", "measurement", "domain", "entity_id", "value", "ts")


@_query
def time_range_export(s: Sensors) -> DataFrame:
    options = ExportOptions(start="2024-01-10 00:00:00", end="2024-01-20 00:00:00")
    points = s.points(s.readings_in(options.start, options.end), options)
    return points.select("store", "measurement", "domain", "entity_id", "value", "ts")


@_query
def export_summary(s: Sensors) -> DataFrame:
    """Also the dry run: everything is judged, nothing is written."""
    return _rounded(qa.run_summary(s.judged(s.readings)), "success_rate")


@_query
def resume_remaining(s: Sensors) -> DataFrame:
    done = pg.completed(s.progress(), (SHORT_TERM, LONG_TERM))
    return pg.remaining(s.candidates, done).select("id", "statistic_id", "category")


@_query
def progress_table(s: Sensors) -> DataFrame:
    """Two recorded runs, read back as the latest row per entity and table."""
    path = scratch_path(s.spark, "progress")
    first = s.progress()
    pg.record_progress(first, path, "2024-01-11 00:00:00")
    later = first.filter(F.col("status") == "running").withColumn("status", F.lit("completed"))
    pg.record_progress(later, path, "2024-01-12 00:00:00")
    return pg.read_progress(s.spark, path).select(
        "metadata_id", "source_table", "status", "last_start_ts", "recorded_at"
    )


@_query
def export_resumed(s: Sensors) -> DataFrame:
    """A run over a range, then a full run with the same progress table, read back."""
    recent = PointStore(s.spark, scratch_path(s.spark, "recent"))
    historical = PointStore(s.spark, scratch_path(s.spark, "historical"), "month")
    inputs, path = dt.inputs(s.spark, s.sf_dir), scratch_path(s.spark, "progress")
    part = ExportOptions(latest_metadata_only=False, end="2024-01-15 00:00:00")
    run_export(s.spark, inputs, recent, historical, part, path, "2024-01-15 00:00:00")
    full = ExportOptions(latest_metadata_only=False)
    run_export(s.spark, inputs, recent, historical, full, path, "2024-02-01 00:00:00")
    return _both(recent, historical)


@_query
def incremental_export(s: Sensors) -> DataFrame:
    progress = s.progress()
    fresh = pg.newer_than_progress(s.readings, progress, is_small(progress))
    points = s.points(readings=fresh)
    return points.select("store", "measurement", "domain", "entity_id", "value", "ts")


class _Dying(PointStore):
    """A store whose writes fail from the n-th on, as when a run is killed."""

    def after(self, n: int) -> _Dying:
        object.__setattr__(self, "left", [None] * n)
        return self

    def replace(self, points: DataFrame, staged: bool = False) -> None:
        if not self.left:
            raise InterruptedError("killed")
        self.left.pop()
        super().replace(points, staged)


def _run_until_killed(s: Sensors, stores, options: ExportOptions, inputs: Inputs, path: str) -> None:
    try:
        run_export(s.spark, inputs, *stores, options, path, "2024-02-01 00:00:00")
    except InterruptedError:
        return
    raise AssertionError("the run was not killed")


def _early(inputs: Inputs, until: str) -> Inputs:
    """The inputs as they were before later readings arrived."""
    return replace(inputs, scan=lambda table, start, end: inputs.scan(table, start, min(end or until, until)))


@_query
def export_resumed_incremental(s: Sensors) -> DataFrame:
    """An incremental run dies after the recent store; readings arrive; the same run is repeated. It
    ends what was staged, goes on with what arrived, and no reading is lost or hidden."""
    recent = PointStore(s.spark, scratch_path(s.spark, "recent"))
    historical = PointStore(s.spark, scratch_path(s.spark, "historical"), "month")
    inputs, path = dt.inputs(s.spark, s.sf_dir), scratch_path(s.spark, "progress")
    options = ExportOptions(latest_metadata_only=False, incremental=True)
    dying = _Dying(s.spark, historical.path, "month").after(0)
    _run_until_killed(s, (recent, dying), options, _early(inputs, "2024-01-10 00:00:00"), path)
    run_export(s.spark, inputs, recent, historical, options, path, "2024-02-02 00:00:00")
    return _both(recent, historical)


def _killed_in_the_third_step(s: Sensors) -> tuple[PointStore, PointStore, str]:
    recent = _Dying(s.spark, scratch_path(s.spark, "recent")).after(2)
    historical = PointStore(s.spark, scratch_path(s.spark, "historical"), "month")
    path = scratch_path(s.spark, "progress")
    options = ExportOptions(latest_metadata_only=False, rows_per_step=1)
    _run_until_killed(s, (recent, historical), options, dt.inputs(s.spark, s.sf_dir), path)
    return recent, historical, path


@_query
def export_killed_points(s: Sensors) -> DataFrame:
    """A run in steps of one day, killed in the third: two days are in the store."""
    recent, historical, _ = _killed_in_the_third_step(s)
    return _both(recent, historical)


@_query
def export_killed_progress(s: Sensors) -> DataFrame:
    """The progress of that run: marks end with the second day, entities with later readings have
    failed, the others are completed."""
    _, _, path = _killed_in_the_third_step(s)
    return pg.read_progress(s.spark, path).select(
        "metadata_id", "source_table", "status", "last_start_ts"
    )


@_query
def incremental_scans(s: Sensors) -> DataFrame:
    """The readings that an incremental run takes up, from one bounded scan per group of marks."""
    path = scratch_path(s.spark, "marks")
    pg.marks_of(s.candidates.select("id"), s.progress()).write.parquet(path)
    fresh = fresh_readings(dt.inputs(s.spark, s.sf_dir), s.spark.read.parquet(path))
    return fresh.select("table_rank", "id", "metadata_id", "start_ts")


# --- rollup ---------------------------------------------------------------------------------

@_query
def rollup_hourly(s: Sensors) -> DataFrame:
    return _rounded(ro.rollup(s.recent()), "value")


@_query
def rollup_counter_max(s: Sensors) -> DataFrame:
    return _rounded(ro.rollup(ro.where_tags(s.recent(), domain="counter")), "value")


@_query
def rollup_domain_fallback(s: Sensors) -> DataFrame:
    """Over both stores: unit-less series are rare in the recent one."""
    unitless = ro.measurement_like(s.points(), "_data$")
    return _rounded(ro.rollup(unitless), "value")


@_query
def rollup_by_category(s: Sensors) -> DataFrame:
    return _rounded(ro.rollup_by_category(s.recent(), stamp="start"), "value")


@_query
def rollup_without_rule(s: Sensors) -> DataFrame:
    return ro.without_rule(s.points())


def _both(recent: PointStore, historical: PointStore) -> DataFrame:
    both = recent.read().withColumn("store", F.lit(pt.RECENT)).unionByName(
        historical.read().withColumn("store", F.lit(pt.HISTORICAL))
    )
    return _rounded(both, "value").select("store", *SERIES, "value", "ts")


def _written_stores(s: Sensors) -> tuple[PointStore, PointStore]:
    recent = PointStore(s.spark, scratch_path(s.spark, "recent"), retention_days=90)
    historical = PointStore(s.spark, scratch_path(s.spark, "historical"), "month")
    recent.replace(s.recent())
    historical.replace(s.historical())
    return recent, historical


@_query
def lifecycle_flow(s: Sensors) -> DataFrame:
    """Points written to both stores, what aged rolled up, the recent store expired."""
    recent, historical = _written_stores(s)
    reached = roll_up_slice(recent, historical, NOW_ROLLUP)
    recent.expire(NOW_RETENTION, not_after=reached)
    return _both(recent, historical)


@_query
def lifecycle_catch_up(s: Sensors) -> DataFrame:
    """Two scheduled runs with weeks between them: the second makes up for what the first could
    not see yet, and only then does the recent store expire."""
    recent, historical = _written_stores(s)
    maintain(recent, historical, "2024-02-10 00:00:00")
    maintain(recent, historical, "2024-04-20 00:00:00")
    return _both(recent, historical)


@_query
def lifecycle_deltas(s: Sensors) -> DataFrame:
    """The two runs of lifecycle_catch_up with a historical store that takes rollups as deltas, read
    before they are folded."""
    recent, historical = _written_stores(s)
    historical = replace(historical, max_deltas=10)
    maintain(recent, historical, "2024-02-10 00:00:00")
    maintain(recent, historical, "2024-04-20 00:00:00")
    return _both(recent, historical)


@_query
def rollup_late_points(s: Sensors) -> DataFrame:
    """A sixth of the points arrives after their hours were rolled up; the next run takes these
    hours up again, and no others."""
    recent = PointStore(
        s.spark, scratch_path(s.spark, "recent"), retention_days=90, log_changes=True
    )
    historical = PointStore(s.spark, scratch_path(s.spark, "historical"), "month", max_deltas=10)
    late = "minute(ts) < 10"
    recent.replace(s.recent().filter(f"NOT {late}"))
    historical.replace(s.historical())
    maintain(recent, historical, "2024-02-20 00:00:00")
    recent.replace(s.recent().filter(f"{late} AND ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"))
    maintain(recent, historical, "2024-02-20 00:30:00")
    return _both(recent, historical)


def _utc_session(s: Sensors) -> SparkSession:
    """Event time is a session-zoned timestamp on the streaming path only."""
    session = s.spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    partitions = "spark.sql.shuffle.partitions"
    session.conf.set(partitions, s.spark.conf.get(partitions))
    return session


@_query
def rollup_stream(s: Sensors) -> DataFrame:
    """The recent store read as a stream and rolled up; hours still open are not emitted."""
    store = PointStore(s.spark, scratch_path(s.spark, "recent"))
    store.replace(s.recent())
    points = PointStore(_utc_session(s), store.path).read_stream()
    hours = st.rollup_stream(points, "1 hour")
    out = scratch_path(s.spark, "stream-out")
    st.run_to_parquet(hours, out, scratch_path(s.spark, "stream-checkpoint"))
    return _rounded(s.spark.read.schema(hours.schema).parquet(out), "value")


@_query
def dedup_stream(s: Sensors) -> DataFrame:
    """First readings of a stream of both tables: two thirds of the events as short-term readings,
    half of them as long-term ones. Keys that the watermark has not closed are not emitted."""
    session = _utc_session(s)
    events = (
        session.readStream.schema(dt.SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(s.sf_dir)
    )
    short = dt.short_term_of(events.filter("event_id % 3 <> 0"))
    long = dt.short_term_of(events.filter("event_id % 2 = 0")).withColumn("table_rank", F.lit(1))
    first = st.first_readings_stream(short.unionByName(long))
    out = scratch_path(s.spark, "stream-out")
    st.run_to_parquet(first, out, scratch_path(s.spark, "stream-checkpoint"))
    found = s.spark.read.schema(first.schema).parquet(out)
    return found.select("metadata_id", "start_ts", "table_rank", "id", "value", "n_short", "n_long")


# --- stores ---------------------------------------------------------------------------------


def _both_stores(s: Sensors) -> DataFrame:
    return s.points()


@_query
def store_profile(s: Sensors) -> DataFrame:
    return pf.store_profile(_both_stores(s), NOW_PREVIEW)


@_query
def store_size(s: Sensors) -> DataFrame:
    sizes = pf.store_size(pf.store_profile(_both_stores(s), NOW_PREVIEW))
    return _rounded(sizes, "size_mb", "size_gb", "points_per_day")


@_query
def store_measurements(s: Sensors) -> DataFrame:
    return pf.measurements(_both_stores(s))


@_query
def store_fields(s: Sensors) -> DataFrame:
    return pf.field_names(_both_stores(s))


@_query
def store_times(s: Sensors) -> DataFrame:
    return pf.times(s.recent())


@_query
def store_first_last(s: Sensors) -> DataFrame:
    return pf.series_ends(s.historical())


@_query
def store_sample_size(s: Sensors) -> DataFrame:
    return pf.sample_size(s.recent(), NOW_PREVIEW)


@_query
def store_series_limit(s: Sensors) -> DataFrame:
    return pf.first_per_series(s.historical(), 3)


@_query
def store_preview(s: Sensors) -> DataFrame:
    return pf.preview(s.recent(), NOW_PREVIEW)


@_query
def store_retention(s: Sensors) -> DataFrame:
    return tl.retained(s.recent(), NOW_RETENTION, 90)


def _mixed_store(s: Sensors) -> DataFrame:
    """A store that also holds live points, some of them without source tag."""
    source = "CASE length(entity_id) % 3 WHEN 0 THEN NULL WHEN 1 THEN 'live' ELSE source END"
    return s.historical().withColumn("source", F.expr(source))


@_query
def store_delete_migrated(s: Sensors) -> DataFrame:
    return tl.without_migrated(_mixed_store(s))


@_query
def store_delete_counts(s: Sensors) -> DataFrame:
    return tl.delete_counts(_mixed_store(s))


@_query
def store_delete_written(s: Sensors) -> DataFrame:
    """The same deletion on a written store."""
    store = PointStore(s.spark, scratch_path(s.spark, "mixed"), "month")
    store.replace(_mixed_store(s))
    store.delete()
    return store.read()


@_query
def unified_timeline(s: Sensors) -> DataFrame:
    """Recent points over the historical store: the migrated long-term points, with the rollup of
    the recent ones in place of equal keys."""
    recent = s.recent()
    return _rounded(tl.unified(recent, ro.rollup(recent), s.historical()), "value")


@_query
def historical_dedup(s: Sensors) -> DataFrame:
    """Long-term readings written without de-duplication, reduced to the newest per point."""
    raw = rd.match_raw(s.long_term, pt.with_tags(s.candidates), s.small).filter("matched")
    points = pt.build_points(qa.unvalidated(raw), keep=("id",))
    return tl.newest_per_point(points, "id").select(*SERIES, "value", "ts")


def query_functions() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The catalogue as callables of (spark, sf_dir)."""

    def bind(fn: Callable[[Sensors], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Sensors(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}
