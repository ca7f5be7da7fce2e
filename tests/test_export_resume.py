"""Runs that die and go on, marks, the scans of incremental runs, the progress snapshot."""

from __future__ import annotations

import pytest
from conftest import at
from frames import meta, readings
from pyspark.sql import types as T

from meterloom import schemas
from meterloom.plans.export import ExportOptions, run_export
from meterloom.plans.fresh import LISTED, fresh_readings, mark_groups
from meterloom.sources import files
from meterloom.sources import progress as pg
from meterloom.sources.run_journal import RunJournal, Step, steps_of
from meterloom.sources.scratch import scratch_path
from meterloom.sources.store import PointStore
from meterloom.sources.tables import Inputs, require_columns

INCREMENTAL = ExportOptions(incremental=True)


class Killed(Exception):
    pass


class Dying(PointStore):
    """Fails from the n-th write on."""

    def after(self, n):
        object.__setattr__(self, "left", [None] * n)
        return self

    def replace(self, points, staged=False):
        if not self.left:
            raise Killed
        self.left.pop()
        super().replace(points, staged)


def _inputs(spark, rows, entities=((1, "sensor.a", "x", "W"),)):
    full = [(i, e, at(t), rank, v) for i, e, t, rank, v in rows]
    tables = [readings(spark, [r for r in full if r[3] == k]) for k in (0, 1)]
    return Inputs(meta(spark, list(entities)), *tables)


def _stores(spark):
    return [PointStore(spark, scratch_path(spark, n)) for n in ("r", "h")]


def _values(stores):
    return [sorted(r.value for r in s.read().collect()) for s in stores]


def _progress(spark, path):
    rows = pg.read_progress(spark, path).collect()
    return {(r.metadata_id, r.source_table): (r.status, str(r.last_start_ts)) for r in rows}


def test_a_reading_between_two_attempts_is_not_lost(spark):
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2024-01-10 00:00:00", 1, 5.0)]
    rows.append((3, 1, "2024-01-11 00:00:00", 1, 2.0))
    stores, path = _stores(spark), scratch_path(spark, "progress")
    dying = Dying(spark, stores[1].path).after(0)
    with pytest.raises(Killed):
        run_export(spark, _inputs(spark, rows), stores[0], dying, INCREMENTAL, path, "2024-02-01 00:00:00")
    assert _values(stores)[0] == [1.0]
    rows.append((4, 1, "2024-01-12 00:00:00", 0, 3.0))
    counters = run_export(spark, _inputs(spark, rows), *stores, INCREMENTAL, path, "2024-02-02 00:00:00")
    assert _values(stores) == [[1.0, 3.0], [2.0]]
    assert counters["total_records"] == 4 and counters["entities_processed"] == 1
    counters = run_export(spark, _inputs(spark, rows), *stores, INCREMENTAL, path, "2024-02-03 00:00:00")
    assert counters["total_records"] == 0
    assert _values(stores) == [[1.0, 3.0], [2.0]]


def test_a_full_run_ends_what_it_staged(spark):
    """What arrives between its attempts is left to the next run, and its marks do not hide it."""
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2024-01-11 00:00:00", 1, 2.0)]
    stores, path = _stores(spark), scratch_path(spark, "progress")
    dying = Dying(spark, stores[1].path).after(0)
    with pytest.raises(Killed):
        run_export(spark, _inputs(spark, rows), stores[0], dying, ExportOptions(), path, "2024-02-01 00:00:00")
    rows.append((3, 1, "2024-01-12 00:00:00", 0, 3.0))
    run_export(spark, _inputs(spark, rows), *stores, ExportOptions(), path, "2024-02-02 00:00:00")
    assert _values(stores) == [[1.0], [2.0]]
    run_export(spark, _inputs(spark, rows), *stores, INCREMENTAL, path, "2024-02-03 00:00:00")
    assert _values(stores) == [[1.0, 3.0], [2.0]]


FIVE_DAYS = [(d, 1, f"2024-01-0{d} 06:00:00", 0, float(d)) for d in range(1, 6)]
FIVE_DAYS += [(6, 2, "2024-01-01 07:00:00", 0, 6.0), (7, 2, "2024-01-05 00:00:00", 1, 7.0)]
TWO = ((1, "sensor.a", "x", "W"), (2, "sensor.b", "x", "W"))


def test_a_run_killed_in_the_third_of_five_periods(spark):
    stores, path = _stores(spark), scratch_path(spark, "progress")
    inputs, options = _inputs(spark, FIVE_DAYS, TWO), ExportOptions(rows_per_step=1)
    dying = Dying(spark, stores[0].path).after(2)
    with pytest.raises(Killed):
        run_export(spark, inputs, dying, stores[1], options, path, "2024-02-01 00:00:00")
    assert _values(stores) == [[1.0, 2.0, 6.0], []]
    assert _progress(spark, path) == {
        (1, "statistics_short_term"): ("failed", "2024-01-02 06:00:00"),
        (2, "statistics_short_term"): ("completed", "2024-01-01 07:00:00"),
        (1, "statistics"): ("completed", "None"),
        (2, "statistics"): ("failed", "None"),
    }
    # An incremental run of its own goes on at these marks.
    other = _stores(spark)
    found = run_export(spark, inputs, *other, INCREMENTAL, path, "2024-02-01 00:00:00", export_id="other")
    assert _values(other) == [[3.0, 4.0, 5.0], [7.0]] and found["total_points"] == 4
    # The repeated run writes what is left, each period once.
    counted = Dying(spark, stores[0].path).after(3)
    run_export(spark, inputs, counted, stores[1], options, path, "2024-02-02 00:00:00")
    assert counted.left == []
    assert _values(stores) == [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [7.0]]
    assert {s for s, _ in _progress(spark, path).values()} == {"exported"}
    assert files.children(spark, f"{path}/runs") == ["other"] or not files.children(spark, f"{path}/runs")


def test_a_run_killed_while_staging_starts_again(spark, monkeypatch):
    stores, path = _stores(spark), scratch_path(spark, "progress")
    inputs = _inputs(spark, FIVE_DAYS, TWO)

    def killed(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(RunJournal, "plan", killed)
        with pytest.raises(Killed):
            run_export(spark, inputs, *stores, ExportOptions(), path, "2024-02-01 00:00:00")
    assert not pg.has_progress(spark, path)
    run_export(spark, inputs, *stores, ExportOptions(), path, "2024-02-02 00:00:00")
    assert _values(stores) == [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [7.0]]


def test_a_start_moves_only_marks_that_it_does_not_cut_off(spark):
    stores, path = _stores(spark), scratch_path(spark, "progress")
    first = ExportOptions(end="2024-01-02 00:00:00")
    run_export(spark, _inputs(spark, FIVE_DAYS, TWO), *stores, first, path, "2024-01-02 00:00:00")
    cut = ExportOptions(incremental=True, start="2024-01-01 06:30:00")
    run_export(spark, _inputs(spark, FIVE_DAYS, TWO), *stores, cut, path, "2024-02-01 00:00:00")
    found = _progress(spark, path)
    assert found[1, "statistics_short_term"] == ("exported", "2024-01-01 06:00:00")  # mark before the start
    assert found[2, "statistics_short_term"] == ("exported", "2024-01-01 07:00:00")
    assert found[2, "statistics"] == ("exported", "None")


def test_progress_does_not_grow_with_runs(spark):
    stores, path = _stores(spark), scratch_path(spark, "progress")
    for day in range(1, 4):
        run_export(spark, _inputs(spark, FIVE_DAYS, TWO), *stores, INCREMENTAL, path, f"2024-02-0{day} 00:00:00")
        names = files.children(spark, path)
        assert [n for n in names if n.startswith("snapshot-")] == [f"snapshot-{day - 1:09d}"]
        assert [n for n in files.children(spark, f"{path}/log") if n.startswith("part-")] == []
        assert files.children(spark, f"{path}/runs") == []
        assert spark.read.parquet(f"{path}/{names[-1]}").count() == 4


def test_a_log_that_was_taken_up_twice_changes_nothing(spark):
    path = scratch_path(spark, "progress")
    row = "SELECT 1L AS metadata_id, 'statistics' AS source_table, '{}' AS status," \
          " TIMESTAMP_NTZ '2024-01-0{}' AS last_start_ts"
    pg.record_progress(spark.sql(row.format("running", 1)), path, "2024-01-05 00:00:00")
    pg.record_progress(spark.sql(row.format("completed", 2)), path, "2024-01-06 00:00:00")
    expected = pg.read_progress(spark, path).collect()
    pg.compact(spark, path)
    assert pg.read_progress(spark, path).collect() == expected
    pg.record_progress(spark.sql(row.format("running", 1)), path, "2024-01-05 00:00:00")
    assert pg.read_progress(spark, path).collect() == expected
    pg.compact(spark, path)
    assert pg.read_progress(spark, path).collect() == expected


@pytest.mark.parametrize("rows_per_step, n", [(1, 4), (10, 2), (100, 1)])
def test_steps_cover_all_time(rows_per_step, n):
    sizes = [("2024-01-03", 4), ("2024-01-01", 6), ("2024-01-02", 4), ("2024-02-01", 3)]
    steps = steps_of("t", sizes, rows_per_step)
    assert len(steps) == n and steps[0].start is None and steps[-1].end is None
    assert [s.end for s in steps[:-1]] == [s.start for s in steps[1:]]
    assert steps_of("t", [], 5) == [Step("t", None, None)]


def _marks(spark, rows):
    schema = "id long, source_table string, table_rank int, last_start_ts timestamp_ntz"
    path = scratch_path(spark, "marks")
    names = ("statistics_short_term", "statistics")
    full = [(i, names[r], r, None if t is None else at(t)) for i, r, t in rows]
    spark.createDataFrame(full, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_scans_are_bounded_by_groups_of_marks(spark):
    """One sensor that went silent in 2021 does not open the history of the others, and without an
    unmarked entity there is no scan without a bound."""
    scans = []
    base = _inputs(spark, [])

    def scan(table, start, end):
        scans.append((table, start, end))
        return base.short_term if table == "statistics_short_term" else base.long_term

    inputs = Inputs(base.statistics_meta, base.short_term, base.long_term, scan=scan)
    rows = [(1, 0, "2021-05-01 00:00:00"), (2, 0, "2024-01-10 05:00:00"), (3, 0, "2024-01-10 04:00:00")]
    rows += [(4, 0, "2023-12-30 00:00:00"), (2, 1, "2024-01-09 00:00:00"), (3, 1, "2024-01-09 00:00:00")]
    plan = fresh_readings(inputs, _marks(spark, rows), end="2024-03-01 00:00:00")
    end = "2024-03-01 00:00:00"
    assert scans == [
        ("statistics_short_term", "2024-01-10 04:00:00", end),
        ("statistics_short_term", "2023-12-30 00:00:00", end),
        ("statistics_short_term", "2021-05-01 00:00:00", end),
        ("statistics", "2024-01-09 00:00:00", end),
    ]
    assert plan.columns == base.short_term.columns
    scans.clear()
    fresh_readings(inputs, _marks(spark, [*rows, (5, 1, None)]), start="2022-01-01 00:00:00")
    assert ("statistics", "2022-01-01 00:00:00", None) in scans  # the unmarked one
    assert ("statistics_short_term", "2022-01-01 00:00:00", None) in scans  # the silent one


def test_ids_of_small_groups_reach_the_scan(spark, tmp_path):
    rows = [(i, i % 5, at(f"2024-01-{1 + i % 28:02d} 00:00:00"), 0, float(i)) for i in range(300)]
    path = str(tmp_path / "short")
    readings(spark, rows).write.parquet(path)
    stored = spark.read.parquet(path)
    inputs = Inputs(meta(spark, []), stored, stored.filter("false"))
    marks = _marks(spark, [(0, 0, "2024-01-27 00:00:00"), (1, 0, "2024-01-02 00:00:00"), (3, 0, None)])
    found = fresh_readings(inputs, marks)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(metadata_id,0)" in plan and "EqualTo(metadata_id,1)" in plan
    assert plan.count("GreaterThanOrEqual(start_ts") == 2
    expected = [
        r[0] for r in rows
        if (r[1] == 0 and r[2] > at("2024-01-27 00:00:00"))
        or (r[1] == 1 and r[2] > at("2024-01-02 00:00:00")) or r[1] == 3
    ]
    assert sorted(r.id for r in found.collect()) == expected


def test_large_groups_are_joined(spark, monkeypatch):
    monkeypatch.setattr("meterloom.plans.fresh.LISTED", 2)
    rows = [(i, i % 6, at(f"2024-01-{1 + i % 28:02d} 00:00:00"), 0, float(i)) for i in range(300)]
    inputs = Inputs(meta(spark, []), readings(spark, rows), readings(spark, []))
    marks = _marks(spark, [*[(e, 0, "2024-01-20 00:00:00") for e in range(4)], *[(e, 1, None) for e in range(4)]])
    found = sorted(r.id for r in fresh_readings(inputs, marks).collect())
    assert found == [r[0] for r in rows if r[1] < 4 and r[2] > at("2024-01-20 00:00:00")]
    assert LISTED == 1000


def test_mark_groups(spark):
    rows = [(1, 0, "2024-01-10 00:00:00"), (2, 0, "2024-01-09 00:00:00"), (3, 0, "2024-01-08 23:59:59")]
    rows += [(4, 0, "2022-01-01 00:00:00"), (5, 0, None), (5, 1, None)]
    found = {(r.id, r.table_rank): r.mark_group for r in mark_groups(_marks(spark, rows)).collect()}
    assert found == {(1, 0): 0, (2, 0): 0, (3, 0): 1, (4, 0): 4, (5, 0): -1, (5, 1): -1}


@pytest.mark.parametrize(
    "column, kind, fits",
    [
        ("start_ts", T.DecimalType(18, 6), True), ("start_ts", T.StringType(), False),
        ("start_ts", T.VarcharType(20), False), ("start_ts", T.IntegerType(), True),
        ("id", T.DecimalType(20, 0), True), ("id", T.DecimalType(20, 2), False),
        ("id", T.DoubleType(), False), ("id", T.CharType(4), False), ("mean", T.NullType(), True),
    ],
)
def test_types_that_may_stand_in(spark, column, kind, fits):
    class Frame:
        columns = schemas.STATISTICS.names
        schema = T.StructType(
            [T.StructField(f.name, kind if f.name == column else f.dataType) for f in schemas.STATISTICS]
        )

    if fits:
        require_columns(Frame, "statistics", schemas.STATISTICS)
    else:
        with pytest.raises(ValueError, match=column):
            require_columns(Frame, "statistics", schemas.STATISTICS)
