from __future__ import annotations

from collections import Counter
import os

import pytest
from conftest import at
from frames import points

from meterloom.operators import points as pt
from meterloom.operators import rollup as ro
from meterloom.plans.catalogue import Sensors
from meterloom.plans.export import ExportOptions, run_export
from meterloom.plans.lifecycle import maintain, roll_up_slice
from meterloom.sources import driver_tables as dt
from meterloom.sources import progress as pg
from meterloom.sources import store as store_module
from meterloom.sources.scratch import scratch_path
from meterloom.sources.store import PointStore
from meterloom.streaming import rollup as st


def rows_of(df):
    return sorted(map(str, df.collect()))


def _p(ts, value, entity="a", **tags):
    return {"ts": at(ts), "value": value, "measurement": "°C/h%", "domain": "sensor",
            "entity_id": entity, "source": "migration", **tags}


@pytest.fixture
def store(spark):
    return PointStore(spark, scratch_path(spark, "store"), retention_days=90)


def test_replace_is_keyed_and_repeatable(spark, store):
    first = points(spark, [_p("2024-01-01 00:00:00", 1.0), _p("2024-01-02 00:00:00", 2.0)])
    store.replace(first)
    newer = points(spark, [
        _p("2024-01-01 00:00:00", 5.0), _p("2024-01-01 00:00:00", 7.0, unit="W"),
    ])
    store.replace(newer)
    want = rows_of(points(spark, [
        _p("2024-01-01 00:00:00", 5.0), _p("2024-01-01 00:00:00", 7.0, unit="W"),
        _p("2024-01-02 00:00:00", 2.0),
    ]))
    assert rows_of(store.read()) == want
    store.replace(newer)
    assert rows_of(store.read()) == want


def test_empty_write_and_missing_store(spark, store):
    assert store.read().count() == 0
    store.replace(points(spark, []))
    assert store.read().count() == 0
    store.replace(points(spark, [_p("2024-01-01 00:00:00", 1.0)]))
    store.replace(points(spark, []))
    assert store.read().count() == 1


def test_untouched_periods_are_not_rewritten(spark, store):
    store.replace(points(spark, [_p("2024-01-01 00:00:00", 1.0), _p("2024-01-02 00:00:00", 2.0)]))
    other = os.path.join(store.path, "period=2024-01-02")
    before = sorted(os.listdir(other))
    store.replace(points(spark, [_p("2024-01-01 01:00:00", 3.0)]))
    assert sorted(os.listdir(other)) == before
    assert store.read().count() == 3


def test_range_read_prunes_periods(spark, store):
    store.replace(points(spark, [_p(f"2024-01-0{d} 12:00:00", d * 1.0) for d in range(1, 6)]))
    part = store.read("2024-01-02 12:00:00", "2024-01-04 12:00:00")
    assert sorted(r.value for r in part.collect()) == [2.0, 3.0]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_delete_drops_emptied_periods(spark, store):
    store.replace(points(spark, [
        _p("2024-01-01 00:00:00", 1.0),
        _p("2024-01-02 00:00:00", 2.0), _p("2024-01-02 00:00:00", 3.0, entity="b", source=None),
    ]))
    store.delete()
    assert [r.value for r in store.read().collect()] == [3.0]
    assert not os.path.exists(os.path.join(store.path, "period=2024-01-01"))
    store.delete()
    assert store.read().count() == 1


@pytest.mark.parametrize("period", ["day", "month"])
def test_expire_cuts_exactly(spark, period):
    store = PointStore(spark, scratch_path(spark, "store"), period, retention_days=90)
    times = ["2023-11-01 00:00:00", "2024-01-10 23:59:59", "2024-01-11 00:00:00",
             "2024-01-11 12:00:00", "2024-02-01 00:00:00"]
    store.replace(points(spark, [_p(t, float(i)) for i, t in enumerate(times)]))
    store.expire("2024-04-10 12:00:00")
    assert sorted(r.value for r in store.read().collect()) == [3.0, 4.0]


def test_no_retention_keeps_everything(spark):
    store = PointStore(spark, scratch_path(spark, "store"))
    store.replace(points(spark, [_p("1999-01-01 00:00:00", 1.0)]))
    store.expire("2024-04-10 00:00:00")
    assert store.read().count() == 1


def test_rolling_up_twice_changes_nothing(spark):
    recent = PointStore(spark, scratch_path(spark, "recent"), retention_days=90)
    historical = PointStore(spark, scratch_path(spark, "historical"), "month")
    recent.replace(points(spark, [
        {**_p(f"2024-01-15 0{h}:10:00", float(h)), "measurement": "W"} for h in range(5)
    ] + [{**_p("2024-01-16 00:00:00", 9.0), "measurement": "W"}]))
    roll_up_slice(recent, historical, "2024-02-15 00:00:00")
    once = rows_of(historical.read())
    assert len(once) == 5
    maintain(recent, historical, "2024-02-15 00:00:00")
    assert rows_of(historical.read()) == once
    # A late point inside the slice is picked up by the next run.
    recent.replace(points(spark, [{**_p("2024-01-15 00:50:00", 4.0), "measurement": "W"}]))
    roll_up_slice(recent, historical, "2024-02-15 00:00:00")
    assert sorted(r.value for r in historical.read().collect()) == [1.0, 2.0, 2.0, 3.0, 4.0]


def test_export_end_to_end(spark, sf_dir):
    s = Sensors(spark, sf_dir)
    inputs = dt.inputs(spark, sf_dir)
    recent = PointStore(spark, scratch_path(spark, "recent"))
    historical = PointStore(spark, scratch_path(spark, "historical"), "month")
    path = scratch_path(spark, "progress")
    options = ExportOptions(latest_metadata_only=False)
    dry = run_export(spark, inputs, recent, historical, ExportOptions(
        latest_metadata_only=False, dry_run=True))
    assert not recent.exists()
    done = run_export(spark, inputs, recent, historical, options, path, "2024-02-01 00:00:00")
    assert done == dry
    assert rows_of(recent.read()) == rows_of(s.recent())
    assert rows_of(historical.read()) == rows_of(s.historical())
    assert done["total_points"] == recent.read().count() + historical.read().count()
    again = run_export(spark, inputs, recent, historical, options, path, "2024-02-02 00:00:00")
    # A finished export hides nothing from a later one, and writing it again changes nothing.
    assert again == done
    assert rows_of(recent.read()) == rows_of(s.recent())


def _small(spark, rows, entities=((1, "sensor.a", "x", "W"),)):
    """Inputs of hand-written readings: (id, entity, time, table rank, value)."""
    from frames import meta, readings

    from meterloom.sources.tables import Inputs

    full = [(i, e, at(t), rank, v) for i, e, t, rank, v in rows]
    tables = [readings(spark, [r for r in full if r[3] == k]) for k in (0, 1)]
    return Inputs(meta(spark, list(entities)), *tables)


def _stores(spark):
    return [PointStore(spark, scratch_path(spark, n)) for n in ("r", "h")]


def _values(stores):
    return [sorted(r.value for r in s.read().collect()) for s in stores]


def test_a_range_run_does_not_mark_the_rest_as_done(spark):
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2024-02-10 00:00:00", 0, 2.0)]
    stores, path = _stores(spark), scratch_path(spark, "progress")
    part = ExportOptions(end="2024-01-15 00:00:00")
    run_export(spark, _small(spark, rows), *stores, part, path, "2024-03-01 00:00:00")
    assert _values(stores) == [[1.0], []]
    run_export(spark, _small(spark, rows), *stores, ExportOptions(), path, "2024-03-02 00:00:00")
    assert _values(stores) == [[1.0, 2.0], []]
    # Readings that arrive after a finished run are seen by the next.
    rows.append((3, 1, "2024-01-20 00:00:00", 1, 3.0))
    run_export(spark, _small(spark, rows), *stores, ExportOptions(), path, "2024-03-03 00:00:00")
    assert _values(stores) == [[1.0, 2.0], [3.0]]


def test_a_late_range_does_not_move_the_marks(spark):
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2024-02-10 00:00:00", 0, 2.0)]
    stores, path = _stores(spark), scratch_path(spark, "progress")
    late = ExportOptions(start="2024-02-01 00:00:00")
    run_export(spark, _small(spark, rows), *stores, late, path, "2024-03-01 00:00:00")
    assert _values(stores) == [[2.0], []]
    incremental = ExportOptions(incremental=True)
    run_export(spark, _small(spark, rows), *stores, incremental, path, "2024-03-02 00:00:00")
    assert _values(stores) == [[1.0, 2.0], []]


def test_a_reading_from_the_future_does_not_hide_the_present(spark):
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2029-12-31 00:00:00", 0, 9.0)]
    stores, path = _stores(spark), scratch_path(spark, "progress")
    run_export(spark, _small(spark, rows), *stores, ExportOptions(), path, "2024-01-15 00:00:00")
    rows.append((3, 1, "2024-01-20 00:00:00", 0, 2.0))
    options = ExportOptions(incremental=True)
    counters = run_export(spark, _small(spark, rows), *stores, options, path, "2024-02-01 00:00:00")
    assert _values(stores) == [[1.0, 2.0, 9.0], []]
    assert counters["short_term_records"] == 2  # the good reading before the mark is not read again


def test_a_new_entity_is_read_from_its_beginning(spark):
    two = ((1, "sensor.a", "x", "W"), (2, "sensor.b", "x", "W"))
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2024-01-10 00:00:00", 1, 8.0)]
    stores, path = _stores(spark), scratch_path(spark, "progress")
    run_export(spark, _small(spark, rows), *stores, ExportOptions(), path, "2024-01-15 00:00:00")
    rows += [(3, 2, "2023-05-05 00:00:00", 0, 3.0), (4, 1, "2024-01-11 00:00:00", 0, 4.0)]
    options = ExportOptions(incremental=True)
    run_export(spark, _small(spark, rows, two), *stores, options, path, "2024-02-01 00:00:00")
    assert _values(stores)[0] == [1.0, 3.0, 4.0]


def test_a_killed_run_resumes_with_the_second_store(spark, monkeypatch):
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2024-01-11 00:00:00", 1, 2.0)]
    stores, path = _stores(spark), scratch_path(spark, "progress")
    inputs, written, real = _small(spark, rows), [], PointStore.replace

    def only_first(self, points, staged=False):
        if self.path == stores[1].path:
            raise RuntimeError("killed")
        real(self, points, staged)

    monkeypatch.setattr(PointStore, "replace", only_first)
    with pytest.raises(RuntimeError):
        run_export(spark, inputs, *stores, ExportOptions(), path, "2024-02-01 00:00:00")
    states = {r.source_table: r.status for r in pg.read_progress(spark, path).collect()}
    assert states == {"statistics_short_term": "completed", "statistics": "failed"}

    def note(self, points, staged=False):
        written.append(self.path)
        real(self, points, staged)

    monkeypatch.setattr(PointStore, "replace", note)
    run_export(spark, inputs, *stores, ExportOptions(), path, "2024-02-02 00:00:00")
    assert written == [stores[1].path]
    assert _values(stores) == [[1.0], [2.0]]
    states = {r.source_table: r.status for r in pg.read_progress(spark, path).collect()}
    assert set(states.values()) == {"exported"}


def test_progress_needs_the_time_of_recording(spark):
    with pytest.raises(ValueError, match="recording"):
        run_export(spark, _small(spark, []), *_stores(spark), progress_path="/tmp/none")


def test_a_partial_deletion_keeps_the_rest_of_its_period(spark, store):
    store.replace(points(spark, [_p("2024-01-01 01:00:00", 1.0), _p("2024-01-01 13:00:00", 2.0)]))
    store.delete(within="ts < TIMESTAMP_NTZ '2024-01-01 12:00:00'")
    assert [r.value for r in store.read().collect()] == [2.0]
    store.delete("CAST(NULL AS BOOLEAN)")
    assert store.read().count() == 1


def test_a_skipped_month_of_maintenance_loses_nothing(spark):
    recent = PointStore(spark, scratch_path(spark, "recent"), retention_days=90)
    historical = PointStore(spark, scratch_path(spark, "historical"), "month")
    days = [f"2024-01-{d:02d} 05:10:00" for d in range(1, 32)]
    recent.replace(points(spark, [{**_p(t, float(i)), "measurement": "W"} for i, t in enumerate(days)]))
    maintain(recent, historical, "2024-02-05 00:00:00")
    assert historical.read().count() == 5
    maintain(recent, historical, "2024-06-30 00:30:00")
    assert sorted(r.value for r in historical.read().collect()) == [float(i) for i in range(31)]
    assert recent.read().count() == 0


def test_recent_points_wait_for_their_rollup(spark):
    recent = PointStore(spark, scratch_path(spark, "recent"), retention_days=90)
    recent.replace(points(spark, [_p("2024-01-01 00:00:00", 1.0), _p("2024-01-03 00:00:00", 2.0)]))
    recent.expire("2024-12-31 00:00:00", not_after="2024-01-02 00:00:00")
    assert [r.value for r in recent.read().collect()] == [2.0]


def test_scratch_is_shared_and_empty_afterwards(spark):
    from meterloom.sources.scratch import SETTING, scratch_base

    with pytest.raises(ValueError, match=SETTING):
        scratch_base(None, "spark://host:7077")
    with pytest.raises(ValueError):
        scratch_base("", "local-cluster[2,1,1024]")
    assert scratch_base("hdfs:///x/", "yarn") == "hdfs:///x"
    assert os.path.isdir(scratch_base(None, "local[4]"))
    base = spark.conf.get(SETTING).removeprefix("file:")
    stores = _stores(spark)
    before = set(os.listdir(base))
    rows = [(1, 1, "2024-01-10 00:00:00", 0, 1.0), (2, 1, "2024-01-11 00:00:00", 1, 2.0)]
    run_export(spark, _small(spark, rows), *stores)
    run_export(spark, _small(spark, rows), *stores)
    stores[0].delete()
    stores[1].expire("2030-01-01 00:00:00")
    own = {os.path.basename(s.path) for s in stores}
    assert set(os.listdir(base)) - before <= own


def test_incremental_runs_add_up_to_a_full_run(spark, sf_dir):
    s, inputs = Sensors(spark, sf_dir), dt.inputs(spark, sf_dir)
    stores = [PointStore(spark, scratch_path(spark, n), "month") for n in ("r", "h")]
    path = scratch_path(spark, "progress")
    first = ExportOptions(latest_metadata_only=False, end="2024-01-15 00:00:00")
    before = run_export(spark, inputs, *stores, first, path, "2024-01-15 00:00:00")
    assert 0 < stores[0].read().count() < s.recent().count()
    rest = ExportOptions(latest_metadata_only=False, incremental=True)
    after = run_export(spark, inputs, *stores, rest, path, "2024-02-01 00:00:00")
    assert rows_of(stores[0].read()) == rows_of(s.recent())
    assert rows_of(stores[1].read()) == rows_of(s.historical())
    assert before["total_points"] + after["total_points"] == sum(x.read().count() for x in stores)


def test_readings_within_one_second_become_one_point(spark):
    from frames import meta, readings

    from meterloom.sources.tables import Inputs

    rows = [
        (1, 1, at("2024-01-01 00:00:00.750000"), 0, 7.0),
        (2, 1, at("2024-01-01 00:00:00.250000"), 0, 3.0),
        (3, 1, at("2024-01-01 00:00:01"), 0, 4.0),
    ]
    inputs = Inputs(
        meta(spark, [(1, "sensor.a", "x", "W")]), readings(spark, rows), readings(spark, [])
    )
    stores = [PointStore(spark, scratch_path(spark, n)) for n in ("r", "h")]
    counters = run_export(spark, inputs, *stores)
    assert counters["total_points"] == 3
    assert {str(r.ts)[17:]: r.value for r in stores[0].read().collect()} == {"00": 7.0, "01": 4.0}
    assert stores[1].read().count() == 0


def test_export_options_narrow_the_run(spark, sf_dir):
    inputs = dt.inputs(spark, sf_dir)
    stores = [PointStore(spark, scratch_path(spark, n), "month") for n in ("r", "h")]
    run_export(spark, inputs, *stores, ExportOptions(
        categories=("energy",), name_filter="RING", measurement="m"))
    rows = stores[1].read().collect()
    assert rows and {r.category for r in rows} == {"energy"}
    assert {r.measurement for r in rows} == {"m"}
    assert all("ring" in r.entity_id for r in rows)


def test_progress_reads_the_latest_row(spark):
    path = scratch_path(spark, "progress")
    row = "SELECT 1L AS metadata_id, 'statistics' AS source_table, '{}' AS status," \
          " TIMESTAMP_NTZ '2024-01-0{}' AS last_start_ts"
    pg.record_progress(spark.sql(row.format("running", 1)), path, "2024-01-05 00:00:00")
    pg.record_progress(spark.sql(row.format("completed", 2)), path, "2024-01-06 00:00:00")
    (got,) = pg.read_progress(spark, path).collect()
    assert (got.status, got.last_start_ts) == ("completed", at("2024-01-02 00:00:00"))
    assert pg.completed(pg.read_progress(spark, path), ("statistics",)).count() == 1
    assert pg.completed(pg.read_progress(spark, path), ("statistics", "statistics_short_term")).count() == 0


def test_stream_equals_batch_for_closed_hours(spark, sf_dir):
    store = PointStore(spark, scratch_path(spark, "recent"))
    store.replace(Sensors(spark, sf_dir).recent())
    target = PointStore(spark, scratch_path(spark, "rolled"))
    st.run_to_store(
        st.rollup_stream(store.read_stream(), "1 hour"), target, scratch_path(spark, "ckpt")
    )
    batch = ro.rollup(store.read())
    limit = store.read().selectExpr("max(ts) - INTERVAL 1 HOUR AS t").first().t
    closed = batch.filter(f"ts <= TIMESTAMP_NTZ '{limit}'")
    assert 0 < closed.count() < batch.count()
    assert rows_of(target.read().selectExpr("* EXCEPT (value)", "round(value, 6) AS v")) == rows_of(
        closed.selectExpr("* EXCEPT (value)", "round(value, 6) AS v"))


def test_stream_picks_up_new_files_and_drops_what_is_too_late(spark):
    store = PointStore(spark, scratch_path(spark, "recent"))
    target = PointStore(spark, scratch_path(spark, "rolled"))
    ckpt = scratch_path(spark, "ckpt")

    def run():
        st.run_to_store(st.rollup_stream(store.read_stream(), "1 hour"), target, ckpt)
        return {str(r.ts)[11:13]: r.value for r in target.read().collect()}

    def w(ts, v):
        return {**_p(ts, v), "measurement": "W"}

    store.replace(points(spark, [w("2024-01-01 00:10:00", 1.0), w("2024-01-01 03:00:00", 5.0)]))
    assert run() == {"01": 1.0}
    # The new file holds a point of a closed hour: ignored, as is the rewritten old content.
    store.replace(points(spark, [w("2024-01-02 03:00:00", 6.0)]))
    assert run() == {"01": 1.0, "04": 5.0}


def test_streaming_needs_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            st.rollup_stream(points(spark, []))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_stamp(spark):
    with pytest.raises(ValueError):
        ro.rollup(points(spark, []), stamp="middle")


def test_store_names():
    assert (pt.RECENT, pt.HISTORICAL) == ("recent", "historical")


def test_merge_cuts_a_large_period_and_replaces_by_key_in_every_piece(spark, tmp_path, monkeypatch):
    """One month, more points than one piece: copies among the incoming stay, absent tags are equal."""
    monkeypatch.setattr(store_module, "ROWS_PER_FILE", 100, raising=False)

    def rows(value, n, first=0):
        return [{"measurement": "W", "entity_id": f"e{i % 7}" if i % 3 else None, "value": value,
                 "ts": at(f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00")} for i in range(first, n)]

    store = PointStore(spark, str(tmp_path / "points"), "month")
    store.replace(points(spark, rows(1.0, 600)))
    twice = rows(2.0, 700, 300) + rows(3.0, 301, 300)
    store.replace(points(spark, twice))
    found = Counter((r.entity_id, r.ts, r.value) for r in store.read().collect())
    want = Counter((r.get("entity_id"), r["ts"], r["value"]) for r in rows(1.0, 300) + twice)
    assert found == want
    files = list((tmp_path / "points" / "period=2024-01-01").glob("part-*.parquet"))
    assert 1 < len(files) <= 8
