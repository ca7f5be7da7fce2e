"""The queue of changed hours, deltas beside the periods, streaming de-duplication."""

from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import at
from frames import points, readings

from meterloom.operators import readings as rd
from meterloom.plans.lifecycle import maintain
from meterloom.sources import files
from meterloom.sources.scratch import scratch_path
from meterloom.sources.store import PointStore
from meterloom.streaming import rollup as st


def _p(ts, value, entity="a", measurement="W", domain="sensor"):
    return {
        "measurement": measurement, "entity_id": entity, "domain": domain, "category": "power",
        "unit": "W", "source": "migration", "value": value, "ts": at(ts),
    }


def _values(store):
    return {(r.entity_id, str(r.ts)): r.value for r in store.read().collect()}


@pytest.fixture
def stores(spark):
    recent = PointStore(spark, scratch_path(spark, "r"), retention_days=90, log_changes=True)
    return recent, PointStore(spark, scratch_path(spark, "h"), "month", max_deltas=3)


def test_a_point_that_arrives_on_day_35_changes_its_hour(spark, stores):
    recent, historical = stores
    recent.replace(points(spark, [_p("2024-01-01 00:10:00", 1.0), _p("2024-01-01 02:10:00", 5.0, "b")]))
    maintain(recent, historical, "2024-02-02 00:00:00")
    assert _values(historical) == {("a", "2024-01-01 01:00:00"): 1.0, ("b", "2024-01-01 03:00:00"): 5.0}
    recent.replace(points(spark, [_p("2024-01-01 00:20:00", 3.0)]))
    maintain(recent, historical, "2024-02-05 00:00:00")
    assert _values(historical) == {("a", "2024-01-01 01:00:00"): 2.0, ("b", "2024-01-01 03:00:00"): 5.0}
    # One delta per run that had something to do; the second holds the changed hour alone.
    assert historical.delta_parts() == ["seq=000000000"]
    assert spark.read.parquet(f"{historical.path}.deltas").count() == 1


def test_a_run_without_changes_reads_no_points(spark, stores, monkeypatch):
    recent, historical = stores
    recent.replace(points(spark, [_p("2024-01-01 00:10:00", 1.0), _p("2024-02-20 00:10:00", 2.0)]))
    maintain(recent, historical, "2024-02-02 00:00:00")
    assert recent.changes(recent.change_parts()).count() == 1  # the hour that is still too young
    before = _values(historical)

    def unread(*_):
        raise AssertionError("points were read")

    with monkeypatch.context() as patch:
        patch.setattr(PointStore, "read", unread)
        maintain(recent, historical, "2024-02-03 00:00:00")
    assert _values(historical) == before
    maintain(recent, historical, "2024-03-25 00:00:00")
    assert recent.change_parts() == []
    assert _values(historical)["a", "2024-02-20 01:00:00"] == 2.0


def test_hours_stay_queued_until_they_are_rolled_up(spark, stores, monkeypatch):
    recent, historical = stores
    recent.replace(points(spark, [_p("2024-01-01 00:10:00", 1.0)]))

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(PointStore, "add", killed)
        with pytest.raises(RuntimeError):
            maintain(recent, historical, "2024-02-05 00:00:00")
    with monkeypatch.context() as patch:  # rolled up, but not yet out of the queue
        patch.setattr(PointStore, "settle_changes", killed)
        with pytest.raises(RuntimeError):
            maintain(recent, historical, "2024-02-05 00:00:00")
    assert len(recent.change_parts()) == 1
    maintain(recent, historical, "2024-02-05 00:00:00")
    assert _values(historical) == {("a", "2024-01-01 01:00:00"): 1.0}
    assert recent.change_parts() == []


def test_unitless_points_of_a_domain_are_rolled_up_together(spark, stores):
    """A late point of one series changes the mean of its domain, so the others are read along."""
    recent, historical = stores
    data = {"measurement": "sensor_data"}
    recent.replace(points(spark, [_p("2024-01-01 00:10:00", 1.0, "a", **data), _p("2024-01-01 00:10:00", 3.0, "b", **data)]))
    maintain(recent, historical, "2024-02-02 00:00:00")
    assert _values(historical) == {(None, "2024-01-01 01:00:00"): 2.0}
    recent.replace(points(spark, [_p("2024-01-01 00:10:00", 8.0, "c", **data)]))
    maintain(recent, historical, "2024-02-03 00:00:00")
    assert _values(historical) == {(None, "2024-01-01 01:00:00"): 4.0}


def test_deltas_are_merged_and_folded(spark):
    store = PointStore(spark, scratch_path(spark, "h"), "month", max_deltas=2)
    store.add(points(spark, [_p("2024-01-01 01:00:00", 1.0), _p("2024-01-02 01:00:00", 2.0)]))
    assert store.delta_parts() == []  # the first write makes the store
    store.add(points(spark, [_p("2024-01-01 01:00:00", 10.0), _p("2024-02-01 01:00:00", 3.0)]))
    store.add(points(spark, [_p("2024-01-01 01:00:00", 20.0)]))
    assert len(store.delta_parts()) == 2
    expected = {
        ("a", "2024-01-01 01:00:00"): 20.0, ("a", "2024-01-02 01:00:00"): 2.0, ("a", "2024-02-01 01:00:00"): 3.0,
    }
    assert _values(store) == expected
    assert {str(r.ts) for r in store.read("2024-01-02 00:00:00", "2024-02-01 01:00:00").collect()} == {"2024-01-02 01:00:00"}
    store.add(points(spark, [_p("2024-02-01 01:00:00", 3.0)]))
    assert store.delta_parts() == []
    assert _values(store) == _values(replace(store, max_deltas=0)) == expected


def test_a_crash_before_deltas_are_removed_changes_no_row(spark, monkeypatch):
    store = PointStore(spark, scratch_path(spark, "h"), "month", max_deltas=9)
    store.add(points(spark, [_p("2024-01-01 01:00:00", 1.0)]))
    store.add(points(spark, [_p("2024-01-01 01:00:00", 2.0), _p("2024-01-05 01:00:00", 5.0)]))
    before = _values(store)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr("meterloom.sources.store.discard", killed)
        with pytest.raises(RuntimeError):
            store.fold()
    assert _values(store) == before
    store.fold()
    assert _values(store) == before and store.delta_parts() == []


def test_later_operations_see_the_deltas(spark):
    store = PointStore(spark, scratch_path(spark, "h"), "month", retention_days=30, max_deltas=9)
    store.add(points(spark, [_p("2024-01-01 01:00:00", 1.0)]))
    store.add(points(spark, [_p("2024-01-01 01:00:00", 2.0), _p("2024-01-01 02:00:00", 3.0)]))
    store.replace(points(spark, [_p("2024-01-01 01:00:00", 9.0)]))
    assert _values(store) == {("a", "2024-01-01 01:00:00"): 9.0, ("a", "2024-01-01 02:00:00"): 3.0}
    store.add(points(spark, [_p("2024-01-01 03:00:00", 4.0)]))
    store.delete("value < 5")
    assert _values(store) == {("a", "2024-01-01 01:00:00"): 9.0}
    store.add(points(spark, [_p("2023-11-01 03:00:00", 4.0)]))
    store.expire("2024-01-20 00:00:00")
    assert _values(store) == {("a", "2024-01-01 01:00:00"): 9.0}
    assert files.children(spark, f"{store.path}.deltas") == []


def test_the_stream_keeps_the_first_reading_whatever_arrives_first(spark, tmp_path):
    """A long-term reading arrives in the first file, the short-term one of its key in the second."""
    kind = readings(spark, []).schema
    batches = [
        [(1, 1, "2024-01-01 00:00:00", 1, 10.0), (5, 2, "2024-01-01 00:00:00", 0, 50.0)],
        [(9, 1, "2024-01-01 00:00:00", 0, 90.0), (4, 2, "2024-01-01 00:00:00", 0, 40.0),
         (7, 1, "2024-01-01 00:30:00", 0, 70.0), (8, 3, None, 0, 1.0)],
        [(2, 1, "2024-01-01 06:00:00", 0, 20.0)],
        [(6, 1, "2024-01-01 05:30:00", 1, 60.0)],
        [(3, 1, "2024-01-01 00:00:00", 0, 30.0), (11, 1, "2024-01-01 09:00:00", 0, 99.0)],
    ]
    source, everything = str(tmp_path / "in"), []
    for batch in batches:
        rows = [(i, e, None if t is None else at(t), rank, v) for i, e, t, rank, v in batch]
        everything += rows
        readings(spark, rows).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source)
    out = scratch_path(spark, "out")
    first = st.first_readings_stream(stream, "1 hour")
    st.run_to_parquet(first, out, scratch_path(spark, "ckpt"))
    found = {(r.metadata_id, str(r.start_ts)): (r.table_rank, r.id, r.value) for r in spark.read.parquet(out).collect()}
    batch_rule = {
        (r.metadata_id, str(r.start_ts)): (r.table_rank, r.id, r.value)
        for r in rd.first_readings(readings(spark, [r for r in everything if r[0] != 3])).collect()
    }
    assert found == {k: v for k, v in batch_rule.items() if k[1] <= "2024-01-01 08:00:00"}
    assert found[1, "2024-01-01 00:00:00"] == (0, 9, 90.0)  # reading 3 came after its key was closed
