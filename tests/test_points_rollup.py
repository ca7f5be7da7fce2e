from __future__ import annotations

from conftest import at
from frames import meta, points, readings

from meterloom.operators import entities as ent
from meterloom.operators import points as pt
from meterloom.operators import profile as pf
from meterloom.operators import quality as qa
from meterloom.operators import readings as rd
from meterloom.operators import rollup as ro
from meterloom.operators import timeline as tl
from meterloom.sources.tables import basic_metadata


def test_point_tags_and_value(spark):
    base = basic_metadata(meta(spark, [
        (1, "sensor.a.b", "x", "W"), (2, "weather.c", "tibber", None), (3, "sensor.d", "tibber", ""),
    ]))
    rich = ent.filter_entities(base.selectExpr(
        "*", "CASE id WHEN 1 THEN 'Name' WHEN 2 THEN '' END AS friendly_name",
        "CASE id WHEN 1 THEN 'power' END AS device_class"))
    rows = readings(spark, [
        (1, 1, at("2024-01-01 00:00:00.900000"), 0, 5.0, 9.0),
        (2, 2, at("2024-01-01 00:00:00"), 1, None, 9.0),
        (3, 3, at("2024-01-01 00:00:00"), 1, float("nan"), 8.0),
    ])
    frame = qa.validate(rd.match_entities(rows, qa.with_limits(pt.with_tags(rich))))
    got = {r.entity_id: r for r in pt.build_points(frame).collect()}
    a, c, d = got["a.b"], got["c"], got["d"]
    assert (a.measurement, a.domain, a.unit, a.friendly_name, a.device_class, a.value, a.store) == (
        "W", "sensor", "W", "Name", "power", 5.0, "recent")
    assert a.ts == at("2024-01-01 00:00:00") and a.source == "migration"
    assert (c.measurement, c.unit, c.friendly_name, c.value, c.store) == (
        "weather_data", None, None, 9.0, "historical")
    assert (d.measurement, d.unit, d.value) == ("sensor_data", None, 8.0)


def test_measurement_override(spark):
    base = ent.filter_entities(basic_metadata(meta(spark, [(1, "sensor.a", "x", "W")])))
    assert pt.with_tags(base, measurement="m").first().measurement == "m"


def _point(ts, value, **tags):
    return {"ts": at(ts), "value": value, "source": "migration", **tags}


SERIES_ROWS = [
    # kWh keeps the last value of the hour, stamped at its end.
    _point("2024-01-01 00:05:00", 1.0, measurement="kWh", domain="sensor", entity_id="e"),
    _point("2024-01-01 00:55:00", 9.0, measurement="kWh", domain="sensor", entity_id="e"),
    _point("2024-01-01 00:30:00", 20.0, measurement="kWh", domain="sensor", entity_id="e"),
    # A kWh counter matches two rules; max wins.
    _point("2024-01-01 00:05:00", 50.0, measurement="kWh", domain="counter", entity_id="k"),
    _point("2024-01-01 00:55:00", 10.0, measurement="kWh", domain="counter", entity_id="k"),
    # W is averaged; the empty hour 01 does not appear.
    _point("2024-01-01 00:00:00", 1.0, measurement="W", domain="sensor", entity_id="w"),
    _point("2024-01-01 00:59:59", 2.0, measurement="W", domain="sensor", entity_id="w"),
    _point("2024-01-01 02:00:00", 7.0, measurement="W", domain="sensor", entity_id="w"),
    # No rule for this unit.
    _point("2024-01-01 00:00:00", 1.0, measurement="EUR", domain="sensor", entity_id="x"),
    # Unit-less counters: max per series, and the mean of the whole domain.
    _point("2024-01-01 00:10:00", 4.0, measurement="counter_data", domain="counter", entity_id="u"),
    _point("2024-01-01 00:20:00", 8.0, measurement="counter_data", domain="counter", entity_id="v"),
    # Unit-less weather: only the domain mean.
    _point("2024-01-01 00:10:00", 2.0, measurement="weather_data", domain="weather", entity_id="y"),
]


def test_rollup_rules(spark):
    rows = ro.rollup(points(spark, SERIES_ROWS)).collect()
    got = {(r.measurement, r.domain, r.entity_id, str(r.ts)[11:13]): r.value for r in rows}
    assert got == {
        ("kWh", "sensor", "e", "01"): 9.0,
        ("kWh", "counter", "k", "01"): 50.0,
        ("W", "sensor", "w", "01"): 1.5,
        ("W", "sensor", "w", "03"): 7.0,
        ("counter_data", "counter", "u", "01"): 4.0,
        ("counter_data", "counter", "v", "01"): 8.0,
        ("counter_data", "counter", None, "01"): 6.0,
        ("weather_data", "weather", None, "01"): 2.0,
    }
    assert all(r.source is None for r in rows if r.entity_id is None)


def test_rollup_of_disjoint_series_is_the_union_of_rollups(spark):
    whole = points(spark, SERIES_ROWS)
    parts = [whole.filter("domain = 'sensor'"), whole.filter("domain <> 'sensor'")]
    split = ro.rollup(parts[0]).unionByName(ro.rollup(parts[1]))
    assert sorted(map(str, split.collect())) == sorted(map(str, ro.rollup(whole).collect()))


def test_start_stamp_and_uncovered_measurements(spark):
    frame = points(spark, SERIES_ROWS)
    starts = {str(r.ts)[11:13] for r in ro.rollup(frame, stamp="start").collect()}
    assert starts == {"00", "02"}
    assert [(r.measurement, r.n_points) for r in ro.without_rule(frame).collect()] == [("EUR", 1)]


def test_rollup_is_one_hash_aggregate_over_one_scan(spark):
    plan = ro.rollup(points(spark, SERIES_ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Union" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_deletion_keeps_untagged_and_far_future_points(spark):
    rows = [
        _point("2024-01-01 00:00:00", 1.0, entity_id="gone"),
        {**_point("2024-01-01 00:00:00", 1.0, entity_id="untagged"), "source": None},
        {**_point("2024-01-01 00:00:00", 1.0, entity_id="live"), "source": "live"},
        _point("2031-01-01 00:00:00", 1.0, entity_id="future"),
    ]
    frame = points(spark, rows)
    assert {r.entity_id for r in tl.without_migrated(frame).collect()} == {
        "untagged", "live", "future"}
    counts = tl.delete_counts(frame).first()
    assert (counts.n_before, counts.n_deleted, counts.n_after) == (2, 1, 1)


def test_recent_wins_in_the_unified_timeline(spark):
    recent = points(spark, [_point("2024-01-01 00:00:00", 1.0, measurement="W", entity_id="a")])
    old = points(spark, [
        _point("2024-01-01 00:00:00", 2.0, measurement="W", entity_id="a"),
        _point("2023-01-01 00:00:00", 3.0, measurement="W", entity_id="a"),
    ])
    got = {str(r.ts)[:4]: r.value for r in tl.unified(recent, old).collect()}
    assert got == {"2024": 1.0, "2023": 3.0}


def test_preview_of_one_entity(spark):
    frame = points(spark, SERIES_ROWS)
    rows = pf.preview(frame, "2024-01-05 00:00:00", entity_id="w", n=2).collect()
    assert [(r.entity_id, r.value) for r in rows] == [("w", 1.0), ("w", 2.0)]
    assert pf.preview(frame, "2024-01-20 00:00:00").count() == 0


def test_sample_size_caps_per_series(spark):
    assert pf.sample_size(points(spark, SERIES_ROWS), "2024-01-02 00:00:00", per_series=2).first()["sample_points"] == 10


def test_session_time_zone_does_not_matter(spark):
    """The same points and rollup whatever the session's zone, around a DST change too."""
    base = ent.filter_entities(basic_metadata(meta(spark, [(1, "sensor.a", "x", "W")])))
    stamps = ["2024-03-31 01:30:00", "2024-03-31 02:30:00.250000", "2024-10-27 02:30:00"]
    rows = readings(spark, [(i, 1, at(t), 0, float(i)) for i, t in enumerate(stamps)])

    def run():
        frame = qa.validate(rd.match_entities(rows, qa.with_limits(pt.with_tags(base))))
        made = pt.build_points(frame)
        return (sorted(map(str, made.select("ts", "value").collect())),
                sorted(map(str, ro.rollup(made).select("ts", "value").collect())))

    in_utc = run()
    try:
        for zone in ("Europe/Berlin", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert run() == in_utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
