"""Value rules on single values, against expectations written down from the rule tables."""

from __future__ import annotations

import math

import pytest
from conftest import at
from frames import meta, readings
from hypothesis import given, settings
from hypothesis import strategies as hs

from meterloom.operators import entities as ent
from meterloom.operators import quality as qa
from meterloom.operators import readings as rd
from meterloom.rules import QualityRules
from meterloom.sources.tables import basic_metadata

UNITS = ["kWh", "W", "°C", "°F", "%", "A", "V", "kB/s", "MB/s", "GB", "MB", "hPa", "bar", "lux"]
NAN, INF = math.nan, math.inf
DAY = at("2024-01-01 00:00:00")

# unit, source, value -> (kept or repaired value, issue codes)
CASES = [
    ("kWh", "recorder", -1.0, 0.0, ["below_minimum", "energy_negative"]),
    ("kWh", "tibber", -1.0, None, ["below_minimum"]),  # special source: no repair
    ("kWh", "recorder", 1000000.0, 1000000.0, []),
    ("kWh", "recorder", 1000001.0, None, ["energy_high"]),
    ("W", "recorder", 0.0, 0.0, []),
    ("W", "recorder", -1.0, None, ["below_minimum"]),
    ("W", "recorder", 50000.5, None, ["above_maximum"]),
    ("W", "recorder", 100001.0, None, ["above_maximum", "power_high"]),
    ("%", "recorder", -3.0, 0.0, ["below_minimum"]),
    ("%", "recorder", -6.0, 0.0, ["below_minimum", "percentage_range"]),
    ("%", "recorder", 103.0, 100.0, ["above_maximum"]),
    ("%", "recorder", 106.0, 100.0, ["above_maximum", "percentage_range"]),
    ("%", "tibber", 103.0, None, ["above_maximum"]),
    ("°C", "recorder", -50.0, -50.0, []),
    ("°C", "recorder", -60.0, None, ["below_minimum"]),
    ("°C", "recorder", 201.0, None, ["above_maximum", "temperature_range"]),
    ("°F", "recorder", 150.0, 150.0, []),
    ("°F", "recorder", 250.0, None, ["temperature_range"]),
    ("bar", "recorder", 0.8, 0.8, []),
    ("bar", "recorder", 1.2000001, None, ["above_maximum"]),
    ("hPa", "recorder", 799.9, None, ["below_minimum"]),
    ("lux", "recorder", -5.0, -5.0, []),
    ("lux", "recorder", NAN, None, ["nan"]),
    ("lux", "recorder", INF, None, ["infinite"]),
    ("kWh", "recorder", -INF, None, ["infinite"]),
    ("kWh", "recorder", -999999.0, None, ["sentinel_low"]),
    ("GB", "recorder", 999999.0, None, ["sentinel_high"]),
    (None, "tibber", 1e300, 1e300, []),
]


def judged(spark, cases):
    """One entity per case, its value in the state field."""
    base = meta(spark, [(i, f"sensor.s{i}", src, unit) for i, (unit, src, *_) in enumerate(cases)])
    entities = qa.with_limits(ent.filter_entities(basic_metadata(base)))
    rows = readings(spark, [(i, i, DAY, 0, c[2]) for i, c in enumerate(cases)])
    return qa.validate(rd.match_entities(rows, entities))


def test_rules(spark):
    frame = judged(spark, CASES).cache()
    got = {r.metadata_id: (r.value, r.n_issues, r.status) for r in frame.collect()}
    codes = {}
    for r in qa.issues(frame).collect():
        codes.setdefault(r.metadata_id, []).append(r.code)
    for i, (unit, source, value, want, want_codes) in enumerate(CASES):
        status = "invalid" if want is None else "corrected" if want_codes else "valid"
        assert got[i] == (want, len(want_codes), status), (unit, source, value)
        assert codes.get(i, []) == want_codes, (unit, source, value)


def test_messages(spark):
    rows = qa.issues(judged(spark, [("W", "recorder", -1.0)])).collect()
    assert [r.message for r in rows] == ["Value -1.0 below minimum 0.0 for unit W"]


def brute_force(unit, value):
    """The rules of a plain recorder entity, in Python."""
    if math.isnan(value) or math.isinf(value) or value in (-999999.0, 999999.0):
        return None
    rules = QualityRules()
    low, high = rules.unit_range.get(unit, (None, None))
    bad = (low is not None and value < low) or (high is not None and value > high)
    kind = {"kWh": "energy", "W": "power", "%": "percentage", "°C": "temperature",
            "°F": "temperature"}.get(unit)
    if kind:
        lo, hi, _, _ = rules.category_range[kind]
        bad = bad or value < lo or value > hi
    if not bad:
        return value
    if kind == "percentage":
        return 0.0 if value < 0 else 100.0
    if kind == "energy" and value < 0:
        return 0.0
    return None


@settings(max_examples=5, deadline=None)
@given(hs.lists(hs.tuples(hs.sampled_from(UNITS), hs.one_of(
    hs.floats(width=64), hs.sampled_from([-5.0, 105.0, 80.0, 200.0, 1e6, 999999.0, 0.8]))),
    min_size=20, max_size=60))
def test_rules_against_brute_force(spark, cases):
    frame = judged(spark, [(u, "recorder", v) for u, v in cases])
    got = {r.metadata_id: r.value for r in frame.collect()}
    assert got == {i: brute_force(u, v) for i, (u, v) in enumerate(cases)}


def one_entity(spark, unit="W", source="recorder"):
    base = basic_metadata(meta(spark, [(1, "sensor.a", source, unit)]))
    return qa.with_limits(ent.filter_entities(base))


def test_a_second_pass_corrects_nothing(spark):
    once = judged(spark, CASES).filter("status <> 'invalid'")
    kept = once.select("id", "metadata_id", "start_ts", "table_rank", "value", "mean",
                       "min_value", "max_value", "sum_value")
    base = meta(spark, [(i, f"sensor.s{i}", c[1], c[0]) for i, c in enumerate(CASES)])
    entities = qa.with_limits(ent.filter_entities(basic_metadata(base)))
    again = qa.validate(rd.match_entities(kept, entities))
    assert again.filter("status <> 'valid' OR n_issues > 0").count() == 0


def test_time_bounds(spark):
    times = ["2020-01-01 00:00:00", "2030-01-01 00:00:00", "2019-12-31 23:59:59",
             "2030-01-01 00:00:01", None]
    rows = readings(spark, [(i, 1, t and at(t), 0, 5.0) for i, t in enumerate(times)])
    frame = qa.validate(rd.match_entities(rows, one_entity(spark)))
    got = {r.id: (r.status, r.invalid_reason) for r in frame.collect()}
    assert got == {0: ("valid", None), 1: ("valid", None), 2: ("invalid", "time"),
                   3: ("invalid", "time"), 4: ("invalid", "time")}


def test_a_nulled_field_leaves_the_record_valid(spark):
    rows = readings(spark, [
        (1, 1, at("2024-01-01 00:00:00"), 0, -5.0, 7.0),
        (2, 1, at("2024-01-01 01:00:00"), 0, None, None, None, None, 3.0),
        (3, 1, at("2024-01-01 02:00:00"), 0, None, None, None, None, None),
    ])
    frame = qa.with_point_flag(qa.validate(rd.match_entities(rows, one_entity(spark))))
    got = {r.id: (r.status, r.n_nulled, r.has_point) for r in frame.collect()}
    # Only sum left: a valid record without a point.
    assert got == {1: ("valid", 1, True), 2: ("valid", 0, False), 3: ("invalid", 0, False)}


def test_metrics_add_up(spark):
    rows = readings(spark, [
        (1, 1, at("2024-01-01 00:00:00"), 0, -5.0),  # invalid, still claims its key
        (2, 1, at("2024-01-01 00:00:00"), 0, 5.0),  # copy
        (3, 1, at("2024-01-01 00:00:00"), 1, 5.0),  # copy in the other table
        (4, 1, at("2024-01-01 01:00:00"), 1, 5.0),
        (5, 2, at("2024-01-01 00:00:00"), 0, 5.0),  # unmatched
    ])
    checked = qa.validate(rd.match_entities(rows, one_entity(spark)))
    judged = qa.judge_all(rd.first_readings(rows), one_entity(spark))
    got = {r.table_rank: r for r in qa.processing_metrics(judged).collect()}
    assert (got[0].total_records, got[0].valid_records, got[0].validation_failures,
            got[0].unmatched_records, got[0].skipped_records) == (3, 0, 2, 1, 3)
    assert (got[1].total_records, got[1].valid_records, got[1].validation_failures) == (2, 1, 1)
    run = qa.run_summary(checked).first()
    assert (run.short_term_records, run.long_term_records, run.total_points) == (2, 2, 1)


def test_success_rate_without_readings(spark):
    none = readings(spark, [])
    checked = qa.validate(rd.match_entities(none, one_entity(spark)))
    assert qa.run_summary(checked).first().success_rate == 100.0
    judged = qa.judge_all(rd.first_readings(none), one_entity(spark))
    assert {r.success_rate for r in qa.processing_metrics(judged).collect()} == {100.0}


def test_unusual_values_guard_nan_and_missing_unit(spark):
    base = basic_metadata(meta(spark, [(1, "sensor.a", "tibber", None), (2, "sensor.b", "x", "kWh")]))
    rows = readings(spark, [
        (1, 1, DAY, 0, NAN), (2, 1, DAY, 0, 20000.0), (3, 2, DAY, 0, 20000.0), (4, 1, DAY, 0, 10000.0),
    ])
    found = qa.unusual_values(rd.match_raw(rows, ent.filter_entities(base)))
    assert [r.id for r in found.collect()] == [2]


def test_raw_scan_takes_the_first_match(spark):
    base = basic_metadata(meta(spark, [(1, "sensor.a", "x", "%"), (2, "sensor.b", "x", "kWh")]))
    rows = readings(spark, [
        (1, 1, DAY, 0, NAN), (2, 1, DAY, 0, -999999.0), (3, 1, DAY, 0, 101.0), (4, 1, DAY, 0, 100.0),
        (5, 2, DAY, 0, -1.0), (6, 1, DAY, 0, INF),
    ])
    found = qa.raw_issues(rd.match_raw(rows, ent.filter_entities(base))).collect()
    assert {r.id: r.issue_type for r in found} == {
        1: "NaN", 2: "Error", 3: "Percentage", 5: "Negative", 6: "Infinite",
    }


def test_bypass_lets_everything_but_nan_through(spark):
    rows = readings(spark, [(1, 1, at("1990-01-01 00:00:00"), 0, NAN, -5.0)])
    frame = qa.unvalidated(rd.match_entities(rows, one_entity(spark)))
    row = qa.with_point_flag(frame).first()
    assert (row.value, row.mean, row.has_point) == (None, -5.0, True)


@pytest.mark.parametrize("bad", [{"a": 1}])
def test_rules_are_frozen(bad):
    with pytest.raises(Exception):
        QualityRules().unit_range = bad
