from __future__ import annotations

import pytest
from frames import meta

from meterloom.operators import entities as ent
from meterloom.rules import EntityRules
from meterloom.sources import driver_tables as dt
from meterloom.sources.tables import basic_metadata

CASES = [
    # statistic_id, source, unit, category, reason
    ("sensor.a", "recorder", "kWh", "energy", "Included as energy"),
    ("sensor.b", "recorder", "W", "power", "Included as power"),
    ("sensor.c", "recorder", "°F", "temperature", "Included as temperature"),
    ("sensor.d", "recorder", "%", "percentage", "Included as percentage"),
    ("sensor.e", "recorder", "V", "electrical", "Included as electrical"),
    ("sensor.f", "recorder", "MB/s", "network", "Included as network"),
    ("sensor.g", "recorder", "mbar", "pressure", "Included as pressure"),
    ("sensor.h", "recorder", "ppm", "special", "Included as special"),
    ("sensor.i", "recorder", None, "excluded", "Excluded by filter patterns or unsupported unit"),
    ("sensor.j", "recorder", "EUR", "excluded", "Excluded by filter patterns or unsupported unit"),
    # A special source wins over unit and name pattern, but a status word still rejects it.
    ("sensor.price", "tibber", None, "special", "Included as special"),
    ("sensor.Status_x", "tibber", "W", "special", "Status indicator: status"),
    # Patterns are substrings of the lower-cased id.
    ("sensor.DISCONNECTED", "recorder", "W", "excluded",
     "Excluded by filter patterns or unsupported unit"),
    ("sensor.x_online", "recorder", "W", "power", "Status indicator: online"),
    ("sensor.x_rssi_online", "recorder", "W", "power", "Status indicator: online"),
    # The id is checked before everything else, the domain is case-sensitive.
    ("nodot", "tibber", "W", "special", "Invalid entity ID format"),
    ("switch.a", "recorder", "W", "power", "Domain 'switch' not in include list"),
    ("Sensor.a", "recorder", "W", "power", "Domain 'Sensor' not in include list"),
    ("sensor.a.b", "recorder", "W", "power", "Included as power"),
]


@pytest.fixture(scope="module")
def decided(spark):
    rows = [(i, sid, src, unit) for i, (sid, src, unit, _, _) in enumerate(CASES)]
    return ent.decide(basic_metadata(meta(spark, rows))).cache()


def test_category_and_reason(decided):
    got = {r.id: (r.category, r.reason) for r in decided.collect()}
    assert got == {i: (c, why) for i, (_, _, _, c, why) in enumerate(CASES)}


def test_filter_keeps_what_decide_includes(spark, decided):
    base = basic_metadata(meta(spark, [(i, a, b, c) for i, (a, b, c, _, _) in enumerate(CASES)]))
    kept = ent.filter_entities(base)
    want = {(r.id, r.reason) for r in decided.collect() if r.included}
    assert {(r.id, r.reason) for r in kept.collect()} == want


def test_aggregation_by_category(decided):
    got = {r.category: (r.aggregation_method, r.aggregation_window) for r in decided.collect()}
    assert got["energy"] == got["special"] == ("last", "1h")
    assert got["network"] == got["power"] == ("mean", "1h")
    assert got["excluded"] == (None, None)


def test_summary_has_zero_categories_and_null_rate_without_entities(spark, decided):
    only = decided.filter("id IN (0, 9)")
    row = ent.filter_summary(only).first()
    assert (row.total_entities, row.included_entities, row.energy, row.power) == (2, 1, 1, 0)
    assert row.inclusion_rate == 50.0
    assert ent.filter_summary(decided.filter("false")).first().inclusion_rate is None


def test_empty_categories_stay_in_the_groups(decided):
    groups = ent.by_category(decided.filter("included AND category = 'energy'").drop("included"))
    rows = groups.collect()
    assert {r.category for r in rows if r.id is None} == {
        "power", "temperature", "percentage", "electrical", "network", "pressure", "special",
    }


def test_unit_breakdown_ignores_domain_and_status(decided):
    rows = ent.unit_breakdown(decided.select("statistic_id", "source", "unit_of_measurement"))
    got = {(r.is_excluded, r.unit): r.n_entities for r in rows.collect()}
    assert got[(False, "no unit")] == 1
    assert got[(True, "no unit")] == 1
    # switch.a, Sensor.a, nodot and the status words count as included here.
    assert got[(False, "W")] == 8


def test_empty_pattern_is_refused():
    with pytest.raises(ValueError):
        EntityRules(exclude_patterns=("%",))


def test_name_filter_is_case_insensitive(decided):
    assert {r.id for r in ent.named_like(decided, "Disc").collect()} == {12}


def test_the_text_id_of_the_driver_tables_is_made_once_per_row(spark, sf_dir):
    """Put in the place of every mention in the filters, it made a method too long to be compiled."""
    kept = ent.filter_entities(basic_metadata(dt.statistics_meta(spark, sf_dir)))
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("replace(p_name") == 1
