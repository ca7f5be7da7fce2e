from __future__ import annotations

from frames import meta

from meterloom.operators import metadata as md
from meterloom.schemas import STATE_ATTRIBUTES, STATES, STATES_META

META = [
    (1, "sensor.a_b", "recorder", "W"),
    (2, "sensor.c", "recorder", "W"),
    (3, "sensor.d", "recorder", "W"),
    (4, "sensor.e", "recorder", "W"),
    (5, "sensor.f", "recorder", "W"),
    (6, "sensor.g", "recorder", "W"),
]


def attributes(spark):
    states_meta = spark.createDataFrame([(10 + i, sid) for i, sid, _, _ in META], STATES_META)
    states = spark.createDataFrame(
        [
            (11, 100, 1.0), (11, 101, 5.0), (11, None, 9.0),  # newest without attributes
            (12, 102, 5.0), (12, 103, 5.0),  # tie: the higher id
            (13, 104, None), (13, 105, None),  # no times at all
            (14, 106, 1.0),
            (15, 107, 1.0),
        ],
        STATES,
    )
    sets = spark.createDataFrame(
        [
            (100, '{"friendly_name":"old"}'),
            (101, '{"friendly_name":"new","device_class":"power"}'),
            (102, '{"friendly_name":"low"}'),
            (103, '{"friendly_name":"high"}'),
            (105, '{"friendly_name":""}'),
            (106, '{"friendly_name":"T","state_class":"timestamp"}'),
            (107, '{not json'),
        ],
        STATE_ATTRIBUTES,
    )
    return states_meta, states, sets


def test_full_mode(spark):
    rows = md.enriched(meta(spark, META), attributes(spark)).collect()
    got = {r.id: r.friendly_name for r in rows}
    # 3 has only states without a time, 4 is a timestamp entity, 5 has malformed JSON, 6 has no states.
    assert got == {1: "new", 2: "high", 3: "d", 5: "f", 6: "g"}
    assert {r.id: r.device_class for r in rows}[1] == "power"


def test_latest_mode_replaces_the_empty_name(spark):
    got = {r.id: r.friendly_name for r in
           md.enriched_latest(meta(spark, META), attributes(spark)).collect()}
    assert got == {1: "new", 2: "high", 3: "d", 5: "f", 6: "g"}


def test_latest_mode_keeps_the_highest_id(spark):
    twice = META + [(9, "sensor.a_b", "other", "kWh")]
    rows = md.enriched_latest(meta(spark, twice), attributes(spark)).collect()
    (row,) = [r for r in rows if r.statistic_id == "sensor.a_b"]
    assert (row.id, row.source, row.unit_of_measurement, row.friendly_name) == (
        9, "other", "kWh", "new",
    )


def test_latest_mode_does_not_multiply_a_twice_listed_entity(spark):
    sm, st, sets = attributes(spark)
    again = sm.unionByName(spark.createDataFrame([(99, "sensor.c")], STATES_META))
    rows = md.enriched_latest(meta(spark, META), (again, st, sets)).collect()
    assert len([r for r in rows if r.statistic_id == "sensor.c"]) == 1


def test_without_attribute_tables(spark):
    base = meta(spark, META[:1])
    assert md.enriched(base, None).first().friendly_name == "sensor.a_b"
    assert md.enriched_latest(base, None).first().friendly_name == "a b"


def test_malformed_texts_are_counted(spark):
    row = md.malformed_attributes(attributes(spark)[2]).first()
    assert (row.malformed, row.total) == (1, 7)


def test_only_repeated_names_lose_the_prefix(spark):
    base = meta(spark, [(1, "weather.sensor.sensor.x_y", "recorder", "W")])
    assert md.enriched_latest(base, None).first().friendly_name == "weather.x y"


def test_latest_attributes_are_hash_aggregates(spark):
    for untimed in (False, True):
        latest = md.latest_attributes(attributes(spark)[1], untimed)
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "Join" not in plan
        got = {r.metadata_id: r.attributes_id for r in latest.collect()}
        assert (13 in got) == untimed


def test_the_attribute_text_is_parsed_once(spark):
    plan = md.entity_attributes(attributes(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1 and "get_json_object" not in plan


def test_listed_ids_may_repeat(spark):
    ids = spark.createDataFrame([(1,)] * 50 + [(2,), (None,), (77,)], "metadata_id long")
    assert sorted(r.id for r in md.by_ids(meta(spark, META), ids, "metadata_id").collect()) == [1, 2]
