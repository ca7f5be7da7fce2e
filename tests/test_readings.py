from __future__ import annotations

import random
import re

import pytest
from conftest import at
from frames import meta, readings

from meterloom.functions.time import epoch_of
from meterloom.operators import entities as ent
from meterloom.operators import quality as qa
from meterloom.operators import readings as rd
from meterloom.operators import sizing
from meterloom.operators.sizing import is_small
from meterloom.schemas import STATISTICS, STATISTICS_META
from meterloom.sources import tables
from meterloom.sources.tables import basic_metadata

T0 = at("2024-01-01 00:00:00")


def test_first_reading_wins_across_tables(spark):
    rows = readings(spark, [
        (9, 1, T0, 0, 1.0), (7, 1, T0, 1, 2.0), (8, 1, T0, 0, 3.0),
        (5, 1, at("2024-01-01 01:00:00"), 1, 4.0), (4, 1, at("2024-01-01 01:00:00"), 1, None, 6.0),
    ])
    got = {r.id: (r.table_rank, r.value, r.mean, r.n_short, r.n_long)
           for r in rd.first_readings(rows).collect()}
    # A null of the winning row stays null: fields never mix between copies.
    assert got == {8: (0, 3.0, None, 2, 1), 4: (1, None, 6.0, 0, 2)}
    per_table = {r.id for r in rd.first_readings(rows, scope="table").collect()}
    assert per_table == {8, 7, 4}


def test_unknown_scope(spark):
    with pytest.raises(ValueError):
        rd.first_readings(readings(spark, []), scope="day")


def test_invalid_first_row_suppresses_a_later_good_one(spark):
    base = basic_metadata(meta(spark, [(1, "sensor.a", "x", "W")]))
    rows = readings(spark, [(1, 1, T0, 0, -5.0), (2, 1, T0, 0, 5.0)])
    frame = qa.validate(rd.match_entities(rows, qa.with_limits(ent.filter_entities(base))))
    assert [(r.id, r.status) for r in frame.collect()] == [(1, "invalid")]


def _skewed(spark):
    """A third of all readings belong to entity 0, another third are copies of one key."""
    rng = random.Random(7)
    rows = [(i, 0, at(f"2024-01-{1 + i % 28:02d} {i % 24:02d}:00:00"), i % 2, float(i)) for i in range(400)]
    rows += [(1000 + i, 3, T0, i % 2, float(i)) for i in range(400)]
    rows += [(2000 + i, rng.randrange(1, 9), at(f"2024-01-{1 + i % 28:02d} 00:00:00"), 1, 1.0)
             for i in range(400)]
    return rows


def test_dedup_against_brute_force_with_hot_keys(spark):
    rows = _skewed(spark)
    best = {}
    for r in rows:
        key = (r[1], r[2])
        if key not in best or (r[3], r[0]) < (best[key][3], best[key][0]):
            best[key] = r
    got = {(r.metadata_id, r.start_ts): (r.table_rank, r.id, r.value)
           for r in rd.first_readings(readings(spark, rows)).collect()}
    assert got == {k: (r[3], r[0], r[4]) for k, r in best.items()}


def test_both_match_strategies_agree(spark):
    base = basic_metadata(meta(spark, [(i, f"sensor.s{i}", "x", "W") for i in range(6)]))
    entities, frame = ent.filter_entities(base), readings(spark, _skewed(spark))
    broadcast = rd.match_entities(frame, entities, small=True, candidates=entities)
    shuffled = rd.match_entities(frame, entities, small=False)
    cols = ["metadata_id", "start_ts", "id", "statistic_id", "n_short", "n_long"]
    assert sorted(broadcast.select(cols).collect()) == sorted(shuffled.select(cols).collect())


def test_aqe_splits_a_hot_entity_in_the_shuffled_match(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(60000).selectExpr(
            "id", "if(id % 3 = 0, 1L, id % 500) AS metadata_id",
            "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT)) AS start_ts",
            "0 AS table_rank", "CAST(id AS DOUBLE) AS value", "1D AS mean", "1D AS min_value",
            "1D AS max_value", "1D AS sum_value")
        entities = spark.range(500).selectExpr("id", "concat('sensor.', id) AS statistic_id", "'x' AS source")
        matched = rd.match_entities(hot.repartition(16), entities, small=False)
        assert matched.count() == 60000
        rows = matched.collect()
        plan = matched._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 60000
        assert "skew=true" in plan
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_plan_has_one_shuffle_of_the_readings_and_hash_aggregates(spark):
    base = basic_metadata(meta(spark, [(i, f"sensor.s{i}", "x", "W") for i in range(6)]))
    entities = qa.with_limits(ent.filter_entities(base))
    frame = qa.validate(rd.match_entities(readings(spark, _skewed(spark)), entities, True, entities))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SortAggregate" not in plan and "Window" not in plan


def test_top_n_per_group_is_cut_before_the_shuffle(spark):
    base = ent.filter_entities(basic_metadata(meta(spark, [(1, "sensor.a", "x", "W")])))
    plan = ent.category_samples(base)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_gaps_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for e in range(4):
        day = 1
        for i in range(60):
            rows.append((i, e, at(f"2024-0{1 + i // 25}-{1 + rng.randrange(27):02d} "
                                  f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:00"), 0, 1.0))
    want = {}
    for e in range(4):
        ts = sorted({r[2] for r in rows if r[1] == e})
        steps = [int((b - a).total_seconds()) for a, b in zip(ts, ts[1:])]
        wide = [s for s in steps if s > 7200]
        want[e] = (len(ts), len(wide), max(wide))
    got = {r.metadata_id: (r.n_readings, r.n_gaps, r.longest_gap_s)
           for r in rd.gaps(readings(spark, rows), 7200).collect()}
    assert got == want


def test_gaps_deal_few_readings_to_a_task_and_skip_copies(spark, monkeypatch):
    """The tasks follow the number of readings, not the shuffle partitions of the session."""
    monkeypatch.setattr(sizing, "ROWS_PER_TASK", 100, raising=False)
    rows = [(i, i % 50, at(f"2024-01-{1 + i % 27:02d} 00:00:00"), 0, 1.0) for i in range(1350)]
    rows += [(9000 + i, None, at(f"2024-01-0{1 + 2 * (i % 2)} 00:00:00"), 1, 1.0) for i in range(6)]
    rows += [(9100, 7, None, 0, 1.0)]
    found = rd.gaps(readings(spark, rows), -1)
    assert found.rdd.getNumPartitions() == 14
    got = {r.metadata_id: (r.n_readings, r.n_gaps, r.longest_gap_s) for r in found.collect()}
    assert got == {None: (2, 1, 172800), **{e: (27, 26, 86400) for e in range(50)}}


def test_range_is_half_open_and_the_empty_id_list_filters_nothing(spark):
    rows = readings(spark, [(i, i, at(f"2024-01-0{i} 00:00:00"), 0) for i in range(1, 5)])
    kept = rd.between(rows, "2024-01-02 00:00:00", "2024-01-04 00:00:00")
    assert sorted(r.id for r in kept.collect()) == [2, 3]
    assert rd.of_entities(rows, None).count() == 4
    some = rows.filter("id = 1").select("id")
    assert rd.of_entities(rows, some).count() == 1


def test_scan_pushes_range_and_prunes_columns(spark, tmp_path):
    root = str(tmp_path)
    first = epoch_of("2024-01-01 00:00:00")
    rows = [(i, 0.0, 1, first + 0.5 + i, 1.0, None, None, None, None, 2.0, 3.0) for i in range(10)]
    for name in ("statistics", "statistics_short_term"):
        spark.createDataFrame(rows, STATISTICS).write.parquet(f"{root}/{name}.parquet")
    spark.createDataFrame([], STATISTICS_META).write.parquet(f"{root}/statistics_meta.parquet")
    available = tables.parquet_tables(spark, root)
    assert set(available) == {"statistics", "statistics_short_term", "statistics_meta"}
    inputs = tables.open_inputs(available)
    assert inputs.attributes is None and inputs.short_term.count() == 10
    late = tables.open_inputs(available, start="2024-01-01 00:00:07")
    assert late.short_term.count() == late.long_term.count() == 3
    scanned = tables.scan_readings(
        available, "statistics", "2024-01-01 00:00:03", "2024-01-01 00:00:05"
    )
    assert [str(r.start_ts) for r in scanned.orderBy("id").collect()] == [
        "2024-01-01 00:00:03.500000", "2024-01-01 00:00:04.500000",
    ]
    plan = scanned.select("metadata_id", "value")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start_ts" in plan and "LessThan(start_ts" in plan
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert schema == "struct<metadata_id:bigint,start_ts:double,state:double>"


def test_input_contract(spark):
    with pytest.raises(ValueError, match="required tables missing"):
        tables.open_inputs({})
    with pytest.raises(ValueError, match="not a readings table"):
        tables.scan_readings({}, "states")
    with pytest.raises(ValueError, match="lacks columns"):
        tables.scan_readings({"statistics": lambda: spark.range(1)}, "statistics")


def test_nan_epoch_is_null(spark):
    row = (1, 0.0, 1, float("nan"), 1.0, None, None, None, None, 2.0, 3.0)
    df = tables.scan_readings({"statistics": lambda: spark.createDataFrame([row], STATISTICS)}, "statistics")
    assert df.first().start_ts is None


def test_size_check_reads_a_bounded_number_of_rows(spark):
    assert is_small(spark.range(10), 10)
    assert not is_small(spark.range(11), 10)
