"""The input contract and what reaches the scans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterloom.operators import metadata as md
from meterloom.plans.catalogue import Sensors, query_functions
from meterloom.schemas import STATISTICS, STATISTICS_META
from meterloom.sources import driver_tables as dt
from meterloom.sources.tables import jdbc_options, open_inputs, require_columns


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["time_range_export", "readings_range"])
def test_a_range_is_pushed_to_both_fact_tables(spark, sf_dir, name):
    plan = _plan(query_functions()[name](spark, sf_dir))
    assert "GreaterThanOrEqual(ts," in plan
    assert "GreaterThanOrEqual(l_shipdate," in plan


def test_pushed_ranges_change_no_row(spark, sf_dir):
    s = Sensors(spark, sf_dir)
    for start, end in (("2024-01-10 00:30:00", "2024-01-20 00:02:00"), ("2014-01-05 00:00:00", "2014-02-01 00:00:00"), (None, "2023-01-01 00:00:00")):
        pushed = dt.inputs(spark, sf_dir).readings(start, end).drop("created_ts")
        plain = s.readings.drop("created_ts")
        if start:
            plain = plain.filter(F.col("start_ts") >= F.lit(start).cast("timestamp_ntz"))
        plain = plain.filter(F.col("start_ts") < F.lit(end).cast("timestamp_ntz"))
        assert pushed.exceptAll(plain).count() == plain.exceptAll(pushed).count() == 0


def test_types_are_part_of_the_contract(spark):
    rows = spark.createDataFrame([], STATISTICS)
    wrong = rows.withColumn("start_ts", F.col("start_ts").cast("string"))
    meta = spark.createDataFrame([], STATISTICS_META)
    with pytest.raises(ValueError, match="start_ts is string"):
        open_inputs({"statistics_meta": lambda: meta, "statistics": lambda: rows, "statistics_short_term": lambda: wrong})
    flags = meta.withColumn("has_mean", F.lit(1)).withColumn("id", F.lit(1))
    assert require_columns(flags, "statistics_meta", STATISTICS_META) is flags


def test_fact_tables_are_never_read_by_one_task():
    common = {"url": "jdbc:sqlite:x"}
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError, match="one task"):
        jdbc_options(common, {}, "statistics")
    assert jdbc_options(common, {"statistics": split}, "statistics")["partitionColumn"] == "id"
    assert "partitionColumn" not in jdbc_options(common, {"statistics": split}, "state_attributes")


def test_a_hot_id_in_the_list_is_collapsed_before_the_shuffle(spark, sf_dir):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        ids = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN 3L ELSE id END AS metadata_id")
        df = md.by_ids(dt.statistics_meta(spark, sf_dir), ids, "metadata_id")
        assert "partial" in _plan(df) or "HashAggregate" in _plan(df)
        assert df.filter("id = 3").count() == 1
    finally:
        spark.conf.set(threshold, before)


def test_metrics_read_each_fact_table_once(spark, sf_dir):
    df = query_functions()["processing_metrics"](spark, sf_dir)
    plan = _plan(df)
    # events feed both the short-term table and the hourly part of the long-term one.
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("events.parquet") == 2


def test_worst_examples_read_each_fact_table_once(spark, sf_dir):
    plan = _plan(query_functions()["worst_offender_examples"](spark, sf_dir))
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("events.parquet") == 2
