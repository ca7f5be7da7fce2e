"""The star-schema test tables mapped onto the sensor inputs.

Every frame is derived by Spark from the whole table, so its size follows the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.sql import lit
from meterloom.functions.time import in_range, ntz
from meterloom.schemas import LONG_TERM, SHORT_TERM
from meterloom.sources.tables import Inputs, working_readings

UNITS = (
    "kWh", "W", "°C", "°F", "%", "A", "V", "kB/s", "GB", "MB", "hPa", "bar", "mbar", "lux", "EUR",
)


# Stated rather than inferred: inference is a job of its own per table.
SCHEMAS = {
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def statistics_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = ", ".join(lit(u) for u in UNITS)
    # Generated, so that the text is made once per entity: a plain expression would be put in the
    # place of every mention in the filters, and that code is too long to be compiled.
    named = table(spark, sf_dir, "part").selectExpr(
        "*",
        """explode(array(concat(
             if(p_partkey % 41 = 0, '', coalesce(get(
               array('counter.', 'weather.', 'climate.', 'switch.'),
               CAST(p_partkey % 8 AS INT) - 4), 'sensor.')),
             replace(p_name, ' ', '_'),
             coalesce(get(array('_Status', '_rssi', '_online'), p_size - 2), ''),
             '_', p_partkey))) AS statistic_id""",
    )
    return named.selectExpr(
        "p_partkey AS id",
        "statistic_id",
        "CASE WHEN p_brand = 'Brand#7' THEN 'tibber' ELSE 'recorder' END AS source",
        f"get(array({units}), p_size % 16) AS unit_of_measurement",
        "p_size % 2 = 0 AS has_mean",
        "p_size % 3 = 0 AS has_sum",
        "p_name AS name",
        "1 AS mean_type",
        "p_type AS unit_class",
    )


_UNUSED = "CAST(NULL AS DOUBLE) AS {}"


def _raw(df: DataFrame, **columns: str) -> DataFrame:
    """Fill the readings columns that a mapping leaves out with nulls."""
    names = ("created_ts", "mean_weight", "last_reset_ts", "state", "min", "max", "sum")
    given = [f"{sql} AS {name}" for name, sql in columns.items()]
    return df.selectExpr(*given, *[_UNUSED.format(n) for n in names if n not in columns])


def short_term_of(events: DataFrame) -> DataFrame:
    """Also usable on a stream of events."""
    slotted = events.selectExpr(
        "event_id", "user_id", "value", "window(ts, '5 minutes').start AS slot"
    )
    raw = _raw(
        slotted,
        id="event_id",
        metadata_id="user_id",
        start_ts="CASE WHEN event_id % 113 = 0 THEN slot - INTERVAL 10 YEAR ELSE slot END",
        state="""CASE WHEN event_id % 97 = 0 THEN double('NaN')
                      WHEN event_id % 101 = 0 THEN -999999D
                      WHEN event_id % 103 = 0 THEN 999999D
                      WHEN event_id % 107 = 0 THEN NULL
                      WHEN event_id % 109 = 0 THEN double('Infinity')
                      WHEN event_id % 5 = 0 THEN -value
                      ELSE value END""",
        mean="value",
        min="value - 10",
        max="value + 10",
        sum="value * 100",
    )
    return working_readings(raw, SHORT_TERM)


def short_term(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """A range is implied on the raw time with room for the slot and the shifted rows, so that
    it reaches the scan, and holds exactly on the derived one."""
    events = table(spark, sf_dir, "events")
    if start is not None:
        # A slot starts before its event, and shifted rows lie ten years earlier.
        events = events.filter(f"ts >= {ntz(start)}")
    if end is not None:
        late = f"{ntz(end)} + INTERVAL 5 MINUTES"
        events = events.filter(f"ts < {late} + INTERVAL 10 YEARS")
        events = events.filter(f"ts < {late} OR event_id % 113 = 0")
    return short_term_of(events).filter(in_range("start_ts", start, end))


def long_term(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    events, lines = table(spark, sf_dir, "events"), table(spark, sf_dir, "lineitem")
    if start is not None:
        # Hours are kept whole: an event belongs to the hour that starts at most an hour before.
        events = events.filter(f"ts >= {ntz(start)}")
        lines = lines.filter(f"l_shipdate >= {ntz(start)} - INTERVAL 24 YEAR")
    if end is not None:
        events = events.filter(f"ts < {ntz(end)} + INTERVAL 1 HOUR")
        lines = lines.filter(f"l_shipdate <= {ntz(end)} - INTERVAL 24 YEAR + INTERVAL 1 DAY")
    return _long_term_of(events, lines).filter(in_range("start_ts", start, end))


def _long_term_of(events: DataFrame, lines: DataFrame) -> DataFrame:
    hourly = (
        events
        .groupBy("user_id", F.window("ts", "1 hour").alias("hour"))
        .agg(
            F.min("event_id").alias("first_event"),
            F.avg("value").alias("mean"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )
    from_events = _raw(
        hourly,
        id="1000000000 + first_event",
        metadata_id="user_id",
        start_ts="hour.start",
        mean="round(mean, 6)",
        min="lowest",
        max="highest",
    )
    from_lines = _raw(
        lines,
        id="2000000000 + l_orderkey * 10 + l_linenumber",
        metadata_id="l_partkey",
        start_ts="l_shipdate + INTERVAL 24 YEAR",
        mean="l_quantity",
        sum="l_extendedprice",
    )
    return working_readings(from_events.unionByName(from_lines), LONG_TERM)


def states_meta_of(meta: DataFrame) -> DataFrame:
    return meta.selectExpr("id AS metadata_id", "statistic_id AS entity_id")


def states_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "user_id AS metadata_id",
        "CASE WHEN event_id % 10 <> 0 THEN event_id END AS attributes_id",
        "ts AS last_updated_ts",
    )


def state_attributes_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS attributes_id",
        """CASE event_id % 4
             WHEN 0 THEN concat('{"device_class":"', event_type, '"}')
             WHEN 1 THEN '{"friendly_name":"","state_class":"measurement"}'
             ELSE concat('{"friendly_name":"Device ', user_id,
                         '","device_class":"', event_type, '","state_class":"',
                         CASE WHEN event_id % 6 = 2 THEN 'timestamp' ELSE 'measurement' END,
                         '"}') END AS shared_attrs""",
    )


def attribute_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    meta = statistics_meta(spark, sf_dir)
    return states_meta_of(meta), states_of(events), state_attributes_of(events)


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        statistics_meta=statistics_meta(spark, sf_dir),
        short_term=short_term(spark, sf_dir),
        long_term=long_term(spark, sf_dir),
        attributes=attribute_tables(spark, sf_dir),
        scan=lambda name, start, end: (short_term if name == SHORT_TERM else long_term)(
            spark, sf_dir, start, end
        ),
    )
