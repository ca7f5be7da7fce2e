"""The registered queries as plain SQL over the driver tables, written another way than the
Spark plans: window numbering instead of aggregates, one branch per rule instead of one pass."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

# Each fragment may use those above it.
_FRAGMENTS = {
    "meta": """
        SELECT p_partkey AS id,
          (CASE WHEN p_partkey % 41 = 0 THEN '' WHEN p_partkey % 8 = 4 THEN 'counter.'
                WHEN p_partkey % 8 = 5 THEN 'weather.' WHEN p_partkey % 8 = 6 THEN 'climate.'
                WHEN p_partkey % 8 = 7 THEN 'switch.' ELSE 'sensor.' END)
          || replace(p_name, ' ', '_')
          || (CASE p_size WHEN 2 THEN '_Status' WHEN 3 THEN '_rssi' WHEN 4 THEN '_online' ELSE '' END)
          || '_' || p_partkey AS statistic_id,
          CASE WHEN p_brand = 'Brand#7' THEN 'tibber' ELSE 'recorder' END AS source,
          CASE p_size % 16 WHEN 0 THEN 'kWh' WHEN 1 THEN 'W' WHEN 2 THEN '°C' WHEN 3 THEN '°F'
            WHEN 4 THEN '%' WHEN 5 THEN 'A' WHEN 6 THEN 'V' WHEN 7 THEN 'kB/s' WHEN 8 THEN 'GB'
            WHEN 9 THEN 'MB' WHEN 10 THEN 'hPa' WHEN 11 THEN 'bar' WHEN 12 THEN 'mbar'
            WHEN 13 THEN 'lux' WHEN 14 THEN 'EUR' END AS unit_of_measurement,
          p_size % 2 = 0 AS has_mean, p_size % 3 = 0 AS has_sum, p_name AS name,
          CAST(1 AS INTEGER) AS mean_type, p_type AS unit_class
        FROM part""",
    "short_term": """
        SELECT event_id AS id, user_id AS metadata_id,
          CASE WHEN event_id % 113 = 0 THEN time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 10 YEAR
               ELSE time_bucket(INTERVAL 5 MINUTE, ts) END AS start_ts,
          0 AS table_rank,
          CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 101 = 0 THEN -999999::DOUBLE
               WHEN event_id % 103 = 0 THEN 999999::DOUBLE WHEN event_id % 107 = 0 THEN NULL
               WHEN event_id % 109 = 0 THEN 'Infinity'::DOUBLE WHEN event_id % 5 = 0 THEN -value
               ELSE value END AS value,
          value AS mean, value - 10 AS min_value, value + 10 AS max_value, value * 100 AS sum_value
        FROM events""",
    "long_term": """
        SELECT 1000000000 + min(event_id) AS id, user_id AS metadata_id,
          date_trunc('hour', ts) AS start_ts, 1 AS table_rank, NULL::DOUBLE AS value,
          round(avg(value), 6) AS mean, min(value) AS min_value, max(value) AS max_value,
          NULL::DOUBLE AS sum_value
        FROM events GROUP BY user_id, date_trunc('hour', ts)
        UNION ALL
        SELECT 2000000000 + l_orderkey * 10 + l_linenumber, l_partkey,
          l_shipdate + INTERVAL 24 YEAR, 1, NULL, l_quantity, NULL, NULL, l_extendedprice
        FROM lineitem""",
    "readings": "SELECT * FROM short_term UNION ALL SELECT * FROM long_term",
    "states": """
        SELECT user_id AS metadata_id, event_id AS attributes_id, ts AS last_updated_ts
        FROM events WHERE event_id % 10 <> 0""",
    "attribute_sets": """
        SELECT event_id AS attributes_id,
          CASE event_id % 4 WHEN 0 THEN '{"device_class":"' || event_type || '"}'
            WHEN 1 THEN '{"friendly_name":"","state_class":"measurement"}'
            ELSE '{"friendly_name":"Device ' || user_id || '","device_class":"' || event_type
              || '","state_class":"'
              || (CASE WHEN event_id % 6 = 2 THEN 'timestamp' ELSE 'measurement' END) || '"}'
          END AS shared_attrs
        FROM events""",
    "latest": """
        SELECT metadata_id, attributes_id FROM (
          SELECT *, row_number() OVER (PARTITION BY metadata_id
            ORDER BY last_updated_ts DESC, attributes_id DESC) AS n FROM states)
        WHERE n = 1""",
    "attributes": """
        SELECT latest.metadata_id,
          json_extract_string(shared_attrs, '$.friendly_name') AS attr_name,
          json_extract_string(shared_attrs, '$.device_class') AS device_class,
          json_extract_string(shared_attrs, '$.state_class') AS state_class
        FROM latest JOIN attribute_sets USING (attributes_id)""",
    "rich_meta": """
        SELECT meta.*,
          coalesce(attr_name, replace(replace(statistic_id, 'sensor.', ''), '_', ' '))
            AS friendly_name, device_class, state_class
        FROM meta LEFT JOIN attributes ON meta.id = attributes.metadata_id
        WHERE state_class IS DISTINCT FROM 'timestamp'""",
    "categorised": """
        SELECT *, CASE WHEN source = 'tibber' THEN 'special'
          WHEN lower(statistic_id) LIKE '%availability%' OR lower(statistic_id) LIKE '%status%'
            OR lower(statistic_id) LIKE '%signal%' OR lower(statistic_id) LIKE '%connected%'
            THEN 'excluded'
          WHEN unit_of_measurement = 'kWh' THEN 'energy'
          WHEN unit_of_measurement = 'W' THEN 'power'
          WHEN unit_of_measurement IN ('°C', '°F') THEN 'temperature'
          WHEN unit_of_measurement = '%' THEN 'percentage'
          WHEN unit_of_measurement IN ('A', 'V') THEN 'electrical'
          WHEN unit_of_measurement IN ('kB/s', 'MB/s', 'GB', 'MB') THEN 'network'
          WHEN unit_of_measurement IN ('hPa', 'bar', 'mbar') THEN 'pressure'
          WHEN unit_of_measurement IN ('lux', 'ppm', 'dB', 'rpm') THEN 'special'
          ELSE 'excluded' END AS category
        FROM meta""",
    "decided": """
        SELECT *, reason LIKE 'Included%' AS included FROM (
          SELECT *, CASE WHEN NOT contains(statistic_id, '.') THEN 'Invalid entity ID format'
            WHEN split_part(statistic_id, '.', 1)
              NOT IN ('sensor', 'counter', 'weather', 'climate', 'utility_meter')
              THEN 'Domain ''' || split_part(statistic_id, '.', 1) || ''' not in include list'
            WHEN category = 'excluded' THEN 'Excluded by filter patterns or unsupported unit'
            WHEN contains(lower(statistic_id), 'availability') THEN 'Status indicator: availability'
            WHEN contains(lower(statistic_id), 'status') THEN 'Status indicator: status'
            WHEN contains(lower(statistic_id), 'connected') THEN 'Status indicator: connected'
            WHEN contains(lower(statistic_id), 'online') THEN 'Status indicator: online'
            WHEN contains(lower(statistic_id), 'signal') THEN 'Status indicator: signal'
            WHEN contains(lower(statistic_id), 'rssi') THEN 'Status indicator: rssi'
            ELSE 'Included as ' || category END AS reason
          FROM categorised)""",
    "entities": "SELECT * FROM decided WHERE included",
    "rich_entities": """
        SELECT entities.*, rich_meta.friendly_name, rich_meta.device_class
        FROM entities JOIN rich_meta USING (id)""",
    "category_list": """
        SELECT unnest(['energy', 'power', 'temperature', 'percentage', 'electrical', 'network',
          'pressure', 'special']) AS category""",
    "unit_limits": """
        SELECT * FROM (VALUES ('°C', -50::DOUBLE, 80::DOUBLE), ('W', 0, 50000), ('kWh', 0, NULL),
          ('%', 0, 100), ('V', 0, 500), ('A', 0, 1000), ('kB/s', 0, 1000000), ('MB/s', 0, 1000),
          ('GB', 0, 10000), ('MB', 0, 10000000), ('hPa', 800, 1200), ('bar', 0.8, 1.2))
          AS t(limit_unit, low, high)""",
    "first_readings": """
        SELECT * FROM (
          SELECT r.*, e.statistic_id, e.unit_of_measurement, e.category,
            row_number() OVER (PARTITION BY r.metadata_id, r.start_ts
              ORDER BY r.table_rank, r.id) AS copy,
            count(*) FILTER (WHERE r.table_rank = 0)
              OVER (PARTITION BY r.metadata_id, r.start_ts) AS n_short,
            count(*) FILTER (WHERE r.table_rank = 1)
              OVER (PARTITION BY r.metadata_id, r.start_ts) AS n_long
          FROM readings r JOIN entities e ON r.metadata_id = e.id)
        WHERE copy = 1""",
    # One row per (first reading, field) with its issues; `hard` values take part in nothing else.
    "fields": """
        SELECT metadata_id, start_ts, table_rank, id, statistic_id, unit_of_measurement, category,
          unnest(['value', 'mean', 'min_value', 'max_value', 'sum_value']) AS field,
          unnest([value, mean, min_value, max_value, sum_value]) AS x
        FROM first_readings""",
    "field_hits": """
        SELECT f.*, low, high,
          isnan(x) OR isinf(x) OR x IN (-999999, 999999) AS hard,
          coalesce(x < low, false) AS below, coalesce(x > high, false) AS above,
          CASE WHEN category = 'energy' AND x < 0 THEN 'energy_negative'
            WHEN category = 'energy' AND x > 1000000 THEN 'energy_high'
            WHEN category = 'power' AND abs(x) > 100000 THEN 'power_high'
            WHEN category = 'percentage' AND (x < -5 OR x > 105) THEN 'percentage_range'
            WHEN category = 'temperature' AND (x < -100 OR x > 200) THEN 'temperature_range'
          END AS by_category
        FROM fields f LEFT JOIN unit_limits ON unit_of_measurement = limit_unit
        WHERE x IS NOT NULL""",
    "field_results": """
        SELECT *,
          CASE WHEN hard THEN 1 ELSE below::INT + above::INT + (by_category IS NOT NULL)::INT END
            AS n,
          CASE WHEN hard THEN NULL
            WHEN NOT below AND NOT above AND by_category IS NULL THEN x
            WHEN category = 'percentage' AND unit_of_measurement = '%' AND x < 0 THEN 0
            WHEN category = 'percentage' AND unit_of_measurement = '%' AND x > 100 THEN 100
            WHEN category = 'energy' AND x < 0 THEN 0 END AS fixed
        FROM field_hits""",
    "validated": """
        SELECT r.*, coalesce(start_ts BETWEEN TIMESTAMP '2020-01-01' AND TIMESTAMP '2030-01-01',
            false) AS time_ok,
          v_value, v_mean, v_min, v_max, v_sum, coalesce(issues, 0) AS issues,
          coalesce(moved, 0) AS moved, coalesce(nulled, 0) AS nulled
        FROM first_readings r LEFT JOIN (
          SELECT metadata_id, start_ts, max(fixed) FILTER (WHERE field = 'value') AS v_value,
            max(fixed) FILTER (WHERE field = 'mean') AS v_mean,
            max(fixed) FILTER (WHERE field = 'min_value') AS v_min,
            max(fixed) FILTER (WHERE field = 'max_value') AS v_max,
            max(fixed) FILTER (WHERE field = 'sum_value') AS v_sum,
            sum(n) AS issues, count(*) FILTER (WHERE fixed <> x) AS moved,
            count(*) FILTER (WHERE fixed IS NULL) AS nulled
          FROM field_results GROUP BY metadata_id, start_ts) f USING (metadata_id, start_ts)""",
    "judged": """
        SELECT *, CASE WHEN NOT time_ok OR nothing_left THEN 'invalid' WHEN moved > 0 THEN 'corrected'
            ELSE 'valid' END AS status,
          CASE WHEN NOT time_ok THEN 'time' WHEN nothing_left THEN 'no field' END AS invalid_reason,
          CASE WHEN time_ok THEN issues ELSE 0 END AS n_issues
        FROM (SELECT *, coalesce(v_value, v_mean, v_min, v_max, v_sum) IS NULL AS nothing_left
              FROM validated)""",
    "issue_rows": """
        SELECT metadata_id, statistic_id, start_ts, field, code,
          CASE code WHEN 'nan' THEN 'NaN values' WHEN 'infinite' THEN 'Infinite values'
            WHEN 'below_minimum' THEN 'Out of range values'
            WHEN 'above_maximum' THEN 'Out of range values'
            WHEN 'energy_negative' THEN 'Negative values (invalid for type)'
            WHEN 'sentinel_low' THEN 'Error sentinel values'
            WHEN 'sentinel_high' THEN 'Error sentinel values'
            ELSE 'Other validation issues' END AS issue_category, limit_value,
          CASE code WHEN 'nan' THEN 'Value is NaN' WHEN 'infinite' THEN 'Value is infinite'
            WHEN 'sentinel_low' THEN 'Value appears to be error sentinel (-999999)'
            WHEN 'sentinel_high' THEN 'Value appears to be error sentinel (999999)'
            WHEN 'below_minimum' THEN 'Value # below minimum # for unit ' || unit_of_measurement
            WHEN 'above_maximum' THEN 'Value # above maximum # for unit ' || unit_of_measurement
            WHEN 'energy_negative' THEN 'Energy value cannot be negative'
            WHEN 'energy_high' THEN 'Energy value seems unrealistically high'
            WHEN 'power_high' THEN 'Power value seems unrealistically high'
            WHEN 'percentage_range' THEN 'Percentage value outside reasonable range'
            WHEN 'temperature_range' THEN 'Temperature value outside physically reasonable range'
          END AS message
        FROM (
          SELECT *, CASE WHEN isnan(x) THEN 'nan' WHEN isinf(x) THEN 'infinite'
              WHEN x < 0 THEN 'sentinel_low' ELSE 'sentinel_high' END AS code,
            NULL::DOUBLE AS limit_value FROM field_hits WHERE hard
          UNION ALL
          SELECT *, 'below_minimum', low FROM field_hits WHERE NOT hard AND below
          UNION ALL
          SELECT *, 'above_maximum', high FROM field_hits WHERE NOT hard AND above
          UNION ALL
          SELECT *, by_category, NULL FROM field_hits WHERE NOT hard AND by_category IS NOT NULL)
        WHERE start_ts BETWEEN TIMESTAMP '2020-01-01' AND TIMESTAMP '2030-01-01'""",
    "points": """
        SELECT coalesce(r.unit_of_measurement, split_part(r.statistic_id, '.', 1) || '_data')
            AS measurement,
          substr(r.statistic_id, position('.' IN r.statistic_id) + 1) AS entity_id,
          split_part(r.statistic_id, '.', 1) AS domain, r.category, r.unit_of_measurement AS unit,
          'migration' AS source, nullif(e.friendly_name, '') AS friendly_name, e.device_class,
          coalesce(v_value, v_mean) AS value, date_trunc('second', start_ts) AS ts,
          CASE table_rank WHEN 0 THEN 'recent' ELSE 'historical' END AS store, metadata_id
        FROM judged r JOIN rich_entities e ON r.metadata_id = e.id
        WHERE status <> 'invalid' AND coalesce(v_value, v_mean) IS NOT NULL""",
    "recent": """
        SELECT measurement, entity_id, domain, category, unit, source, friendly_name, device_class,
          value, ts FROM points WHERE store = 'recent'""",
    "historical": """
        SELECT measurement, entity_id, domain, category, unit, source, friendly_name, device_class,
          value, ts FROM points WHERE store = 'historical'""",
    "raw_fields": """
        SELECT r.table_rank, r.metadata_id, e.statistic_id, e.unit_of_measurement, r.start_ts, r.id,
          unnest(['value', 'mean', 'min_value', 'max_value', 'sum_value']) AS field,
          unnest([value, mean, min_value, max_value, sum_value]) AS x
        FROM readings r JOIN entities e ON r.metadata_id = e.id""",
    "raw_issues": """
        SELECT *, CASE WHEN isnan(x) THEN 'NaN' WHEN isinf(x) THEN 'Infinite'
          WHEN x = -999999 OR x = 999999 THEN 'Error'
          WHEN unit_of_measurement = '%' AND (x < 0 OR x > 100) THEN 'Percentage'
          WHEN unit_of_measurement = '°C' AND (x < -50 OR x > 80) THEN 'Temperature'
          WHEN unit_of_measurement = 'kWh' AND x < 0 THEN 'Negative' END AS issue_type
        FROM raw_fields WHERE x IS NOT NULL""",
    "progress": """
        SELECT user_id AS metadata_id,
          unnest(['statistics_short_term', 'statistics']) AS source_table,
          unnest([0, 1]) AS table_rank,
          CASE WHEN user_id % 3 = 0 THEN 'completed'
            WHEN user_id % 3 = 1 AND user_id % 7 = 0 THEN 'failed' ELSE 'running' END AS status,
          min(ts) + INTERVAL 10 DAY AS last_start_ts
        FROM events GROUP BY user_id""",
    "mixed": """
        SELECT * REPLACE (CASE length(entity_id) % 3 WHEN 0 THEN NULL WHEN 1 THEN 'live'
          ELSE source END AS source) FROM historical""",
}

_SERIES = "measurement, entity_id, domain, category, unit, source, friendly_name, device_class"
_UNUSED_TAGS = ", ".join(
    f"NULL::VARCHAR AS {t}"
    for t in ("category", "unit", "source", "friendly_name", "device_class")
)


def _hourly(fn: str, source: str, condition: str) -> str:
    value = {"last": "arg_max(value, ts)", "mean": "avg(value)", "max": "max(value)"}[fn]
    return (
        f"SELECT {_SERIES}, round({value}, 6) AS value,"
        f" date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts FROM {source} WHERE {condition}"
        f" GROUP BY {_SERIES}, date_trunc('hour', ts)"
    )


def _rollup(source: str, condition: str = "true") -> str:
    """One branch per rule; the counter branch replaces the unit branches of the same series."""
    no_counter = f"({condition}) AND domain <> 'counter'"
    means = (
        "'W','kW','°C','°F','hPa','bar','mbar','%','A','V','mA','mV','lux','ppm','dB','rpm',"
        "'kB/s','MB/s'"
    )
    return " UNION ALL ".join(
        (
            _hourly("last", source, f"{no_counter} AND measurement IN ('kWh', 'Wh')"),
            _hourly("last", source, f"{no_counter} AND measurement IN ('GB', 'MB')"),
            _hourly("mean", source, f"{no_counter} AND measurement IN ({means})"),
            _hourly("max", source, f"({condition}) AND domain = 'counter'"),
            f"SELECT domain || '_data' AS measurement, NULL::VARCHAR AS entity_id, domain,"
            f" {_UNUSED_TAGS}, round(avg(value), 6) AS value,"
            f" date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts FROM {source}"
            f" WHERE ({condition}) AND measurement LIKE '%\\_data' ESCAPE '\\'"
            f" GROUP BY domain, date_trunc('hour', ts)",
        )
    )


_BARE_READING = (
    "id, metadata_id, start_ts, table_rank, mean, min_value, max_value, sum_value,"
    " CASE WHEN NOT isnan(value) AND NOT isinf(value) THEN value END AS value,"
    " CASE WHEN isnan(value) THEN 'nan' WHEN isinf(value) THEN 'inf' END AS value_note"
)
_EXPORTED = "SELECT store, measurement, domain, entity_id, value, ts FROM points"
_PROFILE = """
    SELECT store, count(*) AS total_points,
      count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31')
        AS points_30d,
      count(DISTINCT entity_id) AS n_entities, min(ts) AS first_ts, max(ts) AS last_ts
    FROM points GROUP BY store"""


def _sampled(column: str, source: str, order: str, keep: str = "") -> str:
    """The first three entities per group and how many more there are."""
    return f"""
        SELECT {column}, CAST(position AS INTEGER) AS position, statistic_id{keep},
          greatest(total - 3, 0) AS n_more
        FROM (SELECT *, row_number() OVER (PARTITION BY {column} ORDER BY {order}) AS position,
                count(*) OVER (PARTITION BY {column}) AS total FROM ({source}))
        WHERE position <= 3"""


def _issue_types(source: str) -> str:
    return f"""
        SELECT table_rank, issue_type, count(*) AS n_issues,
          count(DISTINCT statistic_id) AS n_entities
        FROM {source} WHERE issue_type IS NOT NULL GROUP BY table_rank, issue_type"""


def _sample_report(sample: str) -> str:
    """Raw issues of a sample of readings."""
    return _issue_types(
        f"(SELECT i.* FROM raw_issues i JOIN ({sample}) s ON i.table_rank = s.table_rank"
        " AND i.id = s.id AND i.metadata_id = s.metadata_id AND i.start_ts = s.start_ts)"
    )


def _first_5000(table: str, condition: str) -> str:
    return (
        f"(SELECT table_rank, id, metadata_id, start_ts FROM {table} WHERE {condition}"
        " ORDER BY metadata_id, start_ts, id LIMIT 5000)"
    )


_CHOSEN = "metadata_id IN (SELECT id FROM entities)"

_WORST = """
    SELECT *, row_number() OVER (PARTITION BY table_rank ORDER BY n_issues DESC, statistic_id)
      AS place
    FROM (SELECT table_rank, statistic_id, unit_of_measurement, count(*) AS n_issues
          FROM raw_issues WHERE issue_type IS NOT NULL GROUP BY 1, 2, 3)"""

# Query -> final statement over the fragments.
#: The first day that a run in steps of one day, killed in the third, does not write.
_THIRD_DAY = """
    SELECT day FROM (
      SELECT DISTINCT CAST(date_trunc('day', start_ts) AS TIMESTAMP) AS day
      FROM short_term JOIN rich_entities ON metadata_id = rich_entities.id
      WHERE start_ts BETWEEN TIMESTAMP '2020-01-01' AND TIMESTAMP '2030-01-01')
    ORDER BY day LIMIT 1 OFFSET 2"""

_QUERIES = {
    "entity_metadata_basic": """
        SELECT *, name AS friendly_name, NULL::VARCHAR AS device_class,
          NULL::VARCHAR AS state_class FROM meta""",
    "entity_metadata_enriched": "SELECT * FROM rich_meta",
    "entity_metadata_latest": """
        SELECT * REPLACE (coalesce(nullif(friendly_name, ''),
            replace(replace(statistic_id, 'sensor.', ''), '_', ' ')) AS friendly_name)
        FROM rich_meta WHERE id IN (SELECT max(id) FROM meta GROUP BY statistic_id)""",
    "latest_attribute_ids": "SELECT * FROM latest",
    "attribute_lookup": """
        SELECT statistic_id AS entity_id, attr_name AS friendly_name, device_class, state_class
        FROM entities LEFT JOIN attributes ON entities.id = attributes.metadata_id""",
    "metadata_by_ids": "SELECT * FROM meta WHERE id IN (SELECT user_id FROM events)",
    "attribute_health": """
        SELECT count(*) FILTER (WHERE NOT json_valid(shared_attrs)) AS malformed, count(*) AS total
        FROM attribute_sets""",
    "entity_categories": """
        SELECT id, statistic_id, category,
          CASE WHEN category IN ('energy', 'special') THEN 'last'
            WHEN category <> 'excluded' THEN 'mean' END AS aggregation_method,
          CASE WHEN category <> 'excluded' THEN '1h' END AS aggregation_window
        FROM categorised""",
    "entity_inclusion": "SELECT id, statistic_id, category, included, reason FROM decided",
    "entity_ids": "SELECT id FROM entities",
    "entity_filter_summary": """
        SELECT count(*) AS total_entities, count(*) FILTER (WHERE included) AS included_entities,
          count(*) FILTER (WHERE NOT included) AS excluded_entities,
          count(*) FILTER (WHERE included AND category = 'energy') AS energy,
          count(*) FILTER (WHERE included AND category = 'power') AS power,
          count(*) FILTER (WHERE included AND category = 'temperature') AS temperature,
          count(*) FILTER (WHERE included AND category = 'percentage') AS percentage,
          count(*) FILTER (WHERE included AND category = 'electrical') AS electrical,
          count(*) FILTER (WHERE included AND category = 'network') AS network,
          count(*) FILTER (WHERE included AND category = 'pressure') AS pressure,
          count(*) FILTER (WHERE included AND category = 'special') AS special,
          round(100.0::DOUBLE * count(*) FILTER (WHERE included) / nullif(count(*), 0), 6)
            AS inclusion_rate
        FROM decided""",
    "entity_category_breakdown": """
        SELECT category, count(id) AS n_entities FROM category_list LEFT JOIN entities USING (category)
        GROUP BY category""",
    "entity_category_groups": """
        SELECT category, id, statistic_id, unit_of_measurement
        FROM category_list LEFT JOIN entities USING (category)""",
    "entity_category_samples": _sampled(
        "category",
        "SELECT *, coalesce(unit_of_measurement, 'no unit') AS unit FROM entities",
        "statistic_id, id",
        ", unit",
    ),
    "entity_name_filter": """
        SELECT id, statistic_id, category FROM entities WHERE statistic_id ILIKE '%ring%'""",
    "unit_breakdown": """
        SELECT is_excluded, unit, n_entities FROM (
          SELECT *, row_number() OVER (PARTITION BY is_excluded ORDER BY n_entities DESC, unit) AS n
          FROM (SELECT category = 'excluded' AS is_excluded,
                  coalesce(nullif(unit_of_measurement, ''), 'no unit') AS unit,
                  count(*) AS n_entities
                FROM categorised GROUP BY ALL))
        WHERE NOT is_excluded OR n <= 10""",
    "entity_summary": """
        SELECT 'total' AS section, 'entities' AS label, count(*) AS n FROM meta
        UNION ALL SELECT 'total', 'long_term_records', count(*) FROM long_term
        UNION ALL SELECT 'total', 'short_term_records', count(*) FROM short_term
        UNION ALL SELECT 'unit_of_measurement', unit_of_measurement, count(*) FROM meta GROUP BY 2
        UNION ALL SELECT 'source', source, count(*) FROM meta GROUP BY 2""",
    "readings_short_term": f"SELECT {_BARE_READING} FROM short_term",
    "readings_range": f"""
        SELECT {_BARE_READING} FROM readings
        WHERE start_ts >= TIMESTAMP '2024-01-10' AND start_ts < TIMESTAMP '2024-01-20'
          AND {_CHOSEN}""",
    "readings_epoch_scan": f"""
        SELECT {_BARE_READING} FROM readings
        WHERE start_ts >= TIMESTAMP '2024-01-05' AND start_ts < TIMESTAMP '2024-01-25'""",
    "readings_count": f"""
        SELECT table_rank, count(*) AS n_readings, 'all' AS scope FROM readings GROUP BY 1
        UNION ALL
        SELECT table_rank, count(*), 'filtered entities' FROM readings WHERE {_CHOSEN} GROUP BY 1""",
    "readings_time_range": """
        SELECT table_rank, min(start_ts) AS first_ts, max(start_ts) AS last_ts FROM readings
        GROUP BY 1""",
    "readings_dedup": """
        SELECT metadata_id, start_ts, table_rank, id, n_short, n_long FROM first_readings""",
    "readings_dedup_per_table": f"""
        SELECT metadata_id, start_ts, table_rank, id,
          CASE table_rank WHEN 0 THEN copies ELSE 0 END AS n_short,
          CASE table_rank WHEN 1 THEN copies ELSE 0 END AS n_long
        FROM (SELECT *,
            row_number() OVER (PARTITION BY metadata_id, start_ts, table_rank ORDER BY id) AS copy,
            count(*) OVER (PARTITION BY metadata_id, start_ts, table_rank) AS copies
          FROM readings WHERE {_CHOSEN})
        WHERE copy = 1""",
    "gap_report": """
        SELECT metadata_id, count(*) AS n_readings,
          count(*) FILTER (WHERE step > 86400) AS n_gaps,
          max(step) FILTER (WHERE step > 86400) AS longest_gap_s
        FROM (SELECT metadata_id, date_diff('second', lag(start_ts) OVER (
                PARTITION BY metadata_id ORDER BY start_ts), start_ts) AS step
              FROM (SELECT DISTINCT metadata_id, start_ts FROM readings))
        GROUP BY metadata_id""",
    "readings_validated": """
        SELECT metadata_id, start_ts, table_rank, id, v_value AS value, v_mean AS mean,
          v_min AS min_value, v_max AS max_value, v_sum AS sum_value, status, invalid_reason,
          CAST(n_issues AS INTEGER) AS n_issues, CAST(moved AS INTEGER) AS n_corrected,
          CAST(nulled AS INTEGER) AS n_nulled
        FROM judged""",
    "processing_metrics": f"""
        SELECT table_rank, total_records, valid_records, corrected_records,
          total_records - valid_records AS skipped_records,
          matched - valid_records AS validation_failures,
          total_records - matched AS unmatched_records,
          CAST(issues AS BIGINT) AS n_issues, CAST(nulled AS BIGINT) AS n_nulled,
          round(100.0::DOUBLE * valid_records / total_records, 6) AS success_rate
        FROM (SELECT table_rank, count(*) AS total_records,
                count(*) FILTER (WHERE {_CHOSEN}) AS matched FROM readings GROUP BY 1)
        JOIN (SELECT table_rank, count(*) FILTER (WHERE status <> 'invalid') AS valid_records,
                count(*) FILTER (WHERE status = 'corrected') AS corrected_records,
                sum(n_issues) AS issues, sum(nulled) AS nulled
              FROM judged GROUP BY 1) USING (table_rank)""",
    "issue_details": """
        SELECT metadata_id, start_ts, field, code, issue_category, limit_value, message
        FROM issue_rows""",
    "issue_breakdown": """
        SELECT issue_category, count(*) AS n_issues, count(DISTINCT statistic_id) AS n_entities
        FROM issue_rows GROUP BY 1""",
    "issue_entity_samples": _sampled(
        "issue_category", "SELECT DISTINCT issue_category, statistic_id FROM issue_rows", "statistic_id"
    ),
    "issue_sample": _issue_types("raw_issues"),
    "issue_sample_unfiltered": _issue_types("raw_issues"),
    "issue_sample_first_5000": _sample_report(
        f"{_first_5000('short_term', _CHOSEN)} UNION ALL {_first_5000('long_term', _CHOSEN)}"
    ),
    "issue_sample_unfiltered_first_5000": _sample_report(
        f"{_first_5000('short_term', 'true')} UNION ALL {_first_5000('long_term', 'true')}"
    ),
    "validation_report": _issue_types("raw_issues"),
    "validation_samples": _sampled(
        "issue_type",
        "SELECT DISTINCT issue_type, statistic_id FROM raw_issues WHERE issue_type IS NOT NULL",
        "statistic_id",
    ),
    "validation_overview": f"""
        SELECT table_rank, n_readings, n_entities, n_issues FROM
          (SELECT table_rank, count(*) AS n_readings FROM readings WHERE {_CHOSEN} GROUP BY 1)
          JOIN (SELECT table_rank, count(DISTINCT statistic_id) AS n_entities, count(*) AS n_issues
                FROM raw_issues WHERE issue_type IS NOT NULL GROUP BY 1) USING (table_rank)""",
    "worst_offenders": f"""
        SELECT table_rank, statistic_id, unit_of_measurement, n_issues,
          CAST(place AS INTEGER) AS place FROM ({_WORST}) WHERE place <= 5""",
    "worst_offender_examples": f"""
        SELECT table_rank, statistic_id, CAST(position AS INTEGER) AS position, start_ts, field,
          issue_type, CASE WHEN NOT isnan(x) AND NOT isinf(x) THEN x END AS raw_value
        FROM (SELECT *, row_number() OVER (PARTITION BY table_rank, statistic_id
                ORDER BY start_ts, id, list_position(
                  ['value', 'mean', 'min_value', 'max_value', 'sum_value'], field)) AS position
              FROM raw_issues JOIN ({_WORST}) w USING (table_rank, statistic_id)
              WHERE issue_type IS NOT NULL AND place <= 5)
        WHERE position <= 3""",
    "unusual_values": """
        SELECT table_rank, metadata_id, start_ts, id, field,
          CASE WHEN NOT isinf(x) THEN x END AS raw_value, isinf(x) AS is_infinite
        FROM raw_fields WHERE x IS NOT NULL AND NOT isnan(x) AND abs(x) > 10000
          AND (unit_of_measurement IS NULL OR unit_of_measurement NOT IN ('kWh', 'GB', 'MB'))""",
    "points_recent": "SELECT * FROM recent",
    "points_historical": "SELECT * FROM historical",
    "points_skipped": """
        SELECT store, count(*) AS n_readings, count(*) FILTER (WHERE usable) AS n_points,
          count(*) FILTER (WHERE NOT usable) AS n_skipped
        FROM (SELECT CASE table_rank WHEN 0 THEN 'recent' ELSE 'historical' END AS store,
                e.id IS NOT NULL AND (coalesce(isfinite(value), false)
                  OR coalesce(isfinite(mean), false)) AS usable
              FROM readings r LEFT JOIN entities e ON r.metadata_id = e.id)
        GROUP BY store""",
    "points_named": """
        SELECT 'sensor_data' AS measurement, unit, count(*) AS n_points FROM recent GROUP BY unit""",
    "category_export": "SELECT * FROM historical WHERE category IN ('energy', 'power')",
    "export_unvalidated": """
        SELECT CASE table_rank WHEN 0 THEN 'recent' ELSE 'historical' END AS store,
          coalesce(r.unit_of_measurement, split_part(r.statistic_id, '.', 1) || '_data')
            AS measurement, split_part(r.statistic_id, '.', 1) AS domain,
          substr(r.statistic_id, position('.' IN r.statistic_id) + 1) AS entity_id,
          CASE WHEN isfinite(value) THEN value ELSE mean END AS value, start_ts AS ts
        FROM first_readings r JOIN rich_entities e ON r.metadata_id = e.id
        WHERE CASE WHEN isfinite(value) THEN value ELSE mean END IS NOT NULL""",
    "time_range_export": f"""
        {_EXPORTED} WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
    "export_summary": f"""
        SELECT CAST(short AS BIGINT) AS short_term_records, CAST(long AS BIGINT) AS long_term_records,
          short + long AS total_records, recent_points, historical_points,
          recent_points + historical_points AS total_points, corrected AS data_corrections,
          short + long - valid AS data_quality_issues,
          round(100.0::DOUBLE * valid / (short + long), 6) AS success_rate
        FROM (SELECT count(*) FILTER (WHERE table_rank = 0) AS short,
                count(*) FILTER (WHERE table_rank = 1) AS long FROM readings WHERE {_CHOSEN}),
          (SELECT count(*) FILTER (WHERE status <> 'invalid') AS valid,
             count(*) FILTER (WHERE status = 'corrected') AS corrected,
             count(*) FILTER (WHERE status <> 'invalid' AND table_rank = 0
               AND coalesce(v_value, v_mean) IS NOT NULL) AS recent_points,
             count(*) FILTER (WHERE status <> 'invalid' AND table_rank = 1
               AND coalesce(v_value, v_mean) IS NOT NULL) AS historical_points
           FROM judged)""",
    "resume_remaining": """
        SELECT id, statistic_id, category FROM entities
        WHERE id NOT IN (SELECT metadata_id FROM progress WHERE status = 'completed')""",
    "progress_table": """
        SELECT metadata_id, source_table,
          CASE WHEN status = 'running' THEN 'completed' ELSE status END AS status, last_start_ts,
          CASE WHEN status = 'running' THEN TIMESTAMP '2024-01-12' ELSE TIMESTAMP '2024-01-11' END
            AS recorded_at
        FROM progress""",
    "rollup_hourly": _rollup("recent"),
    "rollup_counter_max": _rollup("recent", "domain = 'counter'"),
    "rollup_domain_fallback": _rollup("points", r"measurement LIKE '%\_data' ESCAPE '\'"),
    "rollup_by_category": f"""
        SELECT {_SERIES}, round(CASE WHEN category IN ('energy', 'special')
            THEN arg_max(value, ts) ELSE avg(value) END, 6) AS value, date_trunc('hour', ts) AS ts
        FROM recent GROUP BY {_SERIES}, date_trunc('hour', ts)""",
    "rollup_without_rule": r"""
        SELECT measurement, count(*) AS n_points FROM points
        WHERE domain <> 'counter' AND NOT measurement LIKE '%\_data' ESCAPE '\'
          AND measurement NOT IN ('kWh','Wh','GB','MB','W','kW','°C','°F','hPa','bar','mbar','%',
            'A','V','mA','mV','lux','ppm','dB','rpm','kB/s','MB/s')
        GROUP BY 1""",
    "lifecycle_flow": f"""
        WITH rolled AS ({_rollup("recent", "ts < TIMESTAMP '2024-01-16'")})
        SELECT 'recent' AS store, {_SERIES}, round(value, 6) AS value, ts FROM recent
        WHERE ts >= TIMESTAMP '2024-01-11'
        UNION ALL SELECT 'historical', {_SERIES}, value, ts FROM rolled
        UNION ALL SELECT 'historical', {_SERIES}, round(value, 6), ts FROM historical h
        WHERE NOT EXISTS (SELECT 1 FROM rolled r WHERE r.ts = h.ts
          AND r.entity_id = h.entity_id AND r.domain = h.domain AND r.measurement = h.measurement)""",
    "lifecycle_catch_up": f"""
        WITH rolled AS ({_rollup("recent", "ts < TIMESTAMP '2024-03-21'")})
        SELECT 'recent' AS store, {_SERIES}, round(value, 6) AS value, ts FROM recent
        WHERE ts >= TIMESTAMP '2024-01-21'
        UNION ALL SELECT 'historical', {_SERIES}, value, ts FROM rolled
        UNION ALL SELECT 'historical', {_SERIES}, round(value, 6), ts FROM historical h
        WHERE NOT EXISTS (SELECT 1 FROM rolled r WHERE r.ts = h.ts
          AND r.entity_id = h.entity_id AND r.domain = h.domain AND r.measurement = h.measurement)""",
    "export_resumed": f"SELECT store, {_SERIES}, round(value, 6) AS value, ts FROM points",
    "export_resumed_incremental": f"SELECT store, {_SERIES}, round(value, 6) AS value, ts FROM points",
    "export_killed_points": f"""
        SELECT 'recent' AS store, {_SERIES}, round(value, 6) AS value, ts FROM recent
        WHERE ts < ({_THIRD_DAY})""",
    "export_killed_progress": f"""
        WITH seen AS (
          SELECT 'statistics_short_term' AS source_table, metadata_id, start_ts,
            start_ts < ({_THIRD_DAY}) AS written FROM short_term
          UNION ALL SELECT 'statistics', metadata_id, start_ts, false FROM long_term
        ), valid AS (
          SELECT * FROM seen
          WHERE start_ts BETWEEN TIMESTAMP '2020-01-01' AND TIMESTAMP '2030-01-01'
        )
        SELECT e.id AS metadata_id, t.source_table,
          CASE WHEN coalesce(bool_and(written), true) THEN 'completed' ELSE 'failed' END AS status,
          max(start_ts) FILTER (written) AS last_start_ts
        FROM rich_entities e
        CROSS JOIN (SELECT unnest(['statistics_short_term', 'statistics']) AS source_table) t
        LEFT JOIN valid v ON v.metadata_id = e.id AND v.source_table = t.source_table
        GROUP BY e.id, t.source_table""",
    "incremental_scans": """
        SELECT r.table_rank, r.id, r.metadata_id, r.start_ts
        FROM (SELECT * FROM short_term UNION ALL SELECT * FROM long_term) r
        JOIN entities e ON r.metadata_id = e.id
        LEFT JOIN progress p ON r.metadata_id = p.metadata_id AND r.table_rank = p.table_rank
        WHERE p.last_start_ts IS NULL
          OR r.start_ts > least(p.last_start_ts, TIMESTAMP '2024-01-20')""",
    # The watermark closes the hours that end an hour or more before the latest point.
    "rollup_stream": f"""
        SELECT * FROM ({_rollup("recent")})
        WHERE ts <= (SELECT max(ts) - INTERVAL 1 HOUR FROM recent)""",
    # Keys that end an hour or more before the latest reading are closed.
    "dedup_stream": """
        WITH streamed AS (
          SELECT metadata_id, start_ts, 0 AS table_rank, id, value FROM short_term WHERE id % 3 <> 0
          UNION ALL SELECT metadata_id, start_ts, 1, id, value FROM short_term WHERE id % 2 = 0
        )
        SELECT metadata_id, start_ts, CAST(table_rank AS INTEGER) AS table_rank, id, value,
          n_short, n_long
        FROM (SELECT *, row_number() OVER (PARTITION BY metadata_id, start_ts ORDER BY table_rank, id) AS n,
            count(*) FILTER (table_rank = 0) OVER (PARTITION BY metadata_id, start_ts) AS n_short,
            count(*) FILTER (table_rank = 1) OVER (PARTITION BY metadata_id, start_ts) AS n_long
          FROM streamed)
        WHERE n = 1 AND start_ts <= (SELECT max(start_ts) - INTERVAL 1 HOUR FROM streamed)""",
    "store_profile": _PROFILE,
    "store_size": f"""
        SELECT store, total_points, total_points * 150 AS size_bytes, days_span,
          round(total_points * 150 / 1048576.0::DOUBLE, 6) AS size_mb,
          CASE WHEN total_points * 150 / 1048576.0::DOUBLE > 1024
            THEN round(total_points * 150 / 1073741824.0::DOUBLE, 6) END AS size_gb,
          CASE WHEN days_span > 0 THEN round(total_points / days_span::DOUBLE, 6) END
            AS points_per_day
        FROM (SELECT *, CAST(date_diff('second', first_ts, last_ts) // 86400 AS BIGINT) AS days_span
              FROM ({_PROFILE}))""",
    "store_measurements": "SELECT DISTINCT store, measurement FROM points",
    "store_fields": "SELECT DISTINCT store, 'value' AS field FROM points",
    "store_times": "SELECT ts FROM recent",
    "store_first_last": f"""
        SELECT {_SERIES}, min(ts) AS first_ts, arg_min(value, ts) AS first_value,
          max(ts) AS last_ts, arg_max(value, ts) AS last_value
        FROM historical GROUP BY {_SERIES}""",
    "store_sample_size": f"""
        SELECT count(*) AS all_points, count(*) FILTER (WHERE n <= 1000) AS sample_points FROM (
          SELECT row_number() OVER (PARTITION BY {_SERIES} ORDER BY ts) AS n FROM recent
          WHERE ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31')""",
    "store_series_limit": f"""
        SELECT {_SERIES}, value, ts FROM (
          SELECT *, row_number() OVER (PARTITION BY {_SERIES} ORDER BY ts) AS n FROM historical)
        WHERE n <= 3""",
    "store_preview": f"""
        SELECT entity_id, measurement, value, ts FROM (
          SELECT *, row_number() OVER (PARTITION BY {_SERIES} ORDER BY ts) AS n FROM recent
          WHERE ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31')
        WHERE n <= 10 ORDER BY entity_id, measurement, domain, ts LIMIT 10""",
    "store_retention": "SELECT * FROM recent WHERE ts >= TIMESTAMP '2024-01-11'",
    "store_delete_migrated": """
        SELECT * FROM mixed WHERE source IS DISTINCT FROM 'migration'
          OR ts > TIMESTAMP '2030-12-31 23:59:59' OR ts < TIMESTAMP '1970-01-01'""",
    "store_delete_counts": """
        SELECT count(*) FILTER (WHERE source = 'migration') AS n_before,
          count(*) FILTER (WHERE source = 'migration' AND ts <= TIMESTAMP '2030-12-31 23:59:59')
            AS n_deleted,
          count(*) FILTER (WHERE source = 'migration' AND ts > TIMESTAMP '2030-12-31 23:59:59')
            AS n_after
        FROM mixed""",
    "unified_timeline": f"""
        WITH rolled AS ({_rollup("recent")}),
        hist AS (
          SELECT {_SERIES}, ts, value FROM rolled
          UNION ALL
          SELECT {_SERIES}, ts, round(value, 6) FROM historical h WHERE NOT EXISTS (
            SELECT 1 FROM rolled r WHERE r.ts = h.ts AND r.entity_id = h.entity_id
              AND r.domain = h.domain AND r.measurement = h.measurement))
        SELECT {_SERIES}, ts, round(value, 6) AS value FROM recent
        UNION ALL
        SELECT {_SERIES}, ts, value FROM hist h WHERE NOT EXISTS (
          SELECT 1 FROM recent r WHERE r.ts = h.ts AND r.entity_id = h.entity_id
            AND r.domain = h.domain AND r.measurement = h.measurement)""",
    "historical_dedup": f"""
        SELECT {_SERIES}, value, ts FROM (
          SELECT coalesce(e.unit_of_measurement, split_part(e.statistic_id, '.', 1) || '_data')
              AS measurement, substr(e.statistic_id, position('.' IN e.statistic_id) + 1)
              AS entity_id, split_part(e.statistic_id, '.', 1) AS domain, e.category,
            e.unit_of_measurement AS unit, 'migration' AS source, NULL::VARCHAR AS friendly_name,
            NULL::VARCHAR AS device_class, mean AS value, start_ts AS ts,
            row_number() OVER (PARTITION BY metadata_id, start_ts ORDER BY r.id DESC) AS n
          FROM long_term r JOIN entities e ON r.metadata_id = e.id WHERE mean IS NOT NULL)
        WHERE n = 1""",
}
_QUERIES["lifecycle_deltas"] = _QUERIES["lifecycle_catch_up"]
_ARRIVED = "(minute(ts) >= 10 OR ts < TIMESTAMP '2024-01-16')"
_QUERIES["rollup_late_points"] = f"""
    WITH rolled AS ({_rollup("recent", f"ts < TIMESTAMP '2024-01-21' AND {_ARRIVED}")})
    SELECT 'recent' AS store, {_SERIES}, round(value, 6) AS value, ts FROM recent WHERE {_ARRIVED}
    UNION ALL SELECT 'historical', {_SERIES}, value, ts FROM rolled
    UNION ALL SELECT 'historical', {_SERIES}, round(value, 6), ts FROM historical h
    WHERE NOT EXISTS (SELECT 1 FROM rolled r WHERE r.ts = h.ts
      AND r.entity_id = h.entity_id AND r.domain = h.domain AND r.measurement = h.measurement)"""
# The written deletion gives the same rows as the lazy one.
_QUERIES["store_delete_written"] = _QUERIES["store_delete_migrated"]
# Readings exported before take no part in the run, so the whole chain runs over the rest.
_RESTRICTED = {
    "incremental_export": (
        _EXPORTED,
        """SELECT r.* FROM (SELECT * FROM short_term UNION ALL SELECT * FROM long_term) r
           LEFT JOIN progress p ON r.metadata_id = p.metadata_id AND r.table_rank = p.table_rank
           WHERE p.last_start_ts IS NULL
             OR r.start_ts > least(p.last_start_ts, TIMESTAMP '2024-01-20')""",
    ),
}


def _uses(sql: str, names: Iterable[str]) -> Counter[str]:
    words = Counter(re.findall(r"\w+", sql))
    return Counter({n: words[n] for n in names if words[n]})


def _with_fragments(statement: str, overrides: dict[str, str] | None = None) -> str:
    """The statement with the fragments that it needs; those read more than once are computed
    once."""
    fragments = dict(_FRAGMENTS)
    if overrides:
        fragments["progress"] = fragments.pop("progress")
        ordered = {"progress": fragments["progress"], **fragments}
        fragments = {**ordered, **overrides}
    uses = _uses(statement, fragments)
    for name in reversed(fragments):
        if uses[name]:
            uses.update(_uses(fragments[name], fragments))
    parts = ", ".join(
        f"{name} AS {'MATERIALIZED ' if uses[name] > 1 else ''}({sql})"
        for name, sql in fragments.items()
        if uses[name]
    )
    return f"WITH {parts} SELECT * FROM ({statement})"


def oracle_statements() -> dict[str, str]:
    """Query name -> SQL. A streaming query has none."""
    statements = {name: _with_fragments(sql) for name, sql in _QUERIES.items()}
    for name, (sql, readings) in _RESTRICTED.items():
        statements[name] = _with_fragments(sql, {"readings": readings})
    return statements
