"""The registered queries in SQL, written independently of the operators."""

from __future__ import annotations

from gaugeworks.plans.queries import DAY, SENSOR

READINGS = """
readings AS (
  SELECT event_id AS ingest_seq, CAST(user_id AS VARCHAR) AS sensor_id, ts AS time,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN value END AS pm25,
         CASE WHEN event_type IN ('purchase', 'error') THEN value END AS no2,
         props AS sensor_name
  FROM events)"""

RAW = READINGS + """,
raw AS (
  SELECT ingest_seq, sensor_id, strftime(time, '%Y-%m-%dT%H:%M:%S.%g') AS time,
         CAST(pm25 AS VARCHAR) AS pm25, CAST(no2 AS VARCHAR) AS no2, sensor_name,
         CASE WHEN ingest_seq % 7 <> 0 THEN CAST(ingest_seq % 100 AS VARCHAR) END AS humidity,
         CASE WHEN ingest_seq % 5 <> 0 THEN (ingest_seq % 40) || '.5' END AS temp,
         printf('41.%03d', ingest_seq % 1000) AS lat, printf('-87.%03d', ingest_seq % 1000) AS lon,
         printf('POINT (-87.%03d 41.%03d)', ingest_seq % 1000, ingest_seq % 1000) AS location
  FROM readings)"""

CELLS = RAW + """,
cells AS (
  SELECT ingest_seq, replace(sensor_id || '_' || time, ':', '_') AS rowkey, pm25, no2,
         humidity, temp, lat, lon, location, nullif(sensor_name, '') AS sensor_name, sensor_id AS datasourceid, time
  FROM raw)"""

ALL_CELLS = ("pm25", "no2", "humidity", "temp", "lat", "lon", "location", "sensor_name", "datasourceid", "time")


def last_value(column: str, condition: str = "TRUE") -> str:
    return f"arg_max({column}, ingest_seq) FILTER (WHERE {column} IS NOT NULL AND {condition})"


KEYED = CELLS + f""",
keyed AS (SELECT rowkey, {', '.join(f'{last_value(c)} AS {c}' for c in ALL_CELLS)} FROM cells GROUP BY rowkey)"""

EXPORT = "rowkey, pm25, no2, humidity, temp, lat, lon, location, sensor_name, datasourceid, time"

DAILY_CELLS = RAW + """,
daily_cells AS (
  SELECT ingest_seq, sensor_id || '_' || left(time, 10) AS rowkey, pm25, no2, sensor_name,
         sensor_id AS datasourceid, left(time, 10) AS time, humidity, temp, lat, lon, location
  FROM raw)"""

FURTHER = ("humidity", "temp", "lat", "lon", "location")
# The row key without a day in one place: readings without no2 have it in the id, the others in the time.
CONFLICTS = RAW + """,
conflicts AS (
  SELECT ingest_seq, sensor_id || '_' || left(time, 10) || '_' || time[12:13] AS rowkey, pm25, no2, sensor_name,
         CASE WHEN no2 IS NULL THEN sensor_id || '_' || left(time, 10) ELSE sensor_id END AS datasourceid,
         CASE WHEN no2 IS NULL THEN time[12:13] ELSE left(time, 10) || '_' || time[12:13] END AS time,
         left(time, 10) AS day, humidity, temp, lat, lon, location
  FROM raw)"""

DIRTY = RAW + """,
dirty AS (
  SELECT ingest_seq,
         CASE WHEN ingest_seq % 20 = 6 THEN '' ELSE sensor_id END AS sensor_id,
         CASE ingest_seq % 20 WHEN 5 THEN 'not a time at all' WHEN 7 THEN '' WHEN 9 THEN left(time, 4) || 'x' ELSE time END AS time,
         CASE ingest_seq % 20 WHEN 4 THEN 'abc' WHEN 10 THEN '' ELSE coalesce(pm25, '') END AS pm25,
         CASE ingest_seq % 20 WHEN 4 THEN '1,5' WHEN 10 THEN '' ELSE coalesce(no2, '') END AS no2,
         replace(CASE WHEN ingest_seq % 20 = 8 THEN 'a, b, ' ELSE '' END || sensor_name, '"', chr(39)) AS sensor_name,
         coalesce(humidity, '') AS humidity, coalesce(temp, '') AS temp, lat, lon, location
  FROM raw WHERE ingest_seq % 20 NOT IN (0, 3))"""

DIRTY_READINGS = DIRTY.replace("readings AS (", "all_readings AS (").replace("FROM readings)", "FROM all_readings)") + """,
readings AS (
  SELECT ingest_seq, sensor_id, time, TRY_CAST(pm25 AS DOUBLE) AS pm25, TRY_CAST(no2 AS DOUBLE) AS no2,
         pm25 AS pm25_text, no2 AS no2_text
  FROM dirty)"""

STATS = READINGS + """,
stats AS (
  SELECT coalesce(avg(pm25), 0) AS pm25_mean, coalesce(stddev_samp(pm25), 0) AS pm25_std,
         coalesce(avg(no2), 0) AS no2_mean, coalesce(stddev_samp(no2), 0) AS no2_std
  FROM readings)"""

ANOMALIES = STATS + """,
anomalies AS (
  SELECT sensor_id, time, pm25, no2
  FROM readings, stats
  WHERE (pm25_std > 0 AND pm25 > pm25_mean + 2 * pm25_std)
     OR (no2_std > 0 AND no2 > no2_mean + 2 * no2_std))"""

SUMMARY = READINGS + """,
summary AS (
  SELECT sensor_id,
         avg(pm25) AS pm25_avg, min(pm25) AS pm25_min, max(pm25) AS pm25_max, count(pm25) AS pm25_count,
         avg(no2) AS no2_avg, min(no2) AS no2_min, max(no2) AS no2_max, count(no2) AS no2_count
  FROM readings GROUP BY sensor_id)"""

SUMMARY_COLUMNS = """sensor_id,
  round(pm25_avg, 10) AS pm25_avg, pm25_min, pm25_max, pm25_count,
  round(no2_avg, 10) AS no2_avg, no2_min, no2_max, no2_count"""

DAILY = READINGS + """,
daily AS (
  SELECT CAST(time AS DATE) AS date, round(avg(pm25), 10) AS pm25_avg, round(avg(no2), 10) AS no2_avg,
         count(*) AS records
  FROM readings GROUP BY 1)"""

ROLLING = READINGS + """,
rolling AS (
  SELECT sensor_id, time, round(avg(pm25) OVER w, 8) AS rolling_pm25_24h, round(avg(no2) OVER w, 8) AS rolling_no2_24h
  FROM readings
  WINDOW w AS (PARTITION BY sensor_id ORDER BY CAST(floor(epoch(time)) AS BIGINT)
               RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW))"""


def averages(key: str, name: str) -> str:
    return f"""{READINGS},
averages AS (
  SELECT {key} AS {name},
         coalesce(avg(pm25), 0) AS pm25_avg, count(pm25) AS pm25_count,
         coalesce(avg(no2), 0) AS no2_avg, count(no2) AS no2_count
  FROM readings WHERE pm25 IS NOT NULL OR no2 IS NOT NULL GROUP BY 1)"""


def averages_table(key: str, name: str) -> str:
    return f"""WITH {averages(key, name)}
SELECT {name}, round(pm25_avg, 10) AS pm25_avg, pm25_count, round(no2_avg, 10) AS no2_avg, no2_count FROM averages"""


def decimal_places(value: str, digits: int) -> str:
    """Half-up rounding of the printed number (a binary round differs on ties)."""
    return f"CAST(CAST(CAST(round({value}, 9) AS VARCHAR) AS DECIMAL(38, 12)) AS DECIMAL(38, {digits}))"


def averages_report(key: str, name: str) -> str:
    return f"""WITH {averages(key, name)}
SELECT CAST({name} AS VARCHAR) || chr(9) ||
       'pm25_avg=' || {decimal_places('pm25_avg', 3)} || ', pm25_count=' || pm25_count ||
       ', no2_avg=' || {decimal_places('no2_avg', 3)} || ', no2_count=' || no2_count AS value
FROM averages"""


def dirty_report(key: str, name: str, condition: str) -> str:
    return f"""WITH {DIRTY_READINGS},
averages AS (
  SELECT {key} AS {name},
         coalesce(avg(pm25), 0) AS pm25_avg, count(pm25) AS pm25_count,
         coalesce(avg(no2), 0) AS no2_avg, count(no2) AS no2_count
  FROM readings WHERE (pm25_text <> '' OR no2_text <> '') AND {condition} GROUP BY 1)
SELECT {name} || chr(9) ||
       'pm25_avg=' || {decimal_places('pm25_avg', 3)} || ', pm25_count=' || pm25_count ||
       ', no2_avg=' || {decimal_places('no2_avg', 3)} || ', no2_count=' || no2_count AS value
FROM averages"""


DIRTY_EXCEEDANCES = f"""WITH {DIRTY_READINGS}
SELECT sensor_id || chr(9) || 'pm25_exceedances=' || count(*) FILTER (WHERE pm25 > 35.4) ||
       ', no2_exceedances=' || count(*) FILTER (WHERE no2 > 100) AS value
FROM readings WHERE sensor_id <> '' AND (pm25 > 35.4 OR no2 > 100) GROUP BY sensor_id"""


def dirty_reports() -> str:
    reports = {
        "sensor_averages": dirty_report("sensor_id", "sensor_id", "sensor_id <> ''"),
        "daily_averages": dirty_report("left(time, 10)", "date", "time <> ''"),
        "hourly_averages": dirty_report("left(time, 13)", "hour", "length(time) >= 13"),
        "exceedances": DIRTY_EXCEEDANCES,
    }
    return " UNION ALL ".join(f"SELECT '{name}' AS report, value FROM ({sql})" for name, sql in reports.items())


def exceedances(pm25: float, no2: float) -> str:
    return f"""{READINGS},
exceedances AS (
  SELECT sensor_id, count(*) FILTER (WHERE pm25 > {pm25}) AS pm25_exceedances,
         count(*) FILTER (WHERE no2 > {no2}) AS no2_exceedances
  FROM readings WHERE pm25 > {pm25} OR no2 > {no2} GROUP BY sensor_id)"""


HOUR = "strftime(time, '%Y-%m-%dT%H')"
DATE = "CAST(time AS DATE)"


def all_oracles() -> dict[str, str]:
    display = ", ".join(
        f"CAST({decimal_places(c, 2)} AS DOUBLE) AS {c}"
        for c in ("pm25_avg", "pm25_min", "pm25_max", "no2_avg", "no2_min", "no2_max")
    )
    merged = ", ".join(
        f"coalesce({last_value(c, 'no2 IS NOT NULL')}, {last_value(c, 'no2 IS NULL')}) AS {c}"
        for c in ("pm25", "no2", "sensor_name", "datasourceid", "time")
    )
    merged_all = ", ".join(
        f"coalesce({last_value(c, 'no2 IS NOT NULL')}, {last_value(c, 'no2 IS NULL')}) AS {c}" for c in ALL_CELLS
    )
    numbers = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ("pm25", "no2", "humidity", "temp", "lat", "lon")) + ", location"
    upserted = ", ".join(f"{last_value(c)} AS {c}" for c in ("pm25", "no2", "sensor_name", "datasourceid", "time"))
    return {
        "readings_scan": f"WITH {READINGS} SELECT * FROM readings",
        "positional_scan": f"""WITH {READINGS}
SELECT ingest_seq, sensor_id, replace(sensor_name, '"', chr(39)) AS sensor_name,
       date_trunc('milliseconds', time) AS time, pm25, no2 FROM readings""",
        "text_file_scan": f"""WITH {READINGS}
SELECT sensor_id, replace(sensor_name, '"', chr(39)) AS sensor_name, date_trunc('milliseconds', time) AS time, pm25, no2
FROM readings""",
        "header_file_scan": f"WITH {READINGS} SELECT sensor_id, date_trunc('milliseconds', time) AS time, pm25, no2 FROM readings",
        "result_round_trip": f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary",
        "readings_long": f"""WITH {READINGS}
SELECT sensor_id, time, 'pm25' AS measure, pm25 AS value FROM readings WHERE pm25 IS NOT NULL
UNION ALL
SELECT sensor_id, time, 'no2' AS measure, no2 AS value FROM readings WHERE no2 IS NOT NULL""",
        "rowkeys": f"WITH {CELLS} SELECT ingest_seq, rowkey FROM cells",
        "per_sensor_summary": f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary ORDER BY summary.pm25_avg DESC NULLS LAST, sensor_id",
        "daily_averages": f"WITH {DAILY} SELECT * FROM daily ORDER BY date",
        "global_stats": f"""WITH {STATS}
SELECT round(pm25_mean, 8) AS pm25_mean, round(pm25_std, 8) AS pm25_std,
       round(no2_mean, 8) AS no2_mean, round(no2_std, 8) AS no2_std FROM stats""",
        "sensor_averages": averages_table("sensor_id", "sensor_id"),
        "daily_measures": averages_table(DATE, "date"),
        "hourly_averages": averages_table(HOUR, "hour"),
        "raw_hourly_averages": averages_table(HOUR, "hour"),
        "sensor_exceedances": f"WITH {exceedances(35.4, 100)} SELECT * FROM exceedances",
        "sensor_exceedances_high": f"WITH {exceedances(300, 300)} SELECT * FROM exceedances",
        "exceedance_events": f"""WITH {READINGS}
SELECT sensor_id, time, pm25, no2, coalesce(pm25 > 35.4, FALSE) AS pm25_exceeded, coalesce(no2 > 100, FALSE) AS no2_exceeded
FROM readings WHERE pm25 > 35.4 OR no2 > 100""",
        "sensor_report": averages_report("sensor_id", "sensor_id"),
        "daily_report": averages_report(DATE, "date"),
        "hourly_report": averages_report(HOUR, "hour"),
        "exceedance_report": f"""WITH {exceedances(35.4, 100)}
SELECT sensor_id || chr(9) || 'pm25_exceedances=' || pm25_exceedances || ', no2_exceedances=' || no2_exceedances AS value
FROM exceedances""",
        "anomalies": f"WITH {ANOMALIES} SELECT * FROM anomalies",
        "rolling_24h": f"WITH {ROLLING} SELECT * FROM rolling",
        "rolling_24h_spans": f"WITH {ROLLING} SELECT * FROM rolling",
        "rolling_24h_seconds": f"WITH {ROLLING} SELECT * FROM rolling",
        "rolling_24h_skewed": "WITH " + ROLLING.replace("readings AS (", "all_readings AS (", 1).replace(
            "FROM events),", """FROM events),
readings AS (
  SELECT CASE WHEN ingest_seq % 3 = 0 THEN 'busy' WHEN ingest_seq % 11 <> 0 THEN sensor_id END AS sensor_id,
         CASE WHEN ingest_seq % 50 <> 0 THEN time END AS time, pm25, no2
  FROM all_readings),""", 1) + " SELECT * FROM rolling",
        "rolling_by_days": f"WITH {ROLLING} SELECT * FROM rolling",
        "state_summary": f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS.replace(', 10)', ', 8)').replace('pm25_min, pm25_max', 'round(pm25_min, 8) AS pm25_min, round(pm25_max, 8) AS pm25_max').replace('no2_min, no2_max', 'round(no2_min, 8) AS no2_min, round(no2_max, 8) AS no2_max')} FROM summary",
        "state_daily": f"WITH {DAILY.replace(', 10)', ', 8)')} SELECT * FROM daily",
        "state_stats": f"""WITH {STATS}
SELECT round(pm25_mean, 8) AS pm25_mean, round(pm25_std, 8) AS pm25_std,
       round(no2_mean, 8) AS no2_mean, round(no2_std, 8) AS no2_std FROM stats""",
        "state_sensor_averages": averages_table("sensor_id", "sensor_id").replace(", 10)", ", 8)"),
        "state_daily_measures": averages_table(DATE, "date").replace(", 10)", ", 8)"),
        "keyed_cells": f"WITH {CELLS} SELECT * FROM cells",
        "keyed_upsert": f"WITH {DAILY_CELLS} SELECT rowkey, {upserted} FROM daily_cells GROUP BY rowkey",
        "keyed_merge": f"WITH {DAILY_CELLS} SELECT rowkey, {merged} FROM daily_cells GROUP BY rowkey",
        "keyed_families": f"""WITH {KEYED}
SELECT rowkey, pm25 AS m_pm25, no2 AS m_no2, humidity AS m_humidity, temp AS m_temp, lat AS g_lat, lon AS g_lon,
       location AS g_location, sensor_name AS meta_sensor_name, datasourceid AS meta_datasourceid, time AS meta_time
FROM keyed""",
        "stored_table": f"""WITH {DAILY_CELLS},
merged AS (SELECT rowkey, {merged_all} FROM daily_cells GROUP BY rowkey)
SELECT *, left(time, 10) AS day FROM merged""",
        "stored_conflicts": f"WITH {CONFLICTS} SELECT rowkey, any_value(day) AS day, {merged_all} FROM conflicts GROUP BY rowkey",
        "stored_conflicts_count": f"WITH {CONFLICTS} SELECT count(DISTINCT rowkey) AS row_count FROM conflicts",
        "stored_count": f"WITH {KEYED} SELECT count(*) AS row_count FROM keyed",
        "stored_prefix": f"WITH {KEYED} SELECT * FROM keyed WHERE starts_with(rowkey, '{SENSOR}_')",
        "stored_latest": f"WITH {KEYED} SELECT * FROM keyed WHERE datasourceid = '{SENSOR}' ORDER BY rowkey DESC LIMIT 1",
        "stored_latest_per_sensor": f"""WITH {KEYED}
SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY datasourceid ORDER BY rowkey DESC) = 1""",
        "stored_export": f"WITH {KEYED} SELECT {EXPORT} FROM keyed WHERE starts_with(time, '{DAY}') ORDER BY rowkey",
        "dirty_file_scan": f"""WITH {DIRTY}
SELECT sensor_id, sensor_name, TRY_CAST(time AS TIMESTAMP) AS time, {numbers} FROM dirty""",
        "inferred_file_scan": f"""WITH {RAW}
SELECT CAST(ingest_seq AS INTEGER) AS ingest_seq, CAST(sensor_id AS INTEGER) AS sensor_id, CAST(time AS TIMESTAMP) AS time,
       CAST(pm25 AS DOUBLE) AS pm25, CAST(no2 AS DOUBLE) AS no2, CAST(humidity AS INTEGER) AS humidity,
       CAST(temp AS DOUBLE) AS temp, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, location FROM raw""",
        "inferred_dirty_scan": f"""WITH {DIRTY}
SELECT TRY_CAST(sensor_id AS INTEGER) AS sensor_id, TRY_CAST(time AS TIMESTAMP) AS time, TRY_CAST(pm25 AS DOUBLE) AS pm25,
       TRY_CAST(no2 AS DOUBLE) AS no2, TRY_CAST(humidity AS INTEGER) AS humidity, TRY_CAST(temp AS DOUBLE) AS temp,
       TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon, location FROM dirty""",
        "dirty_sensor_report": dirty_report("sensor_id", "sensor_id", "sensor_id <> ''"),
        "dirty_daily_report": dirty_report("left(time, 10)", "date", "time <> ''"),
        "dirty_hourly_report": dirty_report("left(time, 13)", "hour", "length(time) >= 13"),
        "dirty_exceedance_report": DIRTY_EXCEEDANCES,
        "dirty_reports": dirty_reports(),
        "dirty_ingest": f"""WITH {DIRTY},
accepted AS (
  SELECT ingest_seq, replace(sensor_id || '_' || time, ':', '_') AS rowkey, sensor_id AS datasourceid, time,
         {', '.join(f"nullif({c}, '') AS {c}" for c in ("pm25", "no2", "sensor_name", *FURTHER))}
  FROM dirty WHERE sensor_id <> '' AND time <> '')
SELECT rowkey, {', '.join(f'{last_value(c)} AS {c}' for c in ALL_CELLS)} FROM accepted GROUP BY rowkey""",
        "dirty_points": f"""WITH {DIRTY}
SELECT sensor_id, TRY_CAST(time AS TIMESTAMP) AS time, coalesce(TRY_CAST(pm25 AS DOUBLE), 0) AS pm25
FROM dirty WHERE TRY_CAST(time AS TIMESTAMP) IS NOT NULL""",
        "table_count": f"WITH {DAILY_CELLS} SELECT count(DISTINCT rowkey) AS row_count FROM daily_cells",
        "prefix_scan": f"WITH {KEYED} SELECT * FROM keyed WHERE starts_with(rowkey, '{SENSOR}_')",
        "latest_per_sensor": f"""WITH {KEYED}
SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY datasourceid ORDER BY rowkey DESC) = 1""",
        "latest_for_sensor": f"WITH {KEYED} SELECT * FROM keyed WHERE datasourceid = '{SENSOR}' ORDER BY rowkey DESC LIMIT 1",
        "export_day": f"WITH {KEYED} SELECT {EXPORT} FROM keyed WHERE starts_with(time, '{DAY}') ORDER BY rowkey",
        "export_day_lines": f"""WITH {KEYED}
SELECT rowkey || ',' || coalesce(pm25, '') || ',' || coalesce(no2, '') || ',' || coalesce(humidity, '') || ',' ||
       coalesce(temp, '') || ',' || lat || ',' || lon || ',"' || location || '","' ||
       replace(coalesce(sensor_name, ''), '"', chr(39)) || '",' || datasourceid || ',"' || time || '"' AS value
FROM keyed WHERE starts_with(time, '{DAY}') ORDER BY rowkey""",
        "ingest_limit": f"WITH {CELLS} SELECT * FROM cells ORDER BY ingest_seq LIMIT 100",
        "ingest_limit_blocks": f"WITH {CELLS} SELECT * FROM cells ORDER BY ingest_seq LIMIT 4500",
        "summary_preview": f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary ORDER BY summary.pm25_avg DESC NULLS LAST, sensor_id LIMIT 20",
        "top_sensors": f"""WITH {SUMMARY}
SELECT {SUMMARY_COLUMNS} FROM summary ORDER BY coalesce(summary.pm25_avg, 0) DESC, sensor_id LIMIT 15""",
        "top_sensors_display": f"""WITH {SUMMARY}, top AS (SELECT * FROM summary ORDER BY pm25_avg DESC NULLS LAST, sensor_id LIMIT 15)
SELECT sensor_id, {display}, pm25_count, no2_count FROM top""",
        "daily_head": f"WITH {DAILY} SELECT * FROM daily ORDER BY date LIMIT 30",
        "daily_points": f"WITH {DAILY} SELECT date, coalesce(pm25_avg, 0) AS pm25_avg FROM daily ORDER BY date",
        "anomalies_head": f"WITH {ANOMALIES} SELECT * FROM anomalies ORDER BY time, sensor_id LIMIT 50",
        "anomaly_points": f"WITH {ANOMALIES} SELECT sensor_id, time, pm25 FROM anomalies WHERE time IS NOT NULL",
        "served_anomaly_points": f"WITH {ANOMALIES} SELECT sensor_id, time, coalesce(pm25, 0) AS pm25 FROM anomalies",
        "served_sensor_points": f"WITH {ROLLING} SELECT time, coalesce(rolling_pm25_24h, 0) AS value FROM rolling WHERE sensor_id = '{SENSOR}' ORDER BY time",
        "sensor_list": f"WITH {READINGS} SELECT DISTINCT sensor_id FROM readings ORDER BY sensor_id LIMIT 50",
        "sensor_series": f"WITH {ROLLING} SELECT * FROM rolling WHERE sensor_id = '{SENSOR}' ORDER BY time LIMIT 100",
        "sensor_points": f"WITH {ROLLING} SELECT time, rolling_pm25_24h AS value FROM rolling WHERE sensor_id = '{SENSOR}' ORDER BY time",
        "json_rows": f"""WITH {RAW}
SELECT CAST(to_json(struct_pack(ingest_seq := CAST(ingest_seq AS VARCHAR), sensor_id := sensor_id, time := time,
       pm25 := coalesce(pm25, ''), no2 := coalesce(no2, ''), sensor_name := coalesce(sensor_name, ''))) AS VARCHAR) AS json
FROM raw ORDER BY ingest_seq LIMIT 1000""",
    }
