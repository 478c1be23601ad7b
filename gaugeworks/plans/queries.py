"""Registered queries: every operator over the whole ``events`` table.

Computed averages are rounded here (not in the operators), because the last bits of a floating
point sum depend on the order in which partitions are added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.text import as_text, quoted, row_key
from gaugeworks.functions.time import iso_millis, on_day
from gaugeworks.operators import aggregates as agg
from gaugeworks.operators import arriving, keyed, rolling, serving, stored
from gaugeworks.operators.anomalies import anomalies
from gaugeworks.session import fresh_folder
from gaugeworks.sources.inference import scan_inferred
from gaugeworks.sources.readings import (
    FIELD_POSITIONS,
    HEADERS,
    MEASURES,
    MIN_FIELDS,
    from_events,
    parse_lines,
    scan_by_header,
    scan_positional,
    to_long,
    typed,
)
from gaugeworks.sources.results import read_result, write_csv

DIGITS = 10
ROLLING_DIGITS = 8
SENSOR = "7"
DAY = "2024-01-05"
HIGH_THRESHOLDS = {"pm25": 300.0, "no2": 300.0}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


# The further cells of a reading, as text made from its number; some are missing.
FURTHER_CELLS = {
    "humidity": "if(ingest_seq % 7 = 0, '', cast(ingest_seq % 100 AS string))",
    "temp": "if(ingest_seq % 5 = 0, '', concat(cast(ingest_seq % 40 AS string), '.5'))",
    "lat": "concat('41.', lpad(cast(ingest_seq % 1000 AS string), 3, '0'))",
    "lon": "concat('-87.', lpad(cast(ingest_seq % 1000 AS string), 3, '0'))",
    "location": "concat('POINT (-87.', lpad(cast(ingest_seq % 1000 AS string), 3, '0'), ' 41.', lpad(cast(ingest_seq % 1000 AS string), 3, '0'), ')')",
}


def as_raw(typed_rows: DataFrame) -> DataFrame:
    """Typed readings as text, the way the positional scan delivers them."""
    return typed_rows.select(
        "ingest_seq",
        "sensor_id",
        iso_millis(F.col("time")).alias("time"),
        *[as_text(F.col(c)).alias(c) for c in ("pm25", "no2", "sensor_name")],
        *[F.expr(text).alias(c) for c, text in FURTHER_CELLS.items()],
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(readings(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings written out as the quoted text lines of a readings file."""
    return raw_readings(spark, sf_dir).select("ingest_seq", F.concat_ws(",", *line_fields()).alias("value"))


def line_fields() -> list[Column]:
    filled = {pos: name for name, pos in FIELD_POSITIONS.items()}
    return [quoted(F.col(filled[i])) if i in filled else F.lit("") for i in range(MIN_FIELDS)]


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which known shares are short, long, padded, header-like, or hold bad or missing values, by number modulo 20."""
    turn = F.col("ingest_seq") % 20

    def spoiled(name: str, cases: dict[int, Column]) -> Column:
        value = F.col(name)
        for k, other in cases.items():
            value = F.when(turn == k, other).otherwise(value)
        return value.alias(name)

    raw = raw_readings(spark, sf_dir)
    cases = {
        "sensor_id": {2: F.concat(F.lit(" \t"), "sensor_id", F.lit("  ")), 3: F.lit("datasourceid"), 6: F.lit("")},
        "time": {5: F.lit("not a time at all"), 7: F.lit(""), 9: F.concat(F.substring("time", 1, 4), F.lit("x"))},
        "pm25": {4: F.lit("abc"), 10: F.lit("")},
        "no2": {4: F.lit("1,5"), 10: F.lit("")},
        "sensor_name": {8: F.concat(F.lit("a, b, "), "sensor_name")},
    }
    rows = raw.select(*[spoiled(c, cases[c]) if c in cases else F.col(c) for c in raw.columns])
    fields = F.array(*line_fields())
    fields = F.when(turn == 0, F.slice(fields, 1, MIN_FIELDS - 1)).when(turn == 1, F.concat(fields, F.array(F.lit("x"), F.lit('"y,z"')))).otherwise(fields)
    return rows.select("ingest_seq", F.array_join(fields, ",").alias("value"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.to_cells(raw_readings(spark, sf_dir))


def daily_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells keyed by sensor and day only, so that many readings share a key."""
    by_day = raw_readings(spark, sf_dir).withColumn("time", F.substring("time", 1, 10))
    return keyed.to_cells(by_day)


def ingest_block() -> Column:
    """A coarse part of the ingest order, standing for the blocks of a file."""
    return F.floor(F.col("ingest_seq") / 1000)


def table(rows: DataFrame) -> DataFrame:
    """Typed readings ingested into an empty keyed table."""
    return keyed.reduce_batch(keyed.to_cells(as_raw(rows)), list(keyed.CELLS))


def latest_for_sensor(rows: DataFrame) -> DataFrame:
    return keyed.latest_for_sensor(table(rows.filter(F.col("sensor_id") == SENSOR)), SENSOR)


def exported_day(rows: DataFrame) -> DataFrame:
    return keyed.export_day(table(rows.filter(on_day(rows, "time", DAY))), DAY)


MERGED_CELLS = ["pm25", "no2", "sensor_name", "datasourceid", "time"]


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.reduce_batch(daily_cells(spark, sf_dir), MERGED_CELLS)


def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests over the whole table: readings without no2 first, those with no2 second."""
    rows = daily_cells(spark, sf_dir)
    first = keyed.reduce_batch(rows.filter(F.col("no2").isNull()), MERGED_CELLS)
    second = keyed.reduce_batch(rows.filter(F.col("no2").isNotNull()), MERGED_CELLS)
    return keyed.upsert(first, second, MERGED_CELLS)


def rowkeys(rows: DataFrame) -> DataFrame:
    return rows.select("ingest_seq", row_key(F.col("sensor_id"), iso_millis(F.col("time"))).alias("rowkey"))


def positional_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = typed(parse_lines(lines(spark, sf_dir)))
    return parsed.select("ingest_seq", "sensor_id", "sensor_name", "time", "pm25", "no2")


# --- queries over files that Spark writes from the table first ---------------------------------


def new_folder(spark: SparkSession) -> str:
    return fresh_folder(spark, spark.conf.get("spark.sql.warehouse.dir"))


def text_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    lines(spark, sf_dir).select("value").write.text(path)
    return typed(scan_positional(spark, path)).select("sensor_id", "sensor_name", "time", "pm25", "no2")


def dirty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    dirty_lines(spark, sf_dir).select("value").write.text(path)
    return scan_positional(spark, path)


def dirty_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["sensor_id", "sensor_name", "time", "pm25", "no2", "humidity", "temp", "lat", "lon", "location"]
    return typed(dirty_readings(spark, sf_dir)).select(*columns)


def on_dirty(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(dirty_readings(spark, sf_dir))


def dirty_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty readings whose time parses, as the points of a series."""
    rows = typed(dirty_readings(spark, sf_dir)).where("time IS NOT NULL")
    return rows.select("sensor_id", "time", F.coalesce("pm25", F.lit(0.0)).alias("pm25"))


def header_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    raw = raw_readings(spark, sf_dir).select("sensor_name", *HEADERS).withColumnsRenamed(HEADERS)
    raw.write.option("header", True).option("escape", '"').csv(path)
    return scan_by_header(spark, path)


def result_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    write_csv(agg.per_sensor_summary(readings(spark, sf_dir)), path)
    return rounded(read_result(spark, path))


def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two ingests of ``keyed_merge`` into a stored table."""
    path, rows = new_folder(spark), daily_cells(spark, sf_dir)
    return ingested_twice(spark, path, rows)


def ingested_twice(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """A stored table of cells without no2, into which those with no2 are merged."""
    batch = new_folder(spark)
    stored.write_table(keyed.reduce_batch(rows.filter(F.col("no2").isNull()), list(keyed.CELLS)), path)
    keyed.reduce_batch(rows.filter(F.col("no2").isNotNull()), list(keyed.CELLS)).write.parquet(batch)
    stored.merge_into_table(spark, path, spark.read.parquet(batch))
    return stored.read_table(spark, path)


def stored_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``stored_table``, but the day stands in the id of readings without no2 and in the time of the others.

    Equal keys come with times of different days, or of none.
    """
    raw = raw_readings(spark, sf_dir)
    day, hour = F.substring("time", 1, 10), F.substring("time", 12, 2)
    without = F.col("no2") == ""
    rows = raw.withColumns(
        {
            "sensor_id": F.when(without, F.concat_ws("_", "sensor_id", day)).otherwise(F.col("sensor_id")),
            "time": F.when(without, hour).otherwise(F.concat_ws("_", day, hour)),
        }
    )
    return ingested_twice(spark, new_folder(spark), keyed.to_cells(rows))


def on_stored(operator: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``operator`` (of a session and a stored table) over all readings, ingested into a stored table first."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_folder(spark)
        stored.write_table(table(readings(spark, sf_dir)), path)
        return operator(spark, path)

    return query


def skewed(rows: DataFrame) -> DataFrame:
    """A third of the readings on one sensor, some without a sensor, some without a time."""
    seq = F.col("ingest_seq")
    sensor = F.when(seq % 3 == 0, "busy").when(seq % 11 != 0, F.col("sensor_id"))
    return rows.withColumns({"sensor_id": sensor, "time": F.when(seq % 50 != 0, F.col("time"))})


def served_points(rows: DataFrame) -> DataFrame:
    """One sensor's series of 24-hour averages; where one is missing, 0."""
    rolled = rolling.rolling_24h(rows.filter(F.col("sensor_id") == SENSOR))
    return rolled.select("time", serving.served_rolling_value(rolled).alias("value")).orderBy("time")


# --- days that arrive --------------------------------------------------------------------------


def in_batches(rows: DataFrame, batches: int = 3) -> list[DataFrame]:
    """The readings in batches of whole days, in order."""
    first, last = rows.agg(F.min(F.to_date("time")), F.max(F.to_date("time"))).first()
    if first is None:
        return [rows]
    days = (last - first).days + 1
    number = F.coalesce(F.floor(F.date_diff(F.to_date("time"), F.lit(first)) * batches / F.lit(days)), F.lit(0))
    return [rows.filter(number == k) for k in range(batches)]


def from_states(operator: Callable[[DataFrame], DataFrame], digits: int = ROLLING_DIGITS) -> Callable[[SparkSession, str], DataFrame]:
    """``operator`` on the states of readings that come in batches."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_folder(spark)
        for k, batch in enumerate(in_batches(readings(spark, sf_dir))):
            arriving.add_states(path, str(k), batch)
        return rounded(operator(arriving.read_states(spark, path)), digits)

    return query


def rolling_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24-hour averages of readings that come in batches of days."""
    path = new_folder(spark)
    for batch in in_batches(readings(spark, sf_dir).select("sensor_id", "time", *MEASURES)):
        arriving.add_rolling(spark, path, batch)
    rolled = arriving.read_rolling(spark, path)
    return rounded(rolled.select("sensor_id", "time", *[F.col(f"rolling_{m}").alias(f"rolling_{m}_24h") for m in MEASURES]), ROLLING_DIGITS)


def inferred_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of a headered file under inferred types."""
    path = new_folder(spark)
    raw_readings(spark, sf_dir).drop("sensor_name").write.option("header", True).option("escape", '"').csv(path)
    return scan_inferred(spark, path)


def inferred_dirty_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a file in which up to a quarter of a column's values may be bad."""
    path = new_folder(spark)
    dirty_readings(spark, sf_dir).drop("ingest_seq", "sensor_name").write.option("header", True).option("escape", '"').csv(path)
    return scan_inferred(spark, path, bad=0.25)


# --- registry ----------------------------------------------------------------------------------


def families(rows: DataFrame) -> DataFrame:
    flat = [F.col(f"{family}.{cell}").alias(f"{family}_{cell}") for family, names in keyed.FAMILIES.items() for cell in names]
    return keyed.by_family(table(rows)).select("rowkey", *flat)


def report(averages: Callable[[DataFrame], DataFrame], key: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: agg.averages_report(averages(readings(spark, sf_dir)), key)


def on_readings(operator: Callable[[DataFrame], DataFrame], digits: int | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = operator(readings(spark, sf_dir))
        return result if digits is None else rounded(result, digits)

    return query


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # scans and projections
        "readings_scan": on_readings(lambda r: r),
        "positional_scan": positional_scan,
        "text_file_scan": text_file_scan,
        "header_file_scan": header_file_scan,
        "inferred_file_scan": inferred_file_scan,
        "inferred_dirty_scan": inferred_dirty_scan,
        "result_round_trip": result_round_trip,
        "readings_long": on_readings(to_long),
        "rowkeys": on_readings(rowkeys),
        # aggregations
        "per_sensor_summary": on_readings(agg.per_sensor_summary, DIGITS),
        "daily_averages": on_readings(agg.daily_averages, DIGITS),
        "global_stats": on_readings(agg.global_stats, ROLLING_DIGITS),
        "sensor_averages": on_readings(agg.sensor_averages, DIGITS),
        "daily_measures": on_readings(agg.daily_measures, DIGITS),
        "hourly_averages": on_readings(agg.hourly_averages, DIGITS),
        "raw_hourly_averages": lambda s, d: rounded(agg.hourly_averages(raw_readings(s, d))),
        "sensor_exceedances": on_readings(agg.sensor_exceedances),
        "sensor_exceedances_high": on_readings(lambda r: agg.sensor_exceedances(r, HIGH_THRESHOLDS)),
        "exceedance_events": on_readings(agg.exceedance_events),
        # text reports
        "sensor_report": report(agg.sensor_averages, "sensor_id"),
        "daily_report": report(agg.daily_measures, "date"),
        "hourly_report": report(agg.hourly_averages, "hour"),
        "exceedance_report": on_readings(lambda r: agg.exceedances_report(agg.sensor_exceedances(r))),
        # anomalies and rolling averages
        "anomalies": on_readings(anomalies),
        "rolling_24h": on_readings(rolling.rolling_24h, ROLLING_DIGITS),
        # the same with slices of half a day and of a second
        "rolling_24h_spans": on_readings(lambda r: rolling.rolling_24h(r, slices=2), ROLLING_DIGITS),
        "rolling_24h_seconds": on_readings(lambda r: rolling.rolling_24h(r, slices=rolling.DAY_SECONDS), ROLLING_DIGITS),
        "rolling_24h_skewed": on_readings(lambda r: rolling.rolling_24h(skewed(r)), ROLLING_DIGITS),
        # days that arrive
        "rolling_by_days": rolling_by_days,
        "state_summary": from_states(arriving.summary_of),
        "state_daily": from_states(arriving.daily_averages_of),
        "state_stats": from_states(arriving.global_stats_of),
        "state_sensor_averages": from_states(lambda s: arriving.report_averages_of(s, "sensor_id")),
        "state_daily_measures": from_states(lambda s: arriving.report_averages_of(s, "date")),
        # keyed table
        "keyed_cells": cells,
        "keyed_upsert": keyed_upsert,
        "keyed_merge": keyed_merge,
        "keyed_families": on_readings(families),
        "stored_table": stored_table,
        "table_count": lambda s, d: keyed.table_count(keyed_upsert(s, d)),
        "prefix_scan": on_readings(lambda r: keyed.prefix_scan(table(r), f"{SENSOR}_")),
        "latest_per_sensor": on_readings(lambda r: keyed.latest_per_sensor(table(r))),
        "latest_for_sensor": on_readings(latest_for_sensor),
        "export_day": on_readings(exported_day),
        "export_day_lines": on_readings(lambda r: keyed.export_lines(exported_day(r))),
        "ingest_limit": lambda s, d: keyed.first_accepted(cells(s, d), 100, ingest_block(), F.col("ingest_seq")),
        "ingest_limit_blocks": lambda s, d: keyed.first_accepted(cells(s, d), 4500, ingest_block(), F.col("ingest_seq")),
        # the same over a stored table
        "stored_conflicts": stored_conflicts,
        "stored_conflicts_count": lambda s, d: keyed.table_count(stored_conflicts(s, d)),
        "stored_count": on_stored(stored.count_rows),
        "stored_prefix": on_stored(lambda s, t: stored.prefix_scan(s, t, f"{SENSOR}_").drop("day")),
        "stored_latest": on_stored(lambda s, t: stored.latest_for_sensor(s, t, SENSOR).drop("day")),
        "stored_latest_per_sensor": on_stored(lambda s, t: stored.latest_per_sensor(s, t).drop("day")),
        "stored_export": on_stored(lambda s, t: keyed.export_day(stored.read_table(s, t), DAY)),
        # dirty files
        "dirty_file_scan": dirty_file_scan,
        "dirty_sensor_report": on_dirty(lambda r: agg.averages_report(agg.sensor_averages(r), "sensor_id")),
        "dirty_daily_report": on_dirty(lambda r: agg.averages_report(agg.daily_measures(r), "date")),
        "dirty_hourly_report": on_dirty(lambda r: agg.averages_report(agg.hourly_averages(r), "hour")),
        "dirty_exceedance_report": on_dirty(lambda r: agg.exceedances_report(agg.sensor_exceedances(r))),
        "dirty_reports": on_dirty(agg.all_reports),
        "dirty_ingest": on_dirty(lambda r: keyed.reduce_batch(keyed.to_cells(r), list(keyed.CELLS))),
        "dirty_points": dirty_points,
        # presentation slices
        "summary_preview": on_readings(lambda r: serving.preview(agg.per_sensor_summary(r)), DIGITS),
        "top_sensors": on_readings(lambda r: serving.top_sensors(agg.per_sensor_summary(r)), DIGITS),
        "top_sensors_display": on_readings(
            lambda r: serving.display_rows(serving.top_sensors(agg.per_sensor_summary(r), null_as_zero=False))
        ),
        "daily_head": on_readings(lambda r: serving.daily_head(agg.daily_averages(r)), DIGITS),
        "daily_points": on_readings(lambda r: serving.daily_points(agg.daily_averages(r)), DIGITS),
        "anomalies_head": on_readings(lambda r: serving.anomalies_head(anomalies(r))),
        "anomaly_points": on_readings(lambda r: serving.anomaly_points(anomalies(r))),
        "served_anomaly_points": on_readings(lambda r: serving.served_anomaly_points(anomalies(r))),
        "served_sensor_points": on_readings(served_points, ROLLING_DIGITS),
        "sensor_list": on_readings(serving.sensor_list),
        "sensor_series": on_readings(lambda r: serving.sensor_series(r, SENSOR), ROLLING_DIGITS),
        "sensor_points": on_readings(lambda r: serving.sensor_points(r, SENSOR), ROLLING_DIGITS),
        "json_rows": lambda s, d: serving.json_rows(raw_readings(s, d).drop(*FURTHER_CELLS), "ingest_seq"),
    }
