"""Summaries, report averages, exceedances and global statistics.

Every aggregate here is decomposable, so Spark reduces each key inside the scan tasks and a key
that holds a third of all rows still sends one row per task into the shuffle.

The report operators accept raw text readings as well as typed ones. On text, a measure is
*present* when it is non-empty, even if it does not parse.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.text import three_decimals, to_report_number
from gaugeworks.sources.readings import MEASURES

# Default exceedance thresholds.
DEFAULT_THRESHOLDS = {"pm25": 35.4, "no2": 100.0}


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _number(df: DataFrame, name: str) -> Column:
    return to_report_number(F.col(name)) if _is_text(df, name) else F.col(name)


def _present(df: DataFrame, name: str) -> Column:
    return F.col(name) != "" if _is_text(df, name) else F.col(name).isNotNull()


# --- summaries ---------------------------------------------------------------------------------


def per_sensor_summary(readings: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Average, minimum, maximum and count of each measure per sensor; keeps every sensor."""
    aggs = []
    for m in measures:
        aggs += [
            F.avg(m).alias(f"{m}_avg"),
            F.min(m).alias(f"{m}_min"),
            F.max(m).alias(f"{m}_max"),
            F.count(m).alias(f"{m}_count"),
        ]
    return readings.groupBy("sensor_id").agg(*aggs).orderBy(F.desc_nulls_last(f"{measures[0]}_avg"), "sensor_id")


def daily_averages(readings: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Average of each measure and count of all readings per date; keeps the null date."""
    return (
        readings.groupBy(F.to_date("time").alias("date"))
        .agg(*[F.avg(m).alias(f"{m}_avg") for m in measures], F.count(F.lit(1)).alias("records"))
        .orderBy("date")
    )


def global_stats(readings: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """One row: mean and sample standard deviation of each measure, 0.0 where undefined."""
    aggs = []
    for m in measures:
        aggs += [
            F.coalesce(F.avg(m), F.lit(0.0)).alias(f"{m}_mean"),
            F.coalesce(F.stddev_samp(m), F.lit(0.0)).alias(f"{m}_std"),
        ]
    return readings.agg(*aggs)


# --- report averages ---------------------------------------------------------------------------


def report_averages(df: DataFrame, key: Column, name: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Average (0.0 when nothing parses) and count of each measure per key.

    A key appears only if at least one of its readings has some measure present.
    """
    aggs = []
    for m in measures:
        aggs += [
            F.coalesce(F.avg(f"_{m}"), F.lit(0.0)).alias(f"{m}_avg"),
            F.count(f"_{m}").alias(f"{m}_count"),
        ]
    return (
        df.filter(reduce(or_, [_present(df, m) for m in measures]))
        .select(key.alias(name), *[_number(df, m).alias(f"_{m}") for m in measures])
        .groupBy(name)
        .agg(*aggs)
    )


def sensor_averages(df: DataFrame) -> DataFrame:
    """Report averages per sensor; readings without an id are dropped."""
    return report_averages(df.filter(F.col("sensor_id") != ""), F.col("sensor_id"), "sensor_id")


def daily_measures(df: DataFrame) -> DataFrame:
    """Report averages per day: the date, or the first ten characters of a text time."""
    if _is_text(df, "time"):
        return report_averages(df.filter(F.col("time") != ""), F.substring("time", 1, 10), "date")
    return report_averages(df.filter(F.col("time").isNotNull()), F.to_date("time"), "date")


def hourly_averages(df: DataFrame) -> DataFrame:
    """Report averages per hour, keyed ``yyyy-MM-ddTHH``.

    Text times shorter than that are dropped. Typed times are grouped by whole hours of their own clock,
    whatever the session's zone, and labelled afterwards, once per group.
    """
    if _is_text(df, "time"):
        return report_averages(df.filter(F.length("time") >= 13), F.substring("time", 1, 13), "hour")
    hour = F.struct(F.to_date("time").alias("date"), F.hour("time").alias("hour"))
    hours = report_averages(df.filter(F.col("time").isNotNull()), hour, "hour")
    label = F.concat(F.col("hour.date").cast("string"), F.lit("T"), F.lpad(F.col("hour.hour").cast("string"), 2, "0"))
    return hours.withColumn("hour", label)


def averages_report(averages: DataFrame, key: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Report averages as sorted text lines: key, tab, ``pm25_avg=…, pm25_count=…, …``."""
    return averages.orderBy(key).select(_line(key, _average_parts(measures)).alias("value"))


def _average_parts(measures: Iterable[str]) -> list[Column]:
    parts = []
    for m in measures:
        parts += [
            F.concat(F.lit(f"{m}_avg="), three_decimals(F.col(f"{m}_avg"))),
            F.concat(F.lit(f"{m}_count="), F.col(f"{m}_count").cast("string")),
        ]
    return parts


def _line(key: str, parts: list[Column]) -> Column:
    return F.concat(F.col(key).cast("string"), F.lit("\t"), F.concat_ws(", ", *parts))


# --- exceedances -------------------------------------------------------------------------------


def _above(df: DataFrame, name: str, threshold: float) -> Column:
    # NaN sorts above every number in Spark, but is no exceedance.
    value = _number(df, name)
    return (value > F.lit(float(threshold))) & ~F.isnan(value)


def exceedance_events(df: DataFrame, thresholds: dict[str, float] = DEFAULT_THRESHOLDS) -> DataFrame:
    """Readings strictly above a threshold, with one flag per measure."""
    flags = {f"{m}_exceeded": F.coalesce(_above(df, m, t), F.lit(False)) for m, t in thresholds.items()}
    kept = df.filter((F.col("sensor_id") != "") & reduce(or_, [_above(df, m, t) for m, t in thresholds.items()]))
    return kept.select("sensor_id", "time", *thresholds, *[flag.alias(name) for name, flag in flags.items()])


def sensor_exceedances(df: DataFrame, thresholds: dict[str, float] = DEFAULT_THRESHOLDS) -> DataFrame:
    """Number of exceedances of each measure per sensor; sensors without any are absent."""
    return (
        exceedance_events(df, thresholds)
        .groupBy("sensor_id")
        .agg(*[F.count_if(F.col(f"{m}_exceeded")).alias(f"{m}_exceedances") for m in thresholds])
    )


def exceedances_report(exceedances: DataFrame) -> DataFrame:
    """Exceedance counts as sorted text lines: id, tab, ``pm25_exceedances=N, …``."""
    measures = [c.removesuffix("_exceedances") for c in exceedances.columns if c != "sensor_id"]
    return exceedances.orderBy("sensor_id").select(_line("sensor_id", _exceedance_parts(measures)).alias("value"))


def _exceedance_parts(measures: Iterable[str]) -> list[Column]:
    return [F.concat(F.lit(f"{m}_exceedances="), F.col(f"{m}_exceedances").cast("string")) for m in measures]


# --- all reports in one pass -------------------------------------------------------------------

SENSOR_REPORT, DAY_REPORT, HOUR_REPORT, EXCEEDANCE_REPORT = REPORTS = ("sensor_averages", "daily_averages", "hourly_averages", "exceedances")


def all_reports(raw: DataFrame, thresholds: dict[str, float] = DEFAULT_THRESHOLDS, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """The four text reports of raw text readings from one scan and one shuffle: ``report, value``, sorted by report and key.

    A reading is parsed once and tagged with the reports and keys that it counts for; a key is reduced inside the scan tasks.
    """
    present = reduce(or_, [_present(raw, m) for m in measures])
    above = {m: F.coalesce(_above(raw, m, t), F.lit(False)) for m, t in thresholds.items()}
    tagged = {
        SENSOR_REPORT: (present & (F.col("sensor_id") != ""), F.col("sensor_id")),
        DAY_REPORT: (present & (F.col("time") != ""), F.substring("time", 1, 10)),
        HOUR_REPORT: (present & (F.length("time") >= 13), F.substring("time", 1, 13)),
        EXCEEDANCE_REPORT: ((F.col("sensor_id") != "") & reduce(or_, above.values()), F.col("sensor_id")),
    }
    tags = [F.when(counts, F.struct(F.lit(name).alias("report"), key.alias("key"))) for name, (counts, key) in tagged.items()]
    numbers = [_number(raw, m).alias(f"_{m}") for m in measures]
    flags = [flag.alias(f"_{m}_above") for m, flag in above.items()]
    rows = raw.select(F.explode(F.filter(F.array(*tags), lambda tag: tag.isNotNull())).alias("tag"), *numbers, *flags)
    aggs = []
    for m in measures:
        aggs += [F.coalesce(F.avg(f"_{m}"), F.lit(0.0)).alias(f"{m}_avg"), F.count(f"_{m}").alias(f"{m}_count")]
    aggs += [F.count_if(F.col(f"_{m}_above")).alias(f"{m}_exceedances") for m in thresholds]
    keys = rows.groupBy(F.col("tag.report").alias("report"), F.col("tag.key").alias("key")).agg(*aggs)
    exceeded = _line("key", _exceedance_parts(thresholds))
    line = F.when(F.col("report") == EXCEEDANCE_REPORT, exceeded).otherwise(_line("key", _average_parts(measures)))
    return keys.orderBy("report", "key").select("report", line.alias("value"))
