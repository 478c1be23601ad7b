"""Ordered, limited slices and JSON rows for presentation.

Each limit is a fixed small number of rows over a total order, which Spark plans as a top-n: every
task keeps its own first rows and only those are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.text import as_text
from gaugeworks.operators.rolling import rolling_24h
from gaugeworks.sources.readings import MEASURES

# Rows shown per view.
TOP_SENSORS = 15
DAYS_SHOWN = 30
ANOMALIES_SHOWN = 50
SENSORS_SHOWN = 50
SERIES_ROWS = 100
SERVED_ROWS = 1000
PREVIEWED = 20
# Columns that may hold the rolling measure, best first.
ROLLING_COLUMNS = ("rolling_pm25_24h", "rolling_pm25", "pm25")


def preview(result: DataFrame, n: int = PREVIEWED) -> DataFrame:
    """First rows of a result, in its order."""
    return result.limit(n)


def top_sensors(summary: DataFrame, n: int = TOP_SENSORS, null_as_zero: bool = True) -> DataFrame:
    """Sensors with the highest pm25 average; a missing average counts as 0, or sorts last."""
    average = F.coalesce("pm25_avg", F.lit(0.0)) if null_as_zero else F.col("pm25_avg")
    return summary.orderBy(average.desc_nulls_last(), "sensor_id").limit(n)


def daily_head(daily: DataFrame, n: int = DAYS_SHOWN) -> DataFrame:
    """First days in date order."""
    return daily.orderBy("date").limit(n)


def daily_points(daily: DataFrame) -> DataFrame:
    """Date and pm25 average of every day, a missing average as 0."""
    return daily.select("date", F.coalesce("pm25_avg", F.lit(0.0)).alias("pm25_avg")).orderBy("date")


def anomalies_head(anomalies: DataFrame, n: int = ANOMALIES_SHOWN) -> DataFrame:
    """First anomalies in time order."""
    return anomalies.orderBy("time", "sensor_id", *MEASURES).limit(n)


def anomaly_points(anomalies: DataFrame) -> DataFrame:
    """Time and pm25 of the anomalies whose time is known."""
    return anomalies.filter(F.col("time").isNotNull()).select("sensor_id", "time", "pm25")


def served_anomaly_points(anomalies: DataFrame) -> DataFrame:
    """Time and pm25 of every anomaly, a missing pm25 as 0."""
    return anomalies.select("sensor_id", "time", F.coalesce("pm25", F.lit(0.0)).alias("pm25"))


def sensor_list(rows: DataFrame, n: int = SENSORS_SHOWN) -> DataFrame:
    """First sensors, each once, in id order."""
    return rows.select("sensor_id").distinct().orderBy("sensor_id").limit(n)


def rolling_value(df: DataFrame) -> Column:
    """The first rolling pm25 column that the result has."""
    return F.col(next(c for c in ROLLING_COLUMNS if c in df.columns))


def served_rolling_value(df: DataFrame) -> Column:
    """The first rolling pm25 value that a row has, else 0."""
    present = [F.col(c) for c in ROLLING_COLUMNS[:2] if c in df.columns]
    return F.coalesce(*present, F.lit(0.0))


def sensor_series(readings: DataFrame, sensor_id: str, n: int = SERIES_ROWS) -> DataFrame:
    """First rows of one sensor's rolling averages in time order; only that sensor is computed."""
    rolled = rolling_24h(readings.filter(F.col("sensor_id") == sensor_id))
    return rolled.orderBy("time", *rolled.columns[2:]).limit(n)


def sensor_points(readings: DataFrame, sensor_id: str) -> DataFrame:
    """Time and rolling pm25 of one sensor, whole series, in time order."""
    rolled = rolling_24h(readings.filter(F.col("sensor_id") == sensor_id))
    return rolled.select("time", rolling_value(rolled).alias("value")).orderBy("time")


def display_rows(df: DataFrame, digits: int = 2) -> DataFrame:
    """Doubles rounded for display.

    Rounding to 9 digits first removes summation-order noise just below a tie.
    """
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(F.round(c, 9), digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def json_rows(df: DataFrame, *order: str, n: int = SERVED_ROWS) -> DataFrame:
    """First rows as JSON objects; every value is text, absent values are empty."""
    texts = [as_text(F.col(c)).alias(c) for c in df.columns]
    return df.orderBy(*order).limit(n).select(F.to_json(F.struct(*texts)).alias("json"))
